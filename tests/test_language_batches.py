"""Stems and common subsequences of Arrow batches, whatever their rows hold."""

import random

import pyarrow as pa

from lexflume.functions import language

LISTS = pa.list_(pa.string())


def test_batches_are_cut_into_slices_of_bounded_items(monkeypatch):
    monkeypatch.setattr(language, "SLICE_ITEMS", 10)
    rng = random.Random(5)
    rows = [[rng.choice(["running", "cats", "b", None]) for _ in range(rng.choice([0, 3, 25]))] for _ in range(80)] + [None, []]
    other = rows[::-1]
    a, b = pa.array(rows, LISTS), pa.array(other, LISTS)
    assert len(list(language._slices(a))) > 20
    wanted = [language.lcs_length(x or [], y or []) for x, y in zip(rows, other, strict=True)]
    assert language.lcs_lengths(a, b).to_pylist() == wanted
    assert language.lcs_lengths(a.slice(40), b.slice(40)).to_pylist() == wanted[40:]
    assert language.lcs_lengths(a[:0], b[:0]).to_pylist() == []


def test_stems_keep_null_arrays_and_slices():
    rows = [["running", "cats", "running"], None, [], ["flies"]]
    wanted = [None if r is None else [language.stem(t) for t in r] for r in rows]
    assert language.stems_of(pa.array(rows, LISTS), language.stem).to_pylist() == wanted
    assert language.stems_of(pa.array(rows, LISTS).slice(1), language.stem).to_pylist() == wanted[1:]
