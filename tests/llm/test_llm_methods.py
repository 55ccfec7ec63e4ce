"""The methods themselves against brute force."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexflume.llm import exact_dedup as ex
from lexflume.llm import embedding_dedup, hnsw, lm, minhash, toxicity
from lexflume.llm.bpe import Bpe


def test_quotient_filters_merge_losslessly():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 2**64, 500, np.uint64) for _ in range(3)]
    parts[1][:100] = parts[0][:100]
    bits = 56 - ex.QUOTIENT_BITS
    filters = {}
    for part in parts:
        for s, f in ex.partition_filters(part, 8):
            filters.setdefault(s, []).append(ex.QuotientFilter.of_row(*f.to_row()))
    found = {}
    for s, held in filters.items():
        merged = ex.QuotientFilter.merged(held, bits)
        found |= {(s << 56) | int(e): int(c) for e, c in zip(merged.entries(bits), merged.counts, strict=True)}
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert found == dict(zip(map(int, values), map(int, counts), strict=True))


@pytest.mark.parametrize("text", ["", "the the", "a<|endoftext|>b", "x" * 300, "é漢字😀 1234  \n\t x", "''ll're", "----....----"])
def test_bpe_equals_the_tokenizers_library(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        ours = Bpe(f.read())
    theirs = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    ids = ours.encode_batch([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == theirs
    assert ours.decode(ids) == text


def test_graph_finds_what_a_scan_finds():
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 16))
    points = np.concatenate([base, np.repeat(base[:5], 40, axis=0) + r.normal(0, 0.05, (200, 16)), r.normal(size=(300, 16))])
    units = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    levels = hnsw.levels_of(np.arange(len(units)))
    order = np.argsort(-levels, kind="stable")
    graph = hnsw.Graph.built(units[order], levels[order])
    found = graph.within(units[order], np.arange(len(units)), 0.93, 32)
    for a, b in zip(found, graph.scan(units[order], 0.93), strict=True):
        assert sorted(a) == sorted(b)


def test_audit_sees_missed_neighbours_where_links_are_rare():
    r = np.random.default_rng(4)
    half = 150
    nodes, queries = r.normal(size=(2 * half, 16)), r.normal(size=(200, 16))
    audited = np.linspace(0, 199, embedding_dedup.AUDITED).astype(int)
    planted = np.setdiff1d(np.arange(200), audited)[:5]
    queries[planted] = nodes[half : half + 5] * 2  # copies of nodes that no link leads to
    links = np.full((2 * half, 32), -1)
    links[:half] = r.integers(0, half, (half, 32))
    graph = hnsw.Graph(embedding_dedup._units(nodes), np.zeros(2 * half, int), [links])
    found = embedding_dedup.audited_links(graph, nodes, queries, np.full(200, -1), 0.93)
    assert [nodes_of.tolist() for nodes_of in (found[i] for i in planted)] == [[half + i] for i in range(5)]


def test_shingle_sets():
    assert len(minhash.shingle_set(b"", 2)) == 0
    assert len(minhash.shingle_set(b"a b a b", 2)) == 2
    assert len(minhash.shingle_set(b"a b", 5)) == 1
    assert 0 < minhash.least_overlap(0.8) < minhash.SKETCH * 0.8


def test_ordinal_thresholds_are_ordered_and_separate():
    rows = [[0]] * 30 + [[1]] * 30 + [[1, 2]] * 30
    grades = np.array([0] * 30 + [1] * 30 + [2] * 30)
    model = toxicity.fit_ordinal(rows, grades, 3)
    assert (np.diff(model.thresholds) > 0).all()
    scores = np.array([model.weights[r].sum() for r in rows])
    assert ((model.at_least(scores) > 0.5).sum(axis=1) == grades).all()


def test_model_probabilities_sum_to_one():
    model = lm.Bilinear.fresh(np.log(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    before = np.tile([[3, 7]], (lm.CLASSES, 1))
    assert np.exp(model.log_probabilities(before, np.arange(lm.CLASSES))).sum() == pytest.approx(1, abs=1e-5)


def test_slice_bits_of_alike_and_unlike_sets():
    rng = np.random.default_rng(3)

    def apart(a, b):
        x = minhash.slice_bits(np.sort(a)) ^ minhash.slice_bits(np.sort(b))
        return int(np.unpackbits(x.view(np.uint8)).sum())

    limit = minhash.most_bits_apart(0.8)
    far = []
    for n in (1, 5, 40, 300, 5000):
        for _ in range(20):
            both = rng.integers(0, 2**62, n)
            more = rng.integers(0, 2**62, n // 4)
            assert apart(both, np.concatenate([both, more])) <= limit
            far.append((n, apart(both, rng.integers(0, 2**62, n))))
    assert min(d for n, d in far if n >= 300) > limit
    assert minhash.slice_bits(np.empty(0, np.int64)).tolist() == [0] * len(minhash.BITS)


def test_odd_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    ruled_out = 0
    for n in (0, 1, 30, 300, 300, 3000):
        for share in (0.05, 0.2, 0.3, 0.5):
            a = np.unique(rng.integers(0, 2**62, n))
            b = np.unique(np.r_[a[: len(a) - int(share * n)], rng.integers(0, 2**62, int(share * n))])
            x = minhash.odd_sketch(a) ^ minhash.odd_sketch(b)
            apart = int(np.unpackbits(x.view(np.uint8)).sum())
            different = len(np.setxor1d(a, b))
            assert apart <= different
            ruled_out += n == 300 and share >= 0.2 and apart * 1.8 > (len(a) + len(b)) * 0.2
    assert ruled_out == 6  # pairs of 300 members each with a Jaccard of 2/3 or less


def brute_components(texts, width):
    """Smallest index reachable over pairs of sets of shingles, as tuples of words, with a Jaccard of 0.8."""
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        span = min(width, len(w))
        sets.append({tuple(w[i : i + span]) for i in range(len(w) - span + 1)} if w else set())
    links = [[j for j, b in enumerate(sets) if a and b and 100 * len(a & b) >= 80 * len(a | b)] for a in sets]
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, those in enumerate(links):
            low = min([root[i], *(root[j] for j in those)])
            changed |= low != root[i]
            root[i] = low
    return root


def test_links_hang_on_no_order_of_ids(spark):
    """Two alike texts in the lists of a third that is near neither: whichever id is the smallest, they are linked."""
    from itertools import permutations

    rng = np.random.default_rng(7)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 206)]
    texts = [" ".join(base + [f"n{i}" for i in range(62)]), " ".join(base[:201]), " ".join(base)]
    for order in permutations(range(3)):
        rows = [(10 + at, texts[which]) for at, which in enumerate(order)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
        wanted = brute_components([t for _, t in rows], 2)
        assert found == {10 + i: 10 + w for i, w in enumerate(wanted)} and len(set(wanted)) == 2


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_of_near_copies(spark, monkeypatch, width):
    """A large group of mutated copies, part of them linked, and texts that share a passage only; lists dealt over parts."""
    monkeypatch.setattr(minhash, "PART_PAIRS", 50)
    rng = np.random.default_rng(width)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 150)]
    passage = [f"p{x}" for x in range(60)]
    texts = []
    for _ in range(60):
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 14 if width == 2 else 7)):
            words[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(words))
    for _ in range(40):
        texts.append(" ".join([f"q{x}" for x in rng.integers(0, 10**6, 60)] + passage))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    wanted = brute_components(texts, width)
    assert 41 < len(set(wanted)) < 100
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, width).collect()} == dict(enumerate(wanted))


def test_passage_of_unrelated_texts_makes_no_list(spark):
    """A common line made a list of most of its texts; alike texts still share one."""
    rng = np.random.default_rng(3)
    passage = [f"p{x}" for x in range(8)]
    texts = [[f"q{x}" for x in rng.integers(0, 10**9, 90)] + passage for _ in range(120)]
    texts.append(texts[0][:45] + ["changed"] + texts[0][46:])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    nodes = minhash.set_nodes(minhash.profiles(docs, 5))
    held = {}
    for r in minhash.rare_lists(nodes, 0.8).select("value", "node").collect():
        held.setdefault(r["value"], set()).add(r["node"])
    assert max(len(x) for x in held.values()) < 12  # of 121 texts
    assert any({0, 120} <= x for x in held.values())
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 5).collect()}
    assert found == {i: 0 if i == 120 else i for i in range(121)}


def test_least_neighbours_of_alike_sketches():
    assert [minhash.least_neighbours(t) for t in (0.7, 0.8)] == [0, 4]
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.choice(2**62, 300, False)
        smaller, larger = (np.sort(x)[: minhash.SKETCH].tolist() for x in (a[:240], a))
        pairs = [set(zip(x, x[1:], strict=False)) for x in (smaller, larger)]
        assert len(pairs[0] & pairs[1]) >= 4


def test_long_list_is_a_grid(spark, monkeypatch):
    """300 texts of one list, none linked: each pair meets once, rows are repeated with the sides of the grid."""
    monkeypatch.setattr(minhash, "PART_PAIRS", 400)
    rng = np.random.default_rng(6)
    sizes = [int(x) for x in rng.choice([100, 110, 400], 300)]
    labelled = spark.createDataFrame(
        [(i, n, 0, 0, 0, 0, 1, i) for i, n in enumerate(sizes)],
        "node bigint, n bigint, " + ", ".join(f"{b} bigint" for b in minhash.BITS) + ", value bigint, root bigint",
    )
    nodes = spark.createDataFrame([(i, [0] * 16) for i in range(300)], "node bigint, odd array<bigint>")
    members, outer, _ = minhash._sides(labelled, nodes, 0.8)
    # one row of 226 parts held all of them before: 299 * 226 rows, times three bands
    assert members.count() == 300 * 15 and outer.count() < 299 * 15 * 3
    met = members.join(outer, ["value", "band", "row", "column"]).where("root != rx AND (root = main OR node < x)")
    pairs = sorted(tuple(sorted((r["node"], r["x"]))) for r in met.select("node", "x").collect())
    assert len(pairs) == len(set(pairs))
    alike = [(i, j) for i in range(300) for j in range(i + 1, 300) if min(sizes[i], sizes[j]) >= 0.8 * max(sizes[i], sizes[j])]
    assert set(alike) <= set(pairs)


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n in (1, 2, 3, 6, 12, 30, 60, 90, 400):
        base = [f"w{x}" for x in rng.integers(0, 300, n)]
        for changes in (0, 0, 1, 2, n // 20, n // 8):
            words = list(base)
            for at in rng.integers(0, n, changes):
                words[at] = f"x{rng.integers(0, 9)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    root = brute_components(texts, 2)
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == dict(enumerate(root))
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs, 2, 60)
