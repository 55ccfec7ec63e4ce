"""What a Python worker remembers from task to task."""

import pyarrow as pa

from lexflume.llm import minhash, texts


def test_one_operator_is_remembered_and_the_next_lets_it_go():
    made = []
    for key in ("x", "x", "y", "x"):
        assert texts.kept(key, lambda k=key: made.append(k) or k) == key
    assert made == ["x", "y", "x"]
    rows = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f"])], names=["doc_id", "text"])
    assert [b.num_rows for b in minhash._profile_batches([rows], 5)] == [1]
    texts.kept("x", lambda: made.append("again"))
    assert made[-1] == "again"
    texts.release()


def test_sets_are_made_of_small_pieces(monkeypatch):
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(2000)), pa.array(["a b c d e f"] * 2000)], names=["doc_id", "text"]
    )
    sizes = [b.num_rows for b in minhash._profile_batches([rows], 5)]
    assert sum(sizes) == 2000 and max(sizes) <= minhash.PIECE[0] < 2000
