"""What a Python worker keeps from one task to the next where memory is short."""

import pyarrow as pa

from linkledger.llm import tokenfile


class _Task:
    get = staticmethod(lambda: _Task)
    partitionId = staticmethod(lambda: 3)


def test_one_library_a_worker_and_no_pieces(monkeypatch):
    """Every task made a library of its own, which stayed until a collection of cycles: some 18 MB a task."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(tokenfile, "TaskContext", _Task)
    monkeypatch.setattr(tokenfile, "_WORKER", {})
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three", None])], ["doc_id", "text"])
    (first,) = tokenfile._segments(path, 2, 2)(iter([batch]))
    (made,) = tokenfile._WORKER.values()
    assert not made.known and not made.known.old
    (second,) = tokenfile._segments(path, 2, 2)(iter([batch]))
    assert list(tokenfile._WORKER.values()) == [made]
    assert first.to_pylist() == second.to_pylist()
    assert first.column("lengths").to_pylist() == [[4, 1]]
