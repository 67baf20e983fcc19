"""Counts of shingles by cell take a byte a cell and stop at 255."""

import numpy as np

from repforge.llm import ngram_join as n


def test_counts_stop_at_255_in_a_byte(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2 ** 64, size=size, dtype=np.uint64) >> np.uint64(shift))
            for size, shift in ((50, 0), (3000, 20), (400, 36), (1, 0), (400, 36))]
    expect, counts = np.zeros(1 << n.CELL_BITS, np.int64), np.zeros(1 << n.CELL_BITS, np.uint8)
    for s in sets:
        np.add.at(expect, (s >> np.uint64(64 - n.CELL_BITS)).astype(np.int64), 1)
        n.count_cells(counts, s)
    assert (counts == np.minimum(expect, 255)).all() and expect.max() > 255


def test_a_task_holds_a_byte_for_each_cell(monkeypatch):
    import pyarrow as pa
    made = []
    zeros = np.zeros
    monkeypatch.setattr(n.np, "zeros", lambda shape, *a, **k: (made.append(zeros(shape, *a, **k)), made[-1])[1])
    list(n._sets(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b c d e f"])], names=["doc_id", "text"])])))
    assert max(a.nbytes for a in made) == 1 << n.CELL_BITS
