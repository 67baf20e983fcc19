"""op6: lists keep rows that have a partner, pairs of large sets are held
against each other in wide sketches."""

import numpy as np
import pyarrow as pa

from repforge.llm import ngram_join as n
from repforge.llm.common import sliced
from tests.llm.test_operators import brute_components, counted, frame


def lists_of(rng, lists=60):
    rows = [(t, int(rng.integers(1, 400))) for t in range(lists) for _ in range(int(rng.integers(1, 12)))]
    token, size = np.array(sorted(rows)).T
    return token, size, np.array([int(rng.integers(0, n.prefix_length(int(s)))) for s in size])


def test_partnered_equals_all_pairs():
    token, size, place = lists_of(np.random.default_rng(6))
    want = [any(i != j and token[i] == token[j] and 4 * size[i] <= 5 * size[j] and 4 * size[j] <= 5 * size[i]
                and 9 * min(size[i] - place[i], size[j] - place[j]) >= 4 * (size[i] + size[j])
                for j in range(len(token))) for i in range(len(token))]
    got = n.partnered(token, size.astype(np.int32), place.astype(np.int32))
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_lists_leave_out_sets_without_a_partner():
    columns = {"token": [1, 1, 2, 2, 3, 3], "set_id": [10, 11, 10, 12, 13, 14], "n": [100, 100, 100, 300, 100, 100],
               "place": [0, 2, 1, 1, 15, 15]}
    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))
    rows = pa.Table.from_batches([b.select(["token", "set_id"]) for b in n._shared(iter([batch]))]).to_pylist()
    assert [(r["token"], r["set_id"]) for r in rows if r["token"] is not None] == [(1, 10), (1, 11)]


def test_wide_sketches_bound_the_overlap_and_part_large_sets():
    rng = np.random.default_rng(7)
    for size in (600, 1500, 5000):
        for share in (0.0, 0.5, 0.8, 0.95, 1.0):
            x = np.unique(rng.integers(0, 2**64, size, np.uint64))
            y = np.unique(np.concatenate([x[:int(share * size)], rng.integers(0, 2**64, size // 3, np.uint64)]))
            if len(y) <= 512:
                assert n.wide_sketch_of(y) is None
                continue
            most = (len(x) + len(y) - n.differing_cells(n.wide_sketch_of(x), n.wide_sketch_of(y))) // 2
            assert len(np.intersect1d(x, y)) <= most
        x, y = (np.unique(rng.integers(0, 2**64, size, np.uint64)) for _ in range(2))
        most = (len(x) + len(y) - n.differing_cells(n.wide_sketch_of(x), n.wide_sketch_of(y))) // 2
        assert most < 4 * (len(x) + len(y)) / 9


def test_large_sets_around_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows, passage = [], [f"p{i}" for i in range(200)]
    for family in range(5):
        base = [f"f{family}w{i}" for i in range(int(rng.integers(450, 1600)))]
        for _ in range(6):
            text = list(base)
            for _ in range(int(rng.integers(0, len(base) // 20))):
                text[int(rng.integers(len(text)))] = f"x{rng.integers(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(text + passage)))
    assert counted(n.joined(frame(spark, rows)).collect()) == counted(brute_components(rows))


def test_texts_come_in_runs_of_a_size():
    texts = ["a" * 30, None, "é" * 40, "", "b" * 500, "c", "d" * 99]
    runs = list(sliced(pa.array(["x", *texts]).slice(1), 100))
    assert [t for _, run in runs for t in run] == texts
    assert [low for low, _ in runs] == list(np.cumsum([0, *(len(r) for _, r in runs)])[:-1])
    assert all(len(r) == 1 or sum(len((t or "").encode()) for t in r) <= 100 for _, r in runs)
