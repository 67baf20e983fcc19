"""Gapped verification, centre runs and the shrinking frontier."""

import random

import numpy as np
import pyarrow as pa
import pytest

from repforge.operators import align
from repforge.operators import cluster as clu
from tests.test_cluster import _fixture, best_alignment, sequential_greedy

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def by_cells(c, m, start, band):
    """(columns, matches): least unmatched columns, then fewest columns, of
    ``m`` against any part of ``c``, cell by cell."""
    best = {(0, p): (0, 0) for p in range(max(0, start - band), min(len(c), start + band) + 1)}
    for i in range(len(m) + 1):
        for p in range(max(0, start + i - band), min(len(c), start + i + band) + 1):
            ways = [best[i, p]] if (i, p) in best else []
            if (i - 1, p - 1) in best:
                a, b = best[i - 1, p - 1]
                ways.append((a + (m[i - 1] != c[p - 1]), b + 1))
            if (i - 1, p) in best:
                a, b = best[i - 1, p]
                ways.append((a + 1, b + 1))
            if i and (i, p - 1) in best:
                a, b = best[i, p - 1]
                ways.append((a + 1, b + 1))
            if ways:
                best[i, p] = min(ways)
    cost, columns = min(v for (i, _), v in best.items() if i == len(m))
    return columns, columns - cost


@pytest.mark.parametrize("letters", ["AC", LETTERS, "Aé漢"])
def test_banded_alignment_cell_by_cell(letters):
    rng = random.Random(7)
    pairs = []
    for _ in range(150):
        c = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
        m = list(c[rng.randint(0, 5):])
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(m) + 1)
            m[at: at + rng.randint(0, 1)] = rng.choice(letters) * rng.randint(0, 2)
        pairs.append((c, "".join(m), rng.randint(0, min(6, len(c)))))
    codes, offsets = align.codes_of(pa.array([t for p in pairs for t in p[:2]]))
    size = np.diff(offsets)
    for band in (1, 3, 8):
        got = align.banded(codes, offsets[:-1][::2], size[::2], np.array([p[2] for p in pairs]), offsets[:-1][1::2],
                           size[1::2], band)
        reach = [by_cells(c, m, s, band) if len(m) <= len(c) - s + band else None for c, m, s in pairs]
        for i, want in enumerate(reach):
            if want is not None:
                assert (got[0][i], got[1][i]) == want, (pairs[i], band)


def test_an_inserted_residue_in_the_middle_still_clusters(spark):
    rng = random.Random(1)
    a = "".join(rng.choice(LETTERS) for _ in range(120))
    inserted, deleted = a[:60] + "W" + a[60:], a[:40] + a[41:]
    df = spark.createDataFrame([(1, a), (2, inserted), (3, deleted)], "Sequence_ID long, sequence string")
    assert {r.rep_id for r in clu.cluster(df).collect()} != {2}
    assert {r.rep_id for r in clu.cluster(df, band=8).collect()} == {2}


@pytest.mark.parametrize("run,band", [(4096, 8), (2, 8), (2, 0)])
def test_gapped_pairs_by_hand_and_runs(spark, monkeypatch, run, band):
    """Runs of two members give the same pairs as one run for each centre."""
    monkeypatch.setattr(clu, "RUN", run)
    rng = random.Random(3)
    df, seqs = _fixture(spark)
    more = [(1000 + i, s[:20] + rng.choice(LETTERS) + s[20:]) for i, s in list(seqs.items())[:20] if len(s) > 25]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    u = clu.exact_duplicates(df)
    cand = clu.kmer_candidates(clu.kmer_sketch(u))
    useq = {r.rep_id: r.sequence for r in u.collect()}
    want = {}
    for r in cand.collect():
        c, m, d = useq[r.centre], useq[r.member], r.diagonal
        low, high = max(-d, 0), min(len(m), len(c) - d)
        if (high - low) * 10 < 9 * len(m):
            continue
        plain = best_alignment(c, m, [d])
        if plain is None and band:
            columns, matches = by_cells(c, m[low:high], max(d, 0), band)
            plain = (columns, matches) if matches * 10 >= columns * 9 else None
        if plain is not None:
            key = (r.centre, r.member)
            want[key] = min(want.get(key, plain), plain, key=lambda v: (-v[1], v[0]))
    got = {(r.centre, r.member): (r.aligned, r.matches) for r in clu.verified_pairs(cand, u, band=band).collect()}
    assert got == want and got


def test_a_chain_of_500_and_rounds_that_shrink(spark, monkeypatch):
    n = 500
    u = spark.createDataFrame([(i, "x", 1000 - i) for i in range(1, n + 1)], "rep_id long, sequence string, len int")
    e = spark.createDataFrame([(i, i + 1) for i in range(1, n)], "centre long, member long")
    assert {r.id: r.rep for r in clu.greedy_cover(u, e).collect()} == {i: i if i % 2 else i - 1 for i in range(1, n + 1)}
    rng = random.Random(4)
    nodes = {i: rng.randint(5, 9) for i in range(1, 61)}
    prio = sorted(nodes, key=lambda i: (-nodes[i], i))
    edges = {(prio[min(p)], prio[max(p)]) for p in (rng.sample(range(60), 2) for _ in range(150))}
    sizes = []
    real = clu.materialize
    monkeypatch.setattr(clu, "FINISH_EDGES", 0)
    monkeypatch.setattr(clu, "materialize", lambda df, name: (
        lambda t: (sizes.append(t.count()) if name == "cover-edges" else None) or t)(real(df, name)))
    u = spark.createDataFrame([(i, "x", l) for i, l in nodes.items()], "rep_id long, sequence string, len int")
    got = {r.id: r.rep for r in clu.greedy_cover(u, spark.createDataFrame(sorted(edges), "centre long, member long"))
           .collect()}
    assert got == sequential_greedy(nodes, edges)
    assert all(a > b for a, b in zip(sizes, sizes[1:])) and sizes[-1] == 0 and len(sizes) > 2


def test_a_member_joins_the_best_representative_found_later(spark):
    """4 is covered by 3 in the first round; 2 turns out to be a
    representative of higher priority only after 1, 5 and 6 are settled."""
    nodes = {5: 99, 6: 98, 2: 50, 3: 40, 4: 30}
    edges = {(5, 6), (6, 2), (2, 4), (3, 4)}
    u = spark.createDataFrame([(i, "x", l) for i, l in nodes.items()], "rep_id long, sequence string, len int")
    e = spark.createDataFrame(sorted(edges), "centre long, member long")
    got = {r.id: r.rep for r in clu.greedy_cover(u, e).collect()}
    assert got == sequential_greedy(nodes, edges) and got[4] == 2


def test_masks_vary_by_epoch_and_reach_any_position():
    from repforge.operators.masking import mask_arrays, mix
    ids = np.array([5, 2 ** 60 + 5], np.int64)
    long = np.arange(1000, dtype=np.int64)
    draws = [mix(np.repeat(ids[:1], 1000), long, 42, e) for e in range(3)] + [mix(np.repeat(ids[1:], 1000), long, 42)]
    assert len({int(x) for d in draws for x in d}) == 4000
    flat, none = np.full(2000, 7, np.int32), np.zeros(2000, np.int32)
    a, _ = mask_arrays(ids, np.array([1000, 1000]), flat, none, 42)
    b, _ = mask_arrays(ids, np.array([1000, 1000]), flat, none, 42, epoch=1)
    assert (a != b).any() and 0.1 < np.mean(a != 7) < 0.2
