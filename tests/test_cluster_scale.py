"""Volumes and bounds of the clustering steps: what is sent for a candidate
pair, when it is ruled out, and how the sketch is dealt out."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repforge.operators import align
from repforge.operators import cluster as clu

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def _text(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


def _edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.5:
            out[at] = rng.choice(LETTERS)
        elif kind < 0.75:
            out.insert(at, rng.choice(LETTERS))
        elif len(out) > 5:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("foreign", ["", "\u0416"])
def test_lower_bound_never_exceeds_the_alignment(foreign):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        c = _text(rng, rng.randint(5, 90)) + foreign
        m = _edited(rng, c[rng.randint(0, len(c) // 2):], rng.randint(0, 12)) if rng.random() < 0.7 else _text(rng, 40)
        start = rng.randint(0, len(c) - 1)
        pairs.append((c, m[: len(c) - start], start))
    pairs = [p for p in pairs if p[1]]
    codes, offsets = align.codes_of(pa.array([t for p in pairs for t in p[:2]]))
    size, at = np.diff(offsets), offsets[:-1]
    start = np.array([p[2] for p in pairs])
    for band in (0, 2, 8):
        columns, matches = align.banded(codes, at[::2], size[::2], start, at[1::2], size[1::2], band)
        least = align.apart(codes, at[::2] + start, at[1::2], size[1::2], band)
        assert (least <= columns - matches).all() and least.any()


def _family(spark, related=40, unrelated=40):
    """Sequences that share k-mers with a long centre; some are edited copies
    of a part of it, the others have nothing else in common with it."""
    rng = random.Random(8)
    centre = _text(rng, 900)
    rows = [(1, centre)]
    for i in range(related):
        at = rng.randint(0, 600)
        rows.append((2 + i, _edited(rng, centre[at:at + rng.randint(60, 290)], rng.randint(0, 25))))
    for i in range(unrelated):
        at = rng.randint(0, 880)
        rows.append((1000 + i, _text(rng, rng.randint(0, 200)) + centre[at:at + 14] + _text(rng, rng.randint(0, 200))))
    return clu.exact_duplicates(spark.createDataFrame(rows, "Sequence_ID long, sequence string"))


@pytest.mark.parametrize("band", [0, 8])
@pytest.mark.parametrize("similarity", [0.9, 0.6])
def test_windows_rule_out_no_verified_pair(spark, monkeypatch, band, similarity):
    u = _family(spark).cache()
    cand = clu.kmer_candidates(clu.kmer_sketch(u, m=300)).cache()
    got = {tuple(r) for r in clu.verified_pairs(cand, u, similarity, band=band).collect()}
    monkeypatch.setattr(clu, "_allowed", lambda unlike, *rest: np.ones(len(unlike), bool))
    assert got == {tuple(r) for r in clu.verified_pairs(cand, u, similarity, band=band).collect()} and got


def test_ruled_out_pairs_send_no_whole_text(spark, monkeypatch):
    sent = []
    whole = clu._centre_runs

    def watched(pairs, unique, own=None):
        sent.append((pairs.count(), own))
        return whole(pairs, unique, own)

    monkeypatch.setattr(clu, "_centre_runs", watched)
    u = _family(spark, related=10, unrelated=80).cache()
    clu.verified_pairs(clu.kmer_candidates(clu.kmer_sketch(u, m=400)), u).collect()
    (covered, windows), (near, own) = sent
    assert own is None and near * 2 < covered
    sizes = windows.select(F.max(F.length("sequence")).alias("n")).first()["n"]
    assert sizes < 900 / 5


def test_sketch_is_dealt_out_once(spark):
    u = _family(spark)
    cand = clu.kmer_candidates(clu.kmer_sketch(u)).where("m_len > 3 and diagonal > -9")
    plan = cand._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(kmer") == 2  # equal exchanges: the second one is reused when they run
    cand.collect()
    assert "ReusedExchange" in cand._jdf.queryExecution().executedPlan().toString()


def test_hot_kmers_give_the_same_candidates(spark, monkeypatch):
    u = _family(spark)
    sketch = clu.kmer_sketch(u).cache()
    plain = {tuple(r) for r in clu.kmer_candidates(sketch).collect()}
    monkeypatch.setattr(clu, "SAMPLED", 1)
    monkeypatch.setattr(clu, "HOT", 2)
    assert clu._hot_kmers(sketch).count() > 0
    assert {tuple(r) for r in clu.kmer_candidates(sketch).collect()} == plain and plain
