"""Samples: exact size, errors, balanced quotas, round robin vs simulation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from repforge.operators import sampling


def simulate_round_robin(counts, total):
    taken = {g: 0 for g in counts}
    active = sorted(counts)
    n = 0
    while n < total and active:
        for g in list(active):
            if taken[g] < counts[g]:
                taken[g] += 1
                n += 1
                if n >= total:
                    break
            else:
                active.remove(g)
    return taken


def test_round_robin_quotas_equal_simulation(spark):
    rng = random.Random(3)
    cases = []
    for case in range(60):
        g = rng.randint(1, 8)
        counts = {f"g{j}": rng.choice([0, 1, 2, 3, 5, 8, 20, rng.randint(1, 40)]) for j in range(g)}
        counts = {k: v for k, v in counts.items() if v > 0} or {"g0": 1}
        total = rng.randint(0, sum(counts.values()) + 5)
        cases.append((counts, total))
    for counts, total in cases:
        df = spark.createDataFrame(list(counts.items()), "group_key string, n_rows long")
        got = {r.group_key: r.quota for r in
               sampling.round_robin_quotas(df, total).collect()}
        assert got == simulate_round_robin(counts, total), (counts, total)


def _seqs(spark, n, groups=5):
    return spark.range(1, n + 1).select(F.col("id").alias("Sequence_ID"),
                                        (F.col("id") % groups).cast("string").alias("group_key"))


def test_sample_exact_size_and_reproducible(spark):
    df = _seqs(spark, 2000)
    a = sampling.sample_exact(df, 123)
    b = sampling.sample_exact(df.repartition(7), 123)
    ids_a = {r.Sequence_ID for r in a.collect()}
    assert len(ids_a) == 123
    assert ids_a == {r.Sequence_ID for r in b.collect()}


def test_sample_too_large_raises(spark):
    with pytest.raises(ValueError):
        sampling.sample_exact(_seqs(spark, 10), 11)


def test_balanced_quota_and_short_group(spark):
    df = _seqs(spark, 100, 5)
    s = sampling.sample_balanced(df, 23)
    per = {r.group_key: r["count"] for r in s.groupBy("group_key").count().collect()}
    assert per == {str(i): math.ceil(23 / 5) for i in range(5)}
    with pytest.raises(ValueError):
        sampling.sample_balanced(df, 101)


def test_round_robin_takes_first_rows_in_id_order(spark):
    df = _seqs(spark, 50, 3)
    s = sampling.sample_round_robin(df, 10).collect()
    per = {}
    for r in s:
        per.setdefault(r.group_key, []).append(r.Sequence_ID)
    for g, ids in per.items():
        allg = sorted(i for i in range(1, 51) if str(i % 3) == g)
        assert sorted(ids) == allg[:len(ids)]
    assert len(s) == 10


def test_unknown_scheme_raises(spark):
    with pytest.raises(ValueError):
        sampling.sample(_seqs(spark, 10), "cluster", 5)
