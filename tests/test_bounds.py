"""Selection by bounds against sorted ranks: null and repeated ids, repeated
rows, hot groups and odd id ranges; every row accounted for."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from repforge.operators import bounds, sampling, splits
from repforge.operators.ranks import ordered_ranks


def _md5(i):
    return hashlib.md5(f"42|{i}".encode()).hexdigest()


def _ids(seed, n):
    rnd = random.Random(seed)
    return [rnd.choice([None if rnd.random() < .5 else i, i, i, i, -i * 7, i ** 3, i + 2 ** 40, i % 9])
            for i in range(n)]


def _frame(spark, ids, groups=None):
    """Rows with ids that are null or repeat; ``x`` repeats, too."""
    rows = [(i, groups[n] if groups else "g", n % 3) for n, i in enumerate(ids)]
    return spark.createDataFrame(rows, "Sequence_ID long, group_key string, x long").repartition(5)


@pytest.fixture(params=["plain", "small bins"])
def bins(request, monkeypatch):
    if request.param == "small bins":  # several rounds of narrower bins, hashes of rows for ties
        for name, size in (("BINS", 7), ("GROUP_BINS", 3), ("LISTED", 4), ("GROUP_LISTED", 4)):
            monkeypatch.setattr(bounds, name, size)


def test_parts_hold_the_sorted_ranks(spark, bins):
    ids = _ids(1, 700)
    df = _frame(spark, ids)
    order = sorted(ids, key=lambda i: (i is None, _md5(i)))
    for cuts in ([100, 350], [0, 699], [650, 660, 700], [1]):
        got = bounds.cut(df, bounds.hash_place("Sequence_ID"), cuts).collect()
        assert len(got) == 700 and sorted((str(r.Sequence_ID)) for r in got) == sorted(map(str, ids))
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 700])):
            mine = [r.Sequence_ID for r in got if r.part == n]
            assert sorted(map(str, mine)) == sorted(map(str, order[a:b])), (cuts, n)


def test_folds_in_id_order(spark, bins):
    ids = _ids(2, 500)
    order = sorted(ids, key=lambda i: (i is None, i or 0))
    got = splits.kfold(_frame(spark, ids), 7).collect()
    sizes = [500 // 7 + (i < 500 % 7) for i in range(7)]
    at = 0
    for fold, size in enumerate(sizes):
        assert sorted(str(r.Sequence_ID) for r in got if r.fold == fold) == sorted(map(str, order[at: at + size]))
        at += size


@pytest.mark.parametrize("take", [1, 450, 899, 950, 1000])
def test_a_tenth_of_the_ids_is_null(spark, take):
    ids = [i if i % 10 else None for i in range(1000)]
    df = _frame(spark, ids)
    assert sampling.sample_exact(df, take).count() == take
    s = splits.split_numbers(df, take // 2, take // 4)
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect() if r["count"]} == {
        k: v for k, v in (("train", take // 2), ("val", take // 4), ("test", 1000 - take // 2 - take // 4)) if v}
    assert splits.split_fraction(df, 0.8, 0.1).count() == 1000
    assert sampling.sample_round_robin(df, take).count() == take
    with pytest.raises(ValueError):
        sampling.sample_exact(df, 1001)


def test_per_group_bounds(spark, bins):
    """500 small groups, a hot one with half of all rows and one without a name."""
    ids, groups = [], []
    for g in range(500):
        ids += [None if n == 3 else 1000 * g + n for n in range(4)]
        groups += [f"g{g}"] * 4
    ids += list(range(10 ** 9, 10 ** 9 + 1900)) + [None] * 100 + [7] * 50
    groups += ["hot"] * 2050
    ids += [5, None, None, 6]
    groups += [None] * 4
    df = _frame(spark, ids, groups)
    by = {}
    for i, g in zip(ids, groups):
        by.setdefault(g, []).append(i)
    got = {}
    for r in sampling.sample_per_group(df, 4).collect():
        got.setdefault(r.group_key, []).append(r.Sequence_ID)
    assert {g: len(v) for g, v in got.items()} == {g: 4 for g in by}
    assert sorted(got["hot"]) == sorted(sorted(by["hot"], key=lambda i: (i is None, _md5(i)))[:4])
    for total in (700, 3990, 4040, 10 ** 6):
        got = {}
        for r in sampling.sample_round_robin(df, total).collect():
            got.setdefault(r.group_key, []).append(r.Sequence_ID)
        assert sum(map(len, got.values())) == min(total, len(ids))
        for g, mine in got.items():
            order = sorted(by[g], key=lambda i: (i is None, i or 0))
            assert sorted(map(str, mine)) == sorted(map(str, order[:len(mine)])), (total, g)


def test_large_quota_of_a_hot_group(spark, bins):
    ids = list(range(6000)) + [None] * 3000
    df = _frame(spark, ids, ["a"] * 9000)
    for quota in (2500, 5999, 6001, 8999, 9000):
        got = [r.Sequence_ID for r in sampling.sample_per_group(df, quota).collect()]
        want = sorted(ids, key=lambda i: (i is None, _md5(i)))[:quota]
        assert sorted(map(str, got)) == sorted(map(str, want)), quota


def test_water_level_by_rounds():
    rnd = random.Random(8)
    for _ in range(200):
        sizes = [(s, rnd.randint(1, 3)) for s in rnd.sample(range(1, 30), rnd.randint(1, 6))]
        total = rnd.randint(0, 200)
        level, extra = sampling.water_level(sizes, total)
        given = lambda r: sum(min(s, r) * g for s, g in sizes)
        if total >= given(99):
            assert given(level) == given(99) and extra == 0
        else:
            assert given(level) <= total < given(level + 1) and extra == total - given(level)


def test_ordered_ranks(spark):
    names = [f"{n % 50:02d}-{n}" for n in range(1000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(6)
    got = {r.name: r.rank for r in ordered_ranks(df, ["name"]).collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names, key=lambda n: (n is not None, n or "")))}


def test_no_join_or_window_on_rows_and_three_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).select(F.col("id").alias("Sequence_ID"), F.lit("x").alias("wide")).write.parquet(path)
    log = []
    real = bounds.bounds

    def counted(places, cutoffs, hashed):
        assert places.columns == ["_place"]
        log.append(places)
        return real(places, cutoffs, hashed)
    bounds.bounds, old = counted, bounds.bounds
    try:
        for df in (sampling.sample_exact(spark.read.parquet(path), 77),
                   splits.split_numbers(spark.read.parquet(path), 4000, 500, cap=4800),
                   splits.kfold(spark.read.parquet(path), 9)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not any(op in plan for op in ("Join", "Window", "Exchange", "Sort")) and plan.count("FileScan") == 1
    finally:
        bounds.bounds = old
    assert len(log) == 3  # each: one histogram, one list of places, then the rows


def test_balanced_quota_over_uneven_groups(spark):
    df = spark.range(3000).select(F.col("id").alias("Sequence_ID"), F.when(F.col("id") % 3 > 0, "hot").otherwise(
        F.concat(F.lit("g"), F.col("id") % 30)).alias("group_key"))
    n = df.select("group_key").distinct().count()
    got = sampling.sample_balanced(df, 400).groupBy("group_key").count().collect()
    assert {r["count"] for r in got} == {math.ceil(400 / n)} and len(got) == n
