"""Exact ranks, cut-offs and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from repforge.operators.ranks import (KEY_COL, cut_by_rank, global_rank, hash_key,
                                      with_hash_order)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_global_rank_equals_sorted_position(spark, digits):
    df = spark.range(0, 3000).withColumnRenamed("id", "Sequence_ID")
    keyed = with_hash_order(df, "Sequence_ID", 7, digits)
    ranked = global_rank(keyed, [KEY_COL, "Sequence_ID"], ["_rk_bucket"]).collect()
    got = {r.Sequence_ID: r["rank"] for r in ranked}
    import hashlib
    order = sorted(range(3000), key=lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i))
    assert got == {i: p + 1 for p, i in enumerate(order)}


@pytest.mark.parametrize("cutoffs", [[0], [1], [10, 10, 2999], [1500, 2999, 3000], [5000]])
def test_cut_by_rank_matches_rank(spark, cutoffs):
    df = spark.range(0, 3000).withColumnRenamed("id", "Sequence_ID")
    keyed = with_hash_order(df, "Sequence_ID", 42, 2)
    cut = {r.Sequence_ID: r.part for r in
           cut_by_rank(keyed, [KEY_COL, "Sequence_ID"], ["_rk_bucket"], cutoffs).collect()}
    ranked = {r.Sequence_ID: r["rank"] for r in
              global_rank(keyed, [KEY_COL, "Sequence_ID"], ["_rk_bucket"]).collect()}
    assert len(cut) == 3000
    for i, r in ranked.items():
        assert cut[i] == sum(1 for c in cutoffs if r > c)


def test_per_group_cut_with_column_quota(spark):
    rows = [(i, i % 3, 1 + i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "Sequence_ID long, g int, quota int")
    keyed = with_hash_order(df, "Sequence_ID", 42, 1)
    out = cut_by_rank(keyed, [KEY_COL, "Sequence_ID"], ["_rk_bucket"], ["quota"], group_cols=["g"])
    got = {r.g: r["count"] for r in out.where("part = 0").groupBy("g").count().collect()}
    assert got == {0: 1, 1: 2, 2: 3}


def test_no_single_partition_window_over_rows(spark):
    """The only un-partitioned window runs on the bucket-count table, which
    sits behind an aggregate; the row-level window is partitioned by bucket
    and no TakeOrderedAndProject appears."""
    df = spark.range(0, 1000).withColumnRenamed("id", "Sequence_ID")
    keyed = with_hash_order(df, "Sequence_ID")
    plan = _plan(cut_by_rank(keyed, [KEY_COL, "Sequence_ID"], ["_rk_bucket"], [10]))
    assert "TakeOrderedAndProject" not in plan
    assert "Window [row_number()" in plan
    assert "_rk_bucket" in plan.split("Window [row_number()")[1].split("\n")[0]


def test_hash_key_is_md5_of_seed_and_id(spark):
    import hashlib
    v = spark.range(1).select(hash_key(F.lit(123), 42).alias("k")).first().k
    assert v == hashlib.md5(b"42|123").hexdigest()


def test_bucket_width_follows_row_count(spark):
    from repforge.operators.ranks import ROWS_PER_BUCKET, hex_digits, hex_digits_col
    assert [hex_digits(n) for n in (0, 1000, 15_999, 16_000, 10 ** 9, 10 ** 12)] == [0, 0, 0, 1, 4, 7]
    for n in (10, 10 ** 5, 10 ** 7, 10 ** 10):
        assert 16 ** hex_digits(n) <= max(1, n / ROWS_PER_BUCKET)
    df = spark.createDataFrame([("small", 10), ("big", 5 * 10 ** 6), ("hot", 3 * 10 ** 9)],
                               "g string, n long")
    got = {r.g: r.d for r in df.select("g", hex_digits_col(F.col("n")).alias("d")).collect()}
    assert got == {g: hex_digits(n) for g, n in (("small", 10), ("big", 5 * 10 ** 6), ("hot", 3 * 10 ** 9))}


def test_bucket_tables_stay_small(spark):
    """Many small groups, and sparse ids: at most a bucket for 1,000 rows,
    plus one a group."""
    from repforge.operators.ranks import hex_digits_col, id_bins, with_hash_order
    n, groups = 20_000, 500
    df = spark.range(n).select((F.col("id") * 1_000_003).alias("Sequence_ID"), (F.col("id") % groups).alias("g"))
    assert df.select(id_bins(df, "Sequence_ID").alias("b")).distinct().count() <= n / 1000 + 1
    sized = df.join(df.groupBy("g").count(), "g")
    keyed = with_hash_order(sized, "Sequence_ID", digits=hex_digits_col(F.col("count")))
    assert keyed.select("g", "_rk_bucket").distinct().count() <= n / 1000 + groups
