"""Splits: decimal counts, disjoint and complete, caps, folds."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from repforge.operators import splits


def test_decimal_counts():
    assert splits.split_counts_fraction(100, 0.29, 0.1) == (29, 10)
    assert int(0.29 * 100) == 28  # the float trap the decimal path avoids
    assert splits.split_counts_fraction(7, 0.5, 0.25) == (int(Decimal("3.5")), int(Decimal("1.75")))


def _df(spark, n):
    return spark.range(1, n + 1).withColumnRenamed("id", "Sequence_ID")


def test_split_numbers_disjoint_complete(spark):
    out = splits.split_numbers(_df(spark, 1000), 700, 200).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in out} == {"train": 700, "val": 200, "test": 100}


def test_split_numbers_too_many_raises(spark):
    with pytest.raises(ValueError):
        splits.split_numbers(_df(spark, 10), 8, 3)


def test_split_capped(spark):
    out = splits.split_numbers(_df(spark, 1000), 50, 20, cap=100).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in out} == {"train": 50, "val": 20, "test": 30}


def test_split_stable_under_repartition(spark):
    a = splits.split_fraction(_df(spark, 500), 0.8, 0.1)
    b = splits.split_fraction(_df(spark, 500).repartition(5), 0.8, 0.1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_kfold_contiguous_sizes(spark):
    out = splits.kfold(_df(spark, 17), 5).orderBy("Sequence_ID").collect()
    assert [r.fold for r in out] == [0] * 4 + [1] * 4 + [2] * 3 + [3] * 3 + [4] * 3
