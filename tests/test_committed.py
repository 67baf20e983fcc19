"""Committed tables, reuse by input files, and the one-scan report."""

import glob
import importlib
import os

import pytest

from repforge.sources import committed

E = importlib.import_module("__spark_entry__")


def _frame(spark, n):
    return spark.range(n).selectExpr("id", "id % 3 as part", "array(id, id + 1) as pair")


def test_a_write_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        committed.read_committed(spark, path)
    assert committed.write_committed(_frame(spark, 10), path, ["part"]) == 1
    old = committed.read_committed(spark, path)

    def fails(batches):
        for b in batches:
            yield b
            raise ValueError("lost half way")
    with pytest.raises(Exception, match="lost half way"):
        committed.write_committed(_frame(spark, 99).mapInArrow(fails, "id long, part long, pair array<long>"), path)
    _frame(spark, 5).write.parquet(f"{path}/data-written-but-not-committed")
    assert committed.versions(spark, path) == [1]
    assert committed.read_committed(spark, path, check=True).count() == 10
    assert committed.write_committed(_frame(spark, 7), path) == 2
    assert committed.read_committed(spark, path, check=True).count() == 7 and old.count() == 10
    assert committed.read_committed(spark, path, version=1).count() == 10
    assert committed.drop_uncommitted(spark, path) >= 2
    assert committed.versions(spark, path) == [2] and committed.read_committed(spark, path, check=True).count() == 7


def test_files_that_changed_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    committed.write_committed(_frame(spark, 100).repartition(3), path)
    gone = next(f for f in glob.glob(f"{path}/data-*/*.parquet"))
    os.remove(gone)
    with pytest.raises(ValueError, match="not what was committed"):
        committed.read_committed(spark, path, check=True)


def test_reuse_follows_the_input_files(spark, tmp_path):
    source, path, calls = str(tmp_path / "in"), str(tmp_path / "out"), []

    def compute():
        calls.append(1)
        return spark.read.parquet(source).groupBy().count()
    spark.range(5).write.parquet(source)
    assert [committed.reused(spark, path, [source], compute).first()[0] for _ in range(2)] == [5, 5] and len(calls) == 1
    spark.range(3).write.mode("append").parquet(source)
    assert [committed.reused(spark, path, [source], compute).first()[0] for _ in range(2)] == [8, 8] and len(calls) == 2
    with pytest.raises(Exception):
        committed.reused(spark, path, [str(tmp_path / "missing")], compute)


def test_report_scans_once_and_equals_the_single_queries(spark, sf_small):
    report = E.queries()["catalogue_report"](spark, sf_small)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("customer.parquet") == 1 and plan.count("Expand") == 1
    rows = {}
    for r in report.collect():
        rows.setdefault(r.report, []).append(tuple(r)[1:])
    for name in ("size_by_author", "total_by_author", "unique_by_author", "unique_by_subject",
                 "unique_by_subject_human", "unique_by_species_chain", "unique_by_species"):
        single = [tuple(r) for r in E.queries()[name](spark, sf_small).collect()]
        mine = [tuple(v for v in r if v is not None) for r in rows[name]]
        assert sorted(mine) == sorted(single), name
    assert rows["total_size"][0][3] == E.queries()["total_size"](spark, sf_small).first().total_mb


def test_report_drops_null_keys_and_skips_invalid_numbers(spark):
    from repforge.operators.aggregates import catalogue_report
    rows = [("a", "s", "human", "Heavy", "5", "x", "1.5"), ("a", None, "human", None, "n/a", "2", None),
            (None, "s", None, "Light", "7", "3", "bad"), ("b", "s", "rat", "Heavy", "n/a", "n/a", "2")]
    df = spark.createDataFrame(rows, "Author string, Subject string, Species string, Chain string, "
                                     "Unique_sequences string, Total_sequences string, Size_MB string")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in catalogue_report(df).collect()}
    assert got[("unique_by_author", "a", None)] == (5, None) and got[("total_by_author", "a", None)] == (2, None)
    assert got[("size_by_author", "b", None)] == (None, 2.0) and got[("unique_by_author", "b", None)] == (0, None)
    assert got[("total_size", None, None)] == (None, 3.5)
    assert ("unique_by_author", None, None) not in got and ("unique_by_subject_human", "s", "b") not in got
    assert got[("unique_by_subject_human", "s", "a")] == (5, None)
