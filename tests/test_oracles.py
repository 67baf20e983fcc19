"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import importlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import check_oracles as C  # noqa: E402

E = importlib.import_module("__spark_entry__")
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    return C.duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    a = C.fingerprint(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    b = C.fingerprint([d[0] for d in cur.description], cur.fetchall())
    assert a[0] == b[0], "column names differ"
    assert a[1] == b[1], "row counts differ"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) - set(b[3]), key=repr)[:3]}"


def test_every_query_is_registered_with_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["Subject", "row_count"]
    assert df.count() > 0


def test_rows_only_queries_run(spark, sf_small):
    for name in sorted(set(E.queries()) - set(E.oracle_sql())):
        assert E.queries()[name](spark, sf_small).count() >= 0
