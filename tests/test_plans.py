"""Plan shape of every registered query: no cross joins, no single-task
top-n, no row-at-a-time Python, and scans that read only the columns used."""

import contextlib
import importlib
import io
import re

import pytest

E = importlib.import_module("__spark_entry__")

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "TakeOrderedAndProject",
             "BatchEvalPython", "SortAggregate"]
# wide driver-table columns no query needs
NEVER_READ = ["c_name", "c_address", "c_phone", "c_comment", "o_comment", "n_comment"]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark, sf_small):
    return {name: _plan(fn(spark, sf_small)) for name, fn in E.queries().items()}


def test_no_forbidden_operators(plans):
    bad = {n: [op for op in FORBIDDEN if op in p] for n, p in plans.items()}
    assert {n: ops for n, ops in bad.items() if ops} == {}


def test_scans_are_pruned(plans):
    for name, p in plans.items():
        for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", p):
            assert not any(c in schema for c in NEVER_READ), (name, schema)


def test_catalogue_queries_read_few_customer_columns(plans):
    p = plans["rows_per_file"]
    assert re.findall(r"ReadSchema: (struct<[^\n]*>)", p) == ["struct<o_custkey:bigint>"]
