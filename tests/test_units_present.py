"""J2 on all sequences: odd units that occur are there; absent units are not."""

import importlib

from repforge.operators import groups
from repforge.sources import views

E = importlib.import_module("__spark_entry__")


def test_every_unit_that_occurs(spark, sf_small):
    got = sorted(r.File_index for r in E.queries()["units_present_all"](spark, sf_small).collect())
    occur = {r.File_ID for r in views.sequences(spark, sf_small).select("File_ID").distinct().collect()}
    listed = [r.File_index for r in views.catalogue(spark, sf_small).select("File_index").collect()]
    assert got == sorted(u for u in listed if u in occur)
    assert any(u % 2 for u in got)


def test_absent_units_are_not_present(spark):
    catalogue = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "File_index long, Author string")
    seqs = spark.createDataFrame([(3,), (2,), (3,), (9,), (None,)], "File_ID long")
    assert sorted(r.File_index for r in groups.units_present(catalogue, seqs).collect()) == [2, 3]
