"""One-pass ingest against the line-by-line path and by hand."""

import gzip
import itertools
import random

import pytest
from pyspark.sql import functions as F

from repforge.sources import fused
from repforge.sources import units as U
from tests.test_units import HEADER, _row, _write


def _line_by_line(spark, paths, columns, **how):
    unit = how.pop("unit", None)
    first = how.get("first_row_as_header", False)
    parsed = U.parse_units(U.number_lines(U.read_unit_lines(spark, paths), unit), first_row_as_header=first)
    return U.ingest(parsed, columns, **how)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("fused")
    rnd = random.Random(3)
    for unit in range(1, 9):
        _write(d / f"{unit}.csv.gz", [_row(fwr1="A" * rnd.choice([25, 19]), red=str(100 * unit + i))
                                      for i in range(rnd.choice([0, 1, 2, 5, 40]))])
    _write(d / "20.csv.gz", [_row(red="x"), _row(cdr3="  "), '"a ""quoted, field"",', "", _row(red="7")])
    return str(d)


@pytest.mark.parametrize("nth,length_filter,lost", list(itertools.product([1, 3], [True, False], [False, True])))
def test_fused_equals_line_by_line(spark, folder, nth, length_filter, lost):
    columns = ["fwr1_aa", "v_call", "Redundancy"]
    how = {"nth": nth, "length_filter": length_filter, "first_row_as_header": lost}
    got = fused.ingest(fused.unit_lines(spark, folder), columns, **how)
    assert _rows(got.select("Sequence_ID", "File_ID", *columns).fillna("", "fwr1_aa").fillna("", "v_call")
                 .fillna(-1, "Redundancy")) == \
        _rows(_line_by_line(spark, folder, columns, **how).fillna("", "fwr1_aa").fillna("", "v_call")
              .fillna(-1, "Redundancy"))


@pytest.mark.parametrize("nth,lost", [(1, False), (3, False), (4, True)])
def test_units_of_part_files_with_split_heads(spark, tmp_path, nth, lost):
    """Metadata, header and the first row may each lie in a part of its own."""
    rows = ['"{""Run"": ""r""}"', HEADER, *[_row(red=str(i), fwr1="A" * (25 if i % 4 else 3)) for i in range(23)]]
    for unit, cuts in ((3, [1, 2, 3, 9]), (4, [2, 20]), (5, [])):
        (tmp_path / f"unit={unit}").mkdir()
        for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            with gzip.open(tmp_path / f"unit={unit}" / f"part-{part:05d}.txt.gz", "wt") as f:
                f.write("".join(r + "\n" for r in rows[a:b]))
    paths, unit = f"{tmp_path}/unit=*/*.gz", U.unit_folder(F.col("file_path"))
    how = {"nth": nth, "first_row_as_header": lost}
    got = _rows(fused.ingest(fused.unit_lines(spark, paths), ["Redundancy"], unit=unit, **how))
    assert got == _rows(_line_by_line(spark, paths, ["Redundancy"], unit=unit, **how))
    kept = [i for i in range(23) if i % 4]
    if not lost:
        assert [r[2] for r in got] == 3 * kept[nth - 1::nth] and [r[0] for r in got] == list(range(1, len(got) + 1))
    assert sorted((r.unit_path[-1], r.n_lines, r.first_line) for r in fused.manifest(
        fused.unit_lines(spark, paths), unit).collect()) == [(u, 25, rows[0]) for u in "345"]


def test_whole_lines_are_never_kept_and_rows_never_shuffled(spark, folder):
    lines = fused.unit_lines(spark, folder)
    found = fused.survivors(lines, ["Redundancy"], nth=3, whole_units=True)
    assert set(found.rows.columns) == {"split", "row", "kept_row", "Redundancy"}
    everything = fused.survivors(lines, ["Redundancy"])
    assert found.rows.count() < everything.rows.count()  # only every third was written
    plan = fused.ingest(lines, ["Redundancy"], nth=3)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "MapInArrow" not in plan and "SortMergeJoin" not in plan


def test_parsed_once_in_the_pass(spark, folder, monkeypatch):
    plans = []
    real = fused.materialize
    monkeypatch.setattr(fused, "materialize", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    fused.survivors(fused.unit_lines(spark, folder), ["Redundancy", "v_call"])
    assert plans[0].count("from_csv") == 1 and "Exchange" not in plans[0]


def test_the_same_file_twice_is_an_error(spark, tmp_path):
    _write(tmp_path / "6.csv.gz", [_row(), _row()])
    path = str(tmp_path / "6.csv.gz")
    with pytest.raises(ValueError, match="given twice"):
        fused.ingest(fused.unit_lines(spark, [path, path]), ["Redundancy"])


def test_uncompressed_units_cut_into_blocks(spark, tmp_path):
    """A plain text unit is cut into byte ranges; only the first begins the unit."""
    rows = [_row(red=str(i), fwr1="A" * (25 if i % 5 else 3)) for i in range(400)]
    (tmp_path / "77.csv").write_text("\n".join(['"{}"', HEADER, *rows]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        got = _rows(fused.ingest(fused.unit_lines(spark, str(tmp_path)), ["Redundancy"], nth=3))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(n + 1, 77, i) for n, i in enumerate([i for i in range(400) if i % 5][2::3])]
