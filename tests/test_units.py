"""Data units read from real gzip files."""

import gzip
import os

from pyspark.sql import functions as F

from repforge.sources import units as U

HEADER = ",".join(U.UNIT_COLUMNS)


def _row(fwr1="A" * 25, cdr1="C" * 8, fwr2="D" * 17, cdr2="E" * 8, fwr3="F" * 38, cdr3="G" * 14,
         fwr4="H" * 12, v='"IGHV1-2*01,IGHV1-2*02"', red="3"):
    vals = {c: "" for c in U.UNIT_COLUMNS}
    vals.update({"locus": "H", "fwr1_aa": fwr1, "cdr1_aa": cdr1, "fwr2_aa": fwr2, "cdr2_aa": cdr2,
                 "fwr3_aa": fwr3, "cdr3_aa": cdr3, "fwr4_aa": fwr4, "v_call": v, "Redundancy": red})
    return ",".join(vals[c] for c in U.UNIT_COLUMNS)


def _write(path, rows):
    with gzip.open(path, "wt") as f:
        f.write('"{""Run"": ""x"", ""Author"": ""Doe et al., 2019""}"\n')
        f.write(HEADER + "\n")
        for r in rows:
            f.write(r + "\n")


def test_units_parse_number_and_ingest(spark, tmp_path):
    d = tmp_path / "units"
    d.mkdir()
    _write(d / "11.csv.gz", [_row(), _row(fwr1="A" * 19), _row(cdr3="  "), _row(red="20")])
    _write(d / "12.csv.gz", [])                       # only lines 1-2
    _write(d / "13.csv.gz", [_row(fwr4="H" * 51)])    # nothing passes
    _write(d / "14.csv.gz", [_row()])                 # one row
    lines = U.number_lines(U.read_unit_lines(spark, str(d)))
    parsed = U.parse_units(lines)
    got = sorted((r.File_ID, r.line, r.v_call, r.Redundancy)
                 for r in parsed.select("File_ID", "line", "v_call", "Redundancy").collect())
    assert got[0] == (11, 3, "IGHV1-2*01,IGHV1-2*02", 3)
    assert [g[:2] for g in got] == [(11, 3), (11, 4), (11, 5), (11, 6), (13, 3), (14, 3)]
    ids = U.ingest(parsed, ["fwr1_aa", "Redundancy"]).orderBy("Sequence_ID").collect()
    assert [(r.Sequence_ID, r.File_ID, r.Redundancy) for r in ids] == [(1, 11, 3), (2, 11, 20), (3, 14, 3)]
    unfiltered = U.ingest(parsed, ["fwr1_aa"], length_filter=False)
    assert unfiltered.count() == 6
    lost = U.parse_units(lines, first_row_as_header=True)
    assert lost.count() == 3
    man = {r.unit_path.rsplit("/", 1)[-1]: r.n_lines for r in U.unit_manifest(lines).collect()}
    assert man == {"11.csv.gz": 6, "12.csv.gz": 2, "13.csv.gz": 3, "14.csv.gz": 3}
    meta = U.unit_metadata(lines).collect()
    assert all(m.metadata.startswith('{"Run": "x"') for m in meta)


def test_every_nth_within_unit(spark, tmp_path):
    d = tmp_path / "u2"
    d.mkdir()
    _write(d / "5.csv.gz", [_row(red=str(i)) for i in range(1, 8)])
    parsed = U.parse_units(U.number_lines(U.read_unit_lines(spark, str(d))))
    out = U.ingest(parsed, ["Redundancy"], nth=3).orderBy("Sequence_ID").collect()
    assert [r.Redundancy for r in out] == [3, 6]


def test_large_unit_split_into_parts(spark, tmp_path):
    """A unit holding most rows is written as several gzip parts by several
    tasks; read back as one unit, its lines and ids follow the write order."""
    n = 600
    rows = spark.range(n).select(
        F.when(F.col("id") < 500, F.lit(7)).otherwise(F.lit(8)).alias("unit"),
        F.col("id").alias("ord"),
        F.concat_ws(",", *[F.col("id").cast("string") if c == "Redundancy" else
                           (F.lit("A" * 25) if c == "fwr1_aa" else F.lit(""))
                           for c in U.UNIT_COLUMNS]).alias("value"))
    head = spark.createDataFrame([(u, -2, '"{""Run"": ""r""}"') for u in (7, 8)] +
                                 [(u, -1, HEADER) for u in (7, 8)], "unit long, ord long, value string")
    path = str(tmp_path / "big")
    U.write_units(head.unionByName(rows), path, num_partitions=6)
    parts = os.listdir(os.path.join(path, "unit=7"))
    assert len([p for p in parts if p.endswith(".gz")]) >= 3
    lines = U.number_lines(U.read_unit_lines(spark, f"{path}/unit=*/*.gz"),
                           unit=U.unit_folder(F.col("file_path")))
    parsed = U.parse_units(lines)
    got = sorted((r.File_ID, r.line, r.Redundancy) for r in
                 parsed.select("File_ID", "line", "Redundancy").collect())
    assert got == sorted([(7, i + 3, i) for i in range(500)] + [(8, i + 3, 500 + i) for i in range(100)])
    ids = U.ingest(parsed, ["Redundancy"], length_filter=False).orderBy("Sequence_ID").collect()
    assert [r.Redundancy for r in ids] == list(range(n))
    assert {r.n_lines for r in U.unit_manifest(lines).collect()} == {502, 102}


def test_ids_exact_when_units_span_many_line_bins(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "LINE_BIN", 4)      # windows of at most 4 lines
    d = tmp_path / "bins"
    d.mkdir()
    _write(d / "21.csv.gz", [_row(red=str(i), fwr1="A" * (25 if i % 3 else 19)) for i in range(1, 30)])
    _write(d / "22.csv.gz", [_row(red=str(100 + i)) for i in range(1, 12)])
    parsed = U.parse_units(U.number_lines(U.read_unit_lines(spark, str(d))))
    out = U.ingest(parsed, ["Redundancy"]).orderBy("Sequence_ID").collect()
    expect = [i for i in range(1, 30) if i % 3] + [100 + i for i in range(1, 12)]
    assert [r.Redundancy for r in out] == expect
    assert [r.Sequence_ID for r in out] == list(range(1, len(expect) + 1))
    nth = U.ingest(parsed, ["Redundancy"], nth=3).orderBy("Sequence_ID").collect()
    per_unit = {21: [i for i in range(1, 30) if i % 3], 22: [100 + i for i in range(1, 12)]}
    assert [r.Redundancy for r in nth] == per_unit[21][2::3] + per_unit[22][2::3]


def test_first_row_as_header_counts_for_nth(spark, tmp_path):
    """Rows kept with n = 3: the lost first row is line 1 of the count."""
    d = tmp_path / "lost"
    d.mkdir()
    _write(d / "4.csv.gz", [_row(red=str(i)) for i in range(1, 11)])
    lines = U.number_lines(U.read_unit_lines(spark, str(d)))
    parsed = U.parse_units(lines, first_row_as_header=True)
    out = U.ingest(parsed, ["Redundancy"], nth=3, first_row_as_header=True).orderBy("Sequence_ID").collect()
    assert [(r.Sequence_ID, r.Redundancy) for r in out] == [(1, 3), (2, 6), (3, 9)]


def test_ids_come_from_the_unit_not_from_its_folder(spark, tmp_path):
    import pytest
    d = tmp_path / "2024"
    d.mkdir()
    _write(d / "5.csv.gz", [_row()])
    _write(d / "a b.csv.gz", [_row()])
    with pytest.raises(ValueError, match="missing or ambiguous"):
        U.parse_units(U.number_lines(U.read_unit_lines(spark, str(d))))
    only = U.parse_units(U.number_lines(U.read_unit_lines(spark, str(d / "5.csv.gz"))))
    assert [r.File_ID for r in only.select("File_ID").collect()] == [5]


def test_every_selected_unit_is_read(spark, tmp_path):
    """Folders ending in digits, blanks, percent signs and names without
    digits: each file's rows come back under its catalogue id."""
    import pytest
    from repforge.plans.curate import CurateConfig, ingest_selected
    d = tmp_path / "in 2024"
    d.mkdir()
    names = ["x.csv.gz", "with blank.csv.gz", "100%.csv.gz", "a+b.csv.gz", "7.csv.gz"]
    for i, n in enumerate(names):
        _write(d / n, [_row(red=str(10 * i + k)) for k in range(i + 1)])
    cat = spark.createDataFrame([(i, "human", "Heavy", f"l{i}") for i in range(len(names))],
                                "File_index long, Species string, Chain string, Download_Link string")
    cfg = CurateConfig(columns_to_keep=["Redundancy"])
    for prefix in ("", "file://"):
        paths = spark.createDataFrame([(i, f"{prefix}{d}/{n}") for i, n in enumerate(names)],
                                      "File_index long, path string")
        got = sorted((r.File_ID, r.Redundancy) for r in ingest_selected(spark, cat, paths, cfg).collect())
        assert got == [(i, 10 * i + k) for i in range(len(names)) for k in range(i + 1)]
    with pytest.raises(ValueError, match="1 selected units have no path"):
        ingest_selected(spark, cat, paths.where("File_index > 0"), cfg)
    with gzip.open(d / "7.csv.gz", "wt"):
        pass
    with pytest.raises(ValueError, match="1 selected units gave no line"):
        ingest_selected(spark, cat, paths, cfg)


def test_unit_files_are_scanned_once(spark, tmp_path):
    """No plan of a query over numbered lines scans the unit files: they
    were read when the lines were written."""
    d = tmp_path / "once"
    d.mkdir()
    _write(d / "9.csv.gz", [_row(red=str(i)) for i in range(5)])
    lines = U.number_lines(U.read_unit_lines(spark, str(d)))
    for df in (U.parse_units(lines), U.ingest(U.parse_units(lines), ["Redundancy"], nth=2), U.unit_manifest(lines)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and plan.count("MapInArrow") == 0

