"""Data units: gzip CSV files whose line 1 is JSON metadata, line 2 the
header, then one row per sequence.

A gzip file is read whole by one task, so parallelism comes from the many
files. The task that reads a split numbers its lines as it goes; the lines
are then written once, and a table of one row per split gives each split its
offset. The unit files are read once, and no number depends on how a second
scan would pack them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from repforge.functions.coerce import bytes_to_mb
from repforge.functions.regions import REGIONS
from repforge.operators.filters import region_length_ingest
from repforge.session import materialize, ship_package

# The 97 columns of a data unit, in file order.
UNIT_COLUMNS = [
    "sequence", "locus", "stop_codon", "vj_in_frame", "v_frameshift", "productive", "rev_comp",
    "complete_vdj", "v_call", "d_call", "j_call", "sequence_alignment", "germline_alignment",
    "sequence_alignment_aa", "germline_alignment_aa", "v_alignment_start", "v_alignment_end",
    "d_alignment_start", "d_alignment_end", "j_alignment_start", "j_alignment_end",
    "v_sequence_alignment", "v_sequence_alignment_aa", "v_germline_alignment",
    "v_germline_alignment_aa", "d_sequence_alignment", "d_sequence_alignment_aa",
    "d_germline_alignment", "d_germline_alignment_aa", "j_sequence_alignment",
    "j_sequence_alignment_aa", "j_germline_alignment", "j_germline_alignment_aa", "fwr1",
    "fwr1_aa", "cdr1", "cdr1_aa", "fwr2", "fwr2_aa", "cdr2", "cdr2_aa", "fwr3", "fwr3_aa", "fwr4",
    "fwr4_aa", "cdr3", "cdr3_aa", "junction", "junction_length", "junction_aa",
    "junction_aa_length", "v_score", "d_score", "j_score", "v_cigar", "d_cigar", "j_cigar",
    "v_support", "d_support", "j_support", "v_identity", "d_identity", "j_identity",
    "v_sequence_start", "v_sequence_end", "v_germline_start", "v_germline_end",
    "d_sequence_start", "d_sequence_end", "d_germline_start", "d_germline_end",
    "j_sequence_start", "j_sequence_end", "j_germline_start", "j_germline_end", "fwr1_start",
    "fwr1_end", "cdr1_start", "cdr1_end", "fwr2_start", "fwr2_end", "cdr2_start", "cdr2_end",
    "fwr3_start", "fwr3_end", "fwr4_start", "fwr4_end", "cdr3_start", "cdr3_end", "np1",
    "np1_length", "np2", "np2_length", "c_region", "Redundancy", "ANARCI_numbering",
    "ANARCI_status",
]
UNIT_SCHEMA = StructType([StructField(c, StringType()) for c in UNIT_COLUMNS])
INT_COLUMNS = ["Redundancy"]
# RFC 4180 quoting: a quote inside a quoted field is doubled.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``row``: the line's place in its file split. A split's lines come
    one after another in one task."""
    key, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        path = b["file_path"].dictionary_encode()
        code, block = path.indices.to_numpy(zero_copy_only=False), b["block"].to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (block[1:] != block[:-1])]))
        row = np.arange(b.num_rows) - np.repeat(first, np.diff(np.concatenate([first, [b.num_rows]])))
        if (path.dictionary[code[0]].as_py(), int(block[0])) == key:
            row[: first[1] if len(first) > 1 else None] += seen
        key, seen = (path.dictionary[code[-1]].as_py(), int(block[-1])), int(row[-1]) + 1
        yield pa.RecordBatch.from_arrays([b["file_path"], b["block"], b["value"], pa.array(row, pa.int64())],
                                         names=["file_path", "block", "value", "row"])


def count_rows(lines: DataFrame) -> DataFrame:
    """(file_path, block, value) -> the same with ``row``."""
    ship_package(lines.sparkSession)
    return lines.select("file_path", "block", "value").mapInArrow(
        _count_rows, "file_path string, block bigint, value string, row bigint")


def read_unit_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_path, block, value, row) for every line of every unit file."""
    return count_rows(spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"), "value"))


def unit_folder(path: Column) -> Column:
    """The folder holding a file: the unit when a unit is stored as several
    gzip part files (``.../unit=17/part-00003-....txt.gz``)."""
    return F.regexp_replace(path, "/[^/]*$", "")


def number_lines(lines: DataFrame, unit: Column | None = None) -> DataFrame:
    """Add ``unit_path`` and ``line``: the 1-based line number within the
    unit. The lines are written once (the only scan of the unit files); the
    window runs on the table of splits. A unit is one file by default; with
    ``unit=unit_folder(...)`` it is a folder of part files, numbered across
    the parts in part order (shorter name first, then by name: numeric order
    of ``part-N``)."""
    lines = materialize(lines.withColumn("unit_path", unit if unit is not None else F.col("file_path")), "unit-lines")
    splits = lines.groupBy("unit_path", "file_path", "block").agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy("unit_path")
         .orderBy(F.length("file_path"), "file_path", "block")
         .rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (lines.join(splits.select("unit_path", "file_path", "block", "_start"),
                       ["unit_path", "file_path", "block"], "inner")
                 .withColumn("line", F.col("_start") + F.col("row") + 1)
                 .drop("_start", "row"))


def same_uri(path: Column) -> Column:
    """``file:///a`` and ``file:/a`` are one URI; schemes, authorities and
    percent signs stay as they are."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*:)/+(?=/[^/])", "$1")


def file_uri(spark: SparkSession, path: str) -> str:
    """The URI under which Spark reports a file: qualified by its own file
    system, special characters percent-encoded."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toUri().toString()  # noqa: SLF001


def unit_id(unit_path: Column) -> Column:
    """Unit id from a unit path (a file or a unit folder): the last run of
    digits of its last segment (``.../unit=17`` or ``.../17.csv.gz``), never
    of a folder above it or of a percent escape."""
    plain = F.regexp_replace(unit_path, "%[0-9A-Fa-f]{2}", "_")
    return F.regexp_extract(plain, r"([0-9]+)[^0-9/]*$", 1).try_cast("bigint")


def check_unit_ids(numbered: DataFrame) -> None:
    """Raise where ids taken from names are missing, or name two units."""
    units = numbered.select("unit_path").distinct().withColumn("id", unit_id(F.col("unit_path")))
    bad = (units.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("unit_path").alias("example"))
           .where(F.col("id").isNull() | (F.col("n") > 1)))
    example = bad.limit(1).collect()
    if example:
        raise ValueError(f"{bad.count()} unit ids are missing or ambiguous, e.g. {example[0].asDict()}; "
                         "give the ids (file_id) instead of taking them from file names")


def parse_units(numbered: DataFrame, schema: StructType = UNIT_SCHEMA,
                first_row_as_header: bool = False,
                file_id: Column | None = None) -> DataFrame:
    """Data rows with named columns, ``File_ID``, ``line``, ``file_path``
    and ``block``.

    Lines 1-2 (metadata, header) are dropped; fields are parsed with real CSV
    rules (quoted commas) against the declared schema. With
    ``first_row_as_header`` the first data row is dropped too (the reference
    scripts lose it). ``file_id`` is an expression over the numbered lines;
    without it ids are taken from the unit names and checked.
    """
    first = 4 if first_row_as_header else 3
    rows = numbered.where(F.col("line") >= first)
    if file_id is None:
        check_unit_ids(numbered)
    fid = file_id if file_id is not None else unit_id(F.col("unit_path"))
    parsed = rows.select(fid.alias("File_ID"), "line", "file_path", "block",
                         F.from_csv(F.col("value"), schema.simpleString(), CSV_OPTIONS).alias("_r"))
    out = parsed.select("File_ID", "line", "file_path", "block", "_r.*")
    for c in INT_COLUMNS:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).try_cast("int"))
    return out


def unit_metadata(numbered: DataFrame) -> DataFrame:
    """(unit_path, metadata): line 1 of every unit, CSV-unquoted."""
    first = numbered.where(F.col("line") == 1)
    return first.select("unit_path", F.from_csv(F.col("value"), "metadata string",
                                                CSV_OPTIONS)["metadata"]
                        .alias("metadata"))


def unit_manifest(numbered: DataFrame) -> DataFrame:
    """Per unit: first line, line count, uncompressed bytes and MB. Counts
    are a hash aggregation (partial before the shuffle); the first line is
    the row numbered 1, joined on (one row per unit each side), so no line
    text goes into an aggregation buffer (that would force a sort of every
    line)."""
    g = numbered.groupBy("unit_path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.octet_length("value") + 1).alias("bytes"))
    first = numbered.where(F.col("line") == 1).select("unit_path", F.col("value").alias("first_line"))
    return (g.join(first, "unit_path", "left")
             .select("unit_path", "first_line", "n_lines", "bytes",
                     bytes_to_mb(F.col("bytes")).alias("Size_MB")))


# Rows per rank bucket at most: a window sorts one bucket in one task.
LINE_BIN = 1 << 20


def ingest(parsed: DataFrame, columns: list[str], nth: int = 1,
           length_filter: bool = True, first_row_as_header: bool = False) -> DataFrame:
    """Units -> sequences table: length filter, every ``nth`` filtered row of
    each unit, kept columns, and dense ``Sequence_ID`` from 1 in (unit,
    line) order. With ``first_row_as_header`` the row lost in parsing counts
    as the first one for ``nth``.

    Positions are computed per (unit, line bin): line numbers are dense
    within a unit, so a bin of ``LINE_BIN`` lines is monotone in the order
    and bounds every window, however large one unit is. Ids follow in closed
    form from the units' counts (one row per unit)."""
    f = region_length_ingest(parsed, enabled=length_filter)
    f = f.withColumn("_lbin", F.floor(F.col("line") / F.lit(LINE_BIN)).cast("bigint"))
    lost = 1 if first_row_as_header else 0
    kept = lambda n: F.expr(f"({n} + {lost}) div {nth} - {lost // nth}")
    counts = materialize(f.groupBy("File_ID", "_lbin").agg(F.count(F.lit(1)).alias("_n")), "unit-bins")
    above = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    units = counts.groupBy("File_ID").agg(F.sum("_n").alias("_n")).select(
        "File_ID", F.coalesce(F.sum(kept("_n")).over(above(Window.orderBy("File_ID"))), F.lit(0)).alias("_unit"))
    bins = counts.withColumn("_before", F.coalesce(
        F.sum("_n").over(above(Window.partitionBy("File_ID").orderBy("_lbin"))), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("File_ID", "_lbin").orderBy("line"))
    ranked = (f.join(bins.join(units, "File_ID").drop("_n"), ["File_ID", "_lbin"])
              .withColumn("_pos", F.col("_before") + place)
              .where((F.col("_pos") + lost) % nth == 0))
    return ranked.select((F.col("_unit") + kept("_pos")).alias("Sequence_ID"), "File_ID", *columns)


# ------------------------------------------------------------ test units
def unit_row_text(df: DataFrame, values: dict[str, Column]) -> Column:
    """One CSV line of the 97 unit columns; unlisted columns are empty and
    values holding a comma or quote are quoted."""
    def field(c: str) -> Column:
        v = values.get(c)
        if v is None:
            return F.lit("")
        v = v.cast("string")
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(v.contains(",") | v.contains('"'), quoted).otherwise(v), F.lit(""))
    return F.concat_ws(",", *[field(c) for c in UNIT_COLUMNS])


def write_units(lines: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Write (unit, ord, value) lines as gzip text, one folder per unit,
    lines in ``ord`` order. Rows are range-partitioned on (unit, ord), so a
    large unit is split into several part files written (and later read) by
    several tasks; part ``N`` holds the lines before part ``N+1``. Read a
    unit back with ``number_lines(..., unit=unit_folder(file_path))``."""
    keys = [F.col("unit"), F.col("ord")]
    ranged = (lines.repartitionByRange(num_partitions, *keys) if num_partitions
              else lines.repartitionByRange(*keys))
    (ranged.sortWithinPartitions("unit", "ord")
           .select("unit", "value").write.mode("overwrite")
           .option("compression", "gzip").partitionBy("unit").text(path))


def residue_unit_lines(res: DataFrame) -> DataFrame:
    """Unit lines for the residue view: one unit per ``File_ID``; metadata
    line, header line, then the rows in ``Sequence_ID`` order. The view is
    written once: its texts are derived in one pass, and the range bounds and
    the units are read from the written columns."""
    res = materialize(res, "unit-rows")
    values = {"sequence": F.col("sequence"), "locus": F.col("locus"),
              "v_call": F.concat(F.col("v_call"), F.lit("*01,"), F.col("v_call"), F.lit("*02")),
              "d_call": F.col("d_call"), "j_call": F.col("j_call"),
              "Redundancy": F.col("Redundancy"), "ANARCI_status": F.lit("|")}
    values.update({r: F.col(r) for r in REGIONS})
    rows = res.select(F.col("File_ID").alias("unit"), F.col("Sequence_ID").alias("ord"),
                      unit_row_text(res, values).alias("value"))
    units = materialize(res.select(F.col("File_ID").alias("unit")).distinct(), "unit-ids")
    meta = units.select("unit", F.lit(-2).cast("bigint").alias("ord"), F.concat(
        F.lit('"{""Run"": ""unit_'), F.col("unit").cast("string"),
        F.lit('"", ""Species"": ""human"", ""Chain"": ""Heavy""}"')).alias("value"))
    header = units.select("unit", F.lit(-1).cast("bigint").alias("ord"),
                          F.lit(",".join(UNIT_COLUMNS)).alias("value"))
    return meta.unionByName(header).unionByName(rows)
