"""Units to sequences in one pass.

A task parses each line of its file split once, numbers it, drops what the
length filter drops, and counts. What it writes are the kept columns of the
lines that pass, their place among the split's lines and among its survivors,
and at the end one row of counts for the split. Positions, every n-th line
and dense ids then follow from the counts alone (one row for each split, put
beside the rows by broadcast): the lines themselves are never shuffled,
sorted or parsed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repforge.functions.coerce import bytes_to_mb
from repforge.functions.regions import INGEST_LENGTHS, ingest_length_predicate
from repforge.operators.ranks import broadcast_checked
from repforge.session import materialize, ship_package
from repforge.sources.units import CSV_OPTIONS, INT_COLUMNS, UNIT_SCHEMA, check_unit_ids, same_uri, unit_id

#: Lines at the head of a unit that are no data: metadata, header and, with
#: ``first_row_as_header``, the first row. Their fate is noted split by split.
HEAD_LINES = 3
_COUNTS = ["file_path", "block", "n_lines", "n_bytes", "n_kept", "head"]


def unit_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_path, block, value): every line of every unit file, not yet read."""
    if not isinstance(paths, str) and len(set(paths)) < len(paths):
        raise ValueError("a file was given twice")
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"),
                                         F.col("_metadata.file_block_start").alias("block"), "value")


@dataclass
class Survivors:
    """``rows``: (split, row, kept_row, columns...), one for each line that
    passed; ``splits``: one row of counts for each file split."""
    rows: DataFrame
    splits: DataFrame


def _runs(split: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(split)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(split)])


def _survive(columns: list[str], schema: pa.Schema, nth: int, lost: int, head_lines: int, whole_units: bool):
    """The Arrow pass. With ``whole_units`` a split at byte 0 begins a unit,
    so every n-th line is already known there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        n = size = kept = head = 0
        path, block = None, 0

        def counts() -> pa.RecordBatch:
            values = {"split": split, "file_path": path, "block": block, "n_lines": n, "n_bytes": size,
                      "n_kept": kept, "head": head}
            return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

        for b in batches:
            if not b.num_rows:
                continue
            for low, high in _runs(b["split"].to_numpy()):
                part = b.slice(low, high - low)
                if part["split"][0].as_py() != split:
                    if split is not None:
                        yield counts()
                    split, path, block = (part[c][0].as_py() for c in ("split", "file_path", "block"))
                    n = size = kept = head = 0
                keep = part["keep"].to_numpy(zero_copy_only=False)
                row = n + np.arange(len(keep))
                kept_row = kept + np.cumsum(keep) - 1
                for i in np.flatnonzero(keep & (row < HEAD_LINES)):
                    head |= 1 << int(row[i])
                n, kept = n + len(keep), kept + int(keep.sum())
                size += pc.sum(part["n_bytes"]).as_py()
                written = keep
                if whole_units and block == 0:
                    place = kept_row + 1 - bin(head & ((1 << head_lines) - 1)).count("1") + lost
                    written = keep & (row >= head_lines) & (place % nth == 0)
                rows = part.filter(pa.array(written))
                empty = {f.name: pa.nulls(rows.num_rows, f.type) for f in schema}
                empty |= {c: rows[c] for c in ("split", *columns)}
                empty |= {"row": pa.array(row[written]), "kept_row": pa.array(kept_row[written])}
                yield pa.RecordBatch.from_arrays([empty[f.name] for f in schema], schema=schema)
        if split is not None:
            yield counts()
    return run


def survivors(lines: DataFrame, columns: list[str], length_filter: bool = True, nth: int = 1, lost: int = 0,
              head_lines: int = 2, whole_units: bool = False, schema: StructType = UNIT_SCHEMA) -> Survivors:
    """Read ``lines`` (file_path, block, value) once; write and reread what
    passes. Fields are parsed by CSV rules against the declared schema; an
    integer column that does not hold one is null."""
    spark = lines.sparkSession
    ship_package(spark)
    parsed = lines.select("file_path", "block", F.octet_length("value").alias("size"),
                          F.from_csv("value", schema.simpleString(), CSV_OPTIONS).alias("_r"))
    wanted = [*columns, *(c for c in INGEST_LENGTHS if length_filter and c not in columns)]
    fields = parsed.select("file_path", "block", "size", *[F.col(f"_r.{c}").alias(c) for c in wanted])
    values = [F.col(c).try_cast("int").alias(c) if c in INT_COLUMNS else F.col(c) for c in columns]
    keep = F.coalesce(ingest_length_predicate(), F.lit(False)) if length_filter else F.lit(True)
    marked = fields.select(F.xxhash64("file_path", "block").alias("split"), "file_path", "block",
                           (F.col("size") + 1).cast("long").alias("n_bytes"), keep.alias("keep"), *values)
    kinds = {f.name: f.dataType.simpleString() for f in marked.schema}
    ddl = ", ".join(["split long", "row long", "kept_row long", *[f"`{c}` {kinds[c]}" for c in columns],
                     "file_path string", "block long", "n_lines long", "n_bytes long", "n_kept long", "head int"])
    types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    arrow = pa.schema([("split", pa.int64()), ("row", pa.int64()), ("kept_row", pa.int64()),
                       *[(c, types[kinds[c]]) for c in columns], ("file_path", pa.string()), ("block", pa.int64()),
                       ("n_lines", pa.int64()), ("n_bytes", pa.int64()), ("n_kept", pa.int64()), ("head", pa.int32())])
    written = materialize(marked.mapInArrow(_survive(columns, arrow, nth, lost, head_lines, whole_units), ddl),
                          "survivors")
    splits = written.where(F.col("n_lines").isNotNull()).select("split", *_COUNTS)
    return Survivors(written.where(F.col("n_lines").isNull()).select("split", "row", "kept_row", *columns), splits)


def placed_splits(splits: DataFrame, unit: Column | None = None, head_lines: int = 2) -> DataFrame:
    """Split table with ``unit_path``, ``start`` (lines of the unit before
    the split), ``skip`` (its first lines that are no data), ``n_data``
    (survivors among the data) and ``base``: what to add to a row's
    ``kept_row`` to get its place among the unit's surviving data, from 0.
    A unit is one file, or with ``unit`` (an expression over file_path) a
    folder of part files in part order."""
    before = (Window.partitionBy("unit_path").orderBy(F.length("file_path"), "file_path", "block")
              .rowsBetween(Window.unboundedPreceding, -1))
    above = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    skip = F.greatest(F.lit(0), F.least(F.col("n_lines"), F.lit(head_lines) - F.col("start"))).cast("int")
    lost = F.bit_count(F.col("head").bitwiseAND(F.expr("shiftleft(1, skip) - 1")))
    return (splits.withColumn("unit_path", unit if unit is not None else F.col("file_path"))
            .withColumn("start", above("n_lines")).withColumn("skip", skip).withColumn("_lost", lost)
            .withColumn("n_data", F.col("n_kept") - F.col("_lost"))
            .withColumn("base", above("n_data") - F.col("_lost")).drop("_lost"))


def _beside_rows(found: Survivors, splits: DataFrame) -> DataFrame:
    """Rows with their split's numbers; lines that are no data go."""
    twice = splits.groupBy("split").count().where("count > 1")
    if twice.limit(1).count():
        raise ValueError("a file was given twice, or two file splits have one hash: "
                         f"{splits.join(twice, 'split').select('file_path').limit(2).collect()}")
    return found.rows.join(broadcast_checked(splits), "split").where(F.col("row") >= F.col("skip"))


def read_units(lines: DataFrame, columns: list[str], unit: Column | None = None,
               first_row_as_header: bool = False) -> DataFrame:
    """Every data row: (File_ID, line, columns...), ``line`` 1-based in its unit."""
    head = 3 if first_row_as_header else 2
    found = survivors(lines, columns, length_filter=False)
    splits = placed_splits(found.splits, unit, head)
    check_unit_ids(splits)
    kept = splits.select("split", "file_path", "start", "skip", unit_id(F.col("unit_path")).alias("File_ID"))
    return _beside_rows(found, kept).select("File_ID", (F.col("start") + F.col("row") + 1).alias("line"), *columns)


def _named(splits: DataFrame, ids: DataFrame) -> DataFrame:
    """Splits with the ``File_ID`` of their unit's URI."""
    ids = ids.select(same_uri(F.col("uri")).alias("uri"), "File_ID")
    splits = splits.withColumn("uri", same_uri(F.col("unit_path")))
    silent = ids.join(splits.select("uri"), "uri", "left_anti")
    if silent.limit(1).count():
        raise ValueError(f"{silent.count()} selected units gave no line, e.g. {silent.first().asDict()}")
    return splits.join(ids, "uri", "left").withColumn("File_ID", F.coalesce(
        "File_ID", F.raise_error(F.concat(F.lit("unit without an id: "), F.col("unit_path"))).cast("bigint")))


def ingest(lines: DataFrame, columns: list[str], nth: int = 1, length_filter: bool = True,
           first_row_as_header: bool = False, unit: Column | None = None,
           ids: DataFrame | None = None) -> DataFrame:
    """Units -> sequences: dense ``Sequence_ID`` from 1 in (unit, line) order,
    ``File_ID`` and ``columns`` of every ``nth`` row that passes the length
    filter, counted within its unit. With ``first_row_as_header`` the row
    that is lost as a header counts as the first one for ``nth``. ``ids``
    (uri, File_ID) names the units; without it ids come from the unit names
    and are checked. A unit that ``ids`` lacks is an error, and so is one of
    ``ids`` that gives no line."""
    head, lost = (3, 1) if first_row_as_header else (2, 0)
    found = survivors(lines, columns, length_filter, nth, lost, head, whole_units=unit is None)
    splits = placed_splits(found.splits, unit, head)
    if ids is None:
        check_unit_ids(splits)
        splits = splits.withColumn("File_ID", unit_id(F.col("unit_path")))
    else:
        splits = _named(splits, ids)
    taken = lambda n: F.expr(f"({n} + {lost}) div {nth} - {lost // nth}")
    units = splits.groupBy("File_ID", "unit_path").agg(F.sum("n_data").alias("n_data"))
    above = Window.orderBy("File_ID", "unit_path").rowsBetween(Window.unboundedPreceding, -1)  # a row for each unit
    units = units.select("unit_path", F.coalesce(F.sum(taken("n_data")).over(above), F.lit(0)).alias("first_id"))
    kept = splits.join(units, "unit_path").select("split", "file_path", "skip", "base", "File_ID", "first_id")
    place = F.col("base") + F.col("kept_row") + 1
    return (_beside_rows(found, kept).withColumn("_place", place)
            .where((F.col("_place") + lost) % nth == 0)
            .select((F.col("first_id") + taken("_place")).alias("Sequence_ID"), "File_ID", *columns))


def _count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file_path", "block", "n_lines", "n_bytes", "first_line"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    now: list | None = None
    split = None

    def counts() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(now, kinds)], names=names)

    for b in batches:
        if not b.num_rows:
            continue
        for low, high in _runs(b["split"].to_numpy()):
            part = b.slice(low, high - low)
            if part["split"][0].as_py() != split:
                if now:
                    yield counts()
                split, path, block, first = (part[c][0].as_py() for c in ("split", "file_path", "block", "value"))
                now = [path, block, 0, 0, first]
            now[2] += part.num_rows
            now[3] += pc.sum(pc.binary_length(part["value"])).as_py() + part.num_rows
    if now:
        yield counts()


def manifest(lines: DataFrame, unit: Column | None = None) -> DataFrame:
    """Per unit: unit_path, first_line, n_lines, bytes, Size_MB. The lines
    pass by once and leave one row for each split; nothing is copied."""
    ship_package(lines.sparkSession)
    splits = lines.select(F.xxhash64("file_path", "block").alias("split"), "file_path", "block", "value").mapInArrow(
        _count_lines, "file_path string, block long, n_lines long, n_bytes long, first_line string")
    path = unit if unit is not None else F.col("file_path")
    in_order = Window.partitionBy("unit_path").orderBy(F.length("file_path"), "file_path", "block")
    splits = splits.withColumn("unit_path", path).withColumn("_place", F.row_number().over(in_order))
    # the split that begins a unit has place 1: the text enters no aggregation buffer
    first = splits.where("_place = 1").select("unit_path", "first_line")
    return (splits.groupBy("unit_path").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bytes").alias("bytes"))
            .join(first, "unit_path").withColumn("Size_MB", bytes_to_mb(F.col("bytes"))))
