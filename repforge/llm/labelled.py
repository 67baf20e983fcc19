"""Bounded, documented samples of labelled rows to fit a classifier on."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.common import crc_remainder, texts_of

#: A classifier is fitted on at most this many labelled rows ...
TRAIN_ROWS = 8_000
#: ... and this many characters, taken in the order of a hash of the id.
TRAIN_CHARS = 48_000_000


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                  rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents whose
    crc32(doc_id) mod ``modulus`` is not ``held_out``. Null labels and ids
    are skipped; where an id has several labels the largest counts, where it
    has several texts the largest one."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                     & (crc_remainder(F.col("doc_id"), modulus) != held_out))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    texts = texts_of(docs)
    first = (texts.select("doc_id", F.length("text").alias("n")).join(marks, "doc_id")
             .groupBy("doc_id", "label").agg(F.max("n").alias("n"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    along = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (first.withColumn("so_far", F.sum("n").over(along))  # at most ``rows`` rows
              .filter((F.col("so_far") <= chars)).select("doc_id", "label"))
    return (texts.join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
            .select("doc_id", "text", "label"))


def in_order(batches: Iterator[pa.RecordBatch]) -> tuple[list[int], Iterator[str]]:
    """Labels and texts of ``training_rows``, ascending by id; a text becomes
    a Python string when it is read."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return [], iter(())
    rows = pa.Table.from_batches(held).sort_by("doc_id")
    return rows["label"].to_pylist(), (t.as_py() for t in rows["text"])
