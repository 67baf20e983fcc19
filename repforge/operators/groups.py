"""Sequence -> data unit -> individual / publication, and counts per group.

Counts are taken per unit first and only then joined to the catalogue
(aggregate before join), so the join moves one row per unit, not per
sequence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repforge.functions.coerce import sanitize_filename, sanitize_word
from repforge.operators.ranks import broadcast_checked

GROUP_COL = "group_key"


def individual_key() -> Column:
    """``Subject``; a unit without a subject (``'no'``) belongs to the
    pseudo-individual ``no_<sanitised Author>`` of its publication."""
    return (F.when(F.col("Subject") == "no",
                   F.concat(F.lit("no_"), sanitize_word(F.col("Author"))))
             .otherwise(F.col("Subject")))


def units_present(catalogue: DataFrame, seqs: DataFrame) -> DataFrame:
    """Catalogue rows whose unit occurs among the sequences (semi-join)."""
    present = seqs.select(F.col("File_ID").alias("File_index")).distinct()
    return catalogue.join(present, "File_index", "left_semi")


def unit_groups(catalogue: DataFrame, by: str = "individual") -> DataFrame:
    """(File_index, group_key) for every unit with a usable key."""
    if by == "individual":
        key = individual_key()
    elif by == "publication":
        key = F.col("Author")
    else:
        raise ValueError(f"unknown grouping {by!r}")
    return (catalogue.select("File_index", key.alias(GROUP_COL))
                     .where(F.col(GROUP_COL).isNotNull()))


def assign_groups(seqs: DataFrame, catalogue: DataFrame, by: str = "individual") -> DataFrame:
    """Attach ``group_key`` to each sequence; sequences from units missing in
    the catalogue are dropped. The unit table (one row per unit) is
    broadcast after its size is checked, so a hot unit or group never
    lands in one join task."""
    g = broadcast_checked(unit_groups(catalogue, by))
    return (seqs.join(g, seqs["File_ID"] == g["File_index"], "inner")
                .drop("File_index"))


def rows_per_file(seqs: DataFrame) -> DataFrame:
    """Rows per data unit (partial aggregation, no row movement)."""
    return seqs.groupBy(F.col("File_ID").alias("File_index")).agg(
        F.count(F.lit(1)).alias("row_count"))


def rows_per_subject(seqs: DataFrame, catalogue: DataFrame, min_rows: int = 1000) -> DataFrame:
    """Rows per ``Subject`` with more than ``min_rows`` rows, largest first.

    Counts per unit are left-joined with the unit metadata (null keys
    dropped); all ``'no'`` subjects count together.
    """
    counts = rows_per_file(seqs)
    meta = (catalogue.select("File_index", "Subject", "Author")
                     .dropna(subset=["File_index", "Subject"]))
    joined = counts.join(meta, "File_index", "left")
    per_subject = (joined.where(F.col("Subject").isNotNull())
                         .groupBy("Subject").agg(F.sum("row_count").alias("row_count")))
    return (per_subject.where(F.col("row_count") > min_rows)
                       .orderBy(F.col("row_count").desc(), F.col("Subject")))


def sequences_per_group(seqs: DataFrame, catalogue: DataFrame,
                        by: str = "publication") -> DataFrame:
    """(group_key, n_sequences): counts per unit joined to the unit's group."""
    counts = rows_per_file(seqs)
    g = unit_groups(catalogue, by)
    return (counts.join(g, "File_index", "inner")
                  .groupBy(GROUP_COL).agg(F.sum("row_count").alias("n_sequences")))


def group_file_name(by: str) -> Column:
    if by == "individual":
        return F.concat(F.lit("individual_"), F.col(GROUP_COL), F.lit(".csv"))
    return F.concat(F.lit("publication_"), sanitize_filename(F.col(GROUP_COL)), F.lit(".csv"))


def group_size_overview(seqs: DataFrame, catalogue: DataFrame, by: str = "individual") -> DataFrame:
    """Per group file: ``Filename``, ``Number_of_sequences``, largest first."""
    s = sequences_per_group(seqs, catalogue, by)
    return (s.select(group_file_name(by).alias("Filename"),
                     F.col("n_sequences").alias("Number_of_sequences"))
             .orderBy(F.col("Number_of_sequences").desc(), F.col("Filename")))


def publication_adequacy(seqs: DataFrame, catalogue: DataFrame, total: int,
                         raise_on_short: bool = False) -> DataFrame:
    """Rows per publication next to the quota ``ceil(total / publications)``
    and whether the publication is short of it."""
    s = sequences_per_group(seqs, catalogue, "publication")
    n_groups = s.count()          # one number (groups), not rows
    if n_groups == 0:
        raise ValueError("no publications among the sequences")
    need = math.ceil(total / n_groups)
    out = s.select(F.col(GROUP_COL).alias("Author"), "n_sequences",
                   F.lit(need).cast("bigint").alias("needed"),
                   (F.col("n_sequences") < need).alias("is_short"))
    if raise_on_short:
        short = out.where("is_short")
        n_short = short.count()
        if n_short:
            raise ValueError(f"{n_short} publications with fewer than {need} sequences, e.g. "
                             f"{[r.Author for r in short.select('Author').limit(20).collect()]}")
    return out


def write_groups(seqs_with_group: DataFrame, path: str, by: str = "individual",
                 num_partitions: int | None = None, fmt: str = "parquet") -> DataFrame:
    """One folder per group (``partitionBy``) plus the manifest of groups.

    Rows are range-partitioned on (group, id): Spark samples the keys and
    cuts partitions of equal size, so a group holding a third of all rows
    is spread over a third of the tasks, while small groups share a task.
    ``num_partitions`` defaults to ``spark.sql.shuffle.partitions``.
    """
    out = seqs_with_group.withColumn("group_file", group_file_name(by))
    keys = [F.col(GROUP_COL), F.col("Sequence_ID")]
    out = (out.repartitionByRange(num_partitions, *keys) if num_partitions
           else out.repartitionByRange(*keys))
    writer = out.write.mode("overwrite").partitionBy("group_file")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    # the manifest comes from the groups' names, not from the dealt-out rows
    return seqs_with_group.select(GROUP_COL).distinct().select(group_file_name(by).alias("group_file"))
