"""FASTA sink and source: ``>Sequence_<id>`` header then one residue line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.functions.regions import concat_regions

HEADER_PREFIX = ">Sequence_"


def fasta_records(seqs: DataFrame, id_col: str = "Sequence_ID",
                  seq_col: str | None = None) -> DataFrame:
    """One two-line record per row; the body is ``seq_col`` or the seven
    regions joined in order."""
    body = F.col(seq_col) if seq_col else concat_regions()
    return seqs.select(
        F.col(id_col).alias("Sequence_ID"),
        F.concat(F.lit(HEADER_PREFIX), F.col(id_col).cast("string"), F.lit("\n"), body)
         .alias("record"))


def fasta_lines(records: DataFrame) -> DataFrame:
    """Records as text lines (``value``), header and body separately."""
    return records.select(F.explode(F.split("record", "\n")).alias("value"))


def write_fasta(records: DataFrame, path: str) -> None:
    records.select(F.col("record").alias("value")).write.mode("overwrite").text(path)


def fasta_ids(lines: DataFrame, col: str = "value") -> DataFrame:
    """Ids of the records in a FASTA text: header lines, the part after the
    first ``_`` (``>Sequence_225`` -> 225)."""
    heads = lines.where(F.col(col).startswith(">"))
    return heads.select(
        F.element_at(F.split(F.trim(F.col(col)), "_"), 2).try_cast("bigint").alias("Sequence_ID"))


def read_fasta_ids(spark: SparkSession, path: str) -> DataFrame:
    return fasta_ids(spark.read.text(path))
