"""Table sinks: the sequences table, metrics, reports, reusable counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repforge.sources.tables import exists


def write_sequences(seqs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The sequences table: Parquet (primary) or CSV, a header line in every
    part file (as Spark's CSV reader expects)."""
    w = seqs.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small result (group sums, statistics) as CSV with a header. The
    aggregation keeps its tasks; only its few result rows move to one file."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines in one file."""
    df.repartition(1).write.mode("overwrite").json(path)


def cached(spark: SparkSession, path: str, compute) -> DataFrame:
    """Reuse a table written earlier at ``path``; otherwise compute it,
    write it and read it back (a lineage cut that survives executor loss)."""
    if exists(spark, path):  # an unreadable table raises; it is never overwritten
        return spark.read.parquet(path)
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
