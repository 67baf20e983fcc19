"""Read the driver's parquet tables; Catalyst prunes columns and pushes
filters into the scan, so callers select only what they need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that its scheme names. Any
    other error (no access, unknown file system) is raised, never read as
    "nothing there"."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)  # noqa: SLF001


#: A scan is dealt out anew where its largest task holds more than this many
#: times a core's even share of the rows.
UNEVEN = 2
_BUSY: dict[tuple, bool] = {}


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan over the cores before heavy per-row work
    where a few of its splits hold the rows (a file of one row group is cut
    into several splits, and one of them gets everything). A scan of more
    splits than twice the cores is left alone: no shuffle. The rows of each
    split are counted once, without reading a column."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits > 2 * cores:
        return df
    key = (df.sparkSession.sparkContext.applicationId, cores, *sorted(df.inputFiles()))
    if key not in _BUSY:
        rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]  # a row for each split
        _BUSY[key] = bool(rows) and max(rows) * cores > UNEVEN * sum(rows)
    return df.repartition(cores) if _BUSY[key] else df
