"""Tables whose writes are seen whole or not at all.

A write goes to a folder of its own; then a manifest (a row for each file:
rows, bytes, checksum of its rows) is written beside it and moved into place
under the next version number, which one move does or does not do. Readers
follow the newest manifest, so a failed or repeated write is never half seen,
and a table can be checked against what was committed.

A table may also remember the files it was computed from (their names,
lengths and times); ``reused`` computes it again when those have changed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_INPUTS = "file string, length long, modified long"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first. A missing table has none; any other
    error is raised."""
    fs, folder = _fs(spark, f"{path}/_manifest")
    if not fs.exists(folder):
        return []
    found = (re.fullmatch(r"v(\d+)", s.getPath().getName()) for s in fs.listStatus(folder))
    return sorted(int(m[1]) for m in found if m)


def _rows_of(df: DataFrame) -> DataFrame:
    """(file, rows, checksum) of a frame that was read from files. The
    checksum does not depend on the order of rows."""
    columns = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    digest = F.xxhash64(*columns).cast("decimal(38,0)")
    return (df.groupBy(F.regexp_extract("_metadata.file_path", "([^/]*/)*[^/]*$", 0).alias("file"),
                       F.col("_metadata.file_size").alias("bytes"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).cast("string").alias("checksum")))


def write_committed(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    inputs: Sequence[str] = ()) -> int:
    """Write ``df`` as the next version of the table at ``path`` and return
    its number. ``inputs`` (files or folders) are remembered with it."""
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    seen = fingerprint(spark, inputs) if inputs else []  # before the work: a later change is a change
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    written = _rows_of(spark.read.parquet(f"{path}/{folder}")).withColumn("folder", F.lit(folder))
    staged = f"{path}/_manifest/.{folder}"
    written.repartition(1).write.parquet(f"{staged}/files")  # a row for each file
    spark.createDataFrame([(folder,)], "folder string").repartition(1).write.parquet(f"{staged}/table")
    spark.createDataFrame(seen, _INPUTS).repartition(1).write.parquet(f"{staged}/inputs")
    fs, source = _fs(spark, staged)
    number = max(versions(spark, path), default=0) + 1
    while True:
        target = _fs(spark, f"{path}/_manifest/v{number}")[1]
        if not fs.exists(target) and fs.rename(source, target):
            return number
        number += 1  # another writer was first


def read_committed(spark: SparkSession, path: str, version: int | None = None, check: bool = False) -> DataFrame:
    """The newest committed version (or ``version``). With ``check`` the
    files are read once more and compared with the manifest."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no committed version {version or ''} at {path}")
    base = f"{path}/_manifest/v{version or known[-1]}"
    folder = spark.read.parquet(f"{base}/table").first()["folder"]
    df = spark.read.parquet(f"{path}/{folder}")
    if check:
        said = spark.read.parquet(f"{base}/files").drop("folder")
        now = _rows_of(df)
        wrong = said.exceptAll(now).unionByName(now.exceptAll(said))
        bad = wrong.limit(1).collect()
        if bad:
            raise ValueError(f"table at {path} is not what was committed, e.g. {bad[0].asDict()}")
    return df


def drop_uncommitted(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the data of failed writes and all but the newest ``keep``
    versions; returns how many folders went. For a time without writers."""
    known = versions(spark, path)
    fs, root = _fs(spark, path)
    for old in known[:-keep]:
        fs.delete(_fs(spark, f"{path}/_manifest/v{old}")[1], True)
    live = {spark.read.parquet(f"{path}/_manifest/v{v}/table").first()["folder"] for v in known[-keep:]}
    gone = [s.getPath() for s in fs.listStatus(root)
            if s.getPath().getName().startswith("data-") and s.getPath().getName() not in live]
    staged = [s.getPath() for s in fs.listStatus(_fs(spark, f"{path}/_manifest")[1])
              if s.getPath().getName().startswith(".data-")] if known else []
    for folder in gone + staged:
        fs.delete(folder, True)
    return len(gone)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """(file, length, modification time) of every file at or below the
    paths, hidden ones aside; a path that is missing is an error."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        todo = [fs.getFileStatus(p)]
        while todo:
            status = todo.pop()
            if status.isDirectory():
                todo += [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
            else:
                out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(set(out))


def reused(spark: SparkSession, path: str, inputs: Sequence[str], compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path`` if it was computed from these very files,
    otherwise computed, committed and read back."""
    known = versions(spark, path)
    if known:
        then = spark.read.parquet(f"{path}/_manifest/v{known[-1]}/inputs").collect()  # a row for each input file
        if sorted(map(tuple, then)) == fingerprint(spark, inputs):
            return read_committed(spark, path)
    write_committed(compute(), path, inputs=inputs)
    return read_committed(spark, path)
