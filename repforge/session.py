"""Session helpers: build a session for tests/bench and find the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Defaults for a session built here (tests, bench). A session that is
# already active (a cluster's, the driver's) is returned untouched.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "repforge", extra: dict | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder; set one only where none is set
    (local tests). On a cluster this must be a shared filesystem path."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        # A machine-local folder is only safe when driver and executors are
        # one process; on a cluster the shared folder must be configured.
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                               "object store) before running jobs that cut lineage")
        path = os.path.join("/tmp", "repforge-checkpoints")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written
    intermediate tables (lineage cuts that survive executor loss)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet to the shared checkpoint
    folder and reading it back. Survives executor loss (unlike a local
    checkpoint) and gives stable, re-readable ids."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def _importable_on_workers(sc) -> bool:
    """Can the Python workers import this package already (it is installed
    there, or was shipped with ``--py-files``)? Asked in one tiny task for
    each core that the session reports, so that every executor answers."""
    def probe(_):
        import importlib.util
        yield importlib.util.find_spec(__name__.split(".")[0]) is not None
    n = max(1, sc.defaultParallelism)
    return all(sc.parallelize(range(n), n).mapPartitions(probe).collect())


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers that run Arrow
    batch jobs. If they cannot import it yet, zip its sources once per
    application and hand the zip to ``addPyFile``: the driver serves the
    file and every executor fetches its own copy (the zip is never read from
    a shared or local folder by the executors)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    if _importable_on_workers(sc):
        _SHIPPED.add(app)
        return
    root = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(root)
    fd, path = tempfile.mkstemp(prefix="repforge-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(path)
    _SHIPPED.add(app)
