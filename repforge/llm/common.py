"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.session import scratch_path, ship_package

#: Code points handled at once inside a task. A longer text is handled alone.
SLICE_CHARS = 2_000_000


_HELD: dict[str, object] = {}


def held_alone(build: Callable) -> Callable:
    """Keep what ``build`` returns for the next call with the same arguments,
    and nothing else that was kept so: a Python worker that goes on to
    another operator lets the tables of the last one go."""
    @wraps(build)
    def get(*args):
        key = (build.__module__, build.__qualname__, *args)
        if _HELD.get("key") != key:
            _HELD.clear()
            _HELD["state"], _HELD["key"] = build(*args), key
        return _HELD["state"]
    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null text read as empty; every other column, and
    any clash of its name with a result column, is left behind here."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``limit`` code points each."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def sliced(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of a column's texts of about ``limit`` bytes
    each; only one run at a time is held as Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(column):
        start = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield low, column.slice(low, high - low).to_pylist()
        low = high


@contextmanager
def batches_of(spark: SparkSession, most: str) -> Iterator[None]:
    """Arrow batches sent to Python hold about ``most`` bytes in here."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def batch_of(columns: dict[str, Iterable], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in types.items()],
                                      names=list(types))


class Scratch:
    """Tables written to the shared checkpoint folder to cut lineage, and
    deleted again when no later step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.parquet(path)
        out._scratch = path  # noqa: SLF001
        return out

    def keep(self, df: DataFrame, source: DataFrame) -> DataFrame:
        """``df``, to be dropped as the written ``source`` that it reads."""
        df._scratch = source._scratch  # noqa: SLF001
        return df

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch)  # noqa: SLF001
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"_{prefix}_{uuid.uuid4().hex[:8]}"


#: A key with more than this share of the rows is joined by broadcast, so at
#: most 1/HOT_SHARE keys are ever broadcast.
HOT_SHARE = 1 / 512


def join_owners(rows: DataFrame, owners: DataFrame, key: str, size_col: str) -> DataFrame:
    """Inner join of many rows with one owner row per key. ``owners`` (a
    written table) says how many rows each key has: keys above
    ``HOT_SHARE`` of all rows, at most 1/HOT_SHARE of them, are broadcast,
    the rest is a shuffle join without a hot key."""
    total = owners.agg(F.sum(size_col)).first()[0] or 0
    bound = max(1000, int(total * HOT_SHARE))
    hot = owners.filter(F.col(size_col) > bound)
    cold = owners.filter(F.col(size_col) <= bound)
    hot_keys = [r[0] for r in hot.select(key).collect()]
    if not hot_keys:
        return rows.join(cold, key)
    is_hot = F.col(key).isin(hot_keys)
    return (rows.filter(is_hot).join(F.broadcast(hot), key)
            .unionByName(rows.filter(~is_hot).join(cold, key)))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
