"""Exact integer centroid clustering with a PCA-rotated filter.

Vectors become integers. One pass sums their moments; the eigenvectors of
the covariance rotate them so that the leading coordinates hold most of the
spread. A vector is stored once: its integers, its ``LEAD`` leading rotated
coordinates and the norm of the rest. For a vector v and a centroid c

    |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2  <=  |v - c|^2

so the left side, LEAD + 1 numbers instead of all, rules centroids out. What
survives is compared exactly, in integers; floating point never decides.

Each round is one pass over the stored table. A task returns a sum for each
centroid, never vectors; centroids (k rows) are all that reaches the driver
and all that is sent to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, map_arrow

#: Leading rotated coordinates that are stored and compared.
LEAD = 12
#: Components beyond this stop the job: a squared distance of 64 such
#: components still fits a signed 64-bit integer.
LARGEST = 1 << 27
#: Share of the squared norms that rounding in the bound can never reach.
SLACK = 1e-9
#: Vectors compared at once inside a task.
RUN = 8_192


# --- integers ---------------------------------------------------------------

def kept_vectors(rows: DataFrame, size: int, scale: int, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of vectors that have exactly ``size``
    components, none null, NaN or infinite. Null and repeated ids keep their
    rows; null vectors and those of another length go."""
    whole = (F.size("x") == size) & F.forall("x", lambda y: F.coalesce(
        ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(F.col("x"), lambda y: F.floor(y * F.lit(float(scale))))
    beyond = F.exists(F.col("x"), lambda y: F.abs(y * F.lit(float(scale))) >= LARGEST)
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
            .filter(F.coalesce(whole, F.lit(False)))
            .select("vec_id", F.when(beyond, F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
                                     .cast("array<int>")).otherwise(scaled.cast("array<int>")).alias("v")))


def first_centroids(vectors: DataFrame, k: int, salt: str = "1") -> np.ndarray:
    """The k vectors with the smallest sha256 of ``salt:vec_id``, in that
    order (all of them where there are fewer; null ids last; equal ids by
    their components)."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), size)


# --- rotation -----------------------------------------------------------------

def moments(vectors: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance over all vectors. A task returns one row of
    size + size^2 + 1 sums; they are added up on Spark, component by component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for b in batches:
            if b.num_rows:
                v = _matrix(b["v"], size).astype(np.float64)
                total[0] += len(v)
                total[1: size + 1] += v.sum(0)
                total[size + 1:] += (v.T @ v).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)],
                                         names=["place", "part"])
    sums = np.zeros(1 + size + size * size)
    parts = map_arrow(vectors.select("v"), run, "place int, part double").groupBy("place").agg(F.sum("part").alias("s"))
    for r in parts.collect():  # 1 + size + size^2 rows
        sums[r["place"]] = r["s"]
    n = max(sums[0], 1.0)
    mean = sums[1: size + 1] / n
    return mean, sums[size + 1:].reshape(size, size) / n - np.outer(mean, mean)


class Rotation:
    """Leading coordinates and norm of the rest, about the mean."""

    def __init__(self, mean: np.ndarray, covariance: np.ndarray, lead: int = LEAD):
        _, axes = np.linalg.eigh(covariance)
        self.mean, self.axes = mean, np.ascontiguousarray(axes[:, ::-1][:, :lead])

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centred = v - self.mean
        lead = centred @ self.axes
        rest = np.sqrt(np.maximum((centred * centred).sum(1) - (lead * lead).sum(1), 0.0))
        return lead, rest


def stored(vectors: DataFrame, rotation: Rotation, size: int) -> DataFrame:
    """(vec_id, v, lead, rest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                lead, rest = rotation(_matrix(b["v"], size))
                ends = np.arange(len(lead) + 1, dtype=np.int32) * lead.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b["vec_id"], b["v"], pa.ListArray.from_arrays(ends, lead.ravel()), pa.array(rest)],
                    names=["vec_id", "v", "lead", "rest"])
    return map_arrow(vectors, run, "vec_id long, v array<int>, lead array<double>, rest double")


# --- assignment ---------------------------------------------------------------

def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray,
            c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, its squared distance, exact distances computed).
    Equal distances go to the smaller number."""
    n, k = len(v), len(centroids)
    rows = np.arange(n)
    bound = np.empty((n, k))
    for c in range(k):
        bound[:, c] = ((lead - c_lead[c]) ** 2).sum(1) + (rest - c_rest[c]) ** 2
    size = ((lead * lead).sum(1) + rest * rest)[:, None] + ((c_lead * c_lead).sum(1) + c_rest * c_rest)[None, :] + 1.0
    bound -= SLACK * size
    v = v.astype(np.int64)

    def exact(i: np.ndarray, c: np.ndarray) -> np.ndarray:
        gap = v[i] - centroids[c]
        return np.einsum("ij,ij->i", gap, gap)

    best = bound.argmin(1)
    far = exact(rows, best)
    asked = n
    bound[rows, best] = np.inf
    for c in range(k):  # in ascending order: the smaller number wins a tie
        i = np.flatnonzero(bound[:, c] <= far)
        if len(i):
            d = exact(i, np.full(len(i), c))
            asked += len(i)
            closer = (d < far[i]) | ((d == far[i]) & (c < best[i]))
            best[i[closer]], far[i[closer]] = c, d[closer]
    return best, far, asked


def _assigner(rotation: Rotation, centroids: np.ndarray, size: int):
    c_lead, c_rest = rotation(centroids)

    def parts(b: pa.RecordBatch):
        for low in range(0, b.num_rows, RUN):
            s = b.slice(low, RUN)
            v, lead = _matrix(s["v"], size), _matrix(s["lead"], c_lead.shape[1])
            yield s, v, *nearest(v, lead, s["rest"].to_numpy(), centroids, c_lead, c_rest)[:2]
    return parts


def cluster_sums(table: DataFrame, rotation: Rotation, centroids: np.ndarray, size: int) -> DataFrame:
    """(cluster, place, s): sums of the components of each cluster's vectors,
    and at place ``size`` their number. A task returns k * (size + 1) rows."""
    assigned, k = _assigner(rotation, centroids, size), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for b in batches:
            for _, v, best, _ in assigned(b):
                order = np.argsort(best, kind="stable")
                here, first = np.unique(best[order], return_index=True)
                total[here, :size] += np.add.reduceat(v[order].astype(np.int64), first, axis=0)
                total[:, size] += np.bincount(best, minlength=k)
        cluster, place = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(cluster.ravel(), pa.int32()), pa.array(place.ravel(), pa.int32()),
                                          pa.array(total.ravel())], names=["cluster", "place", "part"])
    return (map_arrow(table, run, "cluster int, place int, part long")
            .groupBy("cluster", "place").agg(F.sum("part").alias("s")))


def moved(table: DataFrame, rotation: Rotation, centroids: np.ndarray, size: int) -> np.ndarray:
    """Centroids after one round: floor(sum / count) of each component; an
    empty centroid stays."""
    sums = [[0] * (size + 1) for _ in centroids]
    for r in cluster_sums(table, rotation, centroids, size).collect():  # k * (size + 1) rows
        sums[r["cluster"]][r["place"]] = r["s"]
    return np.array([[s // total[size] for s in total[:size]] if total[size] else list(c)
                     for total, c in zip(sums, centroids.tolist())], np.int64)


def assign(table: DataFrame, rotation: Rotation, centroids: np.ndarray, size: int) -> DataFrame:
    """(vec_id, cluster, distance)."""
    assigned = _assigner(rotation, centroids, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, _, best, far in assigned(b):
                yield pa.RecordBatch.from_arrays([s["vec_id"], pa.array(best, pa.int32()), pa.array(far, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])
    return map_arrow(table, run, "vec_id long, cluster int, distance long")


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clustered(rows: DataFrame, size: int = 64, scale: int = 64, k: int = 16, rounds: int = 3,
              id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of
    every kept vector.

    Null vectors, vectors of another length and those with a null or
    non-finite component give no row; an empty table gives none either.
    Repeated ids and equal vectors each keep their row; with fewer than ``k``
    kept vectors there are as many centroids. A component beyond ``LARGEST``
    stops the job with an error. Other columns are left behind.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark)
    vectors = scratch.save(kept_vectors(rows, size, scale, id_col, vec_col), "vectors")
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        scratch.drop(vectors)
        return spark.createDataFrame([], RESULT)
    rotation = Rotation(*moments(vectors, size), min(LEAD, size))
    table = scratch.save(stored(vectors, rotation, size), "rotated")
    scratch.drop(vectors)
    for _ in range(rounds):
        centroids = moved(table, rotation, centroids, size)
    found = scratch.save(assign(table, rotation, centroids, size), "clusters")
    scratch.drop(table)
    inertia = {r["cluster"]: r["s"] for r in  # k rows
               found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    marks = spark.createDataFrame([(c, s, sum(inertia.values()), digests[c]) for c, s in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(marks), "cluster")  # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
