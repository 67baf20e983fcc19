"""op12 against plain integer clustering."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from repforge.llm import centroids
from repforge.llm.queries import op12_centroids

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *[T.StructField(c, T.StringType()) for c in ("cluster", "v", "lead", "rest", "distance")]])


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(3)


def plain(rows, size, scale, k, rounds):
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]
    for _ in range(rounds):
        groups = {}
        for (_, v), (_, c) in zip(kept, assigned()):
            groups.setdefault(c, []).append(v)
        for c, vs in groups.items():
            centres[c] = [sum(x) // len(vs) for x in zip(*vs)]
    final = assigned()
    inertia = {}
    for d, c in final:
        inertia[c] = inertia.get(c, 0) + d
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()),
                   hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                  for (i, _), (d, c) in zip(kept, final))


def found(df):
    return sorted((str(r["vec_id"]), *tuple(r)[1:]) for r in df.collect())


def made_up(n, size, seed, coarse=False):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    rows = [(i, [float(np.float32(rnd.choice([-1, 0, 1]) if coarse else m + rnd.gauss(0, 0.3)))
                 for m in rnd.choice(middle)]) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [0.5] * (size - 1)), (n + 3, [float("nan")] + [0.0] * (size - 1)),
             (n + 4, [float("inf")] + [0.0] * (size - 1)), (n + 5, [None] + [0.0] * (size - 1)),
             (None, [0.25] * size), (None, [-0.25] * size), rows[0], rows[0], (0, rows[1][1])]
    return rows


@pytest.mark.parametrize("size,k,coarse", [(8, 4, False), (64, 16, False), (3, 5, True), (20, 500, False)])
def test_clusters_as_plain_integers(spark, size, k, coarse):
    """Coarse vectors repeat and tie; k = 500 leaves some centroids empty."""
    rows = made_up(300, size, size, coarse)
    assert found(centroids.clustered(vectors(spark, rows), size, 64, k, 3)) == plain(rows, size, 64, k, 3)


def test_no_kept_vectors_and_large_components(spark):
    assert centroids.clustered(vectors(spark, [])).count() == 0
    assert centroids.clustered(vectors(spark, [(1, [1.0]), (2, None)])).count() == 0
    with pytest.raises(Exception, match="beyond"):
        centroids.clustered(vectors(spark, [(1, [3e38] * 64)])).count()


def test_the_bound_never_rules_out_the_nearest():
    rnd = np.random.default_rng(4)
    spread = rnd.normal(size=(64,)) * 1000 * 0.8 ** np.arange(64)
    v = (rnd.normal(size=(3000, 64)) * spread).astype(np.int64)
    rotation = centroids.Rotation(v.mean(0), np.cov(v.T, bias=True))
    c = v[:16].copy()
    best, far, asked = centroids.nearest(v, *rotation(v), c, *rotation(c))
    every = ((v[:, None, :] - c[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (far == every.min(1)).all()
    assert asked < 16 * len(v) / 4  # most centroids are ruled out unseen


def test_query(spark, sf_small):
    import pyarrow.parquet as pq

    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{sf_small}/embeddings.parquet").to_pylist()]
    assert found(op12_centroids(spark, sf_small)) == plain(rows, 64, 64, 16, 3)
