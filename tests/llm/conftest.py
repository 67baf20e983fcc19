import random

import pytest
from pyspark.sql import types as T

CLASHING = ["score", "kept", "key", "n", "a", "b", "token", "sha256", "component_id", "bucket", "bytes", "class",
            "copy", "spans", "words", "host", "rank", "length", "held_out"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       *[T.StructField(c, T.StringType()) for c in CLASHING]])


def frame(spark, rows):
    """documents with clashing extra columns; rows are (doc_id, text)."""
    extra = [None] * (3 + len(CLASHING))
    return spark.createDataFrame([(d, t, *extra) for d, t in rows], SCHEMA).repartition(3)


def odd_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta,", "épsilon", "zeta.", "idiot", "1999", "—", "漢字"]
    long = " ".join(rnd.choice(words) for _ in range(60_000))
    base = [" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 4, 5, 6, 30, 200)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, None), (21, ""), (22, "  \n\t "), (23, long), (24, base[5]), (25, base[5]), (25, base[5]),
             (26, base[6] + " tail"), (27, "\x00 odd \x1c signs "), (28, "a\n \n  b   "), (-3, base[6]),
             (None, "no id"), (None, base[6]), (None, None), (9_000_000_000, base[0]), (9_000_000_000, "other text")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
