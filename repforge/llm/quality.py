"""Quality classifier: hashed word n-grams, logistic regression by FTRL.

A word is a run of letters, of digits, or of one other character; it has a
hash and a shape (case, digits, kind and repetition of a sign). Features are
hashed n-grams: words, word pairs, shape triples, and whether a word repeats
the one before. The counts of each kind are scaled to unit length. Weights
come from follow-the-regularised-leader updates over a bounded sample of
labelled rows; a score is the sigmoid of a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repforge.llm.chunks import ChunkIds
from repforge.llm.common import crc_remainder, held_alone, sliced, texts_of
from repforge.llm.labelled import TRAIN_CHARS, TRAIN_ROWS, in_order, training_rows
from repforge.session import ship_package

#: Buckets of hashed n-grams.
BUCKETS = 1 << 18
EPOCHS = 3
_WORD = re.compile(r"[^\W\d_]+|\d+|(\W|_)\1*")
_WORD_BITS = 25


def _shape(word: str) -> int:
    c = word[0]
    if c.isalpha():
        return 1 if word.islower() else 2 if word.isupper() else 3 if word[1:].islower() else 4
    if c.isdigit():
        return 5
    sign = ".,;:!?'\"-()|#$%&*_/@<>=+~".find(c) + 1
    return 6 + sign + (28 if len(word) > 1 else 0)


def _encode(fresh: list[str]) -> list[list[int]]:
    mask = (1 << _WORD_BITS) - 1
    return [[_shape(w) << _WORD_BITS | xxhash.xxh32_intdigest(w) & mask
             for w in (m.group() for m in _WORD.finditer(chunk))] for chunk in fresh]


@held_alone
def _words() -> ChunkIds:
    return ChunkIds(_encode)


def _mix(kind: int, *parts: np.ndarray) -> np.ndarray:
    value = np.full(len(parts[0]), kind * 0x9E3779B97F4A7C15 & 2**64 - 1, np.uint64)
    for p in parts:
        value = (value ^ p.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
    return (value % np.uint64(BUCKETS)).astype(np.int64)


def features(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of one text's word ids."""
    shape = ids >> _WORD_BITS
    kinds = [_mix(1, ids), _mix(2, ids[:-1], ids[1:]), _mix(3, shape[:-2], shape[1:-1], shape[2:]),
             _mix(4, (ids[1:] == ids[:-1]).astype(np.int32)), _mix(5, shape)]
    at, value = [np.zeros(1, np.int64)], [np.ones(1)]
    for k in kinds:
        if len(k):
            buckets, counts = np.unique(k, return_counts=True)
            at.append(buckets)
            value.append(counts / np.sqrt(float(counts @ counts)))
    return np.concatenate(at), np.concatenate(value)


def text_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [features(ids) for ids in _words().ids([t.split() for t in texts])]


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss."""

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.3
    l2: float = 0.5
    z: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    n: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) > self.l1, shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2), 0.0)

    def update(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(float(w @ value)) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(texts: Iterable[str], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights of all buckets. Without rows: all zero (every score is 0.5).
    Texts are read once and held as their features."""
    rows = [(a.astype(np.int32), v.astype(np.float32)) for t in texts for a, v in text_features([t])]
    model, rng = Ftrl(), np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            model.update(at, value.astype(float), labels[i])
    return model.weights().astype(np.float32)


def score_texts(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    out = np.empty(len(texts))
    for low, part in sliced(texts):
        out[low: low + len(part)] = [v @ weights[a] for a, v in text_features(part)]
    return sigmoid(out)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held_out: int = 2,
        rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> np.ndarray:
    """Weights from at most ``rows`` labelled rows and ``chars`` characters,
    fitted in one task; only the weights come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, texts = in_order(batches)
        weights = train(texts, marks)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])
    ship_package(docs.sparkSession)
    sample = training_rows(docs, labels, label, modulus, held_out, rows, chars)
    found = sample.repartition(1).mapInArrow(run, "weights binary").collect()
    return np.frombuffer(found[0][0], np.float32) if found else np.zeros(BUCKETS, np.float32)


def score_column(spark, weights: np.ndarray, text: Column) -> Column:
    """Score of a text column (null counts as empty)."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)  # BUCKETS numbers

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, shared.value))
    return score(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label: str = "quality",
           modulus: int = 4, held_out: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score >= threshold).

    Null text counts as empty and gets the bias alone. Equal texts have equal
    scores; rows are independent; null ids are not held out; extra columns
    are ignored; an empty table gives an empty result, and without labelled
    rows every score is 0.5."""
    weights = fit(docs, labels, label, modulus, held_out)
    rows = texts_of(docs)
    return (rows.select("doc_id", F.coalesce(crc_remainder(F.col("doc_id"), modulus) == held_out,
                                             F.lit(False)).alias("held_out"),
                        score_column(docs.sparkSession, weights, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
