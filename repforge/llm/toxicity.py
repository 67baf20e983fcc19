"""Toxic spans by a linear-chain conditional random field.

Tags are clean and toxic, one for each word. A word's evidence is the sum of
the weights of its features (the word, its first 3 to 8 letters), and the
tags of neighbouring words are tied by transition weights. Training words
are labelled from the marked documents: in a toxic document a word is a
toxic word where its most specific feature that is known well enough is
found in toxic documents nearly alone, far beyond chance. Forward-backward
marginals give each word's probability; the words at 0.5 or more are the
offending spans, and a document's score comes from its marginals: the
likeliest word's, and the evidence of all likely words together.

Forward-backward runs over many texts in lockstep, one numpy operation per
word position, on whole texts.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain as chained
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repforge.llm.chunks import ChunkIds
from repforge.llm.common import crc_remainder, held_alone, map_arrow, sliced, texts_of
from repforge.llm.labelled import TRAIN_CHARS, TRAIN_ROWS, in_order, training_rows
from repforge.session import ship_package

#: Buckets of hashed word features.
BUCKETS = 1 << 18
PREFIXES = range(3, 9)
#: A feature marks toxic words if this share of its documents is toxic ...
PRECISION = 0.8
#: ... and a feature decides about a word if so many documents have it.
SUPPORT = 4
EPOCHS = 4
BATCH = 64
#: Words times texts that one lockstep group holds.
CELLS = 500_000
LIMIT = 30.0
#: Log odds beyond which a word counts as sure.
SURE = 8.0

_WORD = re.compile(r"[^\W\d_]+")


def names(word: str) -> list[str]:
    """Features of a lower-cased word, most specific first."""
    return ["=" + word, *(word[:k] for k in reversed(PREFIXES) if len(word) > k)]


def buckets(word: str) -> list[int]:
    return [xxhash.xxh32_intdigest(n) % BUCKETS for n in names(word)]


# --- labelled words -----------------------------------------------------------

def _numbered(words: list[str]) -> tuple[np.ndarray, int]:
    """Numbers of each word's features, most specific first and -1 where a
    word has fewer, and how many features there are. The word itself has its
    own number; prefixes are numbered one length at a time."""
    at = np.full((len(words), 1 + len(PREFIXES)), -1, np.int32)
    at[:, 0] = np.arange(len(words))
    n = len(words)
    for column, k in enumerate(reversed(PREFIXES), 1):
        seen: dict[str, int] = {}
        for i, w in enumerate(words):
            if len(w) > k:
                at[i, column] = seen.setdefault(w[:k], n + len(seen))
        n += len(seen)
    return at, n


def toxic_words(docs: list[np.ndarray], labels: list[int], words: list[str]) -> np.ndarray:
    """Whether each of ``words`` counts as toxic inside toxic training
    documents; ``docs`` hold the words' numbers."""
    at, n = _numbered(words)
    every, toxic = np.zeros(n, np.int32), np.zeros(n, np.int32)
    for own, y in zip(docs, labels):
        found = np.unique(at[np.unique(own)])
        found = found[found >= 0]
        every[found] += 1
        if y:
            toxic[found] += 1
    base = (sum(labels) + 0.5) / (len(labels) + 1)
    need = log(n + 1) + 2  # beyond chance over all features
    strong = np.zeros(n + 1, bool)  # the last stands for -1
    for k in np.flatnonzero(toxic >= PRECISION * every):
        hit, seen = int(toxic[k]), int(every[k])
        share = (hit + 0.5) / (seen + 1)
        if hit * log(share / base) + (seen - hit) * log((1 - share) / (1 - base)) > need:
            strong[k] = True
    out = np.zeros(len(words), bool)
    for i in np.flatnonzero((toxic[: len(words)] > 0) & strong[at].any(axis=1)):
        own = at[i][at[i] >= 0]
        decides = next((k for k in own if every[k] >= SUPPORT), own[-1])
        out[i] = toxic[decides] >= PRECISION * every[decides]
    return out


# --- the chain --------------------------------------------------------------

@dataclass
class Chain:
    """Word weights (toxic over clean), transition weights and the weights
    of the document score (see ``_summary``)."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = -4.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def evidence(self, word: str) -> float:
        return self.bias + float(self.words[buckets(word)].sum())


def _step(r: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log odds after a transition: log sum over the former tag."""
    odds = np.exp(r)
    return np.log((move[0, 1] + move[1, 1] * odds) / (move[0, 0] + move[1, 0] * odds))


def lockstep(evidence: list[np.ndarray], move: np.ndarray) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Probability of the toxic tag for every word, by forward-backward over
    groups of texts of like length: the texts' places and probabilities, one
    group after another. ``evidence`` are log odds per word."""
    lengths = np.array([len(e) for e in evidence])
    order = [i for i in np.argsort(-lengths, kind="stable") if lengths[i]]
    forward_move, backward_move = np.exp(move), np.exp(move.T)
    i = 0
    while i < len(order):
        n = lengths[order[i]]
        group = order[i: i + max(1, int(CELLS // n))]
        while len(group) > 8 and lengths[group[-1]] * 3 < n:
            group = group[: max(8, len(group) // 2)]
        i += len(group)
        grid = np.zeros((n, len(group)))
        for k, g in enumerate(group):
            grid[: lengths[g], k] = evidence[g]
        own = lengths[group]
        forward = np.empty_like(grid)
        r = np.clip(grid[0], -LIMIT, LIMIT)
        forward[0] = r
        for t in range(1, n):
            r = np.clip(grid[t] + _step(r, forward_move), -LIMIT, LIMIT)
            forward[t] = r
        after = np.zeros(len(group))
        for t in range(n - 1, -1, -1):
            forward[t] += after
            seen = _step(np.clip(grid[t] + after, -LIMIT, LIMIT), backward_move)
            after = np.where(t < own, seen, 0.0)
        odds = 1 / (1 + np.exp(-forward))
        yield group, [odds[: lengths[g], k] for k, g in enumerate(group)]
    if len(order) < len(evidence):
        empty = [int(i) for i in np.flatnonzero(lengths == 0)]
        yield empty, [np.zeros(0)] * len(empty)


def marginals(evidence: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """``lockstep`` of all texts, in their order."""
    out: list[np.ndarray] = [np.zeros(0)] * len(evidence)
    for group, found in lockstep(evidence, move):
        for g, p in zip(group, found):
            out[g] = p
    return out


def _summary(p: np.ndarray) -> list[float]:
    """Constant, log odds of the likeliest word, and the positive log odds
    of all words together (each at most SURE, all at most 5 * SURE)."""
    if not len(p):
        return [1.0, -SURE, 0.0]
    odds = np.clip(np.log(np.maximum(p, 1e-9)) - np.log(np.maximum(1 - p, 1e-9)), -SURE, SURE)
    return [1.0, float(odds.max()), min(float(odds[odds > 0].sum()), 5 * SURE)]


def document_scores(p: list[np.ndarray], chain: Chain) -> np.ndarray:
    sums = np.array([_summary(x) for x in p]).reshape(-1, 3) @ chain.document
    return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def _fit_document(rows: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -35, 35)))
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, rows.T @ (p - y) + ridge * w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: Iterable[str], labels: list[int], epochs: int = EPOCHS) -> Chain:
    """Fit the chain by AdaGrad on the likelihood of the word tags, then the
    document score. Without a toxic row every word stays clean. Texts are
    read once and held as numbers of their words."""
    chain = Chain()
    known: dict[str, int] = {}
    ids = [np.array([known.setdefault(w.lower(), len(known)) for w in _WORD.findall(t)], np.int32) for t in texts]
    toxic = toxic_words(ids, labels, list(known))
    size = np.fromiter((1 + sum(len(w) > k for k in PREFIXES) for w in known), np.int64, len(known))
    flat = np.fromiter(chained.from_iterable(map(buckets, known)), np.int32, int(size.sum()))
    start = np.cumsum(size) - size
    del known
    squares, rng = np.full(BUCKETS, 1e-3), np.random.default_rng(11)
    bias_square, move_square = 1.0, np.ones((2, 2))
    for _ in range(epochs):
        order = np.argsort([len(i) + rng.random() for i in ids])
        groups = np.array_split(order, max(1, len(order) // BATCH))
        for g in rng.permutation(len(groups)):
            mine = [k for k in groups[g] if len(ids[k])]
            if not mine:
                continue
            words = np.concatenate([ids[k] for k in mine])
            at = flat[np.repeat(start[words] - (np.cumsum(size[words]) - size[words]), size[words])
                      + np.arange(size[words].sum())]
            cut = np.cumsum(size[words])
            sums = np.concatenate([[0], np.cumsum(chain.words[at], dtype=np.float64)])
            evidence = chain.bias + sums[cut] - sums[cut - size[words]]
            ends = np.cumsum([len(ids[k]) for k in mine])
            p = marginals(np.split(evidence, ends[:-1]), chain.move)
            y = [toxic[ids[k]].astype(float) * labels[k] for k in mine]
            gap = np.concatenate(p) - np.concatenate(y)
            gradient = np.bincount(at, np.repeat(gap, size[words]), BUCKETS) + 1e-4 * chain.words
            squares += gradient**2
            chain.words -= (0.5 * gradient / np.sqrt(squares)).astype(np.float32)
            bias_square += gap.sum() ** 2
            chain.bias -= 0.5 * gap.sum() / np.sqrt(bias_square)
            # pairs of tags: observed and expected (neighbours' marginals)
            seen = sum(np.array([[((1 - t[:-1]) * (1 - t[1:])).sum(), ((1 - t[:-1]) * t[1:]).sum()],
                                 [(t[:-1] * (1 - t[1:])).sum(), (t[:-1] * t[1:]).sum()]]) for t in y)
            likely = sum(np.array([[((1 - q[:-1]) * (1 - q[1:])).sum(), ((1 - q[:-1]) * q[1:]).sum()],
                                   [(q[:-1] * (1 - q[1:])).sum(), (q[:-1] * q[1:]).sum()]]) for q in p)
            push = (likely - seen) / max(1, len(words)) * 100
            move_square += push**2
            chain.move -= 0.1 * push / np.sqrt(move_square)
    evidence = np.fromiter((chain.bias + float(chain.words[flat[a: a + n]].sum()) for a, n in zip(start, size)),
                           np.float32, len(size))
    rows = np.empty((len(ids), 3))
    for group, p in lockstep([evidence[i] for i in ids], chain.move):
        rows[group] = [_summary(x) for x in p]
    chain.document = _fit_document(rows, np.array(labels, float))
    if not any(labels):
        chain.document = np.array([-20.0, 0, 0])
    return chain


# --- scoring ------------------------------------------------------------------

def _table(chain: Chain) -> ChunkIds:
    return ChunkIds(lambda fresh: [[chain.evidence(w.lower()) for w in _WORD.findall(c)] for c in fresh],
                    dtype=np.float32)


@held_alone
def _loaded(model: bytes) -> tuple[Chain, ChunkIds]:
    chain = pickle.loads(model)
    return chain, _table(chain)


def _evidence(texts: pa.Array, table: ChunkIds) -> list[np.ndarray]:
    return [e for _, part in sliced(texts) for e in table.ids([t.split() for t in part])]


def score_texts(texts: pa.Array, model: bytes) -> np.ndarray:
    chain, table = _loaded(model)
    out = np.empty(len(texts))
    for group, p in lockstep(_evidence(texts, table), chain.move):
        out[group] = document_scores(p, chain)
    return out


def spans_of(texts: pa.Array, model: bytes) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores, and the offending spans (start, end in code points, text,
    probability); neighbouring offending words are one span."""
    chain, table = _loaded(model)
    scores, out = np.empty(len(texts)), [[] for _ in range(len(texts))]
    for group, p in lockstep(_evidence(texts, table), chain.move):
        scores[group] = document_scores(p, chain)
        for g, x in zip(group, p):
            if len(x) and x.max() >= 0.5:
                out[g] = _offending(texts[g].as_py(), x)
    return scores, out


def _offending(text: str, probability: np.ndarray) -> list[dict]:
    spans: list[dict] = []
    last = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if probability[i] < 0.5:
            continue
        if i == last + 1:
            spans[-1]["end"] = m.end()
            spans[-1]["probability"] = max(spans[-1]["probability"], float(probability[i]))
        else:
            spans.append({"start": m.start(), "end": m.end(), "probability": float(probability[i])})
        last = i
    for s in spans:
        s["text"] = text[s["start"]: s["end"]]
    return spans


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, held_out: int = 0,
        rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> bytes:
    """The model, from at most ``rows`` labelled rows and ``chars``
    characters, fitted in one task; only the weights come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, texts = in_order(batches)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, [int(y > 0) for y in marks]))],
                                                   pa.binary())], names=["model"])
    ship_package(docs.sparkSession)
    sample = training_rows(docs, labels, label, modulus, held_out, rows, chars)
    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0][0]) if found else pickle.dumps(train([], []))


def score_column(spark, model: bytes, text: Column) -> Column:
    """Score of a text column (null counts as empty)."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, shared.value))
    return score(F.coalesce(text, F.lit("")))


SPANS = "array<struct<start: long, end: long, probability: double, text: string>>"


def toxic_spans(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document: doc_id, score and the offending spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()),
                               ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = spans_of(b["text"], shared.value)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(scores), pa.array(spans, kind)],
                                             names=["doc_id", "score", "spans"])
    return map_arrow(texts_of(docs), run, f"doc_id long, score double, spans {SPANS}")


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, label: str = "toxic",
           modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score >= threshold),
    n_spans, first_start (code points; null without spans).

    Null text counts as empty. Equal texts have equal scores; rows are
    independent; null ids are not held out; extra columns are ignored; an
    empty table gives an empty result, and without toxic training rows no
    document is toxic."""
    model = fit(docs, labels, label, modulus, held_out)
    return toxic_spans(docs, model).select(
        "doc_id", F.coalesce(crc_remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"), F.array_min("spans.start").alias("first_start"))
