"""Document fingerprints by randomised edit embedding.

A shared random walk goes over the characters: at step ``j`` it reads the
character under it and moves on, or stays, by a random bit that depends only
on ``j`` and that character. What it reads at each step is the embedded
text. Two texts that differ by few edits meet again after each edit, so edit
distance becomes Hamming distance between the embedded texts.

A fingerprint samples the embedded text. Every slot has a fixed random
priority for each step, and takes the step of best priority that the walk
reached: texts of similar length sample the same steps. A slot's value is a
16-bit hash of the step and of four symbols read from there on. Likeness is
the share of equal slots. Slots joined in bands give candidates, which an
exact edit distance verifies.

The walks of many texts run in lockstep over their characters, as one numpy
operation per character position: the walk's only state is its step number,
and a table gives how many steps a character keeps it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, map_arrow, texts_of

WALKS, SLOTS, SYMBOLS, STRIDE = 2, 64, 4, 3
#: The random bits repeat after this many steps.
PERIOD = 4096
SEED = 20240229
#: Characters times texts that one lockstep group holds.
CELLS = 8_000_000


def _stay_table(rng: np.random.Generator) -> np.ndarray:
    """Steps until the walk leaves a character met at each step: for every
    step (mod PERIOD) and character class the distance to the next set bit."""
    bits = rng.random((PERIOD, 256)) < 0.5
    bits[-1] |= ~bits.any(axis=0)
    stay = np.zeros((PERIOD, 256), np.uint8)
    ahead = np.where(bits, 1, 0)
    distance = np.full(256, 255)
    for j in range(2 * PERIOD - 1, -1, -1):
        at = j % PERIOD
        distance = np.where(ahead[at] == 1, 1, np.minimum(distance + 1, 255))
        stay[at] = distance
    return stay


def _records(rng: np.random.Generator, last: int = 1 << 40) -> np.ndarray:
    """Steps at which a sequence of random priorities reaches a new best."""
    at, best, out = 0, rng.random(), [0]
    while at < last:
        at += int(rng.geometric(max(best, 1e-13)))
        best *= rng.random()
        out.append(at)
    return np.array(out, np.int64)


class Walker:
    """The shared randomness: one instance per worker, the same everywhere."""

    def __init__(self, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.stay = np.concatenate([_stay_table(rng).ravel() for _ in range(WALKS)])
        self.records = [_records(rng) for _ in range(SLOTS)]
        self.mix = rng.integers(1, 2**63, SYMBOLS + 2, dtype=np.uint64) | np.uint64(1)
        self.salt = np.arange(SLOTS, dtype=np.uint64) * self.mix[1]

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """uint16 slots, one row per text. An empty text has one fixed row."""
        out = np.zeros((len(texts), SLOTS), np.uint16)
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        i = 0
        while i < len(order):
            longest = max(1, int(lengths[order[i]]))
            group = order[i: i + max(1, CELLS // (longest * WALKS))]
            out[group] = self._group([texts[k] for k in group], lengths[group])
            i += len(group)
        return out

    def _group(self, texts: list[str], lengths: np.ndarray) -> np.ndarray:
        """Texts of descending length, in lockstep; those that end leave."""
        n, d = int(lengths[0]), len(texts)
        chars = np.zeros((n + 1, d), np.uint8)
        for k, t in enumerate(texts):
            code = np.frombuffer(t.encode("utf-32-le"), np.uint32)
            chars[: len(code), k] = (code * np.uint32(2654435761)) >> np.uint32(24)
        # steps[i]: step at which the walks meet character i (up to the text's length)
        steps = np.zeros((n + 1, WALKS, d), np.int32 if n < 2**22 else np.int64)
        alive = np.searchsorted(-lengths, -np.arange(n), side="left")  # texts longer than i
        width, table = d, (np.arange(WALKS) * PERIOD * 256)[:, None]
        step = np.zeros((WALKS, d), np.int64)
        at, moved = np.empty_like(step), np.empty((WALKS, d), np.uint8)
        for i in range(n):
            if alive[i] < 0.8 * width:
                width = int(alive[i])
                step = step[:, :width].copy()
                at, moved = np.empty_like(step), np.empty((WALKS, width), np.uint8)
            np.bitwise_and(step, PERIOD - 1, out=at)
            at <<= 8
            at += table
            at += chars[i, :width]
            self.stay.take(at, out=moved, mode="clip")
            step += moved
            steps[i + 1, :, :width] = step
        out = np.empty((d, SLOTS), np.uint16)
        for low in range(0, d, 512):
            part = slice(low, min(d, low + 512))
            out[part] = self._sample(chars[:, part], steps[:, :, part], lengths[part])
        return out

    def _sample(self, chars: np.ndarray, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        d = len(lengths)
        text, out = np.arange(d), np.zeros((d, SLOTS), np.uint16)
        for w in range(WALKS):
            slots = np.arange(w, SLOTS, WALKS)
            reached = steps[lengths, w, text].astype(np.int64)
            record = np.stack([np.searchsorted(self.records[s], reached, side="left") - 1 for s in slots], axis=1)
            first = np.stack([self.records[s][np.maximum(record[:, k], 0)] for k, s in enumerate(slots)], axis=1)
            here = (first[:, :, None] + STRIDE * np.arange(SYMBOLS)).reshape(d, -1)
            column = np.broadcast_to(text[:, None], here.shape)
            low, high = np.zeros(here.shape, np.int64), np.repeat(lengths[:, None], here.shape[1], axis=1)
            for _ in range(int(lengths.max()).bit_length() + 1):  # the last character met at or before the step
                mid = (low + high + 1) >> 1
                ok = steps[mid, w, column] <= here
                low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
            there = (here < reached[:, None]) & (low < lengths[:, None])
            symbol = np.where(there, chars[low, column].astype(np.uint64) + np.uint64(1), np.uint64(0))
            symbol = symbol.reshape(d, len(slots), SYMBOLS)
            value = (record + 1).astype(np.uint64) * self.mix[0] + self.salt[slots]
            for k in range(SYMBOLS):
                value ^= value >> np.uint64(29)
                value = (value + symbol[:, :, k]) * self.mix[2 + k]
            value ^= value >> np.uint64(32)
            value *= self.mix[0]
            out[:, slots] = (value >> np.uint64(48)).astype(np.uint16)
        return out


_WALKER: list[Walker] = []


def walker() -> Walker:
    if not _WALKER:
        _WALKER.append(Walker())
    return _WALKER[0]


def as_text(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row."""
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of whole texts; null counts as empty, equal texts
    have equal fingerprints, repeated rows repeat, extra columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(as_text(walker().fingerprints(b["text"].to_pylist())), pa.string())],
                names=["doc_id", "fingerprint"])
    return map_arrow(texts_of(docs, id_col, text_col), run, "doc_id long, fingerprint string")


# --- each document beside the next one ----------------------------------------

def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as
    many characters, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


PAIR_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")


def _pairs_of(batches: Iterator[pa.RecordBatch], chars: int = 12_000_000):
    """Runs of consecutive rows: (ids, texts) where the last text only
    follows. Rows come sorted by (bucket, copy, id)."""
    bucket, ids, texts, held, closed = None, [], [], 0, False
    for b in batches:
        for to, copy, doc, text in zip(b["bucket"].to_pylist(), b["copy"].to_pylist(),
                                       b["doc_id"].to_pylist(), b["text"].to_pylist()):
            if to != bucket:
                bucket, ids, texts, held, closed = to, [], [], 0, False
            if closed:
                continue  # further rows with the next bucket's first id
            ids.append(doc)
            texts.append(text)
            held += len(text)
            closed = bool(copy)
            if len(ids) > 1 and (closed or held > chars):
                yield ids[:-1], texts
                ids, texts, held = [doc], [text], len(text)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _pairs_of(batches):
        n = len(ids)
        edited = [edited_text(a, b) for a, b in zip(texts[:-1], texts[1:])]
        prints = walker().fingerprints(texts + edited)
        own, after, changed = prints[:n], prints[1: n + 1], prints[n + 1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
             pa.array(as_text(own)), pa.array(as_text(changed)),
             pa.array(likeness(own, changed)), pa.array(likeness(own, after))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"])


def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text (see
    ``edited_text``; the next document by ascending id follows, after the
    last one the first), and their likeness.

    Ids are cut into buckets by Spark's range partitioner; each bucket also
    gets a copy of the first row of the next one, so texts are shuffled once.
    Null text counts as empty. Null ids come first. Rows that repeat an id
    are ordered by text. A single row follows itself. An empty table gives
    an empty result; extra columns are ignored."""
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col)
    lowest = -(2**63)
    order = F.coalesce("doc_id", F.lit(lowest))
    # as many ranges as shuffle partitions, however small the column of ids is
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = sorted(r["first"] for r in rows.select(order.alias("key")).repartitionByRange(parts, "key")
                    .groupBy(F.spark_partition_id()).agg(F.min("key").alias("first")).collect())
    starts = np.array(firsts, np.int64)

    @F.pandas_udf("array<int>")
    def buckets(key: pd.Series) -> pd.Series:
        at = np.searchsorted(starts, key.to_numpy(), side="right") - 1
        first = starts[at] == key.to_numpy()
        return pd.Series([[a, (a - 1) % len(starts)] if f else [a] for a, f in zip(at.tolist(), first)])

    dealt = (rows.select("doc_id", "text", order.alias("key"), F.posexplode(buckets(order)).alias("copy", "bucket"))
             .repartition("bucket").sortWithinPartitions("bucket", "copy", "key", "text")
             .select("bucket", "copy", "doc_id", "text"))
    return map_arrow(dealt, _compare, PAIR_SCHEMA)


# --- near copies: bands, then edit distance ---------------------------------

BANDS = 16


def edit_distance(a: str, b: str) -> int:
    """Bit-parallel edit distance; the bit vectors are Python integers."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    peq: dict[str, int] = {}
    for i, c in enumerate(b):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << len(b)) - 1, 1 << (len(b) - 1)
    up, down, score = full, 0, len(b)
    for c in a:
        eq = peq.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | ~(across | up) & full, up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1 | 1) & full, fall << 1 & full
        vertical = eq | down
        up, down = fall | ~(vertical | rise) & full, rise & vertical
    return score


def near_leaders(docs: DataFrame, max_edits: float = 0.2, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, leader_id): the smallest verified leader of a document. Rows
    with equal text share the smallest id as their owner; owners that share
    a band of the fingerprint are compared with the band's leaders, ascending
    by id, and become leaders where no one is within ``max_edits`` of the
    longer length. No pairs within a band are emitted, and no band is capped.
    Null text counts as empty; rows with null ids are left out."""
    scratch = Scratch(docs.sparkSession)
    rows = texts_of(docs, id_col, text_col).filter(F.col("doc_id").isNotNull())
    keyed = rows.select("doc_id", F.sha2("text", 256).alias("key"))
    owners = keyed.groupBy("key").agg(F.min("doc_id").alias("owner"))
    prints = scratch.save(fingerprints(rows.join(owners.select(F.col("owner").alias("doc_id")), "doc_id")), "prints")
    width = SLOTS * 4 // BANDS
    banded = prints.select("doc_id", F.explode(F.array(*[
        F.concat(F.lit(f"{i}:"), F.substring("fingerprint", 1 + i * width, width))
        for i in range(BANDS)])).alias("band"))
    crowded = banded.groupBy("band").count().filter("count > 1").select("band")
    members = (banded.join(crowded, "band").join(rows, "doc_id")
               .repartition("band").sortWithinPartitions("band", "doc_id"))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band, leaders = None, []
        for b in batches:
            out = []
            for key, doc, text in zip(b["band"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist()):
                if key != band:
                    band, leaders = key, []
                for leader, other in leaders:
                    most = max_edits * max(len(text), len(other))
                    if abs(len(text) - len(other)) <= most and edit_distance(text, other) <= most:
                        out.append((doc, leader))
                        break
                else:
                    leaders.append((doc, text))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)],
                                             names=["owner", "leader"])

    found = map_arrow(members.select("band", "doc_id", "text"), lead, "owner long, leader long")
    best = found.groupBy("owner").agg(F.min("leader").alias("leader"))
    return (keyed.join(owners, "key").join(best, "owner", "left")
            .select("doc_id", F.coalesce("leader", "owner").alias("leader_id")))
