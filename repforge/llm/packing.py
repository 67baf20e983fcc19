"""Packing into sequences of a fixed length by cutting-stock column generation.

A document's ids are cut into full sequences and one remainder. Piece
lengths fall into classes; the histogram of the classes (at most ``CLASSES``
rows, whatever the input) is the demand of a cutting-stock problem. Its
linear program is solved over patterns (counts of each class in a sequence):
the simplex prices rows, and a knapsack dynamic program finds the pattern
that improves most, until the known bound is reached. The rounded patterns
are then dealt out on Spark: every piece has a rank in its class, and a
pattern's slots of a class are an interval of ranks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.chunks import ChunkIds
from repforge.llm.common import Scratch, batches_of, held_alone, map_arrow, sliced, texts_of
from repforge.llm.token_counts import doubtful_characters

#: Lengths are rounded up to sequence / CLASSES when patterns are made.
CLASSES = 256
#: The linear program ends when its value is this close to its lower bound.
GAP = 1e-4
#: Pieces that one ranking window sorts, on average.
RANK_ROWS = 100_000

# --- ids ------------------------------------------------------------------

#: Blanks at which a byte-level vocabulary's word split depends on more than
#: the neighbouring characters.
_RUN = re.compile(r"\s \s|\s \Z")
_SAFE_BLANK = re.compile(r"(?<=\S) | (?=\S)")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as itself where it is printable
    Latin-1, else as one of the next free characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(path: str):
    """The file's byte-pair merges as ranks, which encode short texts several
    times faster, or None where ids in the order of the merges do not say
    everything (another kind of file)."""
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    model, cut = said["model"], said.get("pre_tokenizer") or {}
    plain = (model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
             and not cut.get("add_prefix_space") and not said.get("normalizer") and not model.get("ignore_merges")
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "byte_fallback")))
    if not plain:
        return None
    special = {t["content"] for t in said["added_tokens"]}
    byte, vocab = _byte_of_character(), model["vocab"]
    merged = [vocab["".join(m.split(" ")) if isinstance(m, str) else "".join(m)] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(merged) + 256 + len(special & set(vocab)) != len(vocab):
        return None
    ranks = {bytes(byte[c] for c in token): n for token, n in vocab.items() if token not in special}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@held_alone
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    ranked = rank_encoder(path)
    doubtful = re.compile(doubtful_characters())

    def asks_library(chunk, text: str) -> bool:
        # only a text without blanks to cut at can hold a special string
        return (ranked is None or not text.isascii() and doubtful.search(text) is not None
                or isinstance(chunk, tuple) and any(s in text for s in special))

    def encode(fresh: list) -> list[list[int]]:
        # a chunk is a word after its blank; a tuple holds text without one
        said = [c[0] if isinstance(c, tuple) else " " + c for c in fresh]
        by_library = [i for i, s in enumerate(said) if asks_library(fresh[i], s)]
        ids = dict(zip(by_library, (e.ids for e in tokenizer.encode_batch_fast(
            [said[i] for i in by_library], add_special_tokens=False))))
        return [ids[i] if i in ids else ranked.encode_ordinary(s) for i, s in enumerate(said)]

    return special, ChunkIds(encode)


def chunks_of(text: str, special: list[str]) -> list:
    """Chunks whose ids, one after another, are the text's."""
    if any(s in text for s in special):
        return [(text,)]
    parts = _SAFE_BLANK.split(text) if _RUN.search(text) else text.split(" ")
    return [(parts[0],), *parts[1:]]


def token_ids(texts: list[str], path: str, end_id: int) -> list[np.ndarray]:
    special, table = _tokenizer(path)
    return [np.append(ids, end_id).astype("<u4")
            for ids in table.ids([chunks_of(t, special) for t in texts])]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, sequence: int, end_id: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens. A document
    of n ids is cut at every multiple of ``sequence``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_ids = b["doc_id"].to_pylist()
            for low, texts in sliced(b["text"], 1_000_000):
                rows = []
                for doc, ids in zip(doc_ids[low: low + len(texts)], token_ids(texts, tokenizer_path, end_id)):
                    for start in range(0, len(ids), sequence):
                        part = ids[start: start + sequence]
                        rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return map_arrow(texts_of(docs, id_col, text_col), run, PIECES)


# --- patterns ---------------------------------------------------------------

def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Dynamic program over capacities. Returns the value of the best
    multiset of items, and one column for each item: the best multiset that
    holds the item (the overall best is among them)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fit = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if fit[room]:
            worth = best[room - sizes[: fit[room]]] + values[: fit[room]]
            top = int(worth.argmax())
            if worth[top] > best[room] + 1e-12:
                best[room], last[room] = worth[top], top
    columns = np.eye(len(sizes), dtype=np.int64)
    for i, size in enumerate(sizes):
        room = capacity - int(size)
        while room > 0:
            if last[room] < 0:
                room -= 1
                continue
            columns[last[room], i] += 1
            room -= int(sizes[last[room]])
    return float(best[capacity]), columns


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                      gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """Fractional optimum of: fewest patterns that hold the demand (sizes
    ascending). Revised simplex on the basis of one pattern a row; when no
    column of the pool improves, the knapsack prices new ones. Ends when the
    value is within ``gap`` of the bound that the prices prove (value of the
    demand at those prices / worth of the best pattern)."""
    m = len(sizes)
    fits = capacity // sizes
    patterns = np.diag(fits).astype(np.int64)
    inverse = np.diag(1.0 / fits)
    x = demand / fits
    bound, pool = float(demand @ sizes) / capacity, patterns.copy()
    while True:
        prices = inverse.sum(axis=0)
        worths = prices @ pool
        pick = int(worths.argmax())
        if worths[pick] <= 1 + 1e-7:
            paid = np.maximum(prices, 0)
            worth, pool = knapsack(paid, sizes, capacity)
            bound = max(bound, float(demand @ paid) / max(worth, 1.0))
            worths = prices @ pool
            pick = int(worths.argmax())
            if worths[pick] <= 1 + 1e-7 or x.sum() <= bound * (1 + gap):
                break
        column = pool[:, pick]
        direction = inverse @ column
        ratios = np.full(m, np.inf)
        up = direction > 1e-9
        ratios[up] = x[up] / direction[up]
        leave = int(ratios.argmin())
        step = ratios[leave]
        x = np.maximum(x - step * direction, 0)
        x[leave] = step
        inverse[leave] /= direction[leave]
        direction[leave] = 0
        inverse -= np.outer(direction, inverse[leave])
        patterns[:, leave] = column
    return [(patterns[:, j].copy(), float(x[j])) for j in range(m) if x[j] > 1e-9]


def first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns for a small rest: always the largest item that still fits."""
    left, out = left.copy(), []
    order = np.argsort(-sizes)
    while left.any():
        room, taken = capacity, np.zeros(len(sizes), np.int64)
        for i in order:
            n = min(int(left[i]), room // int(sizes[i]))
            taken[i], room = n, room - n * int(sizes[i])
        left -= taken
        out.append(taken)
    return out


def patterns_for(histogram: dict[int, int], capacity: int = CLASSES,
                 gap: float = GAP) -> list[tuple[dict[int, int], int]]:
    """Patterns ({class: count}, times) that hold every item of the
    histogram {class: items}: the linear program's, rounded down, then
    first-fit patterns for what rounding left."""
    classes = sorted(c for c, n in histogram.items() if n)
    if not classes:
        return []
    sizes = np.array(classes, np.int64)
    demand = np.array([histogram[c] for c in classes], np.int64)
    left, out = demand.copy(), []
    for taken, times in sorted(column_generation(sizes, demand.astype(float), capacity, gap),
                               key=lambda p: -p[1]):
        whole = int(min([times + 1e-6, *(left[taken > 0] // taken[taken > 0])]))
        if whole > 0:
            left -= whole * taken
            out.append((taken, whole))
    out += [(taken, 1) for taken in first_fit(sizes, left, capacity)]
    return [({classes[i]: int(n) for i, n in enumerate(taken) if n}, times) for taken, times in out]


def slots_of(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each class the intervals of ranks that patterns take: rows of
    (first rank, items in a sequence, first sequence, place in the sequence)."""
    taken: dict[int, int] = {}
    rows: dict[int, list] = {}
    sequence = 0
    for pattern, times in patterns:
        place = 0
        for c in sorted(pattern, reverse=True):
            rows.setdefault(c, []).append((taken.get(c, 0), pattern[c], sequence, place))
            taken[c] = taken.get(c, 0) + pattern[c] * times
            place += pattern[c]
        sequence += times
    return {c: np.array(r, np.int64) for c, r in rows.items()}


# --- packing ----------------------------------------------------------------

def pack(docs: DataFrame, tokenizer_path: str, sequence: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset.

    A null or empty text is one piece that holds the end id. Documents with
    a null id and repeated rows are packed like any other row: each row's
    ids appear once. An empty table gives an empty result; extra columns are
    ignored. Ranks follow the hash of (doc_id, start), so the result does
    not depend on how the input is laid out."""
    spark = docs.sparkSession
    if sequence % CLASSES:
        raise ValueError(f"the sequence length must be a multiple of {CLASSES}")
    width = sequence // CLASSES
    scratch = Scratch(spark)
    with batches_of(spark, "8m"):
        cut = scratch.save(pieces(docs, tokenizer_path, sequence, end_id, id_col, text_col)
                           .withColumn("class", F.ceil(F.col("length") / width).cast("int")), "pieces")
    histogram = {r["class"]: r["count"] for r in cut.groupBy("class").count().collect()}
    table = slots_of(patterns_for(histogram))
    buckets = max(1, sum(histogram.values()) // (RANK_ROWS * CLASSES) + 1)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    before = (dealt.groupBy("class", "bucket").count()
              .select("class", "bucket", F.coalesce(
                  F.sum("count").over(Window.partitionBy("class").orderBy("bucket")
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    ranked = dealt.join(before, ["class", "bucket"]).withColumn(
        "rank", F.col("before") - 1 + F.row_number().over(
            Window.partitionBy("class", "bucket").orderBy("doc_id", "start")))

    @F.pandas_udf("struct<sequence_id: long, place: long>")
    def slot(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        c, r = classes.to_numpy(), ranks.to_numpy()
        out = np.zeros((2, len(c)), np.int64)
        for one in np.unique(c):
            rows, mine = table[int(one)], c == one
            hit = rows[np.searchsorted(rows[:, 0], r[mine], side="right") - 1]
            nth = r[mine] - hit[:, 0]
            out[0, mine] = hit[:, 2] + nth // hit[:, 1]
            out[1, mine] = hit[:, 3] + nth % hit[:, 1]
        return pd.DataFrame({"sequence_id": out[0], "place": out[1]})

    placed = ranked.withColumn("slot", slot("class", "rank")).select(*PIECE_COLUMNS, "slot.*")
    along = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*PIECE_COLUMNS, "sequence_id",
                         F.coalesce(F.sum("length").over(along), F.lit(0)).alias("offset"))


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
