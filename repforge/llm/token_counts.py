"""Token counts by a two-tier table of pre-token lengths.

A byte-level vocabulary never merges across pre-tokens, so a text's token
count is the sum of its pre-tokens' counts, and a pre-token's count is a
constant of the vocabulary. The first tier is a compact table of frequent
pre-tokens, broadcast once; the second is a bounded cache in each Python
worker, filled by the library for what the first tier misses. Everything
happens where the text lies: no pre-token is ever shuffled.

The frequent pre-tokens come from a bounded sample of documents
(``SAMPLE_ROWS``, ``SAMPLE_CHARS``). That table only saves time: no count
depends on it, and an empty one gives the same result.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.common import fresh, held_alone, map_arrow, slices, texts_of

#: The frequent table: at most so many pre-tokens of at most MAX_KEY code
#: points, counted in at most SAMPLE_ROWS documents of SAMPLE_CHARS together.
FREQUENT = 1 << 16
MAX_KEY = 64
SAMPLE_ROWS, SAMPLE_CHARS = 2_000, 8_000_000
#: Pre-tokens that a worker keeps beyond the frequent table.
CACHED = 400_000
#: Code points whose pre-tokens are held at once.
HELD_CHARS = 1_000_000
#: Characters whose pre-tokens are held at once from a longer text.
RUN = 65_536

# Fixed value: the pre-token pattern of the byte-level vocabularies.
_PRE_TOKEN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def doubtful_characters() -> str:
    """Character class of what Unicode 3.2 did not assign, or put into
    another class than today: there the library's own tables decide."""
    def kind(db, c: str) -> str:
        group = db.category(c)[0]
        return group if group in "LN" else "-"

    old, odd = unicodedata.ucd_3_2_0, []
    for point in range(0x80, 0x10000):
        c = chr(point)
        if 0xD800 <= point < 0xE000 or old.category(c) == "Cn" or kind(old, c) != kind(unicodedata, c):
            if odd and odd[-1][1] == point - 1:
                odd[-1][1] = point
            else:
                odd.append([point, point])
    odd.append([0x10000, 0x10FFFF])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in odd) + "]"


class TokenCounter:
    """Token counts of texts with one vocabulary file, one per worker."""

    def __init__(self, path: str, limit: int = CACHED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern, self.doubtful = regex.compile(_PRE_TOKEN), re.compile(doubtful_characters())
        self.limit, self.frequent, self.known = limit, {}, {}

    def use(self, frequent: dict[str, int]) -> None:
        if frequent is not self.frequent:
            self.frequent, self.known = frequent, {**frequent, **self.known}

    def whole(self, texts: list[str]) -> list[int]:
        """By the library on whole texts (or pre-tokens)."""
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def plain(self, text: str) -> bool:
        """Can the text be cut into pre-tokens by the pattern alone?"""
        return (not any(s in text for s in self.special)
                and (text.isascii() or self.doubtful.search(text) is None))

    def _learn(self, found: Iterable[list[str]]) -> dict[str, int]:
        new = set(chain.from_iterable(found)).difference(self.known)
        if len(self.known) - len(self.frequent) + len(new) > self.limit:
            self.known = dict(self.frequent)
            new = set(chain.from_iterable(found)).difference(self.known)
        new = list(new)
        got = dict(zip(new, self.whole(new)))
        if len(got) <= self.limit:
            self.known.update((p, n) for p, n in got.items() if len(p) <= MAX_KEY)
        return got

    def _sums(self, found: list[list[str]]) -> list[int]:
        got = self._learn(found)
        long = {p: n for p, n in got.items() if p not in self.known}
        if not long:
            return [sum(map(self.known.__getitem__, f)) for f in found]
        return [sum(long[p] if p in long else self.known[p] for p in f) for f in found]

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        for low, high in slices(texts, HELD_CHARS):
            if high - low == 1 and len(texts[low]) > HELD_CHARS:
                out[low] = self.long(texts[low])
                continue
            plain = [i for i in range(low, high) if self.plain(texts[i])]
            other = sorted(set(range(low, high)).difference(plain))
            for i, n in zip(plain, self._sums([self.pattern.findall(texts[i]) for i in plain])):
                out[i] = n
            for i, n in zip(other, self.whole([texts[i] for i in other])):
                out[i] = n
        return out

    def long(self, text: str) -> int:
        """A very long text, RUN pre-tokens at a time."""
        if not self.plain(text):
            return self.whole([text])[0]
        matches = (m.group() for m in self.pattern.finditer(text))
        n = 0
        while run := list(islice(matches, RUN)):
            n += self._sums([run])[0]
        return n


@held_alone
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def frequent_lengths(docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
                     size: int = FREQUENT) -> dict[str, int]:
    """pre-token -> token count, for at most ``size`` of the most frequent
    pre-tokens of a bounded sample: the first ``rows`` documents in the order
    of a hash of id and length, as long as they hold ``chars`` together.
    A document that holds more alone is passed over."""
    n, order = fresh("n"), fresh("order")
    sized = docs.select("text", F.length("text").alias(n)).filter(F.col(n).between(1, chars))
    total = sized.count()
    # a task passes on the few rows that can be among the first, no more
    below = F.lit(min(2 ** 63 - 1, int(2 * rows / max(total, 1) * 2 ** 64) - 2 ** 63))
    along = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sample = (docs.select("doc_id", "text", F.length("text").alias(n))
              .withColumn(order, F.xxhash64("doc_id", n))
              .filter(F.col(n).between(1, chars) & (F.col(order) <= below)).orderBy(order).limit(rows)
              .withColumn(n, F.sum(n).over(along))  # at most ``rows`` rows
              .filter(F.col(n) <= chars).select("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = _counter(path), Counter()
        for b in batches:
            for text in b["text"].to_pylist():
                if counter.plain(text):
                    seen.update(counter.pattern.findall(text))
        top = sorted(((-c, p) for p, c in seen.items() if len(p) <= MAX_KEY))[:size]
        words = [p for _, p in top]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counter.whole(words), pa.int32())],
                                         names=["pre_token", "n"])
    # one task by the limit above; at most ``size`` rows reach the driver
    found = map_arrow(sample, count, "pre_token string, n int").limit(size).collect()
    return {r["pre_token"]: r["n"] for r in found}


COUNTED = "doc_id long, n_bytes long, n_tokens long"


def counted(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text",
            frequent: dict[str, int] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, in no order.

    Null texts count as empty (0 bytes, 0 tokens); null and repeated ids keep
    their rows; other columns are left behind. A text that holds a special
    token's string, or a character whose class is not the same in every
    version of Unicode, is encoded whole by the library. A very long text is
    cut into pre-tokens bit by bit; pre-tokens over MAX_KEY code points are
    encoded anew each time and never cached. An empty table gives no rows.
    """
    spark, texts = docs.sparkSession, texts_of(docs, id_col, text_col)
    table = spark.sparkContext.broadcast(frequent_lengths(texts, path) if frequent is None else frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        counter.use(table.value)
        for b in batches:
            found = b["text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["n_bytes"], pa.array(counter.counts(found), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    sized = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_arrow(sized, run, COUNTED).withColumn("over_limit", F.col("n_tokens") > limit)
