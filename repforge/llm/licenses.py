"""License notices in whole texts: pigeonhole seeds, then bounded-error matching.

A text is lower-cased (A-Z) and cut into words; the words joined by single
blanks are searched. A notice that may match with at most ``k`` edits is cut
into ``k + 1`` seeds: a match with ``k`` edits leaves one seed untouched, so
an exact scan for seeds (one Aho-Corasick pass) meets every match. Around
each seed the ``regex`` library's bounded-error matching decides, and gives
the edits and the span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.llm.common import map_arrow, slices, texts_of

#: Characters of a phrase for each edit that a match may have.
CHARS_PER_EDIT = 10


@dataclass(frozen=True)
class Notice:
    """``body`` may match with edits; ``tail`` (a version) must follow exactly.
    ``base`` notices are counted where they stand word for word."""

    label: str
    body: str
    tail: str = ""
    base: bool = False

    @property
    def phrase(self) -> str:
        return self.body + self.tail

    @property
    def edits(self) -> int:
        return len(self.body) // CHARS_PER_EDIT if len(self.body) >= 2 * CHARS_PER_EDIT else 0


NOTICES = (
    Notice("mit", "under the mit license", base=True),
    Notice("apache-2", "apache license version", " 2", base=True),
    Notice("cc-by-nc", "cc by nc", base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("apache-2", "licensed under the apache license version", " 2"),
    Notice("cc-by-nc", "creative commons attribution noncommercial"),
    Notice("cc-by-sa", "creative commons attribution sharealike"),
    Notice("gpl-2", "gnu general public license version", " 2"),
    Notice("gpl-3", "gnu general public license version", " 3"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mpl-2", "mozilla public license version", " 2"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification"),
)

#: Bytes of UTF-8 that are no part of a word become blanks, A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of the lower-cased text, as UTF-8."""
    return text.encode("utf-8").translate(_FOLD).split()


def seeds_of(body: str, edits: int) -> list[tuple[int, str]]:
    """(offset, seed): ``edits + 1`` pieces of about equal length."""
    n, k = len(body), edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, body[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=8)
def _scanner(notices: tuple[Notice, ...]):
    import ahocorasick
    import regex

    where: dict[str, list[tuple[int, int]]] = {}
    for i, n in enumerate(notices):
        for offset, seed in seeds_of(n.body, n.edits):
            where.setdefault(seed, []).append((i, offset))
    automaton = ahocorasick.Automaton()
    for seed, places in where.items():
        automaton.add_word(seed, (len(seed), places))
    automaton.make_automaton()
    fuzzy = [regex.compile(rf"(?<![^ ])(?:{n.body}){{e<={n.edits}}}{n.tail}(?![^ ])",
                           regex.BESTMATCH | regex.VERSION1) for n in notices]
    return automaton, fuzzy


def scan(joined: str, notices: tuple[Notice, ...] = NOTICES) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) of every match in the joined words: every
    place without edits, and around the other seeds the best match and those
    beside it."""
    automaton, fuzzy = _scanner(notices)
    found: dict[tuple[int, int], tuple[int, int]] = {}
    windows: dict[int, list[list[int]]] = {}
    for last, (length, places) in automaton.iter(joined):
        for i, offset in places:
            n = notices[i]
            start = last - length + 1 - offset
            end = start + len(n.phrase)
            if (start >= 0 and joined.startswith(n.phrase, start) and joined[start - 1: start] in ("", " ")
                    and joined[end: end + 1] in ("", " ")):
                found[i, start] = (end, 0)
            elif n.edits:
                low, high = max(0, start - n.edits), end + n.edits
                low = joined.rfind(" ", 0, low) + 1
                high = joined.find(" ", high) if high < len(joined) else -1
                high = len(joined) if high < 0 else high
                spans = windows.setdefault(i, [])
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(high, spans[-1][1])
                    spans[-1][0] = min(low, spans[-1][0])
                else:
                    spans.append([low, high])
    for i, spans in windows.items():
        exact = sorted((s, e[0]) for (j, s), e in found.items() if j == i)
        least = len(notices[i].phrase) - notices[i].edits
        while spans:
            low, high = spans.pop()
            # ^ and $ of the window are word boundaries by construction
            m = fuzzy[i].search(joined, low, high) if high - low >= least else None
            if m is None:
                continue
            if not any(s < m.end() and m.start() < e for s, e in exact):
                found[i, m.start()] = (m.end(), sum(m.fuzzy_counts))
            # the best match of the window may stand behind weaker ones
            spans += [[low, m.start() - 1], [m.end() + 1, high]]
    return sorted((i, s, e, k) for (i, s), (e, k) in found.items())


def spans_of(text: str, notices: tuple[Notice, ...] = NOTICES) -> tuple[int, list[dict]]:
    """Number of words, and the matches of one text as dicts with label,
    base, edits, first_word, n_words, likeness and the matched words."""
    words = words_of(text)
    raw = b" ".join(words).decode("latin-1")
    automaton, _ = _scanner(notices)
    if next(automaton.iter(raw), None) is None:
        return len(words), []
    joined = raw if raw.isascii() else b" ".join(words).decode("utf-8", "replace")
    out = []
    for i, start, end, edits in scan(joined, notices):
        n, got = notices[i], joined[start:end]
        out.append({"label": n.label, "base": n.base and edits == 0, "edits": edits,
                    "first_word": joined.count(" ", 0, start), "n_words": got.count(" ") + 1,
                    "likeness": 1 - edits / len(n.phrase), "matched": got})
    return len(words), out


_SPAN = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("edits", pa.int32()),
                   ("first_word", pa.int64()), ("n_words", pa.int32()), ("likeness", pa.float64()),
                   ("matched", pa.string())])
SCHEMA = ("doc_id long, n_words long, spans array<struct<label: string, base: boolean, edits: int, "
          "first_word: long, n_words: int, likeness: double, matched: string>>")


def license_spans(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words and the spans of all notices found.

    Null or empty text has no words and no spans. Rows are independent:
    repeated rows give repeated results, null ids stay null, an empty table
    gives an empty result, extra columns are ignored. Texts are read whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = b["text"].to_pylist(), b["doc_id"]
            for low, high in slices(texts):
                got = [spans_of(t, notices) for t in texts[low:high]]
                yield pa.RecordBatch.from_arrays(
                    [ids[low:high], pa.array([g[0] for g in got], pa.int64()),
                     pa.array([g[1] for g in got], pa.list_(_SPAN))], names=["doc_id", "n_words", "spans"])
    return map_arrow(texts_of(docs, id_col, text_col), run, SCHEMA)


def license_digest(found: DataFrame) -> DataFrame:
    """One row per document from ``license_spans``: n_base counts the base
    phrases' exact places, first_word and last_word are the smallest and
    largest of them (null without any), score is the best likeness."""
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda s: F.concat_ws(",", F.array_sort(F.array_distinct(s["label"])))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.col("spans")["likeness"]), F.lit(0.0)).alias("score"))
