"""SentencePiece encoding for merge-type vocabularies, and decoding.

A text becomes symbols; an agenda (a heap ordered by score, then position)
holds every adjacent pair whose joined text is a piece. The best pair is
merged, its new neighbours enter the agenda, and stale entries are skipped,
until no pair is left. Symbols that are no piece fall back to bytes.

Many words run through their agendas in lockstep: the entries of all words
are one array, a step takes every word's best entry and merges it. Long words
use the heap.

No piece of the vocabulary crosses from a letter into a blank (checked when
the model is read), so the agenda runs once for each distinct word of a
worker's texts. Every Arrow batch is checked against the sentencepiece
library on the whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repforge.llm.chunks import ChunkIds
from repforge.llm.common import map_arrow, slices, texts_of

BLANK = "▁"
#: Longer words use the heap, so that a step is never run for a few of them.
LOCKSTEP_CHARS = 48
#: Rank of a pair that makes no piece.
NEVER = np.iinfo(np.int32).max
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*")


class Agenda:
    """Merge-type vocabulary: piece -> (score, id)."""

    def __init__(self, processor):
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        plain = [i for i in range(len(pieces)) if not (processor.is_control(i) or processor.is_unknown(i)
                                                       or processor.is_byte(i) or processor.is_unused(i))]
        self.score = {pieces[i]: processor.get_score(i) for i in plain}
        self.id = {pieces[i]: i for i in plain}
        self.byte = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if processor.is_byte(i)}
        self.unknown = processor.unk_id()
        if any(BLANK in p.lstrip(BLANK) for p in self.id):
            raise ValueError("a piece has a blank after a letter: words cannot be encoded one by one")
        self._tabulate()

    def _tabulate(self) -> None:
        """Numbers for symbols (pieces and their characters), and a sorted
        table of the pairs that make a piece: its rank by score, its number."""
        symbols = sorted(set(self.id) | {c for p in self.id for c in p})
        number = {s: i for i, s in enumerate(symbols)}
        self.symbols = len(symbols)
        # a character c that is no piece is -1 - c, as id and, if in no piece, as number
        self.id_of_number = np.array([self.id[s] if s in self.id else -1 - ord(s) for s in symbols], np.int64)
        self.number_of_char = -1 - np.arange(0x110000, dtype=np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.number_of_char[ord(s)] = i
        rank = {x: i for i, x in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = sorted((number[p[:k]] * self.symbols + number[p[k:]], rank[x], number[p])
                       for p, x in self.score.items() for k in range(1, len(p))
                       if p[:k] in number and p[k:] in number)
        # the last row matches no pair
        self.pair_key, self.pair_rank, self.pair_number = np.array([*pairs, (2**62, NEVER, -1)], np.int64).T.copy()

    def _entries(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of the pair table for each pair of symbols, the last if none."""
        key = left.astype(np.int64) * self.symbols + right
        at = np.searchsorted(self.pair_key, key)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), at, len(self.pair_key) - 1)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, all agendas one step at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero((lengths > 0) & (lengths <= LOCKSTEP_CHARS))
        owner = np.repeat(short, lengths[short])
        text = "".join([words[i] for i in short.tolist()])
        symbol = self.number_of_char[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        none = len(self.pair_key) - 1
        entry = np.full(len(symbol), none)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        entry[inner] = self._entries(symbol[inner], symbol[inner + 1])
        done = []
        while len(symbol):
            rank = self.pair_rank[entry]
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(starts, append=len(owner))
            best = np.minimum.reduceat(rank, starts)
            going = np.repeat(best < NEVER, sizes)
            done.append((owner[~going], symbol[~going]))
            first = going & (rank == np.repeat(best, sizes))
            owner, symbol, entry, at = owner[going], symbol[going], entry[going], np.flatnonzero(first[going])
            if not len(at):
                break
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # leftmost of equals
            symbol[at] = self.pair_number[entry[at]]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            owner, symbol, entry = owner[stays], symbol[stays], entry[stays]
            at = at - np.arange(len(at))
            entry[at] = none
            for left in (at, at[at > 0] - 1):
                left = left[left + 1 < len(owner)]
                left = left[owner[left] == owner[left + 1]]
                entry[left] = self._entries(symbol[left], symbol[left + 1])
        by_word = np.zeros(len(words), np.int64)
        if done:
            owner, symbol = (np.concatenate(x) for x in zip(*done))
            order = np.argsort(owner, kind="stable")
            owner, ids = owner[order], np.where(symbol < 0, symbol, self.id_of_number[symbol])[order]
            by_word = np.bincount(owner, minlength=len(words))
            plain = np.bincount(owner[ids < 0], minlength=len(words)) == 0
            flat = ids.tolist()
        else:
            plain, flat = np.ones(len(words), bool), []
        cuts = np.concatenate([[0], np.cumsum(by_word)]).tolist()
        out = [flat[a:b] for a, b in pairwise(cuts)]
        for i in np.flatnonzero(~plain).tolist():
            out[i] = [y for x in out[i] for y in ((x,) if x >= 0 else self._fallback(chr(-1 - x)))]
        for i in np.flatnonzero(lengths > LOCKSTEP_CHARS).tolist():
            out[i] = self.encode(words[i])
        return out

    def _fallback(self, symbol: str) -> list[int]:
        return [self.byte[b] for b in symbol.encode("utf-8")] if self.byte else [self.unknown]

    def encode(self, word: str) -> list[int]:
        symbols = list(word)
        n = len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        score = self.score
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in score:
                agenda.append((-score[pair], i, pair))
        heapify(agenda)
        while agenda:
            _, i, pair = heappop(agenda)
            j = right[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                new = pair + symbols[k]
                if new in score:
                    heappush(agenda, (-score[new], i, new))
            h = left[i]
            if h >= 0:
                new = symbols[h] + pair
                if new in score:
                    heappush(agenda, (-score[new], h, new))
        out = []
        for s in symbols:
            if s is None:
                continue
            if s in self.id:
                out.append(self.id[s])
            else:
                out.extend(self._fallback(s))
        return out


def words_of(text: str) -> list[str]:
    """Words of a text; each stands for a blank followed by the word."""
    if not text:
        return []
    if "  " not in text and BLANK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in _WORD.findall(BLANK + text.replace(" ", BLANK))]


@lru_cache(maxsize=2)
def _model(path: str):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    agenda = Agenda(processor)
    words = ChunkIds(lambda fresh: agenda.encode_words([BLANK + w for w in fresh]))
    return processor, words


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of whole texts with begin and end ids, by the agenda."""
    processor, words = _model(path)
    first, last = [processor.bos_id()], [processor.eos_id()]
    return [np.concatenate([first, ids, last]).astype(np.uint32)
            for ids in words.ids([words_of(t) for t in texts])]


def encode_checked(texts: list[str], path: str) -> tuple[list[np.ndarray], list[str], list[bool]]:
    """The agenda's ids of whole texts, the texts they decode to, and whether
    the library has the same ids."""
    ids = encode_texts(texts, path)
    processor, _ = _model(path)
    lists = [x.tolist() for x in ids]
    decoded = processor.decode(lists, num_threads=1)
    library = processor.encode(texts, add_bos=True, add_eos=True, num_threads=1)
    return ids, decoded, [x == y for x, y in zip(lists, library)]


SCHEMA = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")


def encoded(docs: DataFrame, model_path: str, keep_ids: bool = False, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and
    ``agrees``: whether the agenda's ids, from which all else is made, equal
    the library's. ``keep_ids`` adds the ids and the
    decoded text.

    Null and empty texts are encoded as the begin and end ids alone. Rows
    are independent (repeated rows repeat, null ids stay null); an empty
    table gives an empty result; extra columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, doc_ids = b["text"].to_pylist(), b["doc_id"]
            for low, high in slices(texts, 1_000_000):
                ids, decoded, agrees = encode_checked(texts[low:high], model_path)
                columns = [doc_ids[low:high], pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                           pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in decoded]),
                           pa.array(agrees, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                if keep_ids:
                    columns += [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                                pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    schema = SCHEMA + (", ids array<int>, decoded string" if keep_ids else "")
    return map_arrow(texts_of(docs, id_col, text_col), run, schema)
