"""Exact duplicates with Patricia-trie owners.

Rows are partitioned by (byte length, content hash). Each partition inserts
the full byte strings into a compressed radix trie whose terminal nodes hold
the owner's id and the number of rows, so texts are compared byte by byte
and a hash collision cannot merge two texts. A trie that outgrows its budget
gives up its largest subtree: the subtree's records, and all later rows that
fall under it, go to the next round, where they are dealt out anew.

Before the shuffle every Arrow batch keeps one row per text, so a group that
holds a third of all rows arrives as one row per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, join_owners, map_arrow, texts_of

#: Bytes of text that one trie may hold.
TRIE_BYTES = 96 << 20


class Trie:
    """Compressed radix trie over byte strings. A node is
    ``[edge, children by first byte, terminal]``; a terminal is
    ``[owner, rows]`` or None."""

    def __init__(self, keep_largest: bool, unit: int = 1):
        self.root = [b"", {}, None]
        self.unit = unit
        self.prefer = max if keep_largest else min
        self.held = 0
        self.by_unit: dict[bytes, int] = {}

    def _merge(self, node: list, owner: int | None, rows: int) -> None:
        if node[2] is None:
            node[2] = [owner, rows]
            return
        have = node[2]
        if owner is not None:
            have[0] = owner if have[0] is None else self.prefer(have[0], owner)
        have[1] += rows

    def _grow(self, data: bytes, new: int) -> None:
        self.held += new
        unit = data[: self.unit]
        self.by_unit[unit] = self.by_unit.get(unit, 0) + new

    def insert(self, data: bytes, owner: int | None, rows: int) -> None:
        node, pos = self.root, 0
        while pos < len(data):
            child = node[1].get(data[pos])
            if child is None:
                node[1][data[pos]] = [data[pos:], {}, [owner, rows]]
                self._grow(data, len(data) - pos)
                return
            edge = child[0]
            if not data.startswith(edge, pos):
                same = common_prefix(edge, data[pos: pos + len(edge)])
                node[1][data[pos]] = [edge[:same], {edge[same]: child}, None]
                child[0] = edge[same:]
                child = node[1][data[pos]]
                edge = child[0]
            pos += len(edge)
            node = child
        self._merge(node, owner, rows)

    def deepen(self) -> None:
        """Longer units, so that texts which all begin alike make two or
        more: one byte past what everything held has in common."""
        node, pos = self.root, 0
        while len(node[1]) == 1 and node[2] is None:
            node = next(iter(node[1].values()))
            pos += len(node[0])
        if not node[1]:
            return  # a single text
        prefix = next(self.records())[0][:pos]
        self.unit, self.by_unit = pos + 1, {}
        for first, child in node[1].items():
            held, stack = 0, [child]
            while stack:
                here = stack.pop()
                held += len(here[0])
                stack.extend(here[1].values())
            self.by_unit[prefix + bytes([first])] = held
        self.held = pos + sum(self.by_unit.values())

    def records(self, node: list | None = None, prefix: bytes = b"") -> Iterator[tuple]:
        """(bytes, owner, rows) of every terminal under ``node``."""
        stack = [(node or self.root, prefix)]
        while stack:
            here, before = stack.pop()
            data = before + here[0]
            if here[2] is not None:
                yield data, here[2][0], here[2][1]
            stack.extend((child, data) for child in here[1].values())

    def take_subtree(self, unit: bytes) -> list[tuple]:
        """Remove and return all records whose text starts with ``unit``
        (for a text shorter than the unit: the text itself)."""
        gone = self.by_unit.pop(unit, 0)
        self.held -= gone
        if len(unit) < self.unit:
            found = [r for r in self.records() if r[0] == unit]
            node = self.root
            pos = 0
            while pos < len(unit):
                node = node[1][unit[pos]]
                pos += len(node[0])
            node[2] = None
            return found
        parent, node, pos = None, self.root, 0
        while pos < len(unit):
            parent, node = node, node[1][unit[pos]]
            pos += len(node[0])
        above = unit[: pos - len(node[0])]
        del parent[1][unit[len(above)]]
        return list(self.records(node, above))


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


_ROWS = {"bytes": pa.binary(), "owner": pa.int64(), "rows": pa.int64(), "spilled": pa.bool_()}
_SCHEMA = "bytes binary, owner long, rows long, spilled boolean"


def _out(rows: list[tuple], spilled: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([spilled] * len(rows), pa.bool_())],
        names=list(_ROWS))


def _chunks(rows: Iterator[tuple], limit: int = 4 << 20) -> Iterator[list[tuple]]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[0])
        if size > limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _combine(keep_largest: bool):
    """One row per text of every Arrow batch."""
    prefer = max if keep_largest else min

    def run(batches):
        for b in batches:
            seen: dict[bytes, list] = {}
            for data, owner, n in zip(b["bytes"].to_pylist(), b["owner"].to_pylist(), b["rows"].to_pylist()):
                have = seen.get(data)
                if have is None:
                    seen[data] = [owner, n]
                else:
                    have[1] += n
                    if owner is not None:
                        have[0] = owner if have[0] is None else prefer(have[0], owner)
            for rows in _chunks((k, v[0], v[1]) for k, v in seen.items()):
                yield _out(rows, False)
    return run


def _insert(keep_largest: bool, budget: int, unit: int):
    def run(batches):
        trie, spilled = Trie(keep_largest, unit), {}  # unit length -> units
        for b in batches:
            away = []
            for data, owner, n in zip(b["bytes"].to_pylist(), b["owner"].to_pylist(), b["rows"].to_pylist()):
                if any(data[:length] in units for length, units in spilled.items()):
                    away.append((data, owner, n))
                    continue
                trie.insert(data, owner, n)
                if trie.held > budget and len(trie.by_unit) < 2:
                    trie.deepen()
                if trie.held > budget and len(trie.by_unit) > 1:
                    largest = max(trie.by_unit, key=trie.by_unit.get)
                    spilled.setdefault(trie.unit, set()).add(largest)
                    away.extend(trie.take_subtree(largest))
            for rows in _chunks(iter(away)):
                yield _out(rows, True)
        for rows in _chunks(trie.records()):
            yield _out(rows, False)
    return run


def owners(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
           trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: ``sha256`` (lowercase hex of its UTF-8),
    ``keep_id`` (smallest or largest id of its rows), ``group_size``. A
    written table.

    Null text counts as empty. Null ids never own a text unless all its ids
    are null. An empty table gives no row."""
    largest = {"smallest": False, "largest": True}[keep]
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = texts_of(docs, id_col, text_col).select(
        F.col("text").cast("binary").alias("bytes"), F.col("doc_id").alias("owner"),
        F.lit(1).cast("long").alias("rows"))
    rows = map_arrow(rows, _combine(largest), _SCHEMA)
    done, turn = None, 0
    while True:
        unit = 1 << min(turn, 20)  # subtrees of a later round lie deeper
        dealt = rows.repartition(F.octet_length("bytes"), F.xxhash64("bytes", F.lit(turn)))
        found = map_arrow(dealt, _insert(largest, trie_bytes, unit), _SCHEMA)
        # the text itself goes on only for spilled rows
        found = scratch.save(found.select(
            F.sha2("bytes", 256).alias("sha256"), "owner", "rows", "spilled",
            F.when(F.col("spilled"), F.col("bytes")).alias("bytes")), "trie")
        kept = found.filter(~F.col("spilled")).select(
            "sha256", F.col("owner").alias("keep_id"), F.col("rows").alias("group_size"))
        done = kept if done is None else done.unionByName(kept)
        if found.filter("spilled").limit(1).count() == 0:
            return done
        rows = found.filter("spilled").select("bytes", "owner", "rows")
        turn += 1


def dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text",
          trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``kept`` is true for the rows whose id is the owner's: rows that repeat
    an id together with its text are the same document and stay together,
    and rows with null ids stay only where no row of the text has an id.
    Null text counts as empty; extra columns are ignored; an empty table
    gives an empty result."""
    found = owners(docs, keep, id_col, text_col, trie_bytes)
    rows = texts_of(docs, id_col, text_col).select("doc_id", F.sha2(F.col("text"), 256).alias("sha256"))
    return join_owners(rows, found, "sha256", "group_size").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"))
