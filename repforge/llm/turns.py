"""Conversation structure repair by scalar big-integer weights.

A conversation's rows become one letter each: the initial of the role and
the first fault. A path through the graph (rows passed, inserts made, state of
the role grammar ``(s?(ua)+)?``) is an edit sequence, and its weight is one
integer: the high digits are the cost, the low digits, of fixed width and by
position, are the audit letters, with zeros where the audit has ended. The
smallest integer is the cheapest repair with the least audit; nothing else
decides.

Long conversations are cut into blocks of ``BLOCK`` rows. A block's table
(state before, state after -> integer) depends on its letters alone; costs
ahead are carried back over the blocks, and each block then takes its least
integer. An insert belongs to the row after it, so every block's audit ends
with a row's letter, no audit of a block is the start of another one, and the
choice block by block is the least audit of the whole.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repforge.llm.common import Scratch, map_arrow

#: Rows solved in one table.
BLOCK = 32
#: Repaired rows held before they are handed on.
HELD_ROWS = 4_096

# --- weights ------------------------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
DELETE, INSERT, KEEP, REROLE = range(1, 5)  # digits in the order of the letters
LETTERS = " DIKR"
COSTS = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED = 5
DIGIT = 3

#: state -> state after a user, an assistant or a system row.
_ENTERS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_INSERTS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Cost of the inserts that end a conversation, and their states.
_TAIL = {START: [], ASSISTANT: [], USER: [ASSISTANT], SYSTEM: [USER, ASSISTANT]}
AT_END = [COSTS[INSERT] * len(_TAIL[s]) for s in STATES]


def _row_edits(letter: str, state: int) -> list[tuple[int, int, int]]:
    """(edit, cost, state after) of one row; ``x`` (blank) and ``y``
    (duplicate) must go, a capital is truncated, ``o`` is any other role."""
    edits = [(DELETE, COSTS[DELETE], state)]
    if letter not in "xy":
        extra = TRUNCATED if letter.isupper() else 0
        kept = _ENTERS.get(letter.lower(), {}).get(state)
        if kept is not None:
            edits.append((KEEP, extra, kept))
        edits += [(REROLE, COSTS[REROLE] + extra, _ENTERS[to][state]) for to in "ua" if state in _ENTERS[to]]
    return edits


def _width(rows: int) -> int:
    """Most letters of a cheapest path: deleting every row and two inserts
    lead anywhere that inserts lead."""
    return rows + (COSTS[DELETE] * rows + 2 * COSTS[INSERT]) // COSTS[INSERT]


@lru_cache(maxsize=1 << 15)
def weights(letters: str, before: int) -> dict[int, int]:
    """state after -> smallest weight of a path over all rows."""
    width = _width(len(letters))
    spare = width - len(letters)
    cost = lambda c: c << (DIGIT * width)
    at = lambda digit, place: digit << (DIGIT * (width - 1 - place))
    least = {(0, before): 0}
    for row, letter in enumerate(letters):
        for _ in range(2):  # two inserts lead wherever inserts lead
            for (made, state), w in list(least.items()):
                if made < spare:
                    node = (made + 1, _INSERTS[state])
                    through = w + cost(COSTS[INSERT]) + at(INSERT, row + made)
                    if through < least.get(node, through + 1):
                        least[node] = through
        after: dict[tuple[int, int], int] = {}
        for (made, state), w in least.items():
            for edit, c, to in _row_edits(letter, state):
                through = w + cost(c) + at(edit, row + made)
                if through < after.get((made, to), through + 1):
                    after[(made, to)] = through
        least = after
    out: dict[int, int] = {}
    for (_, state), w in least.items():
        out[state] = min(w, out.get(state, w))
    return out


def costs_before(letters: str, times: int, ahead: list[int]) -> list[int]:
    """Least cost to the end from each state before a block."""
    if times:  # a run of rows that must go
        return [a + COSTS[DELETE] * times for a in ahead]
    shift = DIGIT * _width(len(letters))
    return [min((w >> shift) + ahead[to] for to, w in weights(letters, s).items()) for s in STATES]


@lru_cache(maxsize=1 << 15)
def chosen(letters: str, before: int, ahead: tuple[int, ...]) -> tuple[int, str, list, int]:
    """(cost, audit, edits of each row, state after) of the least weight. A
    row's edits are (letter, new role or None), its inserts first."""
    width = _width(len(letters))
    after, weight = min(weights(letters, before).items(), key=lambda t: t[1] + (ahead[t[0]] << (DIGIT * width)))
    digits = [(weight >> (DIGIT * (width - 1 - p))) & 7 for p in range(width)]
    audit = [d for d in digits if d]
    rows, state, edits = iter(letters), before, []
    made: list = []
    for digit in audit:
        if digit == INSERT:
            state = _INSERTS[state]
            made.append(("I", "user" if state == USER else "assistant"))
            continue
        letter = next(rows)
        to = next(t for e, _, t in _row_edits(letter, state) if e == digit)
        role = ("user" if to == USER else "assistant") if digit == REROLE else None
        edits.append([*made, (LETTERS[digit], role)])
        made, state = [], to
    return weight >> (DIGIT * width), "".join(LETTERS[d] for d in audit), edits, after


# --- rows ---------------------------------------------------------------------

#: White space of the contract: blank, tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
_ORDER = ["conv_id", "turn", "role", "text_sha"]


def rows_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies); null roles and texts are one
    space. Other columns are left behind."""
    return conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows_of`` with the test damage that crc32('conv_id:turn') mod 20
    picks (a null is one space there): 0 ``copies`` 0 (dropped), 1 no text,
    2 text without ``.!?``, 3 ``copies`` 2, 4 role user."""
    spelled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")), F.lit(20))
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
         .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, F.col("copies") * 2)
         .otherwise(F.col("copies")).alias("copies"))


def _letter() -> Column:
    """One letter for a row, duplicates not yet known."""
    said = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return (F.when(said == "", "x").when(F.right(said, F.lit(1)).isin(".", "!", "?"), plain)
            .otherwise(F.upper(plain)))


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def records(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one record with their number, and whether an
    earlier turn has the same role and text. Counted before they are
    shuffled; texts stay behind, their sha256 stands for them."""
    found = (rows.filter("copies > 0").select("conv_id", "turn", "role", _digest().alias("text_sha"),
                                              _letter().alias("letter"), "copies")
             .groupBy(*_ORDER, "letter").agg(F.sum("copies").alias("copies")))
    return found


def _with_repeats(found: DataFrame) -> DataFrame:
    """``found`` (written) with letter ``y`` where an earlier turn of the
    conversation has the role and text. Only what occurs in two turns or
    more is joined back."""
    first = (found.filter("letter <> 'x'").groupBy("conv_id", "role", "text_sha")
             .agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("least"),
                  F.max(F.col("turn").isNull()).alias("unnumbered")).filter("turns > 1")
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_sha").alias("t"),
                     "least", "unnumbered"))
    seen = (found["conv_id"].eqNullSafe(F.col("c")) & (found["role"] == F.col("r")) & (found["text_sha"] == F.col("t")))
    later = F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("least")))
    return (found.join(first, seen, "left")
            .withColumn("letter", F.when((F.col("letter") != "x") & F.coalesce(later, F.lit(False)), "y")
                        .otherwise(F.col("letter"))).select(*_ORDER, "letter", "copies"))


BLOCKS = "conv_id long, turn long, role string, text_sha binary, part int, letters string, times long"


def blocks(marked: DataFrame, size: int = BLOCK) -> DataFrame:
    """Records in order, cut into blocks: the place of the first row, and
    ``letters`` of at most ``size`` rows, or (``times`` > 0) a run of so many
    copies that must go. Ranges, not conversations, are dealt to the tasks,
    so a long conversation is cut by many of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, ""
        for b in batches:
            out: list[tuple] = []
            for *key, letter, copies in zip(*(b[c].to_pylist() for c in (*_ORDER, "letter", "copies"))):
                if held and (key[0] != place[0] or len(held) >= size):
                    out.append((*place, 0, held, 0))
                    held = ""
                place, held = (place, held + letter) if held else (key, letter)
                again = "x" if letter == "x" else "y"
                if len(held) + copies - 1 <= size:
                    held += again * (copies - 1)
                else:
                    out += [(*place, 0, held, 0), (*key, 1, again, copies - 1)]
                    held = ""
            yield _table(out, BLOCKS)
        if held:
            yield _table([(*place, 0, held, 0)], BLOCKS)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_sha")]
    return map_arrow(marked.repartitionByRange(*order).sortWithinPartitions(*order), run, BLOCKS)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(),
          "array<long>": pa.list_(pa.int64())}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)],
                                      names=[n for n, _ in fields])


def _with_costs_ahead(cut: DataFrame) -> DataFrame:
    """Adds ``ahead``: least cost from each state after the block to the end
    of the conversation. One walk from the last block to the first, over
    blocks, with four numbers in hand."""
    schema = f"{BLOCKS}, ahead array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ahead = (), AT_END
        for b in batches:
            out = []
            for block in zip(*(c.to_pylist() for c in b.columns)):
                if (block[0],) != conv:
                    conv, ahead = (block[0],), AT_END
                out.append((*block, ahead))
                ahead = costs_before(block[5], block[6], ahead)
            yield _table(out, schema)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").desc_nulls_last(), F.col("role").desc(),
             F.col("text_sha").desc(), F.col("part").desc()]
    # a fixed number: few bytes, much work, so partitions must not be merged by size
    n = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(cut.repartition(n, "conv_id").sortWithinPartitions(*order), run, schema)


# --- repair ---------------------------------------------------------------------

class _Conversation:
    """One conversation as its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost, self.audit = conv_id, START, 0, []
        self.waiting: deque = deque()  # edits of the rows to come
        self.faults = {"x": 0, "y": 0, "cut": 0}
        self.low = self.high = self.last = None
        self.turns, self.illegal = 0, 0

    def block(self, letters: str, times: int, ahead: list[int]) -> None:
        if times:
            self.faults[letters] += times
            self.cost += COSTS[DELETE] * times
            self.audit.append("D" * times)
            self.waiting.append([times])
            return
        cost, audit, edits, self.state = chosen(letters, self.state, tuple(ahead))
        self.cost += cost
        self.audit.append(audit)
        self.waiting.extend(edits)
        for c in letters:
            if c in "xy":
                self.faults[c] += 1
            elif c.isupper():
                self.faults["cut"] += 1

    def row(self, turn, role: str, copies: int) -> Iterator[tuple[str, str | None]]:
        """The row's edits: (letter, new role)."""
        initial = role[:1]
        self.illegal += (self.last is not None and self.last + initial not in ("su", "ua", "au")) + (
            (copies - 1) * (initial + initial not in ("su", "ua", "au")))
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        while copies:
            edits = self.waiting.popleft()
            if isinstance(edits[0], int):  # a run that goes
                taken = min(copies, edits[0])
                if edits[0] > taken:
                    self.waiting.appendleft([edits[0] - taken])
                copies -= taken
                yield "D", None
                continue
            copies -= 1
            yield from edits

    def end(self) -> list[str]:
        """Roles of the rows inserted after the last one."""
        added = ["user" if s == USER else "assistant" for s in _TAIL[self.state]]
        self.cost += AT_END[self.state]
        self.audit.append("I" * len(added))
        return added

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.faults["x"], self.faults["y"], self.faults["cut"], self.illegal, self.cost,
                "".join(self.audit))


_STREAM = ["conv_id", "turn", "role", "text_sha", "part", "text", "copies", "letters", "times", "ahead"]


def _stream(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows and blocks of whole conversations in order: a block comes right
    before its first row (part 0 or 1 before 2); a dropped row comes as 3."""
    said = rows.select("conv_id", "turn", "role", _digest().alias("text_sha"),
                       F.when(F.col("copies") > 0, 2).otherwise(3).alias("part"),
                       F.when(F.col("copies") > 0, F.col("text")).alias("text"), F.col("copies").cast("long"),
                       F.lit(None).cast("string").alias("letters"), F.lit(None).cast("long").alias("times"),
                       F.lit(None).cast("array<long>").alias("ahead"))
    cut = decided.select(*_ORDER, "part", F.lit(None).cast("string").alias("text"),
                         F.lit(None).cast("long").alias("copies"), "letters", "times", "ahead")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text_sha", "part"]
    return said.unionByName(cut).repartition("conv_id").sortWithinPartitions(*order).drop("text_sha")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """("row", conversation, letter, role, text) and ("end", conversation)
    for sorted rows and blocks; one row is held at a time."""
    at = None

    def ended():
        for role in at.end():
            yield "row", at, "I", role, ""
        yield "end", at, None, None, None

    for b in batches:
        text = b["text"]
        columns = [b[c].to_pylist() for c in _STREAM if c not in ("text", "text_sha")]
        for i, (conv, turn, role, part, copies, letters, times, ahead) in enumerate(zip(*columns)):
            if at is None or at.conv_id != conv:
                if at is not None:
                    yield from ended()
                at = _Conversation(conv)
            if part < 2:
                at.block(letters, times, ahead)
            elif part == 2:
                for letter, new in at.row(turn, role, copies):
                    said = "" if letter in "ID" else text[i].as_py()
                    yield "row", at, letter, new or role, said
    if at is not None:
        yield from ended()


def _decided(scratch: Scratch, rows: DataFrame, size: int) -> DataFrame:
    found = scratch.save(records(rows), "turns")
    marked = scratch.save(_with_repeats(found), "turns-marked")
    scratch.drop(found)
    decided = scratch.save(_with_costs_ahead(blocks(marked, size)), "turn-blocks")
    scratch.drop(marked)
    return decided


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text), rows
    kept, given another role or inserted, in order of ``place`` from 0."""
    decided = _decided(Scratch(rows.sparkSession), rows, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place = [], 0
        for what, at, letter, role, text in _walk(batches):
            if what == "end":
                place = 0
            elif letter != "D":
                out.append((at.conv_id, place, letter, role, text))
                place += 1
            if len(out) >= HELD_ROWS:
                yield _table(out, REPAIRED)
                out = []
        yield _table(out, REPAIRED)
    return map_arrow(_stream(rows, decided), run, REPAIRED)


DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def repair_digest(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per conversation of ``rows`` (``rows_of``, ``damaged`` or both):
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    Rows of a conversation go by turn, nulls first, then by role and the
    sha256 of the text (ties; equal rows stand side by side). A null conv_id
    is a conversation of its own. A conversation without rows has zeros, an
    empty audit and the hash of nothing. A role that does not begin with s, u
    or a, an empty one included, is never kept as it is. An empty table gives
    no rows. Very long texts are hashed as they pass; of a conversation, one
    row and its audit are held. The digest reads a conversation's texts one
    after another, so a single one, however long, is hashed by one task; its
    faults, blocks and costs are found by many.
    """
    decided = _decided(Scratch(rows.sparkSession), rows, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest, some = [], hashlib.sha256(), False
        for what, at, letter, role, text in _walk(batches):
            if what == "end":
                out.append((*at.summary(), digest.hexdigest()))
                digest, some = hashlib.sha256(), False
            elif letter != "D":
                digest.update(f"\n{role}:{text}".encode() if some else f"{role}:{text}".encode())
                some = True
            if len(out) >= HELD_ROWS:
                yield _table(out, DIGEST)
                out = []
        yield _table(out, DIGEST)
    return map_arrow(_stream(rows, decided), run, DIGEST)
