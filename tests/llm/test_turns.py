"""op11 against a version that follows the contract row by row."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from repforge.llm import turns
from repforge.llm.queries import op11_turn_repair

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("copies", "letters", "part", "cost", "ahead")]])
WHITE = " \t\n\x0b\x0c\r"
WORD = {"u": "user", "a": "assistant"}


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(3)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def search(rows, faults):
    """Cheapest edits by a search over explicit edit strings."""
    heap = [(0, "", 0, ())]
    seen = set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        initials = "".join(r[:1] or "-" for r, _ in out)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, out
        if not re.fullmatch("s?(ua)*u?", initials) or (i, audit, initials) in seen:
            continue
        seen.add((i, audit, initials))
        for w in WORD.values():
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*out, (w, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, (*out, (role, text))))
                for w in WORD.values():
                    heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, (*out, (w, text))))


def by_contract(rows, after):
    result = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faults, before = [], set()
        for _, _, role, text in mine:
            said = text.rstrip(WHITE)
            faults.append("blank" if not said else "duplicate" if (role, text) in before
                          else "truncated" if said[-1] not in ".!?" else "")
            before.add((role, text))
        numbers = [r[1] for r in mine if r[1] is not None]
        initials = [r[2][:1] for r in mine]
        cost, audit, out = search([r[2:] for r in mine], faults)
        result[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
                        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return result


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def made_up(seed, n):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "Well?\n", "é. ", "ok.", "more.", "text.", "last."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"]
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(0, 6)):
            rows.append((conv if conv else None, rnd.choice([turn, turn, turn, 2 * turn, None, -3]),
                         rnd.choice(roles), rnd.choice(texts)))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("size", [turns.BLOCK, 1, 2])
def test_repairs_by_contract(spark, size):
    rows = made_up(size, 150)
    frame = turns.damaged(turns.rows_of(conversations(spark, rows)))
    assert found(turns.repair_digest(frame, size)) == by_contract(rows, damage(rows))


def test_clean_rows_and_empty_tables(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."),
            (2, 5, "assistant", "Cut"), (2, 9, "user", "What?")]
    plain = turns.rows_of(conversations(spark, rows))
    got = found(turns.repair_digest(plain))
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KKK")
    assert got[2][:7] == (3, 0, 0, 1, 0, 4, "DD")  # a role's change and an insert cost more
    assert got == by_contract(rows, rows)
    none = turns.rows_of(conversations(spark, []))
    assert turns.repair_digest(none).count() == 0 and turns.repaired(none).count() == 0


def test_repaired_rows_make_the_digest(spark):
    rows = made_up(9, 80)
    frame = turns.damaged(turns.rows_of(conversations(spark, rows)))
    said = {}
    for r in sorted(turns.repaired(frame).collect(), key=lambda r: (r["conv_id"] or -1, r["place"])):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, r in found(turns.repair_digest(frame)).items():
        assert r[-1] == hashlib.sha256("\n".join(said.get(conv, [])).encode()).hexdigest()


def test_long_conversation_in_blocks(spark):
    """One conversation holds most rows; blocks of any size agree, and with
    one table over all rows where that is affordable."""
    rnd = random.Random(2)
    rows = [(7, i, rnd.choice(["user", "assistant", "assistant", "system"]), f"{'same' if rnd.random() < .2 else i}"
             + rnd.choice([".", ".", ""])) for i in range(300)]
    rows += [(7, 400, "user", "again and again.")] * 200 + [(7, 401, "assistant", "x" * 3_000_000 + ".")]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Yes.")]
    plain = turns.rows_of(conversations(spark, rows))
    one, other = found(turns.repair_digest(plain)), found(turns.repair_digest(plain, 5))
    assert one == other and one[7][2] > 199
    letters = "".join(rnd.choice("uuaasoUAxy") for _ in range(60))
    whole = turns.chosen(letters, turns.START, tuple(turns.AT_END))
    parts = [letters[i: i + 7] for i in range(0, 60, 7)]
    ahead = [turns.AT_END]
    for p in reversed(parts[1:]):
        ahead.insert(0, turns.costs_before(p, 0, ahead[0]))
    state, audit = turns.START, ""
    for p, a in zip(parts, ahead):
        _, said, _, state = turns.chosen(p, state, tuple(a))
        audit += said
    assert audit == whole[1]


def test_query_covers_every_conversation(spark, sf_small):
    import pyarrow.parquet as pq

    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_small}/conversations.parquet",
                                                     columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    want = by_contract(rows, damage(rows))
    assert found(op11_turn_repair(spark, sf_small)) == want
