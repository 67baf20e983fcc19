"""Exact Jaccard join of word n-gram sets with set-relation skipping.

1. Every text becomes its set of hashed shingles; equal sets share one id.
2. Shingles have one global order (rarer first, by a counting sketch over
   all sets; any order is right, this one is fast). Two sets at or above the
   threshold share a shingle in their prefixes, so the index holds prefixes
   only: (shingle, set, size, position). A list keeps the sets that sizes and
   positions allow a link with another one of it.
3. First answers: within an index list each set is compared with the list's
   smallest set of compatible size, its leader. Verified links give
   components; each set keeps its best leader and their exact overlap.
4. Lists are cut into blocks, one per leader, with the block's size range
   and best position. Pairs of blocks that no pair of their sets could pass,
   or that lie in one component, are skipped; of the others the two leaders
   are compared. First each block meets only the next one of another
   component in an order by hash: that joins the leaders of
   one large family by a number of pairs that grows with the lists, so the
   full comparison finds few blocks of different components left.

   Steps 3 and 4 use a parity sketch: bit c says whether a set has an odd
   number of shingles in cell c. Where two sketches differ, at least one
   shingle of that cell is in one set only, so the number of differing bits
   bounds the overlap from above, exactly. Pairs that this bound rules out
   are dropped before any set is sent. Pairs of large sets, which leave
   these cells full, are held against each other in as many cells as they
   have shingles.
5. The members' answers follow from the leaders': |x & y| is at most
   |l & l'| + |x - l| + |y - l'|. Only pairs of different components that
   this bound allows are compared, best bounds first. No pair above the
   threshold is lost.

Nothing is emitted for pairs inside a component, so a group of thousands of
near copies costs one comparison a set, not one a pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repforge.llm.chunks import ChunkIds
from repforge.llm.common import Scratch, batches_of, held_alone, join_owners, map_arrow, sliced, slices, texts_of

#: The threshold as a fraction: 4/5.
NUM, DEN = 4, 5
WIDTH = 5
#: Cells of the counting sketch (top bits of the shingle hash), in blocks.
CELL_BITS, BLOCK_BITS = 24, 18
#: Words whose hashes a worker keeps; a hash is soon made again.
MAX_WORDS = 100_000
#: Bytes of texts or sets that go to a Python worker at once.
BATCH = "8m"
#: Comparisons of two components' members in the first round; the second
#: round takes all that are left between components.
FIRST_TESTS = 64
#: Bits of the filter that finds the texts of chosen sets.
FILTER_BITS = 1 << 24
#: Members that one task compares with a leader.
LEADER_ROWS = 1000

#: Times that each block meets its neighbour before all blocks meet.
NEAR_ROUNDS = 1
#: Words of 64 bits in a parity sketch. Sets of up to about a thousand
#: shingles are told apart by it; larger ones go on to the exact comparison.
SKETCH_WORDS = 8
SKETCH = [f"sketch_{i}" for i in range(SKETCH_WORDS)]

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@held_alone
def _words() -> ChunkIds:
    return ChunkIds(lambda fresh: [[xxhash.xxh64_intdigest(w)] for w in fresh], MAX_WORDS, np.uint64)


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (64 bits) of each text. A text of
    fewer words is one shingle; one without words has none."""
    out = []
    for low, high in slices(texts):
        for words in _words().ids([t.encode("utf-8").translate(_LOWER).split() for t in texts[low:high]]):
            if not len(words):
                out.append(np.zeros(0, np.uint64))
                continue
            k = min(width, len(words))
            value = np.full(len(words) - k + 1, k * 0x9E3779B97F4A7C15 & 2**64 - 1, np.uint64)
            for i in range(k):
                value = (value ^ words[i: len(words) - k + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
                value ^= value >> np.uint64(32)
            out.append(np.unique(value))
    return out


def set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int) -> int:
    """Shingles of which a set of ``n`` shares one with every match."""
    return n - (NUM * n + DEN - 1) // DEN + 1


def needed(a: Column, b: Column) -> Column:
    """Least overlap of two sets of these sizes at the threshold."""
    return F.ceil(NUM * (a + b) / (NUM + DEN))


def linked(overlap: Column, a: Column, b: Column) -> Column:
    return (NUM + DEN) * overlap >= NUM * (a + b)


# --- sets, order, index ---------------------------------------------------------

def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS words of parities, by the low bits of the hashes."""
    odd = np.bincount((tokens & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch_of(tokens: np.ndarray) -> bytes | None:
    """Parities in as many cells (a power of two) as the set has shingles, for
    sets too large for SKETCH_WORDS words. Its halves, one on the other by
    xor, are the sketch of half as many cells."""
    if len(tokens) <= 64 * SKETCH_WORDS:
        return None
    cells = 1 << (len(tokens) - 1).bit_length()
    odd = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing_cells(x: bytes, y: bytes) -> int:
    """Differing bits of two wide sketches, the longer folded to the other."""
    a, b = (np.frombuffer(v, np.uint64) for v in (x, y))
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def _differing(a: str, b: str) -> Column:
    """Differing bits of the sketches under two prefixes."""
    return sum((F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in SKETCH[1:]),
               F.bit_count(F.col(f"{a}{SKETCH[0]}").bitwiseXOR(F.col(f"{b}{SKETCH[0]}"))))


def count_cells(counts: np.ndarray, tokens: np.ndarray) -> None:
    """Add a set's sorted shingles to the counts of their cells, which stop
    at 255: a byte a cell."""
    cells = (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    cell, more = cells[first], np.diff(first, append=len(cells))
    counts[cell] = np.minimum(counts[cell] + more, 255)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and the task's counts of shingles by cell."""
    counts, seen = np.zeros(1 << CELL_BITS, np.uint8), set()
    for b in batches:
        n = b.num_rows
        sizes, keys, wide = np.zeros(n, np.int64), [], []
        sketches = np.zeros((n, SKETCH_WORDS), np.int64)
        for low, texts in sliced(b["text"]):
            for at, tokens in enumerate(shingle_sets(texts), low):
                sizes[at] = len(tokens)
                keys.append(set_id(tokens) if len(tokens) else None)
                sketches[at] = sketch_of(tokens)
                wide.append(wide_sketch_of(tokens))
                if len(tokens) and keys[-1] not in seen:
                    seen.add(keys[-1])
                    count_cells(counts, tokens)
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(sizes), pa.array(keys, pa.int64()),
             *(pa.array(np.ascontiguousarray(sketches[:, i])) for i in range(SKETCH_WORDS)),
             pa.array(wide, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
            names=["doc_id", "n_shingles", "set_id", *SKETCH, "wide", "block", "counts"])
    blocks = [(i, c) for i, c in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)) if c.any()]
    n = len(blocks)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64())] * (3 + SKETCH_WORDS) +
        [pa.nulls(n, pa.binary()), pa.array([i for i, _ in blocks], pa.int32()),
         pa.array([zlib.compress(c.tobytes(), 1) for _, c in blocks], pa.binary())],
        names=["doc_id", "n_shingles", "set_id", *SKETCH, "wide", "block", "counts"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for i, c in zip(b["block"].to_pylist(), b["counts"].to_pylist()):
            more = np.frombuffer(zlib.decompress(c), np.uint8).astype(np.uint32)
            sums[i] = sums[i] + more if i in sums else more
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()),
         pa.array([np.floor(4 * np.log2(1 + c)).astype(np.uint8).tobytes() for c in sums.values()], pa.binary())],
        names=["block", "levels"])


def _levels(blocks: DataFrame) -> np.ndarray:
    """One byte per cell: 4 log2 of its count (2**CELL_BITS bytes, whatever
    the input)."""
    found = map_arrow(blocks.select("block", "counts").repartition("block"), _sum_blocks,
                      "block int, levels binary").collect()
    out = np.zeros((1 << (CELL_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    for r in found:
        out[r[0]] = np.frombuffer(r[1], np.uint8)
    return out.ravel()


def _index(levels) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for _, texts in sliced(b["text"]):
                tokens, keys, sizes, places = [], [], [], []
                for s in shingle_sets(texts):
                    if not len(s) or (key := set_id(s)) in seen:
                        continue
                    seen.add(key)
                    p = prefix_length(len(s))
                    rank = levels.value[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    tokens.append(s[np.argsort(rank, kind="stable")[:p]])
                    keys.append(np.full(p, key, np.int64))
                    sizes.append(np.full(p, len(s), np.int32))
                    places.append(np.arange(p, dtype=np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(keys)),
                         pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                        names=["token", "set_id", "n", "place"])
    return run


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of consecutive rows; a list (equal tokens) is never cut."""
    held: list[dict[str, np.ndarray]] = []

    def join(parts):
        return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    for b in batches:
        if not b.num_rows:
            continue
        now = {k: b[k].to_numpy(zero_copy_only=False) for k in b.schema.names}
        last = int(np.searchsorted(now["token"], now["token"][-1], side="left"))
        if held and (last > 0 or held[-1]["token"][-1] != now["token"][0]):
            cut = last
            done = [*held, {k: v[:cut] for k, v in now.items()}] if cut else held
            yield join(done)
            held = [{k: v[cut:] for k, v in now.items()}]
        elif held:
            held.append(now)
        else:
            if last:
                yield {k: v[:last] for k, v in now.items()}
            held = [{k: v[last:] for k, v in now.items()}]
    if held:
        yield join(held)


def _range_max(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest of values[low:high], for many bounds; of none the least integer."""
    out = np.full(len(low), np.iinfo(np.int64).min)
    length, level, width = high - low, values, 1  # level[i]: the largest of width values from i on
    while True:
        now = np.flatnonzero((length >= width) & (length < 2 * width))
        out[now] = np.maximum(level[low[now]], level[high[now] - width])
        if not (length >= 2 * width).any():
            return out
        level = np.maximum(level[:-width], level[width:])
        width *= 2


def partnered(token: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which rows have another in their list that sizes and positions allow a
    link with. Rows are sorted by token, n. The first shingle that two linked
    sets share leaves their overlap room behind it in both, so a row without
    such a partner finds no link in this list."""
    n = n.astype(np.int64)
    rest, here = n - place, np.arange(len(n))
    list_of = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) * (2 * int(n.max()) + 2)
    most = np.minimum(DEN * n // NUM, ((NUM + DEN) * rest - NUM * n) // NUM)
    low = np.searchsorted(list_of + n, list_of - (-NUM * n // DEN), side="left")
    high = np.searchsorted(list_of + n, list_of + np.maximum(most, 0), side="right")
    room = (NUM + DEN) * rest - NUM * n
    return np.maximum(_range_max(room, low, np.minimum(high, here)),
                      _range_max(room, np.maximum(low, here + 1), high)) >= NUM * n


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of two or more sets, each set once, of the rows that have a
    partner; then the stars of these lists as (leader, set_id) without token."""
    for c in _whole_lists(batches):
        fresh = np.ones(len(c["token"]), bool)
        fresh[1:] = (c["token"][1:] != c["token"][:-1]) | (c["set_id"][1:] != c["set_id"][:-1])
        c = {k: v[fresh] for k, v in c.items()}
        keep = partnered(c["token"], c["n"], c["place"])
        if keep.any():
            c = {k: v[keep] for k, v in c.items()}
            rows, stars = len(c["token"]), _stars(c)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[k]) for k in ("token", "set_id", "n", "place")), pa.nulls(rows, pa.int64())],
                names=["token", "set_id", "n", "place", "leader"])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(stars), pa.int64()), pa.array(stars[:, 1]), *[pa.nulls(len(stars), pa.int32())] * 2,
                 pa.array(stars[:, 0])], names=["token", "set_id", "n", "place", "leader"])


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    pairs = np.stack([a, b], axis=1)
    return np.unique(pairs, axis=0) if len(pairs) else pairs


def _stars(c: dict[str, np.ndarray]) -> np.ndarray:
    """(leader, set): of every list the smallest set, with all sets of
    compatible size; then again for the rest of the list."""
    token, key, n = c["token"], c["set_id"], c["n"].astype(np.int64)
    rest = n - c["place"]  # shingles from the shared one on
    leader = np.full(len(token), -1)
    start = np.concatenate([[True], token[1:] != token[:-1]])
    while True:
        head = np.maximum.accumulate(np.where(start, np.arange(len(token)), 0))
        beyond = (leader < 0) & (NUM * n > DEN * n[head])
        # the first row of each segment that is too large starts a new one
        new = beyond & ~np.concatenate([[False], beyond[:-1] & ~start[1:]])
        leader = np.where((leader < 0) & ~beyond, head, leader)
        if not new.any():
            break
        start = start | new
    need = -(-NUM * (n + n[leader]) // (NUM + DEN))
    ok = (leader != np.arange(len(token))) & (np.minimum(rest, rest[leader]) >= need)
    return _distinct_pairs(key[leader[ok]], key[ok])


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leader pairs (a < b) of each block and the next one of its list, where
    components differ and sizes and positions allow a link."""
    for c in _whole_lists(batches):
        low, high, rest = (c[k].astype(np.int64) for k in ("low", "high", "rest"))
        at = np.flatnonzero((c["token"][1:] == c["token"][:-1]) & (c["component"][1:] != c["component"][:-1]))
        to = at + 1
        need = -(-NUM * (low[at] + low[to]) // (NUM + DEN))
        ok = ((NUM * low[to] <= DEN * high[at]) & (NUM * low[at] <= DEN * high[to])
              & (np.minimum(rest[at], rest[to]) >= need))
        x, y = c["leader"][at[ok]], c["leader"][to[ok]]
        yield _pair_batch(_distinct_pairs(np.minimum(x, y), np.maximum(x, y)))


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leader pairs (a < b) of blocks of one list that lie in different
    components and that sizes, positions and sketches do not rule out, with
    their room: what members add to the leaders' overlap, less the least
    overlap needed. Rows:
    token, low, high (sizes), rest (largest), slack (largest), leader,
    component, leader_n, sketch; sorted by token, low. All rows of a batch
    meet the row ``step`` places on at once, until none has a partner left."""
    for c in _whole_lists(batches):
        low, high, rest, slack, leader_n = (c[k].astype(np.int64)
                                            for k in ("low", "high", "rest", "slack", "leader_n"))
        token, leader, component = c["token"], c["leader"], c["component"]
        sketch = np.stack([c[s] for s in SKETCH], axis=1).view(np.uint64)  # of a signed number numpy counts |x|
        found: list[np.ndarray] = []
        held, step, at = 0, 1, np.arange(len(token))
        while True:
            at = at[at + step < len(token)]
            to = at + step
            # low grows along a list: a size that does not fit ends the row
            fits = (token[to] == token[at]) & (NUM * low[to] <= DEN * high[at])
            at, to = at[fits], to[fits]
            if not len(at):
                break
            step += 1
            need = -(-NUM * (low[at] + low[to]) // (NUM + DEN))
            ok = (component[to] != component[at]) & (np.minimum(rest[at], rest[to]) >= need)
            i, j, need = at[ok], to[ok], need[ok]
            if not len(i):
                continue
            differing = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
            room = slack[i] + slack[j] - need
            ok = (leader_n[i] + leader_n[j] - differing) // 2 + room >= 0
            if ok.any():
                x, y = leader[i[ok]], leader[j[ok]]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y), room[ok]], axis=1))
                held += len(x)
            if held > 1_000_000:
                yield _roomiest(np.concatenate(found))
                found, held = [], 0
        if found:
            yield _roomiest(np.concatenate(found))


def _roomiest(rows: np.ndarray) -> pa.RecordBatch:
    """Each pair of the rows (a, b, room) once, with its largest room."""
    rows = rows[np.lexsort((-rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return pa.RecordBatch.from_arrays([pa.array(rows[first, k]) for k in range(3)], names=["a", "b", "room"])


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


# --- verification -----------------------------------------------------------------

def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, np.ndarray] = {}
    for b in batches:
        slot = b["slot"].to_numpy()
        for part in np.unique(slot >> BLOCK_BITS):
            bits = parts.setdefault(int(part), np.zeros(1 << BLOCK_BITS, bool))
            bits[slot[slot >> BLOCK_BITS == part] & ((1 << BLOCK_BITS) - 1)] = True
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(parts), pa.int32()), pa.array([np.packbits(p).tobytes() for p in parts.values()], pa.binary())],
        names=["part", "bits"])


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """FILTER_BITS bits (packed), set where a hash of the column ``h`` falls
    (2 MB, whatever the input; the more hashes, the more other rows pass)."""
    slot = F.col("h").bitwiseAND(FILTER_BITS - 1)
    found = map_arrow(hashes.select(slot.alias("slot")).distinct()
                      .repartition(F.shiftright("slot", BLOCK_BITS)), _mark, "part int, bits binary").collect()
    out = np.zeros((FILTER_BITS >> BLOCK_BITS, 1 << BLOCK_BITS >> 3), np.uint8)
    for part, bits in found:
        out[part] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _emit_sets(wanted: DataFrame, firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """(set_id, tokens) of the sets in ``wanted``, and of few others. One
    document of each set is looked up in the texts through a bitmap filter,
    so texts are not shuffled."""
    chosen = firsts.join(wanted, "set_id", "left_semi").select(F.xxhash64("doc_id").alias("h"))
    bitmap = rows.sparkSession.sparkContext.broadcast(_bitmap(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = b["h"].to_numpy() & (FILTER_BITS - 1)
            passed = bitmap.value[slot >> 3] >> (7 - (slot & 7)) & 1
            for _, texts in sliced(b.filter(pa.array(passed.astype(bool)))["text"]):
                sets = [s for s in shingle_sets(texts) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_id", "tokens"])
    return map_arrow(rows.select(F.xxhash64("doc_id").alias("h"), "text"), run, "set_id long, tokens binary")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, salt, member first false): the leader's set, then
    its members'."""
    leader, tokens = None, None
    for b in batches:
        out = []
        for a, member, other, data in zip(b["a"].to_pylist(), b["member"].to_pylist(), b["set_id"].to_pylist(),
                                          b["tokens"].to_pylist()):
            mine = np.frombuffer(data, np.uint64)
            if not member:
                leader, tokens = a, mine
                continue
            if a != leader:
                raise RuntimeError("a member came without its leader's set")
            at = np.minimum(np.searchsorted(tokens, mine), len(tokens) - 1)
            out.append((a, other, len(tokens), len(mine), int((tokens[at] == mine).sum())))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)],
                                         names=["a", "b", "n_a", "n_b", "overlap"])


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, overlap) of distinct pairs. A leader's set is sent
    once for each LEADER_ROWS of its members."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("salts"))
    members = (pairs.join(salts, "a").join(sets.withColumnRenamed("set_id", "b"), "b")
               .select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"),
                       F.lit(True).alias("member"), F.col("b").alias("set_id"), "tokens"))
    leaders = (salts.join(sets.withColumnRenamed("set_id", "a"), "a")
               .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                       F.lit(False).alias("member"), F.col("a").alias("set_id"), "tokens"))
    dealt = (leaders.unionByName(members).repartition("a", "salt")
             .sortWithinPartitions("a", "salt", "member").select("a", "member", "set_id", "tokens"))
    return map_arrow(dealt, _overlaps, "a long, b long, n_a long, n_b long, overlap long")


def _more_sets(scratch: Scratch, sets: DataFrame | None, pairs: DataFrame, firsts: DataFrame,
               rows: DataFrame) -> DataFrame:
    """``sets`` with those of the ends of ``pairs`` that it lacks; the texts
    are read only if there are any."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    if sets is not None:
        ends = scratch.save(ends.join(sets.select("set_id"), "set_id", "left_anti"), "ends")
        if not ends.limit(1).count():
            scratch.drop(ends)
            return sets
    more = scratch.save(_emit_sets(ends, firsts, rows).join(ends, "set_id"), "tokens")
    return more if sets is None else sets.unionByName(more)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(set_id, component) of the ends of edges (a, b): smallest id reachable
    over edges, by min labels with hooking and pointer jumping; one written
    table a round."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = scratch.save(both.groupBy(F.col("a").alias("set_id")).agg(F.min("b").alias("least"))
                       .select("set_id", F.least("set_id", "least").alias("component")), "labels")
    while True:
        of_b = now.select(F.col("set_id").alias("b"), F.col("component").alias("seen"))
        least = (both.join(of_b, "b").groupBy(F.col("a").alias("set_id")).agg(F.min("seen").alias("seen"))
                 .join(now, "set_id"))
        hooks = least.filter("seen < component").select(F.col("component").alias("set_id"), "seen")
        better = (least.select("set_id", "seen").unionByName(hooks)
                  .groupBy("set_id").agg(F.min("seen").alias("seen")))
        hooked = (now.join(better, "set_id", "left")
                  .select("set_id", F.least("component", F.coalesce("seen", "component")).alias("next"),
                          F.col("component").alias("before")))
        hooked = scratch.save(hooked, "hooked")
        # most labels name themselves already; only the others look one up
        up = hooked.filter("next <> set_id").select(F.col("set_id").alias("next"), F.col("next").alias("root"))
        after = scratch.save(hooked.join(up, "next", "left").select(
            "set_id", F.coalesce("root", "next").alias("component"), "before"), "labels")
        changed = after.filter("component <> before").limit(1).count()
        scratch.drop(now, hooked)
        now = after
        if not changed:
            return scratch.keep(now.select("set_id", "component"), now)


def _component(comps: DataFrame, end: str, name: str) -> DataFrame:
    return comps.select(F.col("set_id").alias(end), F.col("component").alias(name))


def merged(scratch: Scratch, comps: DataFrame, edges: DataFrame) -> DataFrame:
    """``comps`` after more edges: each component is one node, so only edges
    between components are walked. Sets without a row are alone."""
    between = scratch.save(
        edges.join(_component(comps, "a", "of_a"), "a", "left").join(_component(comps, "b", "of_b"), "b", "left")
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        .filter("a <> b").distinct(), "contracted")
    if not between.limit(1).count():
        scratch.drop(between)
        return comps
    roots = components(scratch, between)
    known = (comps.join(_component(roots, "component", "root"), "component", "left")
             .select("set_id", F.coalesce("root", "component").alias("component")))
    out = scratch.save(known.unionByName(roots.join(comps.select("set_id"), "set_id", "left_anti")), "components")
    scratch.drop(between, roots, comps)
    return out


def _wide_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that their wide sketches allow a link."""
    for b in batches:
        keep = [x is None or y is None or (n - differing_cells(x, y)) // 2 + room >= 0 for x, y, n, room in
                zip(*(b[k].to_pylist() for k in ("a_wide", "b_wide", "both", "room")))]
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _unless_apart(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that their sizes and sketches allow a link;
    with a column room, those whose overlap may reach -room."""
    side = lambda end: sketches.select(
        F.col("set_id").alias(end), F.col("n").alias(f"{end}_n"), F.col("wide").alias(f"{end}_wide"),
        *(F.col(s).alias(f"{end}_{s}") for s in SKETCH))
    room = F.col("room") if "room" in pairs.columns else -needed(F.col("a_n"), F.col("b_n"))
    both = F.col("a_n") + F.col("b_n")
    near = (pairs.join(side("a"), "a").join(side("b"), "b").withColumn("room", room)
            .filter(F.floor((both - _differing("a_", "b_")) / 2) + F.col("room") >= 0))
    return map_arrow(near.select("a", "b", "a_wide", "b_wide", both.alias("both"), "room"), _wide_apart,
                     "a long, b long")


def set_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_shingles, set_id), (sets: set_id, component) for
    the sets that share a prefix shingle with another set."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = texts_of(docs, id_col, text_col)
    found = scratch.save(map_arrow(
        rows, _sets, "doc_id long, n_shingles long, set_id long, " + ", ".join(f"{s} long" for s in SKETCH)
        + ", wide binary, block int, counts binary"), "sets")
    ids = found.filter(F.col("block").isNull()).select("doc_id", "n_shingles", "set_id")
    levels = spark.sparkContext.broadcast(_levels(found.filter(F.col("block").isNotNull())))

    postings = map_arrow(rows.select("text"), _index(levels), "token long, set_id long, n int, place int")
    listed = scratch.save(map_arrow(postings.repartition("token").sortWithinPartitions("token", "n", "set_id"),
                                    _shared, "token long, set_id long, n int, place int, leader long"), "lists")
    lists = listed.filter(F.col("leader").isNull()).drop("leader")
    nodes = scratch.save(lists.groupBy("set_id").agg(F.max("n").alias("n")), "nodes")

    sketches = scratch.save(
        found.groupBy("set_id").agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"),
                                    *(F.max(s).alias(s) for s in [*SKETCH, "wide"]))
        .join(nodes.select("set_id"), "set_id", "left_semi"), "sketches")

    # first answers: sets and their list's leader
    stars = (listed.filter(F.col("leader").isNotNull())
             .groupBy(F.col("leader").alias("a"), F.col("set_id").alias("b")).count().select("a", "b"))
    stars = scratch.save(_unless_apart(stars, sketches), "stars")
    sets = _more_sets(scratch, None, stars, sketches, rows)
    seen = scratch.save(_verify(stars, sets).distinct(), "overlaps")
    is_link = linked(F.col("overlap"), F.col("n_a"), F.col("n_b"))
    comps = components(scratch, seen.filter(is_link))

    # each set's leader: the linked one with most sets
    popular = Window.partitionBy("b").orderBy(F.desc("rows"), "a")
    best = (seen.filter(is_link).join(seen.filter(is_link).groupBy("a").agg(F.count("*").alias("rows")), "a")
            .withColumn("nth", F.row_number().over(popular)).filter("nth = 1")
            .select(F.col("b").alias("set_id"), F.col("a").alias("leader"),
                    (F.col("n_b") - F.col("overlap")).alias("extra")))
    led = scratch.save(nodes.join(best, "set_id", "left").join(comps, "set_id", "left").select(
        "set_id", "n", F.coalesce("component", "set_id").alias("component"), F.coalesce("leader", "set_id").alias("leader"),
        F.coalesce("extra", F.lit(0)).alias("extra")), "led")

    # blocks of the lists, first each with its neighbour
    blocks = scratch.save(
        lists.join(led.select("set_id", "leader", "extra"), "set_id").groupBy("token", "leader")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("place")).alias("rest"),
             F.max("extra").alias("slack")), "blocks")
    placed = lambda: (blocks.join(_component(comps, "leader", "component"), "leader", "left")
                      .withColumn("component", F.coalesce("component", "leader")))
    for turn in range(NEAR_ROUNDS):
        near = placed().drop("slack").withColumn("order", F.xxhash64("token", "leader", F.lit(turn)))
        near = map_arrow(near.repartition("token").sortWithinPartitions("token", "order", "leader"), _near_pairs,
                         "a long, b long").groupBy("a", "b").count().select("a", "b")
        near = scratch.save(_unless_apart(near, sketches), "near")
        sets = _more_sets(scratch, sets, near, sketches, rows)
        met = scratch.save(_verify(near, sets).filter(is_link).select("a", "b").distinct(), "met")
        comps = merged(scratch, comps, met)
        scratch.drop(near, met)

    # then all blocks of different components, by their leaders
    apart = (placed().groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most"))
             .filter("least < most").select("token"))
    wide = (placed().join(apart, "token", "left_semi")
            .join(sketches.drop("doc_id", "wide").withColumnsRenamed({"set_id": "leader", "n": "leader_n"}), "leader"))
    pairs = scratch.save(_unless_apart(map_arrow(
        wide.repartition("token").sortWithinPartitions("token", "low", "leader"), _block_pairs,
        "a long, b long, room long").groupBy("a", "b").agg(F.max("room").alias("room")), sketches), "pairs")
    sets = _more_sets(scratch, sets, pairs, sketches, rows)
    between = scratch.save(_verify(pairs, sets).distinct(), "between")
    comps = merged(scratch, comps, between.filter(is_link).select("a", "b"))

    # members of leaders whose overlap leaves room for a link
    room = led.groupBy("leader").agg(F.min("n").alias("low"), F.max("extra").alias("slack"),
                                     F.max(F.col("set_id") != F.col("leader")).alias("others"))
    side = lambda s: room.select(F.col("leader").alias(s), F.col("low").alias(f"low_{s}"),
                                 F.col("slack").alias(f"slack_{s}"), F.col("others").alias(f"others_{s}"))
    parts = _component(comps, "set_id", "part")
    of = lambda end: parts.withColumnsRenamed({"set_id": end, "part": f"part_{end}"})
    tight = (between.join(side("a"), "a").join(side("b"), "b")
             .filter((F.col("overlap") + F.col("slack_a") + F.col("slack_b")) >= needed(F.col("low_a"), F.col("low_b")))
             .filter(F.col("others_a") | F.col("others_b"))
             .join(of("a"), "a", "left").join(of("b"), "b", "left")
             .filter(F.coalesce("part_a", "a") != F.coalesce("part_b", "b"))
             .select("a", "b", "overlap", "slack_b", "low_b"))
    if tight.limit(1).count():
        tight = scratch.save(tight, "tight")
        tested = between.select("a", "b")
        for most in (FIRST_TESTS, None):
            member = led.drop("component").join(comps, "set_id", "left").withColumn(
                "component", F.coalesce("component", "set_id"))
            half = lambda s: member.select(
                F.col("leader").alias(f"leader_{s}"), F.col("set_id").alias(f"set_{s}"), F.col("n").alias(f"n_{s}"),
                F.col("extra").alias(f"extra_{s}"), F.col("component").alias(f"component_{s}"))
            bound = F.col("overlap") + F.col("extra_a") + F.col("extra_b")
            more = (tight.join(half("a"), (F.col("a") == F.col("leader_a")) & (
                        F.col("overlap") + F.col("extra_a") + F.col("slack_b") >= needed(F.col("n_a"), F.col("low_b"))))
                    .join(half("b"), (F.col("b") == F.col("leader_b")) & (F.col("component_a") != F.col("component_b"))
                          & (bound >= needed(F.col("n_a"), F.col("n_b"))))
                    .withColumn("bound", bound)
                    .withColumn("a", F.least("set_a", "set_b")).withColumn("b", F.greatest("set_a", "set_b"))
                    .withColumn("from", F.least("component_a", "component_b"))
                    .withColumn("to", F.greatest("component_a", "component_b"))
                    .groupBy("a", "b", "from", "to").agg(F.min("bound").alias("bound"))
                    .join(tested, ["a", "b"], "left_anti"))
            if most:
                best_first = Window.partitionBy("from", "to").orderBy(F.desc("bound"), "a", "b")
                more = more.withColumn("nth", F.row_number().over(best_first)).filter(F.col("nth") <= most)
            more = scratch.save(_verify(scratch.save(more.select("a", "b"), "members"), sets).distinct(), "inside")
            tested = tested.unionByName(more.select("a", "b"))
            comps = merged(scratch, comps, more.filter(is_link).select("a", "b"))
    scratch.drop(listed, blocks, nodes, sketches, stars, seen, led, pairs, between)
    return ids, comps


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable
    by links, itself included).

    Null, empty and blank texts have no shingle and link with nothing: their
    component is their own id. Equal sets (repeated rows, copies) are always
    linked. A null id is no component's smallest unless all its ids are
    null. Extra columns are ignored; an empty table gives an empty result."""
    scratch = Scratch(docs.sparkSession)
    with batches_of(docs.sparkSession, BATCH):
        ids, comps = set_components(docs, id_col, text_col)
    sets = ids.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    sets = sets.join(comps, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    sets = scratch.save(sets, "members")
    least = sets.groupBy("component").agg(F.min("first").alias("component_id"))
    owners = scratch.save(sets.join(least, "component").select("set_id", "component_id", "rows"), "owners")
    full = join_owners(ids.filter(F.col("set_id").isNotNull()), owners, "set_id", "rows")
    return full.select("doc_id", "n_shingles", "component_id").unionByName(
        ids.filter(F.col("set_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
