"""Near-duplicate removal as a Spark job (linear-time k-mer clustering).

Our stated definition (not bit-equality with any external tool):

1. exact duplicates collapse to the smallest id;
2. each unique sequence is sketched by its ``m`` distinct k-mers with the
   smallest key, each with its first position: the k-mer packed 5 bits per
   residue, mixed with fmix64, top 63 bits as a BIGINT;
3. per k-mer the longest sequence (smallest id on ties) is the centre and
   every other sequence with that k-mer becomes a candidate pair
   (centre, member) on the diagonal that the k-mer's two positions give: one
   candidate per (k-mer, member), never all pairs;
4. a candidate aligns the member with the centre on its diagonal without
   gaps. ``aligned`` counts the member's residues that lie opposite the
   centre, ``matches`` the equal ones. It is verified if the alignment covers
   at least ``coverage`` of the member (the target, the shorter one) and at
   least ``similarity`` of the aligned residues match; of several diagonals
   the one with most matches counts. With a ``band`` a covered candidate that
   fails is aligned again with gaps, at most ``band`` places off its diagonal:
   then ``aligned`` counts columns, gaps among them;
5. greedy cover in priority order (length desc, id asc): a sequence joins the
   best representative among its verified higher-priority neighbours, else
   it becomes a representative. A round settles every local maximum and its
   neighbours and drops their edges; the result equals the sequential greedy.

The sketch is dealt out by k-mer once; a hash ``max`` of a packed priority
and a join against one row per k-mer read that one shuffle. Hot k-mers
(conserved framework regions) are not dealt to one task: their centres come
from a partial aggregation and are put beside the rows by broadcast. No window
over a k-mer is used.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repforge.operators.align import apart, banded, codes_of, equal_codes
from repforge.operators.masking import GOLDEN, fmix64
from repforge.operators.ranks import broadcast_checked
from repforge.session import ensure_checkpoint_dir, materialize, ship_package

K = 10
M = 20
SIMILARITY = 0.9
COVERAGE = 0.9
#: Residues of k-mers that one numpy pass holds in a task.
SLICE_RESIDUES = 2_000_000


def exact_duplicates(seqs: DataFrame, id_col: str = "Sequence_ID",
                     seq_col: str = "sequence") -> DataFrame:
    """One row per distinct sequence: ``rep_id`` (smallest id), copies, length."""
    return (seqs.groupBy(seq_col)
                .agg(F.min(id_col).alias("rep_id"), F.count(F.lit(1)).alias("n_copies"))
                .select("rep_id", F.col(seq_col).alias("sequence"),
                        F.length(seq_col).alias("len"), "n_copies"))


# Residue alphabet for k-mer packing (5 bits per residue;
# any other byte packs as 31).
ALPHABET = "ACDEFGHIKLMNPQRSTVWY"
OTHER = 31
_CODE = np.full(256, OTHER, dtype=np.uint64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i


def kmer_keys(data: np.ndarray, lengths: np.ndarray, k: int = K, seed: int = 42):
    """(row, key, position) of every k-mer of every row: the k-mer packed
    into 5*k bits (exact), mixed with fmix64 and shifted to 63 bits (a BIGINT)."""
    n_win = np.maximum(lengths - k + 1, 0)
    row = np.repeat(np.arange(lengths.size), n_win)
    first = np.repeat(np.cumsum(lengths) - lengths, n_win)
    local = np.arange(row.size, dtype=np.int64) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    codes = _CODE[data]
    # windows at every place of the buffer, by doubling; those that cross a
    # row's end are never looked up
    packed, size = codes, 1
    for bit in bin(k)[3:] if len(codes) >= k else "":
        packed, size = (packed[:-size] << np.uint64(5 * size)) | packed[size:], 2 * size
        if bit == "1":
            packed, size = (packed[:-1] << np.uint64(5)) | codes[size:], size + 1
    packed = packed[first + local]
    with np.errstate(over="ignore"):
        h = fmix64(packed ^ np.uint64((seed * GOLDEN) % 2 ** 64)) >> np.uint64(1)
    return row, h.astype(np.int64), local


def smallest_per_row(row: np.ndarray, key: np.ndarray, place: np.ndarray, m: int):
    """The ``m`` smallest distinct keys of each row, each with its first
    position (vectorised). ``row`` and each row's ``place`` ascend. Keys are
    uniform in 63 bits, so of a long row only those below a bound that leaves
    more than twice ``m`` are sorted; a row left with too few is sorted whole."""
    if not row.size:
        return row, key, place
    share = (2 * m + 24) / np.maximum(np.bincount(row), 1)
    bound = np.where(share < 1, np.minimum(share, 0.9) * 2.0 ** 63, 2.0 ** 62).astype(np.int64)
    low = (key < bound[row]) | (share >= 1)[row]
    found = _sorted_smallest(row[low], key[low], place[low], m)
    short = (share < 1) & (np.bincount(found[0], minlength=share.size) < m)
    if not short.any():
        return found
    again, kept = short[row], ~short[found[0]]
    whole = _sorted_smallest(row[again], key[again], place[again], m)
    r, kk, pp = (np.concatenate([f[kept], w]) for f, w in zip(found, whole))
    order = np.argsort(r, kind="stable")
    return r[order], kk[order], pp[order]


def _sorted_smallest(row: np.ndarray, key: np.ndarray, place: np.ndarray, m: int):
    order = np.lexsort((key, row))  # stable: of equal keys the first place comes first
    r, kk, pp = row[order], key[order], place[order]
    new = np.ones(r.size, dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (kk[1:] != kk[:-1])
    r, kk, pp = r[new], kk[new], pp[new]
    row_start = np.ones(r.size, dtype=bool)
    row_start[1:] = r[1:] != r[:-1]
    idx = np.arange(r.size)
    first_of_row = np.maximum.accumulate(np.where(row_start, idx, 0))
    keep = (idx - first_of_row) < m
    return r[keep], kk[keep], pp[keep]


def byte_slices(lengths: np.ndarray, limit: int = SLICE_RESIDUES):
    """Bounds of runs of rows that hold about ``limit`` bytes each."""
    bucket = (np.cumsum(lengths) - lengths) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(lengths)]])
    return zip(cuts[:-1], cuts[1:])


def kmer_sketch(unique: DataFrame, k: int = K, m: int = M, seed: int = 42) -> DataFrame:
    """(id, len, kmer, place): the ``m`` smallest k-mer keys of each unique
    sequence; sequences shorter than ``k`` have none. Runs on Arrow batches,
    cut by bytes, with numpy inside the tasks (no shuffle)."""
    src = unique.where(F.col("len") >= k).select(F.col("rep_id").alias("id"), "len", "sequence")

    def run(batches):
        for b in batches:
            seqs = b.column(2)
            bufs = seqs.buffers()
            width = np.int64 if pa.types.is_large_string(seqs.type) else np.int32
            if not len(seqs):
                continue
            offs = np.frombuffer(bufs[1], dtype=width)[seqs.offset:seqs.offset + len(seqs) + 1].astype(np.int64)
            whole = np.frombuffer(bufs[2], dtype=np.uint8)
            ids = b.column(0).to_numpy(zero_copy_only=False)
            lens = b.column(1).to_numpy(zero_copy_only=False)
            for low, high in byte_slices(np.diff(offs)):
                row, key, place = kmer_keys(whole[offs[low]:offs[high]], np.diff(offs[low:high + 1]), k, seed)
                row, key, place = smallest_per_row(row, key, place, m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[low + row], pa.int64()), pa.array(lens[low + row], pa.int32()),
                     pa.array(key, pa.int64()), pa.array(place, pa.int64())], names=["id", "len", "kmer", "place"])

    ship_package(src.sparkSession)
    # no row has a null: said here, so that no reader of the sketch adds its own filter and shuffle
    return src.mapInArrow(run, "id bigint, len int, kmer bigint, place bigint").where(
        "len is not null and kmer is not null and place is not null")


# Priority = length * 10^19 + (10^19 - 1 - id) as DECIMAL(38,0): covers
# every non-negative BIGINT id, and a decimal aggregation buffer is updated
# in place, so ``max`` stays a hash aggregation (no sort).
ID_SPAN = 10 ** 19
PRIORITY_TYPE = "decimal(38,0)"


def _span():
    return F.lit(Decimal(ID_SPAN)).cast(PRIORITY_TYPE)


def priority_key(len_col: str = "len", id_col: str = "id"):
    """(length desc, id asc) packed in one DECIMAL(38,0) so that a plain
    ``max`` (hash aggregation, no sort) picks the highest priority. A
    negative id stops the job rather than mis-ordering."""
    span = _span()
    idc = F.col(id_col).cast(PRIORITY_TYPE)
    key = (F.col(len_col).cast(PRIORITY_TYPE) * span + (span - F.lit(1) - idc)).cast(PRIORITY_TYPE)
    return F.when(F.col(id_col) >= 0, key).otherwise(
        F.raise_error(F.lit("negative sequence id")).cast(PRIORITY_TYPE))


def centre_of(key):
    """The id packed in a priority key."""
    span = _span()
    return (span - F.lit(1) - F.pmod(key, span)).cast("bigint")


def length_of(key):
    """The length packed in a priority key."""
    # remove the id part first: the division is then exact (decimal division
    # keeps only a few fractional digits and would round 49.99.. up to 50)
    return ((key - F.pmod(key, _span())) / _span()).cast("int")


# A centre's position rides below its priority: priority * 10^9 + position
# (sequences of fewer than 10^9 residues, checked).
PLACE_SPAN = 10 ** 9
#: A k-mer that more than HOT of every SAMPLED-th sequence share is not dealt
#: to one task.
SAMPLED, HOT = 64, 1000


def _hot_kmers(sketch: DataFrame) -> DataFrame | None:
    """(kmer) of the k-mers that very many sequences share, estimated on a
    part of the ids: it decides how rows are dealt out, never which."""
    part = sketch.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0)
    hot = materialize(part.groupBy("kmer").count().where(F.col("count") > HOT).select("kmer"), "hot-kmers")
    return None if hot.isEmpty() else hot


def kmer_candidates(sketch: DataFrame) -> DataFrame:
    """(centre, member, c_len, m_len, diagonal), one per shared k-mer centre;
    linear in the sketch size. The centre is the longest sequence of the
    k-mer; ``diagonal`` is the member's first residue counted in the centre.
    The sketch is dealt out by k-mer once, for centres and members; rows of
    hot k-mers stay where they are and meet their few centres by broadcast."""
    sketch = sketch.where(F.col("kmer").isNotNull())  # on both sides of the join, which then read one shuffle
    hot = _hot_kmers(sketch)
    if hot is None:
        dealt = sketch.repartition("kmer")
        return _meet(dealt, _centres(dealt)).distinct()
    hot = broadcast_checked(hot)
    dealt = sketch.join(hot, "kmer", "left_anti").repartition("kmer")
    shared = sketch.join(hot, "kmer", "left_semi")
    return (_meet(dealt, _centres(dealt))
            .unionByName(_meet(shared, broadcast_checked(_centres(shared)))).distinct())


def _centres(sketch: DataFrame) -> DataFrame:
    """(kmer, c_place, centre, c_len): the longest sequence of each k-mer."""
    span = F.lit(Decimal(PLACE_SPAN)).cast(PRIORITY_TYPE)
    packed = (priority_key() * span).cast(PRIORITY_TYPE) + F.col("place").cast(PRIORITY_TYPE)
    packed = F.when(F.col("len") < PLACE_SPAN, packed.cast(PRIORITY_TYPE)).otherwise(
        F.raise_error(F.lit("sequence too long")).cast(PRIORITY_TYPE))
    top = (sketch.groupBy("kmer").agg(F.max(packed).alias("_p"), F.count(F.lit(1)).alias("_n"))
           .where("_n > 1"))  # a k-mer of one sequence has no member
    place = F.pmod(F.col("_p"), span)
    top = top.select("kmer", place.cast("bigint").alias("c_place"),
                     ((F.col("_p") - place) / span).cast(PRIORITY_TYPE).alias("_k"))
    return top.select("kmer", "c_place", centre_of(F.col("_k")).alias("centre"),
                      length_of(F.col("_k")).alias("c_len"))


def _meet(sketch: DataFrame, centres: DataFrame) -> DataFrame:
    return (sketch.join(centres, "kmer", "inner")
                  .where(~F.col("id").eqNullSafe(F.col("centre")))  # adds no filter of its own to the rows
                  .select("centre", F.col("id").alias("member"), "c_len", F.col("len").alias("m_len"),
                          (F.col("c_place") - F.col("place")).alias("diagonal")))


#: Members that meet one copy of their centre's text.
RUN = 4096


def _beside_centres(batches):
    """Rows sorted by (centre, run), the centre's text first, then its
    members': (members, codes, centre's place in codes, its size, member's
    place) of each batch. One text of the batch before is carried over; no
    pair is handled alone."""
    carried = np.empty(0, np.uint8)
    for b in batches:
        if not b.num_rows:
            continue
        codes, offsets = codes_of(b["text"])
        codes = np.concatenate([carried, codes])
        begin, length = offsets[:-1] + len(carried), np.diff(offsets)
        is_centre = b["member"].is_null().to_numpy(zero_copy_only=False)
        held = np.maximum.accumulate(np.where(is_centre, np.arange(b.num_rows), -1))
        c_begin = np.where(held >= 0, begin[held], 0)
        c_size = np.where(held >= 0, length[held], len(carried))
        rows = np.flatnonzero(~is_centre)
        if len(rows):
            yield b.take(pa.array(rows)), codes, c_begin[rows], c_size[rows], begin[rows]
        carried = codes[c_begin[-1]: c_begin[-1] + c_size[-1]].copy()


def _compare(similarity: float, band: int):
    """(centre, member, c_len, m_len, aligned, matches) of members."""
    limit = Fraction(str(similarity))

    def run(batches):
        for members, codes, c_at, c_size, m_at in _beside_centres(batches):
            diagonal = members["diagonal"].to_numpy()
            aligned = members["aligned"].to_numpy()
            m_from, c_from = np.maximum(-diagonal, 0), np.maximum(diagonal, 0)
            matches = equal_codes(codes, c_at + c_from, m_at + m_from, aligned)
            if band:
                failed = np.flatnonzero(matches * limit.denominator < limit.numerator * aligned)
                least = apart(codes, c_at[failed] + c_from[failed], (m_at + m_from)[failed], aligned[failed], band)
                failed = failed[_allowed(least, aligned[failed], limit, band)]
                aligned = aligned.copy()
                aligned[failed], matches[failed] = banded(
                    codes, c_at[failed], c_size[failed], c_from[failed], (m_at + m_from)[failed],
                    aligned[failed], band)
            yield pa.RecordBatch.from_arrays(
                [*(members[c] for c in ("centre", "member", "c_len", "m_len")), pa.array(aligned, pa.int64()),
                 pa.array(matches, pa.int64())],
                names=["centre", "member", "c_len", "m_len", "aligned", "matches"])
    return run


def _allowed(unlike: np.ndarray, aligned: np.ndarray, limit: Fraction, band: int) -> np.ndarray:
    """May an alignment of ``aligned`` residues with so many unlike columns
    or more still pass? With gaps there are at most ``aligned`` + unlike
    columns, without gaps ``aligned``."""
    return unlike * (limit.numerator if band else limit.denominator) <= (limit.denominator - limit.numerator) * aligned


#: A window's residues beyond its share of the member.
WINDOW = 16


def _window_share(similarity: float, band: int) -> Fraction:
    """Share of a member whose residues, unlike the centre's as unrelated
    texts are, rule a pair out: nine of ten residues differ there, and of
    pairs of neighbours nine of ten lie nowhere in the band."""
    limit = Fraction(str(similarity))
    share = (1 - limit) * Fraction(13, 10) if not band else (1 - limit) / max(limit, Fraction(1, 100)) * Fraction(27, 10)
    return Fraction(min(int(share * 1000), 1000), 1000)


def _windows(unique: DataFrame, share: Fraction) -> DataFrame:
    """Texts cut to the window in their middle."""
    size = F.expr(f"least(len, len * {share.numerator} div {share.denominator} + {WINDOW})").cast("int")
    return unique.select("rep_id", F.substring(F.col("sequence"), F.expr("1") + F.floor((F.col("len") - size) / 2).cast("int"),
                                               size).alias("sequence"))


def _within(similarity: float, band: int, share: Fraction):
    """Members' windows beside their centres' texts: the candidates whose
    unlike columns in the window alone do not rule them out."""
    limit = Fraction(str(similarity))

    def run(batches):
        for members, codes, c_at, _, m_at in _beside_centres(batches):
            diagonal, aligned, size = (members[c].to_numpy().astype(np.int64) for c in ("diagonal", "aligned", "m_len"))
            window = np.minimum(size, size * share.numerator // share.denominator + WINDOW)
            start = (size - window) // 2
            m_from = np.maximum(-diagonal, 0)
            low, high = np.maximum(start, m_from), np.minimum(start + window, m_from + aligned)
            seen = np.maximum(high - low, 0)
            low = np.minimum(low, high)
            a, b = c_at + low + diagonal, m_at + low - start
            a, b = np.where(seen > 0, a, 0), np.where(seen > 0, b, 0)
            unlike = apart(codes, a, b, seen, band) if band else seen - equal_codes(codes, a, b, seen)
            kept = members.filter(pa.array(_allowed(unlike, aligned, limit, band)))
            yield pa.RecordBatch.from_arrays([kept[c] for c in PAIR], names=PAIR)
    return run


PAIR = ["centre", "member", "c_len", "m_len", "diagonal", "aligned"]


def _centre_runs(covered: DataFrame, unique: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """Members beside one copy of their centre's text for each run of about
    RUN of them: a centre of a million members is many runs, and no text
    travels once for each pair. ``own`` has the members' texts where they
    are not the centres' (windows)."""
    sizes = covered.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("int").alias("runs"))
    hot = sizes.where("runs > 1").withColumnRenamed("centre", "_c")  # at most rows / RUN
    run = F.coalesce(F.pmod(F.xxhash64("member"), F.col("runs")), F.lit(0)).cast("int")
    text_of = lambda df: df.select(F.col("rep_id").alias("_t"), F.col("sequence").alias("text"))
    members = (covered.join(broadcast_checked(hot), F.col("centre") == F.col("_c"), "left")
               .withColumn("run", run).drop("_c", "runs")
               .join(text_of(unique if own is None else own), F.col("member") == F.col("_t")).drop("_t"))
    copies = (sizes.join(text_of(unique), F.col("centre") == F.col("_t"))
              .select("centre", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), "text"))
    rows = members.unionByName(copies, allowMissingColumns=True)
    return rows.repartition("centre", "run").sortWithinPartitions("centre", "run", F.col("member").asc_nulls_first())


def fraction(x: float) -> Column:
    """A threshold as written (0.905 stays 0.905, no binary rounding)."""
    return F.lit(Decimal(str(x)))


def verified_pairs(candidates: DataFrame, unique: DataFrame, similarity: float = SIMILARITY,
                   coverage: float = COVERAGE, band: int = 0) -> DataFrame:
    """(centre, member, c_len, m_len, aligned, matches) of the candidates
    that pass coverage and similarity, one row per pair. Coverage needs only
    lengths and the diagonal, so it is checked before any sequence is joined;
    then a window of each member is held against its centre, and only the
    pairs that it does not rule out are joined with whole texts."""
    low = F.greatest(-F.col("diagonal"), F.lit(0))
    high = F.least(F.col("m_len").cast("bigint"), F.col("c_len") - F.col("diagonal"))
    covered = materialize(candidates.withColumn("aligned", high - low)
                          .where(F.col("aligned") >= fraction(coverage) * F.col("m_len")), "covered")
    ship_package(unique.sparkSession)
    share = _window_share(similarity, band)
    near = materialize(_centre_runs(covered, unique, _windows(unique, share)).mapInArrow(
        _within(similarity, band, share), "centre bigint, member bigint, c_len int, m_len int, diagonal bigint, "
        "aligned bigint"), "near")
    ends = near.select(F.explode(F.array("centre", "member")).alias("rep_id")).distinct()
    counted = _centre_runs(near, unique.join(broadcast_checked(ends), "rep_id", "left_semi")).mapInArrow(
        _compare(similarity, band),
        "centre bigint, member bigint, c_len int, m_len int, aligned bigint, matches bigint")
    passed = counted.where(F.col("matches") >= fraction(similarity) * F.col("aligned"))
    # of several diagonals the one with most matches, then the shorter one:
    # matches * 2^31 - aligned packs both for a hash aggregation
    span = F.lit(1 << 31)
    best = passed.groupBy("centre", "member", "c_len", "m_len").agg(
        F.max(F.col("matches") * span - F.col("aligned")).alias("_b"))
    matches = F.expr(f"(_b + {(1 << 31) - 1}) div {1 << 31}")
    return best.select("centre", "member", "c_len", "m_len",
                       (matches * span - F.col("_b")).alias("aligned"), matches.alias("matches"))


#: Edges that are settled in one task, at the end of the rounds.
FINISH_EDGES = 200_000


def _settle(batches):
    """Members among the nodes of a few edges, in order of the edges; a node
    that no order reaches is given as not settled."""
    into: dict[int, int] = {}
    out: dict[int, list[int]] = {}
    for b in batches:
        for src, dst in zip(b["src"].to_pylist(), b["dst"].to_pylist()):
            into[dst] = into.get(dst, 0) + 1
            out.setdefault(src, []).append(dst)
    ready, members = [n for n in out if n not in into], set()
    while ready:
        node = ready.pop()
        for dst in out.get(node, ()):
            if node not in members:
                members.add(dst)
            into[dst] -= 1
            if not into[dst]:
                ready.append(dst)
    stuck = [n for n, left in into.items() if left]
    yield pa.RecordBatch.from_arrays([pa.array([*members, *stuck], pa.int64()),
                                      pa.array([True] * len(members) + [False] * len(stuck))], names=["id", "settled"])


def greedy_members(edges: DataFrame) -> DataFrame | None:
    """(id) of the sequences that a representative covers; every other one of
    the edges represents itself. None if there is no edge. A round takes the
    nodes without an edge from above, all local maxima at once: they are
    representatives, what they point at is covered, and every edge of either
    leaves the table, which is written anew each round and only shrinks. A
    round without a local maximum (edges that do not descend in priority)
    raises. The last FINISH_EDGES edges are settled in one task."""
    live = materialize(edges.select(F.col("centre").alias("src"), F.col("member").alias("dst")).distinct(),
                       "cover-edges")
    left = live.count()
    if not left:
        return None
    found = []
    while left > FINISH_EDGES:
        heads = live.select(F.col("src").alias("id")).distinct().join(
            live.select(F.col("dst").alias("id")), "id", "left_anti")
        covered = materialize(live.join(heads, F.col("src") == F.col("id"), "left_semi")
                              .select(F.col("dst").alias("id")).distinct(), "cover-members")
        if covered.isEmpty():
            raise RuntimeError("a greedy round decided nothing: an edge does not descend in priority")
        found.append(covered)
        live = materialize(live.join(covered, F.col("dst") == F.col("id"), "left_anti")
                           .join(covered, F.col("src") == F.col("id"), "left_anti"), "cover-edges")
        left = live.count()
    ship_package(edges.sparkSession)
    last = materialize(live.coalesce(1).mapInArrow(_settle, "id bigint, settled boolean"), "cover-members")
    if not last.where("not settled").isEmpty():
        raise RuntimeError("a greedy round decided nothing: an edge does not descend in priority")
    return reduce(DataFrame.unionByName, [*found, last.select("id")])


def greedy_decided(unique: DataFrame, edges: DataFrame) -> DataFrame | None:
    """(id, rep) of every covered sequence: the representative of highest
    priority among its verified neighbours. None if there is no pair."""
    ensure_checkpoint_dir(unique.sparkSession)
    members = greedy_members(edges)
    if members is None:
        return None
    e = edges.select(F.col("centre").alias("src"), F.col("member").alias("dst"))
    up = (e.join(members, F.col("dst") == F.col("id"), "left_semi")
          .join(members, F.col("src") == F.col("id"), "left_anti"))
    lengths = unique.select(F.col("rep_id").alias("_s"), "len")
    best = (up.join(lengths, F.col("src") == F.col("_s")).groupBy("dst")
            .agg(F.max(priority_key("len", "src")).alias("_k")))
    return best.select(F.col("dst").alias("id"), centre_of(F.col("_k")).alias("rep"))


def greedy_cover(unique: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, rep) for every unique sequence (``greedy_decided`` for the
    covered ones, the rest represent themselves)."""
    everyone = unique.select(F.col("rep_id").alias("id"))
    decided = greedy_decided(unique, edges)
    if decided is None:
        return everyone.select("id", F.col("id").alias("rep"))
    return everyone.join(decided, "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))


def cluster(seqs: DataFrame, id_col: str = "Sequence_ID", seq_col: str = "sequence",
            k: int = K, m: int = M, similarity: float = SIMILARITY,
            coverage: float = COVERAGE, band: int = 0) -> DataFrame:
    """(Sequence_ID, rep_id) for every input row."""
    ensure_checkpoint_dir(seqs.sparkSession)
    unique = materialize(exact_duplicates(seqs, id_col, seq_col), "unique-sequences")
    edges = materialize(verified_pairs(kmer_candidates(kmer_sketch(unique, k, m)), unique, similarity, coverage, band), "verified")
    decided = greedy_decided(unique, edges)
    # every copy of a distinct sequence follows its exact-duplicate rep; the
    # sequence's sha256 stands for it in the join
    digest = lambda c: F.unhex(F.sha2(F.col(c), 256)).alias("digest")
    assigned = seqs.select(F.col(id_col).alias("Sequence_ID"), digest(seq_col)).join(
        unique.select(F.col("rep_id").alias("id"), digest("sequence")), "digest")
    if decided is None:
        return assigned.select("Sequence_ID", F.col("id").alias("rep_id"))
    # only members of a greedy cluster change: join that table alone instead
    # of one row per unique sequence
    return (assigned.join(decided, "id", "left")
                    .select("Sequence_ID", F.coalesce("rep", "id").alias("rep_id")))


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("rep_id").agg(F.count(F.lit(1)).alias("size"))


def representative_ids(assignments: DataFrame) -> DataFrame:
    """(rep_id): a representative is the row that represents itself, so a
    filter finds them (no shuffle)."""
    return assignments.where(F.col("Sequence_ID") == F.col("rep_id")).select("rep_id")


def representatives(seqs: DataFrame, assignments: DataFrame, id_col: str = "Sequence_ID") -> DataFrame:
    """Rows whose id is a representative (semi-join; shuffle join at scale)."""
    return seqs.join(representative_ids(assignments).select(F.col("rep_id").alias(id_col)), id_col, "left_semi")
