"""Exact ranks over a total order without a single-task window.

Rows are placed in *buckets* by an expression that is monotone in the order
(a hex prefix of an md5 key, an id bin, a file split). Bucket counts form a
small table; a window over that table gives each bucket its offset. A row's
rank is its bucket's offset plus its position inside the bucket.

``cut_by_rank`` goes one step further for samples and splits: a bucket that
lies wholly between two cut-offs is labelled from its offsets alone, so only
the few buckets that straddle a cut-off are sorted at all.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 42
KEY_COL = "_rk_key"


def hash_key(id_col: Column | str, seed: int | str = DEFAULT_SEED) -> Column:
    """Seeded pseudo-random order key: ``md5('<seed>|<id>')`` (lowercase
    hex). Reproducible in any engine with md5."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def hex_bucket(key: Column | str, digits: int | Column = 4) -> Column:
    """Bucket = leading hex digits of the md5 key (monotone in the key).
    ``digits`` may be a column that is constant within a group."""
    c = F.col(key) if isinstance(key, str) else key
    return F.substring(c, 1, digits)


MAX_DIGITS = 8


# A bucket table has at most one row for this many rows (or one per group).
ROWS_PER_BUCKET = 1000


def hex_digits(n_rows: int) -> int:
    """Most md5 hex digits whose buckets still hold ``ROWS_PER_BUCKET`` rows
    on average (md5 prefixes are uniform): a bucket holds about 1,000 to
    16,000 rows, and a small table is one bucket."""
    d = 0
    while d < MAX_DIGITS and n_rows >= ROWS_PER_BUCKET * 16 ** (d + 1):
        d += 1
    return d


def hex_digits_col(n_rows: Column) -> Column:
    """``hex_digits`` per group, as a column over a per-group counts table."""
    out = F.lit(0)
    for d in range(1, MAX_DIGITS + 1):
        out = F.when(n_rows >= F.lit(ROWS_PER_BUCKET * 16 ** d), F.lit(d)).otherwise(out)
    return out


# Row bound for broadcasting a per-group / per-bucket table (a few tens of
# bytes per row: well under the broadcast memory limit).
BROADCAST_MAX_ROWS = 2_000_000


def broadcast_checked(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only after checking its size: it is written once
    to the shared checkpoint folder and counted from the written files;
    within ``max_rows`` it is broadcast, beyond that it stays a normal join
    input (sort-merge, with AQE's skew-join splitting hot keys on the other
    side)."""
    from repforge.session import materialize
    small = materialize(small, "broadcast-side")
    return F.broadcast(small) if small.count() <= max_rows else small


def _cols(xs: Sequence[str]) -> list[Column]:
    return [F.col(x) for x in xs]


def bucket_offsets(df: DataFrame, bucket_cols: Sequence[str],
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, bucket) -> n, start (rows before this bucket in its group).

    The input is one row per bucket (partial aggregation before the
    shuffle); the window runs on that small table only.
    """
    counts = df.groupBy(*group_cols, *bucket_cols).agg(F.count(F.lit(1)).alias("_rk_n"))
    w = (Window.partitionBy(*group_cols).orderBy(*_cols(bucket_cols))
         .rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_rk_start", F.coalesce(F.sum("_rk_n").over(w), F.lit(0)).cast("bigint"))


def global_rank(df: DataFrame, order_cols: Sequence[str], bucket_cols: Sequence[str],
                rank_col: str = "rank", group_cols: Sequence[str] = ()) -> DataFrame:
    """1-based dense rank of every row in ``order_cols`` order (within
    ``group_cols``). ``order_cols`` must be unique per group; ``bucket_cols``
    must be monotone in ``order_cols``. Work is spread over buckets."""
    offsets = bucket_offsets(df, bucket_cols, group_cols).select(
        *group_cols, *bucket_cols, "_rk_start")
    keys = [*group_cols, *bucket_cols]
    w = Window.partitionBy(*keys).orderBy(*_cols(order_cols))
    return (_beside(df, offsets, keys)
              .withColumn(rank_col, F.col("_rk_start") + F.row_number().over(w))
              .drop("_rk_start"))


def _beside(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of its bucket; a null bucket is one, too."""
    renamed = small.select(*[F.col(k).alias(f"_rk_key{i}") if k in keys else F.col(k)
                             for i, k in enumerate(small.columns)])
    names = {k: f"_rk_key{i}" for i, k in enumerate(small.columns)}
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(names[k])) for k in keys], F.lit(True))
    return df.join(renamed, same, "inner").drop(*names.values())


def ordered_ranks(df: DataFrame, order_cols: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """1-based rank of every row in ``order_cols`` order (nulls first, ties
    in any order) without a window: rows are dealt out by range, sorted and
    written with their place in their part; the parts' sizes, one number for
    each, give what comes before."""
    from repforge.session import materialize
    dealt = materialize(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                        .withColumn("_m", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_m", 33).cast("int")
    before, starts = 0, []
    for r in sorted(dealt.groupBy(part.alias("part")).count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    table = df.sparkSession.createDataFrame(starts, "_part int, _before bigint")
    place = F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (dealt.withColumn("_part", part).join(F.broadcast(table), "_part")  # a row for each part
            .withColumn(rank_col, place).drop("_part", "_before", "_m"))


def _count_exceeded(value: Column, cutoffs: Sequence[Column]) -> Column:
    """How many cut-offs ``value`` is strictly above."""
    return reduce(lambda a, b: a + b,
                  [F.when(value > c, 1).otherwise(0) for c in cutoffs], F.lit(0))


# Bucket tables up to this many rows are broadcast without a check.
SMALL_BUCKET_TABLE = 1 << 16


def cut_by_rank(df: DataFrame, order_cols: Sequence[str], bucket_cols: Sequence[str],
                cutoffs: Sequence[int | str], label_col: str = "part",
                group_cols: Sequence[str] = (), max_buckets: int | None = None) -> DataFrame:
    """Label each row with the number of cut-offs its rank exceeds.

    ``cutoffs`` are ascending rank bounds: ints, or names of columns that are
    constant within a group (per-group quotas). With cut-offs ``[a, b]`` ranks
    1..a get 0, a+1..b get 1, the rest 2. Only buckets straddling a cut-off
    are ranked with a window; all others are labelled from bucket offsets.
    ``max_buckets`` is a bound on the bucket table known by construction
    (e.g. ``16**digits``); without a small one the table is counted before
    it is broadcast.
    """
    cut_names = [c for c in cutoffs if isinstance(c, str)]
    cut_cols = [F.col(c) if isinstance(c, str) else F.lit(int(c)) for c in cutoffs]
    counts = df.groupBy(*group_cols, *cut_names, *bucket_cols).agg(
        F.count(F.lit(1)).alias("_rk_n"))
    w_off = (Window.partitionBy(*group_cols).orderBy(*_cols(bucket_cols))
             .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum("_rk_n").over(w_off), F.lit(0)).cast("bigint")
    offsets = counts.withColumn("_rk_start", start)
    end = F.col("_rk_start") + F.col("_rk_n")
    straddles = reduce(lambda a, b: a | b,
                       [(F.col("_rk_start") < c) & (c < end) for c in cut_cols], F.lit(False))
    offsets = offsets.select(
        *group_cols, *bucket_cols, "_rk_start",
        straddles.alias("_rk_split"),
        # rank >= start + 1 for every row, so "start >= c" means all exceed c
        _count_exceeded(F.col("_rk_start") + 1, cut_cols).alias("_rk_label"))
    keys = [*group_cols, *bucket_cols]
    # A bucket table bounded by construction is broadcast directly; any
    # other (per group, or many buckets) is counted before it is broadcast.
    small = not group_cols and max_buckets is not None and max_buckets <= SMALL_BUCKET_TABLE
    offsets = F.broadcast(offsets) if small else broadcast_checked(offsets)
    joined = _beside(df, offsets, keys)
    whole = (joined.where(~F.col("_rk_split"))
                   .withColumn(label_col, F.col("_rk_label")))
    w = Window.partitionBy(*keys).orderBy(*_cols(order_cols))
    split = (joined.where(F.col("_rk_split"))
                   .withColumn("_rk_rank", F.col("_rk_start") + F.row_number().over(w))
                   .withColumn(label_col, _count_exceeded(F.col("_rk_rank"), cut_cols))
                   .drop("_rk_rank"))
    return whole.unionByName(split).drop("_rk_start", "_rk_split", "_rk_label")


def with_hash_order(df: DataFrame, id_col: str, seed: int | str = DEFAULT_SEED,
                    digits: int | Column = 4) -> DataFrame:
    """Add the md5 order key and its hex bucket."""
    return (df.withColumn(KEY_COL, hash_key(id_col, seed))
              .withColumn("_rk_bucket", hex_bucket(KEY_COL, digits)))


def id_width(lo: Column, hi: Column, n_rows: Column) -> Column:
    """Ids per bin so that ids spread over [lo, hi] fall about
    ``ROWS_PER_BUCKET`` to a bin: the bins follow the rows, not the range."""
    bins = F.greatest(F.floor(n_rows / ROWS_PER_BUCKET), F.lit(1))
    return F.greatest(F.ceil((hi - lo + 1) / bins), F.lit(1)).cast("bigint")


def id_bins(df: DataFrame, id_col: str) -> Column:
    """Monotone bucket of an id: at most one linear bin between the smallest
    and largest id for ``ROWS_PER_BUCKET`` rows. Needs one small aggregate
    (three numbers) on the driver."""
    lo, hi, n = df.agg(F.min(id_col), F.max(id_col), F.count(id_col)).first()
    if lo is None:
        return F.lit(0).cast("bigint")
    width = max(1, -(-(int(hi) - int(lo) + 1) // max(1, n // ROWS_PER_BUCKET)))
    return F.expr(f"({id_col} - {int(lo)}L) div {width}L")
