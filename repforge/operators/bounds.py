"""Selection by exact bounds: which rows are among the first ``n`` of an order.

An order is a *place*, a number that a row's key gives (60 bits of a seeded
md5, or an id); rows without an id come last. The place of the n-th row is
found by counting rows in bins that get narrower, and then a row needs no
rank: it is in if its place is at most that bound. Rows are neither sorted
nor joined with a table of buckets, and counting reads the key column alone.

Rows that share the bound's place (repeated or missing ids) are told apart by
a hash of the whole row, again by a bound; only rows that are alike in every
column are numbered.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from repforge.operators.ranks import DEFAULT_SEED, broadcast_checked, hash_key
from repforge.session import materialize

#: Places of hash orders lie in [0, 2^HASH_BITS).
HASH_BITS = 60
#: Rows without a key come after all others.
LAST = (1 << 63) - 1
#: Bins of the first count over a whole hashed table (a power of 2), of the
#: later ones, and of one count for each group.
FIRST_BITS, BINS, GROUP_BINS = 12, 1 << 16, 1 << 10
#: Places that are listed one by one, over a whole table and for each group.
LISTED, GROUP_LISTED = 1 << 16, 1 << 12
_MANTISSA = 10
P = "_place"


def hash_place(id_col: str, seed: int | str = DEFAULT_SEED) -> Column:
    """Place in the seeded md5 order of an id; null ids last."""
    return F.coalesce(F.conv(F.substring(hash_key(id_col, seed), 1, HASH_BITS // 4), 16, 10).cast("bigint"),
                      F.lit(LAST))


def id_place(id_col: str) -> Column:
    """Place in id order; null ids last."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST))


def row_place(df: DataFrame) -> Column:
    """Place by a hash of every column (maps aside)."""
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - HASH_BITS)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _float_bin(p: Column) -> Column:
    """Bins as narrow as their distance from 0 allows, monotone in ``p``: for
    orders whose range is not known. 2^10 bins for each doubling."""
    size = F.when(p < 0, F.bitwise_not(p)).otherwise(p)
    shift = F.greatest(F.floor(F.log2(size.cast("double"))).cast("int") - _MANTISSA, F.lit(0))
    shift = F.when(size < (1 << _MANTISSA), 0).otherwise(shift)
    up = (shift.cast("bigint") * (1 << (_MANTISSA + 1)) + F.call_function("shiftright", size, shift))
    return F.when(p < 0, -up - 1).otherwise(up)


# --- a whole table --------------------------------------------------------------

@dataclass
class Bound:
    """Rows below ``place`` are in, and ``inside`` of the ``there`` rows at it."""
    place: int
    inside: int
    there: int


def bounds(places: DataFrame, cutoffs: Callable[[int], Sequence[int]] | Sequence[int],
           hashed: bool) -> list[Bound]:
    """The bound of each cut-off over the one column ``_place``. ``cutoffs``
    may be a function of the number of rows. Two passes over that column
    find bounds of up to 2^FIRST_BITS * LISTED hashed rows, each factor BINS
    takes one more; at most BINS rows for each cut-off reach the driver."""
    p = F.col(P)
    first = F.when(p == LAST, LAST).otherwise(F.shiftright(p, HASH_BITS - FIRST_BITS) if hashed else _float_bin(p))
    counted = [F.count(F.lit(1)).alias("n"), F.min(P).alias("low"), F.max(P).alias("high")]
    bins = sorted(places.groupBy(first.alias("bin")).agg(*counted).collect(), key=lambda r: r["bin"])
    total = sum(r["n"] for r in bins)
    wanted = list(cutoffs(total) if callable(cutoffs) else cutoffs)
    found: dict[int, Bound] = {}
    open_: dict[int, tuple[int, int, int]] = {}  # cut-off -> low, high, rows before low

    def settle(cut: int, bins: list, before: int) -> None:
        for r in bins:
            if before + r["n"] >= cut:
                if r["low"] == r["high"]:
                    found[cut] = Bound(r["low"], cut - before, r["n"])
                else:
                    open_[cut] = (r["low"], r["high"], before)
                    sizes[cut] = r["n"]
                return
            before += r["n"]

    sizes: dict[int, int] = {}
    for cut in set(wanted):
        if cut <= 0:
            found[cut] = Bound(-LAST - 1, 0, 0)
        elif cut >= total:
            found[cut] = Bound(LAST, 0, 0)
        else:
            settle(cut, bins, 0)
    while open_:
        ranges = sorted({(low, high): max(1, -(-(high - low + 1) // BINS)) if sizes[c] > LISTED else 1
                         for c, (low, high, _) in open_.items()}.items())
        index = reduce(lambda a, b: a.when(p.between(*b[1][0]), F.lit(b[0])), enumerate(ranges),
                       F.when(F.lit(False), -1))
        width = F.element_at(F.array(*[F.lit(w) for _, w in ranges]), F.col("range") + 1)
        low = F.element_at(F.array(*[F.lit(r[0]) for r, _ in ranges]), F.col("range") + 1)
        inside = places.withColumn("range", index).where(F.col("range").isNotNull())
        got = (inside.withColumn("low", low).withColumn("width", width)
               .groupBy("range", F.expr(f"({P} - low) div width").alias("bin")).agg(*counted).collect())
        by_range: dict[tuple[int, int], list] = {}
        for r in sorted(got, key=lambda r: r["low"]):
            by_range.setdefault(ranges[r["range"]][0], []).append(r)
        for cut, (lo, hi, before) in list(open_.items()):
            del open_[cut]
            settle(cut, by_range[(lo, hi)], before)
    return [found[c] for c in wanted]


def _numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> Column:
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    return F.row_number().over(Window.partitionBy(*groups).orderBy(*order, F.xxhash64(*columns)))


def cut(df: DataFrame, place: Column, cutoffs: Callable[[int], Sequence[int]] | Sequence[int],
        label_col: str = "part", hashed: bool = True, ties: Sequence[Column] = (), _deep: bool = False) -> DataFrame:
    """Each row with the number of cut-offs that its rank exceeds, as
    ``label_col``: with cut-offs [a, b] the first a rows get 0, the next
    b - a get 1, the rest 2. ``ties`` orders a few rows of one place before
    the row's hash does."""
    found = bounds(df.select(place.alias(P)), cutoffs, hashed)
    placed = df.withColumn(P, place)
    p = F.col(P)
    label = reduce(lambda a, b: a + b, [F.when(p > b.place, 1).otherwise(0) for b in found], F.lit(0))
    torn = sorted({b.place: b.there for b in found if b.inside < b.there and b.there > 0}.items())
    whole = placed if not torn else placed.where(~p.isin([at for at, _ in torn]))
    out = whole.withColumn(label_col, label).drop(P)
    for at, there in torn:
        here = placed.where(p == at).drop(P)
        below = sum(at > b.place for b in found)
        inside = [b.inside for b in found if b.place == at and b.there > 0]
        if there > LISTED and not _deep:
            part = cut(here, row_place(df), inside, label_col, _deep=True)
        else:
            rank = _numbered(here, [], ties)
            part = here.withColumn(P, rank).withColumn(label_col, reduce(
                lambda a, b: a + b, [F.when(F.col(P) > i, 1).otherwise(0) for i in inside], F.lit(0))).drop(P)
        out = out.unionByName(part.withColumn(label_col, F.col(label_col) + below))
    return out


# --- every group ------------------------------------------------------------------

def _guess(quota: Column, n: Column) -> tuple[Column, Column]:
    """Where the ``quota``-th of ``n`` uniform places lies but for one case
    in a billion; a wrong guess costs another count, never a wrong bound."""
    share = quota / n
    margin = 6 * F.sqrt(share * (1 - share) / n) + 20 / n
    at = lambda x: F.floor(x * F.lit(float(1 << HASH_BITS))).cast("bigint")
    return at(F.greatest(share - margin, F.lit(0.0))), at(F.least(share + margin, F.lit(1.0)))


def group_bounds(places: DataFrame, group_col: str, targets: DataFrame, hashed: bool) -> DataFrame:
    """(group, place, inside, there) for each row of ``targets`` (group,
    quota, n, low, high), 0 < quota < n (n: rows with a key). Every count
    shuffles at most GROUP_BINS + 2 or GROUP_LISTED + 2 numbers of a group,
    added up before the shuffle."""
    p, lo, hi = F.col(P), F.col("low"), F.col("high")
    if hashed:
        low, high = _guess(F.col("quota"), F.col("n"))
        expected = (high - low).cast("double") / float(1 << HASH_BITS) * F.col("n")
        targets = targets.withColumn("expected", expected).withColumn("low", low).withColumn("high", high)
    else:
        targets = targets.withColumn("expected", F.col("n").cast("double"))
    keyless = F.col("quota") > F.col("n")
    targets = (targets.withColumn("low", F.when(keyless, LAST).otherwise(lo))
               .withColumn("high", F.when(keyless, LAST).otherwise(hi)))
    width = (F.when((F.col("expected") <= GROUP_LISTED) | (lo == hi), F.lit(1).cast("bigint"))
             .otherwise(F.greatest(F.ceil((hi - lo + 1) / GROUP_BINS), F.lit(1)).cast("bigint")))
    done: list[DataFrame] = []
    todo = targets.select(group_col, "quota", "low", "high", "expected")
    while todo.limit(1).count():
        ranges = broadcast_checked(todo.withColumn("width", width).select(
            F.col(group_col).alias("_g"), "low", "high", "width"))
        bin_ = F.when(p < lo, -1).otherwise(F.expr(f"({P} - low) div width"))
        bins = (places.join(ranges, places[group_col].eqNullSafe(F.col("_g")) & (p <= hi))
                .groupBy(group_col, bin_.alias("bin"))
                .agg(F.count(F.lit(1)).alias("c"), F.min(P).alias("first"), F.max(P).alias("last")))
        upto = Window.partitionBy("_h").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        quotas = todo.select(F.col(group_col).alias("_h"), "quota", "low", "high")
        hit = (bins.join(quotas, bins[group_col].eqNullSafe(F.col("_h")))
               .withColumn("cum", F.sum("c").over(upto))
               .where((F.col("cum") >= F.col("quota")) & (F.col("cum") - F.col("c") < F.col("quota"))))
        hit = hit.select("_h", "bin", "c", "first", "last", (F.col("quota") - F.col("cum") + F.col("c")).alias("inside"))
        state = materialize(todo.join(hit, todo[group_col].eqNullSafe(F.col("_h")), "left").drop("_h"), "group-bounds")
        exact = (F.col("bin") >= 0) & (F.col("first") == F.col("last"))
        done.append(state.where(exact).select(group_col, F.col("first").alias("place"), "inside",
                                              F.col("c").alias("there")))
        missed_low, missed_high = F.col("bin") == -1, F.col("bin").isNull()
        todo = state.where(~F.coalesce(exact, F.lit(False))).select(
            group_col, "quota",
            F.when(missed_high, hi + 1).otherwise(F.col("first")).alias("low"),
            F.when(missed_high, F.lit(LAST - 1)).when(missed_low, lo - 1).otherwise(F.col("last")).alias("high"),
            F.when(missed_high, F.lit(float("inf"))).otherwise(F.col("c").cast("double")).alias("expected"))
    return reduce(DataFrame.unionByName, done) if done else targets.limit(0).select(
        group_col, *[F.lit(0).cast("bigint").alias(c) for c in ("place", "inside", "there")])


def first_per_group(df: DataFrame, group_col: str, place: Column, quotas: DataFrame, hashed: bool = True,
                    ties: Sequence[Column] = (), _deep: bool = False) -> DataFrame:
    """The first ``quota`` rows of every group. ``quotas`` (a written table)
    has (group, quota, n_rows, n_keyed, low, high): all rows, rows with a
    key, and the least and largest place of those. One row for each group
    is put beside the rows by broadcast, where its size allows."""
    places = df.select(group_col, place.alias(P))
    inner = quotas.where("quota > 0 and quota < n_rows").select(
        group_col, "quota", F.col("n_keyed").alias("n"), "low", "high")
    found = group_bounds(places, group_col, inner, hashed)
    whole = quotas.where("quota >= n_rows").select(
        group_col, F.lit(LAST).alias("place"), F.lit(0).cast("bigint").alias("inside"),
        F.lit(0).cast("bigint").alias("there"))
    table = found.unionByName(whole).withColumnRenamed(group_col, "_g")
    placed = df.withColumn(P, place)
    beside = placed.join(broadcast_checked(table), placed[group_col].eqNullSafe(F.col("_g")))
    p = F.col(P)
    out = beside.where((p < F.col("place")) | ((p == F.col("place")) & (F.col("inside") == F.col("there"))))
    out = out.select(*df.columns)
    torn = found.where("inside < there")
    most = torn.agg(F.max("there")).first()[0]
    if most is None:
        return out
    here = beside.where((p == F.col("place")) & (F.col("inside") < F.col("there")))
    if most > GROUP_LISTED and not _deep:
        some = torn.select(group_col, F.col("inside").alias("quota"), F.col("there").alias("n_rows"),
                           F.col("there").alias("n_keyed"), F.lit(None).cast("bigint").alias("low"),
                           F.lit(None).cast("bigint").alias("high"))
        rest = first_per_group(here.select(*df.columns), group_col, row_place(df), some, _deep=True)
    else:
        rest = (here.withColumn("_n", _numbered(df, [group_col], ties)).where(F.col("_n") <= F.col("inside"))
                .select(*df.columns))
    return out.unionByName(rest)
