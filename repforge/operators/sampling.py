"""Exact, balanced and round-robin samples.

Random order is the seeded md5 key of the sequence id, so a sample is exact
in size and reproducible; ``df.sample`` is only approximate and is not used.
A sample is a filter: the bound of its last row is found by counting
(``operators.bounds``), for a whole table or for each group. Rows without an
id take part; they come last in every order.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.operators.bounds import cut, first_per_group, hash_place, id_place
from repforge.operators.groups import GROUP_COL, assign_groups
from repforge.operators.ranks import DEFAULT_SEED, hash_key, ordered_ranks
from repforge.session import materialize

SCHEMES = ("random", "balance_individuals", "balance_publications")


def sample_exact(df: DataFrame, n: int, id_col: str = "Sequence_ID", seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement; error if ``n`` exceeds the
    rows. The picked rows are the ``n`` smallest md5 keys."""
    def cutoffs(total: int) -> list[int]:
        if n > total:
            raise ValueError(f"requested sample size ({n}) is larger than total sequences ({total})")
        return [n]
    part = cut(df, hash_place(id_col, seed), cutoffs, "_part", ties=[hash_key(id_col, seed)])
    return part.where(F.col("_part") == 0).drop("_part")


def group_counts(df: DataFrame, group_col: str = GROUP_COL, id_col: str = "Sequence_ID") -> DataFrame:
    """Per group: ``n_rows``, ``n_keyed`` (rows with an id), ``low`` and
    ``high`` (least and largest id)."""
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"), F.count(id_col).alias("n_keyed"),
                                     F.min(id_col).cast("bigint").alias("low"),
                                     F.max(id_col).cast("bigint").alias("high"))


def sample_per_group(df: DataFrame, quota: int, group_col: str = GROUP_COL,
                     id_col: str = "Sequence_ID", seed: int = DEFAULT_SEED,
                     counts: DataFrame | None = None) -> DataFrame:
    """``quota`` rows from every group (md5 order within the group); error
    if a group has fewer rows. ``counts`` (``group_counts``, written) is
    reused when the caller already has it."""
    if counts is None:
        counts = materialize(group_counts(df, group_col, id_col), "group-counts")
    short = counts.where(F.col("n_rows") < quota)
    n_short = short.count()
    if n_short:
        raise ValueError(f"{n_short} groups with fewer than {quota} rows, e.g. "
                         f"{[(r[0], r[1]) for r in short.orderBy(group_col).limit(10).collect()]}")
    quotas = counts.withColumn("quota", F.lit(int(quota)).cast("bigint"))
    return first_per_group(df, group_col, hash_place(id_col, seed), quotas, ties=[hash_key(id_col, seed)])


def sample_balanced(df: DataFrame, total: int, group_col: str = GROUP_COL,
                    id_col: str = "Sequence_ID", seed: int = DEFAULT_SEED) -> DataFrame:
    """The same number, ``ceil(total / groups)``, from every group. One pass
    gives the per-group counts (written once, one row per group); the group
    count and the shortage check both read that small table."""
    counts = materialize(group_counts(df, group_col, id_col), "group-counts")
    n_groups = counts.count()
    if n_groups == 0:
        raise ValueError("no groups to sample from")
    return sample_per_group(df, math.ceil(total / n_groups), group_col, id_col, seed,
                            counts=counts)


def water_level(sizes: list[tuple[int, int]], total: int) -> tuple[int, int]:
    """``sizes``: (group size, groups of that size). The largest level R with
    sum(min(size, R)) <= total, and what then remains of ``total``."""
    level, left = 0, total
    groups = sum(g for _, g in sizes)
    for size, g in sorted(sizes):
        if (size - level) * groups > left:
            return level + left // groups, left % groups
        left -= (size - level) * groups
        level, groups = size, groups - g
    return level, 0


def round_robin_quotas(counts: DataFrame, total: int, group_col: str = GROUP_COL) -> DataFrame:
    """Per group, how many rows round-robin sampling takes.

    One row per group per round, exhausted groups leave, stop at ``total``.
    Closed form: R = largest level with sum(min(n, R)) <= total; every
    group gives min(n, R) and the first ``total - that`` groups (by name)
    with more than R rows give one more. R comes from the number of groups
    of each size: N rows have at most sqrt(2 N) different sizes. Names are
    ranked by range, and only where some groups give one more.
    """
    sizes = [(r["n_rows"], r["count"]) for r in counts.groupBy("n_rows").count().collect()]
    level, extra = water_level(sizes, int(total))
    flat = counts.select(group_col, "n_rows", F.least("n_rows", F.lit(level)).cast("bigint").alias("quota"))
    if not extra:
        return flat
    ranked = ordered_ranks(flat.where(F.col("n_rows") > level), [group_col], "_rank")
    more = F.when(F.col("_rank") <= extra, 1).otherwise(0)
    return flat.where(F.col("n_rows") <= level).unionByName(
        ranked.withColumn("quota", F.col("quota") + more).drop("_rank"))


def sample_round_robin(df: DataFrame, total: int, group_col: str = GROUP_COL,
                       id_col: str = "Sequence_ID") -> DataFrame:
    """Round-robin sample: rows are taken in id (file) order within each
    group, up to the group's round-robin quota; rows without an id come
    last. Fewer than ``total`` rows only when every group is exhausted."""
    stats = materialize(group_counts(df, group_col, id_col), "group-counts")
    quotas = round_robin_quotas(stats.select(group_col, "n_rows"), total, group_col).select(
        F.col(group_col).alias("_q"), "quota")
    quotas = materialize(stats.join(quotas, stats[group_col].eqNullSafe(F.col("_q"))).drop("_q"), "quotas")
    return first_per_group(df, group_col, id_place(id_col), quotas, hashed=False)


def sampling_distribution(sample: DataFrame, groups: DataFrame,
                          group_col: str = GROUP_COL) -> DataFrame:
    """Rows drawn per group, including groups with none, largest first."""
    drawn = sample.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_sampled"))
    return (groups.select(group_col).distinct().join(drawn, group_col, "left")
                  .select(group_col, F.coalesce("n_sampled", F.lit(0)).cast("bigint").alias("n_sampled"))
                  .orderBy(F.col("n_sampled").desc(), F.col(group_col)))


def sample(seqs: DataFrame, scheme: str, total: int, catalogue: DataFrame | None = None,
           seed: int = DEFAULT_SEED) -> DataFrame:
    """Scheme switch; an unknown scheme is an error."""
    if scheme == "random":
        return sample_exact(seqs, total, seed=seed)
    if scheme in ("balance_individuals", "balance_publications"):
        if catalogue is None:
            raise ValueError(f"{scheme} needs the catalogue")
        by = "individual" if scheme == "balance_individuals" else "publication"
        return sample_balanced(assign_groups(seqs, catalogue, by), total, seed=seed)
    raise ValueError(f"unknown sampling scheme {scheme!r}; expected one of {SCHEMES}")
