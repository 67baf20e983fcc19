"""Catalogue statistics: grouped sums, pivots, isotype shares, histograms.

All are partial-aggregated before the shuffle; windows run only on the
already-aggregated (small) results.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from repforge.functions.coerce import to_count
from repforge.operators.filters import species_filter

# Right-closed edges of the subject-size histogram.
SUBJECT_SIZE_EDGES = [0, 100, 1000, 10000, 100000, 1000000, 10000000, math.inf]


def _not_null(cols: Sequence[str]):
    pred = F.lit(True)
    for c in cols:
        pred = pred & F.col(c).isNotNull()
    return pred


def numeric(df: DataFrame, col: str, kind: str = "bigint") -> DataFrame:
    """Coerce a text count column in place (invalid -> null)."""
    if isinstance(df.schema[col].dataType, StringType):
        return df.withColumn(col, F.col(col).try_cast(kind))
    return df


def grouped_sum(df: DataFrame, group_cols: Sequence[str], sum_col: str,
                alias: str | None = None, kind: str = "bigint") -> DataFrame:
    """Sum of ``sum_col`` per group; null keys dropped (like pandas),
    invalid numbers skipped, an all-invalid group sums to 0."""
    d = numeric(df.select(*group_cols, sum_col), sum_col, kind)
    return (d.where(_not_null(group_cols))
             .groupBy(*group_cols)
             .agg(F.coalesce(F.sum(sum_col), F.lit(0)).alias(alias or sum_col)))


def catalogue_report(catalogue: DataFrame) -> DataFrame:
    """Every grouped sum of the catalogue in one pass: (report, key_1, key_2,
    total, size_mb). Grouping sets make the groups of all reports from one
    scan; the grouping id says which set a row belongs to, so that a null
    that stands for "all" and a null key, which is dropped, stay apart."""
    size = F.col("Size_MB").try_cast("decimal(38,4)")
    c = catalogue.select("Author", "Subject", "Species", "Chain", size.alias("s"),
                         F.col("Unique_sequences").try_cast("bigint").alias("u"),
                         F.col("Total_sequences").try_cast("bigint").alias("t"))
    human = F.col("Species") == "human"
    keys = ["Author", "Subject", "Species", "Chain"]
    sets = [["Author"], ["Subject", "Author"], ["Species", "Chain"], ["Species"], []]
    g = c.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.grouping_id().alias("set"), F.sum("u").alias("u"), F.sum("t").alias("t"), F.sum("s").alias("s"),
        F.sum(F.when(human, F.col("u"))).alias("human_u"), F.count(F.when(human, 1)).alias("human_n"))

    def row(report: str, of: list[str], total=None, mb=None, only=None):
        """One row of the report where the grouping set is ``of``."""
        is_set = F.col("set") == sum(1 << (3 - i) for i, k in enumerate(keys) if k not in of)
        names = [F.col(k) for k in of] + [F.lit(None).cast("string")] * 2
        zero = lambda v, kind: (F.coalesce(v, F.lit(0)) if v is not None else F.lit(None)).cast(kind)
        return F.when(is_set & _not_null(of) & (F.lit(True) if only is None else only), F.struct(
            F.lit(report).alias("report"), names[0].alias("key_1"), names[1].alias("key_2"),
            zero(total, "bigint").alias("total"), zero(mb, "double").alias("size_mb")))

    u, t, s = F.col("u"), F.col("t"), F.col("s")
    rows = [row("size_by_author", ["Author"], mb=s), row("total_by_author", ["Author"], t),
            row("unique_by_author", ["Author"], u), row("unique_by_subject", ["Subject", "Author"], u),
            row("unique_by_subject_human", ["Subject", "Author"], F.col("human_u"), only=F.col("human_n") > 0),
            row("unique_by_species_chain", ["Species", "Chain"], u), row("unique_by_species", ["Species"], u),
            row("total_size", [], mb=s)]
    return g.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r")).select("r.*")


def pivot_sum(df: DataFrame, row_col: str, pivot_col: str, values: Sequence[str],
              sum_col: str) -> DataFrame:
    """Rows ``row_col`` x columns ``values`` of ``pivot_col``, sums, missing 0.
    Explicit pivot values avoid the extra distinct job."""
    d = numeric(df.select(row_col, pivot_col, sum_col), sum_col)
    d = d.where(_not_null([row_col, pivot_col]))
    out = d.groupBy(row_col).pivot(pivot_col, list(values)).agg(F.sum(sum_col))
    return out.na.fill(0, subset=list(values))


def isotype_stats(catalogue: DataFrame, species: str | list | None = None) -> DataFrame:
    """Per isotype: summed unique/total counts and their percentage of all
    isotypes (0 when the total is 0; null isotypes excluded)."""
    d = species_filter(catalogue.select("Species", "Isotype", "Unique_sequences",
                                        "Total_sequences"), species)
    d = d.select("Isotype",
                 to_count(F.col("Unique_sequences"), 0).alias("u"),
                 to_count(F.col("Total_sequences"), 0).alias("t"))
    sums = (d.where(F.col("Isotype").isNotNull()).groupBy("Isotype")
             .agg(F.sum("u").alias("Total_Unique_Sequences"),
                  F.sum("t").alias("Total_Total_Sequences")))
    everything = Window.partitionBy()   # over the per-isotype rows only
    tu = F.sum("Total_Unique_Sequences").over(everything)
    tt = F.sum("Total_Total_Sequences").over(everything)
    return sums.select(
        "Isotype", "Total_Unique_Sequences", "Total_Total_Sequences",
        F.when(tu > 0, F.col("Total_Unique_Sequences") / tu * 100)
         .otherwise(F.lit(0.0)).alias("Percentage_Unique_Sequences"),
        F.when(tt > 0, F.col("Total_Total_Sequences") / tt * 100)
         .otherwise(F.lit(0.0)).alias("Percentage_Total_Sequences"))


def author_count(catalogue: DataFrame) -> DataFrame:
    return catalogue.agg(F.countDistinct("Author").alias("author_count"))


def authors(catalogue: DataFrame) -> DataFrame:
    return catalogue.select("Author").distinct()


def authors_without_subject(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(F.col("Subject") == "no").select("Author").distinct()


def subjects_in_many_publications(catalogue: DataFrame) -> DataFrame:
    """Subjects named in more than one publication, with the sorted list.
    The set per subject is bounded by the number of publications."""
    g = (catalogue.where(F.col("Subject").isNotNull() & F.col("Author").isNotNull())
                  .groupBy("Subject")
                  .agg(F.array_sort(F.collect_set("Author")).alias("_pubs")))
    return (g.where(F.size("_pubs") > 1)
             .select("Subject", F.size("_pubs").alias("n_publications"),
                     F.array_join("_pubs", "; ").alias("publications")))


def total_size(catalogue: DataFrame) -> DataFrame:
    """Sum of ``Size_MB`` (invalid -> 0) in MB, GB and TB."""
    mb = F.coalesce(F.col("Size_MB").try_cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)"))
    s = catalogue.agg(F.sum(mb).alias("mb"))
    return s.select(F.col("mb").cast("double").alias("total_mb"),
                    F.round(F.col("mb").cast("double") / 1024, 6).alias("total_gb"),
                    F.round(F.col("mb").cast("double") / 1024 / 1024, 9).alias("total_tb"))


def subject_size_histogram(catalogue: DataFrame,
                           edges: Sequence[float] = SUBJECT_SIZE_EDGES) -> DataFrame:
    """Number of (Subject, Author) groups per right-closed size bin; empty
    bins kept, sizes outside every bin (e.g. 0) not counted."""
    spark = catalogue.sparkSession
    sizes = grouped_sum(catalogue, ["Subject", "Author"], "Unique_sequences", "size")
    bin_id = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        lo, hi = edges[i - 1], edges[i]
        cond = F.col("size") > F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (F.col("size") <= F.lit(float(hi)))
        bin_id = F.when(cond, F.lit(i - 1)).otherwise(bin_id)
    counts = (sizes.select(bin_id.alias("bin")).where(F.col("bin").isNotNull())
                   .groupBy("bin").agg(F.count(F.lit(1)).alias("n_subjects")))
    bins = spark.createDataFrame(
        [(i, float(edges[i]), float(edges[i + 1])) for i in range(len(edges) - 1)],
        "bin int, lower double, upper double")
    return (bins.join(counts, "bin", "left")
                .select("bin", "lower", "upper",
                        F.coalesce("n_subjects", F.lit(0)).cast("bigint").alias("n_subjects")))


def age_histogram(catalogue: DataFrame, n_bins: int = 20) -> DataFrame:
    """Unique sequences per age bin: ``n_bins`` equal bins over [min, max]
    of the numeric ages, last bin closed (numpy rule); empty bins are kept
    with 0. Rows with a non-numeric age or count are skipped; without any
    numeric age there is no bin."""
    d = catalogue.select(F.col("Age").try_cast("double").alias("age"),
                         to_count(F.col("Unique_sequences")).alias("w"))
    d = d.where(F.col("age").isNotNull() & F.col("w").isNotNull())
    # the range is two numbers (one partial aggregate), used as literals:
    # no join against the rows
    lo, hi = d.agg(F.min("age"), F.max("age")).first()
    empty = lo is None
    if empty:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    span = F.lit(float(hi)) - F.lit(float(lo))
    b = F.least(F.floor((F.col("age") - F.lit(float(lo))) / span * n_bins),
                F.lit(n_bins - 1)).cast("int")
    edge = lambda i: F.lit(float(lo)) + span * i / n_bins
    sums = d.groupBy(b.alias("bin")).agg(F.sum("w").alias("unique_sequences"))
    bins = catalogue.sparkSession.range(0 if empty else n_bins).select(F.col("id").cast("int").alias("bin"))
    return (bins.join(sums, "bin", "left")
                .select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
                        F.coalesce("unique_sequences", F.lit(0)).cast("bigint").alias("unique_sequences")))


def labelled_groups(df: DataFrame, group_cols: Sequence[str], sum_col: str,
                    threshold: float) -> DataFrame:
    """Grouped sums with a label (the group key) only above ``threshold``."""
    s = grouped_sum(df, group_cols, sum_col)
    key = F.concat_ws(" / ", *[F.col(c) for c in group_cols])
    return s.withColumn("label", F.when(F.col(sum_col) > threshold, key).otherwise(F.lit("")))
