"""Model assessment over a loss table (model, test_set, rank, batch, loss):
the evaluation loop's averaging and the train x test loss matrix."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# exp() overflows a double above this; the perplexity is then reported null
MAX_EXP_ARG = 709.0


def loss_by_test_set(losses: DataFrame, weighted: bool = False) -> DataFrame:
    """Per (model, test_set): mean over valid batches within each rank, then
    the mean of the rank means (unweighted, like an all-reduce AVG; with
    ``weighted`` every batch counts the same). NaN/null batches are skipped;
    an infinite batch makes its mean infinite (opposite infinities: NaN).
    Finite sums are exact (DECIMAL), so the means do not depend on the order."""
    valid = losses.where(F.col("loss").isNotNull() & ~F.isnan("loss"))
    infinite = F.abs("loss") == float("inf")
    per_rank = valid.groupBy("model", "test_set", "rank").agg(
        F.sum(F.when(~infinite, F.col("loss").cast("decimal(38,12)"))).alias("s"),
        F.sum(F.when(infinite, F.col("loss"))).alias("inf"), F.count(F.lit(1)).alias("n"))
    # the infinite part (if any) decides the mean
    total = lambda s, inf: F.coalesce(inf, s.cast("double"))
    per_rank = per_rank.withColumn("rank_mean", total(F.col("s"), F.col("inf")) / F.col("n"))
    if weighted:
        agg = per_rank.groupBy("model", "test_set").agg(
            (total(F.sum("s"), F.sum("inf")) / F.sum("n")).alias("m"), F.sum("n").alias("n_batches"))
    else:
        agg = per_rank.groupBy("model", "test_set").agg(
            F.avg("rank_mean").alias("m"), F.sum("n").alias("n_batches"))
    return agg.select("model", "test_set", F.col("m").alias("eval_loss"), "n_batches",
                      F.when(F.col("m") <= MAX_EXP_ARG, F.exp("m")).alias("perplexity"))


def loss_matrix(per_set: DataFrame, test_sets: Sequence[str],
                macro_sets: Sequence[str] | None = None) -> DataFrame:
    """Models as rows, test sets as columns (explicit order), plus the mean
    over ``macro_sets`` (default: all listed sets)."""
    wide = per_set.groupBy("model").pivot("test_set", list(test_sets)).agg(F.first("eval_loss"))
    macro = list(macro_sets or test_sets)
    total = sum((F.col(c) for c in macro[1:]), F.col(macro[0]))
    return wide.withColumn("macro_mean", total / len(macro))


def perplexity(loss: str = "eval_loss"):
    return F.when(F.col(loss) <= MAX_EXP_ARG, F.exp(loss))
