"""Plain-text corpus (one sequence per line) and tokenised datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repforge.functions.regions import concat_regions
from repforge.functions.tokens import tokenize
from repforge.operators.ranks import global_rank, id_bins
from repforge.sources.tables import exists

TOKEN_COLUMNS = ["input_ids", "attention_mask", "special_tokens_mask"]
SHARD_ROWS = 1_000_000


def sequence_text(seqs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``text`` = the seven regions joined (missing ones empty)."""
    return seqs.select(*(keep or ["Sequence_ID"]), concat_regions().alias("text"))


def write_text(df: DataFrame, path: str, text_col: str = "text",
               partition_col: str | None = None) -> None:
    """One sequence per line, no header (optionally one folder per value of
    ``partition_col``, e.g. the split or the source file)."""
    out = df.select(*( [partition_col] if partition_col else []), F.col(text_col).alias("value"))
    w = out.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.text(path)


def read_corpus(spark: SparkSession, files: dict[str, str | list[str]]) -> DataFrame:
    """Named splits of text files -> (split, text). One scan per split,
    unioned; every file is read whole, line by line."""
    parts = []
    for split, paths in files.items():
        p = [paths] if isinstance(paths, str) else list(paths)
        parts.append(spark.read.text(p).select(F.lit(split).alias("split"),
                                               F.col("value").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tokenize_corpus(corpus: DataFrame, text_col: str = "text",
                    keep: list[str] | None = None, max_length: int = 150) -> DataFrame:
    """Token arrays for every line, one Arrow batch at a time (the
    expression form ``functions.tokens.tokenize`` defines the same output)."""
    from repforge.operators.encoding import tokenize_batches
    return tokenize_batches(corpus, text_col, keep, max_length)


def with_shards(rows: DataFrame, shard_rows: int = SHARD_ROWS, order_col: str = "Sequence_ID") -> DataFrame:
    """Add ``shard``: each split is cut into shards of ``shard_rows``
    consecutive rows in ``order_col`` order. Number rows before they are
    tokenised: ranks need only the ids."""
    binned = rows.withColumn("_bin", id_bins(rows, order_col))
    ranked = global_rank(binned, [order_col], ["_bin"], "_place", group_cols=["split"])
    return ranked.withColumn("shard", F.expr(f"cast((_place - 1) div {shard_rows} as int)")).drop("_bin", "_place")


#: Rows that a task tokenises and sorts by folder before it writes them (100
#: MB of token arrays at 150 tokens): it holds them without a spill.
DEALT_ROWS = 50_000


def deal_shards(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows of a shard (see ``with_shards``) in one partition. Deal rows
    out before they are tokenised: a text is a tenth of its token arrays.
    ``n_rows`` gives the number of partitions; left to the size of the
    texts, a task would get many more arrays than it can hold."""
    parts = max(-(-n_rows // DEALT_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(parts, "split", "shard")


def write_token_shards(tokens: DataFrame, path: str, dealt: bool = False) -> None:
    """Parquet, one folder per split and shard (see ``with_shards``), one
    file of at most ``shard_rows`` rows each. ``dealt``: the rows were dealt
    out by ``deal_shards`` before they were tokenised."""
    whole = tokens if dealt else tokens.repartition("split", "shard")
    whole.write.mode("overwrite").partitionBy("split", "shard").parquet(path)


def read_tokenized_test(spark: SparkSession, path: str, split: str = "test") -> DataFrame | None:
    """The ``split`` part of a tokenised dataset, or None if the split or a
    required column is missing (callers skip that dataset)."""
    if not exists(spark, path):
        return None
    return select_test_split(spark.read.parquet(path), split)


def select_test_split(df: DataFrame, split: str = "test") -> DataFrame | None:
    if "split" not in df.columns or not {"input_ids", "attention_mask"} <= set(df.columns):
        return None
    return df.where(F.col("split") == split)
