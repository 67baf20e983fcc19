"""Train / validation / test splits and contiguous folds.

Each row's part follows from its place in seeded md5 order (or id order for
folds) and the exact bounds of the parts (``operators.bounds``): no sort, no
join, no rank. Rows without an id come last in every order and keep a part.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repforge.operators.bounds import cut, hash_place, id_place
from repforge.operators.ranks import DEFAULT_SEED, hash_key

SPLIT_NAMES = ["train", "val", "test"]


def split_counts_fraction(total: int, train_fraction: float, val_fraction: float) -> tuple[int, int]:
    """Counts truncated with decimal arithmetic (0.29 * 100 -> 29, not 28)."""
    t = int(Decimal(str(train_fraction)) * total)
    v = int(Decimal(str(val_fraction)) * total)
    return t, v


def _split(df: DataFrame, parts: Callable[[int], tuple[int, int]], id_col: str, seed: int, cap: int) -> DataFrame:
    """``parts`` gives the rows of train and val from the number of rows."""
    def cutoffs(n_rows: int) -> list[int]:
        total = min(n_rows, cap) if cap > 0 else n_rows
        train, val = parts(total)
        if train + val > total:
            raise ValueError(f"training + validation sequences ({train + val}) exceed "
                             f"total available ({total})")
        return [train, train + val] + ([total] if cap > 0 else [])
    out = cut(df, hash_place(id_col, seed), cutoffs, ties=[hash_key(id_col, seed)])
    name = (F.when(F.col("part") == 0, "train").when(F.col("part") == 1, "val")
              .otherwise("test"))
    return out.where(F.col("part") < 3).withColumn("split", name).drop("part")


def split_numbers(df: DataFrame, train: int, val: int, id_col: str = "Sequence_ID",
                  seed: int = DEFAULT_SEED, cap: int = 0) -> DataFrame:
    """First ``train`` rows of the seeded shuffle -> train, next ``val`` ->
    val, the rest -> test. ``cap > 0`` keeps only the first ``cap`` rows of
    the shuffle before splitting. Error if train + val exceed the rows."""
    return _split(df, lambda total: (train, val), id_col, seed, cap)


def split_fraction(df: DataFrame, train_fraction: float, val_fraction: float,
                   id_col: str = "Sequence_ID", seed: int = DEFAULT_SEED,
                   cap: int = 0) -> DataFrame:
    """Like ``split_numbers`` with counts ``int(fraction * total)``."""
    return _split(df, lambda total: split_counts_fraction(total, train_fraction, val_fraction), id_col, seed, cap)


def kfold(df: DataFrame, k: int, id_col: str = "Sequence_ID") -> DataFrame:
    """Contiguous folds in id order; the first ``n % k`` folds are one row
    larger. Adds ``fold`` (0-based); fold i's test part is ``fold == i``."""
    def cutoffs(n: int) -> list[int]:
        if k < 2 or k > n:
            raise ValueError(f"need 2 <= k <= rows ({n}), got k={k}")
        return [i * (n // k) + min(i, n % k) for i in range(1, k)]
    return cut(df, id_place(id_col), cutoffs, "fold", hashed=False)


def write_splits(split_df: DataFrame, path: str, text_col: str | None = None) -> None:
    """One pass: ``partitionBy('split')`` Parquet, or text lines if
    ``text_col`` is given."""
    if text_col:
        split_df.select("split", F.col(text_col).alias("value")).write.mode(
            "overwrite").partitionBy("split").text(path)
    else:
        split_df.write.mode("overwrite").partitionBy("split").parquet(path)
