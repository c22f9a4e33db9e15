"""Splits by time, by date fold and by entity. Fold membership is always a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_share(key: Column, seed: int, share: float) -> Column:
    """True for a repeatable ``share`` of the keys, by digest rather than by ``rand``."""
    bound = f"{min(int(share * 65536), 65535):04x}"
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.substring(digest, 1, 4) < bound


def sample_by_key(df: DataFrame, key: str, seed: int, share: float) -> DataFrame:
    """A repeatable share of the keys; a key is wholly in or wholly out.

    Stands in for 'the first N rows', which mean nothing in a distributed read.
    """
    return df.filter(hash_share(F.col(key), seed, share))


def entity_split(df: DataFrame, entity: str, seed: int = 42, test_share: float = 0.25) -> DataFrame:
    """Add ``is_test``; all rows of an entity fall on the same side."""
    return df.withColumn("is_test", hash_share(F.col(entity), seed, test_share))


def time_split(df: DataFrame, day: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut-off day, and rows on or after it."""
    cut = F.lit(cutoff).cast("date")
    return df.filter(F.col(day) < cut), df.filter(F.col(day) >= cut)


def date_folds(df: DataFrame, day: str, n_splits: int = 5) -> DataFrame:
    """Expanding-window folds over the distinct days, one row per day.

    With D days and k folds the test size is D // (k + 1); fold i validates the
    block of that size that ends (k - 1 - i) blocks before the last day and
    trains on all earlier days. ``val_fold`` is the fold a day is validated in,
    NULL for the first block, so a day trains in every later fold. Fewer than
    k + 1 days are an error.
    """
    days = df.select(day).where(F.col(day).isNotNull()).distinct()
    ranked = days.withColumn("_r", F.row_number().over(Window.orderBy(day)) - 1)  # one row per calendar day
    total = days.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.floor(total / (n_splits + 1))
    fold = n_splits - 1 - F.floor((total - 1 - F.col("_r")) / size)
    short = F.raise_error(F.concat(F.lit(f"{n_splits} folds need at least {n_splits + 1} days, the table has "), total.cast("string"))).cast("int")
    return ranked.select(day, F.when(total <= n_splits, short).when(fold >= 0, fold.cast("int")).alias("val_fold"))


def with_folds(df: DataFrame, day: str, n_splits: int = 5) -> DataFrame:
    """Rows with their ``val_fold``; the fold table has one row per calendar day."""
    return df.join(F.broadcast(date_folds(df, day, n_splits)), day, "left")


def train_rows(folded: DataFrame, fold: int) -> DataFrame:
    """Rows of all days before fold ``fold``'s validation block."""
    return folded.filter(F.coalesce(F.col("val_fold"), F.lit(-1)) < fold)


def validation_rows(folded: DataFrame, fold: int) -> DataFrame:
    return folded.filter(F.col("val_fold") == fold)
