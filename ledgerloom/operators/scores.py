"""Fitted scores as a versioned table that decisions, book and officers read.

A version is written once, as a folder of its own; it counts from the moment its
writer has committed it. Readers take the newest committed version, so a run
that fails half-way changes nothing for them, and a rerun of a version that
exists is an error instead of a second truth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import path_exists
from .decisions import rank_portfolio, recommend_channel, weekly_book

KEY = ("SK_ID_CURR", "SK_ID_PREV")
SCORES = ("recovery_probability", "estimated_days_to_cure", "partial_recovery_ratio")


def write_scores(model: PipelineModel, events: DataFrame, path: str, version: int, keep: Sequence[str]) -> None:
    """Score ``events`` and write them as ``version``; what is kept beside the scores is what decisions need."""
    model.transform(events).select(*KEY, *keep, *SCORES).write.mode("error").parquet(f"{path}/version={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first; a folder without its success mark is still being written or was left behind."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [n for n in numbers if path_exists(spark, f"{path}/version={n}/_SUCCESS")]


def current_scores(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one asked for, with its number in ``score_version``."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"no score version {'' if version is None else version} in {path}")
    chosen = known[-1] if version is None else version
    return spark.read.parquet(f"{path}/version={chosen}").withColumn("score_version", F.lit(chosen))


def decided_book(scores: DataFrame, size: int = 400) -> DataFrame:
    """Vulnerability, channel, expected recovery, rank in the whole book, and the officer of the ``size`` best accounts."""
    screened = recommend_channel(scores).select(*scores.columns, "is_vulnerable")
    ranked = rank_portfolio(screened, "recovery_probability", "cash", KEY)
    dealt = weekly_book(ranked, size, KEY).select(*KEY, "assigned_officer")
    return ranked.join(F.broadcast(dealt), list(KEY), "left")  # at most ``size`` rows
