"""Exact ranking metrics on a scored frame, without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import prefix_sums


def _by_score(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score, with their totals at or above it."""
    s = df.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    order = [F.col(b) for b in by] + [F.col(score).desc()]
    s = prefix_sums(s, order, {"cum_pos": F.col("pos"), "cum_neg": F.col("neg")})
    if not by:
        return s
    # running totals go on across groups; take off what stood before each group
    base = s.groupBy(*by).agg(F.min(F.col("cum_pos") - F.col("pos")).alias("_bp"), F.min(F.col("cum_neg") - F.col("neg")).alias("_bn"))
    return s.join(base, list(by)).select(
        *by, score, "pos", "neg", (F.col("cum_pos") - F.col("_bp")).alias("cum_pos"), (F.col("cum_neg") - F.col("_bn")).alias("cum_neg"))


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` per group of ``by`` (few groups, such as folds or models).

    ROC area is the rank-sum with ties counted half; it is 0.5 when a class is
    absent. ``pr_auc`` is average precision: the gain in recall at each distinct
    score times the precision there, with no interpolation.
    """
    s = _by_score(df, score, label, list(by))
    below = F.col("neg").cast("double")
    higher_pos = (F.col("cum_pos") - F.col("pos")).cast("double")
    pairs = below * higher_pos + below * F.col("pos") / 2
    precision = F.try_divide(F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double"))
    out = s.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(pairs).alias("_pairs"),
        F.sum(F.col("pos") * precision).alias("_ap"))
    return out.select(
        *by, "n_pos", "n_neg",
        F.coalesce(F.try_divide(F.col("_pairs"), F.col("n_pos").cast("double") * F.col("n_neg")), F.lit(0.5)).alias("roc_auc"),
        F.coalesce(F.try_divide(F.col("_ap"), F.col("n_pos").cast("double")), F.lit(0.0)).alias("pr_auc"))


def score_cuts(df: DataFrame, score: str, parts: int = 1024) -> list[float]:
    """Scores that cut ``df`` into about even parts, for :func:`roc_area`; they decide speed only."""
    found = df.approxQuantile(score, [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted(set(found))


def roc_area(df: DataFrame, score: str, label: str, by: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """``roc_auc`` as in :func:`ranking_metrics`, for many groups of like scores, in one shuffle of the rows.

    Scores are ordered inside the part of a group between two cuts; a part's
    negatives pair with all positives of the higher parts by their number.
    """
    by = list(by)
    rows = df.select(*by, F.col(score).cast("double").alias("_s"), F.col(label).cast("long").alias("_y"))
    rows = Bucketizer(splits=[-math.inf, *(cuts or [0.0]), math.inf], inputCol="_s", outputCol="_part", handleInvalid="error").transform(rows)
    # a whole number, since a grouping by a double is shuffled once more after the rows were dealt by it
    rows = rows.withColumn("_part", F.col("_part").cast("int"))
    scores = rows.repartition(*by, "_part").groupBy(*by, "_part", "_s").agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    above = Window.partitionBy(*by, "_part").orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    higher = F.coalesce(F.sum("pos").over(above), F.lit(0)).cast("double")
    pairs = F.col("neg").cast("double") * (higher + F.col("pos") / 2)
    parts = scores.withColumn("_pairs", pairs).groupBy(*by, "_part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("_pairs").alias("_pairs"))
    ahead = Window.partitionBy(*by).orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    before = F.coalesce(F.sum("pos").over(ahead), F.lit(0)).cast("double")
    out = parts.withColumn("_pairs", F.col("_pairs") + F.col("neg").cast("double") * before).groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("_pairs").alias("_pairs"))
    return out.select(*by, "n_pos", "n_neg", F.coalesce(F.try_divide(F.col("_pairs"), F.col("n_pos").cast("double") * F.col("n_neg")), F.lit(0.5)).alias("roc_auc"))


def at_k(df: DataFrame, score: Column, label: str, amount: str, key: str, k: int) -> DataFrame:
    """Precision and money recovered among the k highest scores; the key breaks ties."""
    top = df.select(score.alias("_s"), F.col(label).alias("_y"), F.col(amount).alias("_a"), F.col(key).alias("_key"))
    top = top.orderBy(F.col("_s").desc(), F.col("_key")).limit(k)
    return top.agg(
        F.avg(F.col("_y").cast("double")).alias("precision"),
        F.coalesce(F.sum(F.col("_a") * F.col("_y")).cast("double"), F.lit(0.0)).alias("money_recovered"))


# How many accounts the policies are compared on.
POLICY_K = [50, 100, 200, 400]
#: Parts of a policy that are ranked apart before the final ranking.
SLICES = 64


def policy_scores(prob: str, amount: str, key: str) -> dict[str, Column]:
    """Four ways of ordering a book; the random one is a digest of the key, so it repeats."""
    return {
        "prob": F.col(prob).cast("double"), "ev": F.col(prob).cast("double") * F.col(amount).cast("double"),
        "incumbent": F.col(amount).cast("double"),
        "random": F.conv(F.substring(F.md5(F.concat(F.lit("42:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double"),
    }


def compare_policies(df: DataFrame, prob: str, label: str, amount: str, key: str, ks: Sequence[int] = tuple(POLICY_K)) -> DataFrame:
    """Precision and money per k for each policy, and the gain of expected value over biggest debt first.

    Every policy keeps its best max(k) rows, first in each slice of the keys and
    then among these: the first step spreads over the slices, the second sees at
    most slices times max(k) rows of a policy.
    """
    policies = policy_scores(prob, amount, key)
    long = df.select(
        F.col(key).alias("_key"), F.col(label).alias("_y"), F.col(amount).alias("_a"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("policy"), s.alias("score")) for n, s in policies.items()])).alias("_p"),
    ).select("_key", "_y", "_a", "_p.policy", "_p.score")
    order = [F.col("score").desc(), F.col("_key")]
    part = Window.partitionBy("policy", F.pmod(F.xxhash64("_key"), F.lit(SLICES))).orderBy(*order)
    long = long.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= max(ks)).drop("_r")
    w = Window.partitionBy("policy").orderBy(*order)
    best = long.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max(ks))
    hits = best.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter(F.col("_r") <= F.col("k"))
    cells = hits.groupBy("k", "policy").agg(
        F.avg(F.col("_y").cast("double")).alias("precision"), F.sum(F.col("_a") * F.col("_y")).cast("double").alias("money"))
    wide = cells.groupBy("k").pivot("policy", list(policies)).agg(F.first("precision").alias("p"), F.first("money").alias("m"))
    gain = F.col("ev_m") - F.col("incumbent_m")
    return wide.select(
        "k", *[F.col(f"{n}_p").alias(f"precision_{n}") for n in policies], *[F.col(f"{n}_m").alias(f"money_recovered_{n}") for n in policies],
        (F.col("ev_p") / F.greatest(F.col("incumbent_p"), F.lit(0.001))).alias("precision_gain_ratio"), gain.alias("money_lift"),
        (gain / F.greatest(F.col("incumbent_m"), F.lit(1.0)) * 100.0).alias("money_lift_pct"))


def summarise_folds(scores: DataFrame, metric_columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds, as long rows."""
    long = scores.unpivot([*by, "fold"], list(metric_columns), "metric", "value")
    return long.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds"))
