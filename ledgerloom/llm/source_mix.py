"""Mixing sources to target weights by repetition rates.

Sizes are summed per source; targets share a budget by weight, no source above
``ceiling`` times its size, what is cut off shared again by weight. The rate of a
source is target / size. A document is taken floor(rate) times plus once more
with probability frac(rate), drawn from a digest of its id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE
from ledgerloom.session import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CEILING = 2
SEED = "mix"
#: Sources whose targets are sent to every task.
BROADCAST_SOURCES = 10_000


def word_count(text: str = "text") -> Column:
    """Words of the whole text; NULL has none."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), "")).cast("bigint")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", weights=WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING) -> DataFrame:
    """One row per source: ``source_size``, ``weight`` and ``target`` (words).

    The shared level is found from running sums over the sources ordered by
    ceiling / weight: a source is at its ceiling exactly if those before it are
    and the level of the rest still reaches it. The windows see one row per
    source, never documents.
    """
    sums = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("bigint")
    w = sums.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * ceiling)
    order = W.orderBy(F.col("_cap") / F.col("weight"), F.col(source).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    before = w.withColumns({
        "_all": F.sum("source_size").over(everything), "_weights": F.sum("weight").over(everything),
        "_caps_before": F.coalesce(F.sum("_cap").over(order), F.lit(0)), "_weights_before": F.coalesce(F.sum("weight").over(order), F.lit(0))})
    level = (F.col("_all") * F.lit(float(budget)) - F.col("_caps_before")) / (F.col("_weights") - F.col("_weights_before"))
    # the level of the first source that stays below its ceiling holds for all of them
    found = before.withColumn("_level", level).withColumn(
        "_shared", F.min(F.when(F.col("_level") * F.col("weight") < F.col("_cap"), F.struct(F.col("_weights_before"), F.col("_level")))).over(everything)["_level"])
    target = F.when(F.col("_shared").isNull(), F.col("_cap").cast("double")).otherwise(F.least(F.col("_cap").cast("double"), F.col("_shared") * F.col("weight")))
    return found.select(source, "source_size", "weight", target.alias("target"))


def draw(ident: str, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of seed and id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(ident).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def mix(docs: DataFrame, ident: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``copies``.

    NULL texts have size 0; the NULL source is a source like any other, last in
    order; a source of size 0 has target 0 and is not taken. Rows that share an
    id draw the same number. Columns of these names in ``docs`` are replaced.
    """
    fresh = ["size", "source_size", "target", "copies"]
    base = docs.drop(*fresh).withColumn("size", word_count(text))
    targets = source_targets(base.select(F.col(source).alias("_mix_source"), "size"), "_mix_source", "size", weights, budget, ceiling)
    # one row per source: sent to all tasks if they are counted to be few, so that documents need not move; else joined by shuffle
    targets = materialize(targets.drop("weight"), "targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    joined = base.join(targets, base[source].eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + F.when(draw(ident, seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("bigint"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each document as many times as it was taken, numbered from 0 in ``copy``."""
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
