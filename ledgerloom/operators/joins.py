"""Join helpers: checked cardinality, outer joins that survive a hot key, frame comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def repeated_keys(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = _keys(on)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "inner", validate: str = "many_to_one") -> DataFrame:
    """Equi-join that fails first when a side which must be unique on the key is not."""
    sides = {"many_to_one": [right], "one_to_many": [left], "one_to_one": [left, right], "many_to_many": []}
    if validate not in sides:
        raise ValueError(f"unknown cardinality {validate!r}")
    for side in sides[validate]:
        bad = repeated_keys(side, on).limit(1).collect()
        if bad:
            raise ValueError(f"join key {_keys(on)} is not unique, e.g. {bad[0].asDict()}; expected {validate}")
    return left.join(right, _keys(on), how)


def left_outer(one: DataFrame, many: DataFrame, on) -> DataFrame:
    """Every row of ``one`` with its matches in ``many``, where ``many`` may hold a hot key.

    A left outer join cannot split its right side, so one hot key would run as
    one task. The matched part is an inner join, which adaptive execution can
    split on both sides, and the unmatched rows come from an anti-join with the
    distinct keys. ``one`` has few rows per key, so a task holds its share of
    it in a table and reads ``many`` past it, which needs no sort of ``many``.
    """
    keys = _keys(on)
    known = many.select(*keys).distinct()
    return many.join(one.hint("shuffle_hash"), keys, "inner").select(*one.columns, *[c for c in many.columns if c not in keys]).unionByName(
        one.join(known, keys, "left_anti"), allowMissingColumns=True)


def full_outer(one: DataFrame, many: DataFrame, on) -> DataFrame:
    """Full outer join in the same splittable form as :func:`left_outer`.

    The keys of ``one`` are met as they are shuffled for the inner join; making
    them distinct first would hold them in memory once more and change nothing.
    """
    keys = _keys(on)
    only_many = many.join(one.select(*keys).hint("shuffle_hash"), keys, "left_anti")
    return left_outer(one, many, on).unionByName(only_many, allowMissingColumns=True)


def flag_missing(df: DataFrame, known: DataFrame, key: str, flag: str) -> DataFrame:
    """Keep every row; mark those whose key is not in ``known`` (a NULL key is missing)."""
    keys = known.select(key).distinct().withColumn("_known", F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.col("_known").isNull()).drop("_known")


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows above the mean of their own column; the mean is a scalar subquery."""
    mean = df.agg(F.avg(column).alias("mean")).scalar()
    return df.filter(F.col(column) > mean)


def compare_frames(a: DataFrame, b: DataFrame, keys: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Differences between two keyed frames, one row per key and column that disagrees.

    A full outer join is used so that a key present on one side only is reported
    as well. ``tolerance`` applies to numbers; other types must be equal.
    """
    keys = list(keys)
    values = [c for c in a.columns if c not in keys]
    numeric = {f.name for f in a.schema if f.dataType.typeName() in
               ("byte", "short", "integer", "long", "float", "double", "decimal")}
    left = a.select(*keys, F.struct(*values).alias("_a"))
    right = b.select(*keys, F.struct(*values).alias("_b"))
    both = left.join(right, keys, "full")
    checks = []
    for c in values:
        x, y = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        if c in numeric:
            gap = F.abs(x.cast("double") - y.cast("double")) > F.lit(tolerance)
            differs = F.coalesce(gap, x.isNull() != y.isNull())
        else:
            differs = ~x.eqNullSafe(y)
        one_sided = F.col("_a").isNull() | F.col("_b").isNull()
        checks.append(
            F.when(one_sided | differs,
                   F.struct(F.lit(c).alias("column"), x.cast("string").alias("left_value"),
                            y.cast("string").alias("right_value")))
        )
    return (
        both.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("_d"))
        .select(*keys, "_d.column", "_d.left_value", "_d.right_value")
    )


def fanout_report(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Row counts before and after an inner join, without building the join.

    Each side is counted per key first, so the joined size is a sum of products.
    """
    keys = _keys(on)
    n_l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("l"))
    n_r = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("r"))
    return n_l.join(n_r, keys, "full").agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("joined_rows"),
        F.coalesce(F.max("r"), F.lit(0)).alias("max_matches"),
    )
