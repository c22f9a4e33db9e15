"""Global order without a one-partition window.

A window with no partition key, or with a key that holds a third of the rows,
runs in a single task. Here the rows are range-partitioned instead: each task
numbers its own slice, the slice totals (one small row per slice) are summed
up, and the totals are added back as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def _sliced(df: DataFrame, order: Sequence[Column], range_columns: int | None = None) -> DataFrame:
    """Rows with ``_slice`` and ``_seq``, in the given order across slices.

    Written out once: slice bounds come from a sample, so two branches that
    recomputed them could disagree.
    """
    parts = order[:range_columns] if range_columns else order
    out = df.repartitionByRange(*parts).sortWithinPartitions(*order)
    out = out.withColumn("_id", F.monotonically_increasing_id())
    out = out.withColumn("_slice", F.shiftright("_id", _SLICE_BITS).cast("int"))
    out = out.withColumn("_seq", F.col("_id").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))).drop("_id")
    return materialize(out, "ordered")


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Global row number from 1, in ``order``. The order must end with a unique key."""
    rows = _sliced(df, order)
    sizes = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    start = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(start), F.lit(0)).alias("_offset"))
    return (
        rows.join(F.broadcast(offsets), "_slice")  # one row per slice
        .withColumn(name, F.col("_offset") + F.col("_seq") + 1)
        .drop("_slice", "_seq", "_offset")
    )


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Running totals, this row included, over a global order with a unique last key."""
    names = list(sums)
    rows = _sliced(df.select("*", *[c.alias(f"_v_{n}") for n, c in sums.items()]), order)
    totals = rows.groupBy("_slice").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names])
    inside = Window.partitionBy("_slice").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_r_{n}") for n in names])
    out = out.join(F.broadcast(offsets), "_slice")  # one row per slice
    keep = df.columns + [(F.col(f"_r_{n}") + F.col(f"_o_{n}")).alias(n) for n in names]
    return out.select(*keep)


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Running total per group, this row included, safe for a group of any size.

    A group that spans several slices carries its earlier slices' totals forward;
    that table has at most one row per group and slice.
    """
    group = list(group)
    rows = _sliced(df, [F.col(g) for g in group] + list(order))
    carry = rows.groupBy(*group, "_slice").agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(*group, "_slice", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_slice", *group).orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_run", F.sum(value).over(inside))
        .join(carry, group + ["_slice"])
        .select(*df.columns, (F.col("_run") + F.col("_before")).alias(name))
    )


def dense_rank_of(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """Global dense rank of a column: only its distinct values are ordered."""
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct()
    order = F.col(value).desc() if descending else F.col(value).asc()
    return df.join(with_position(distinct, [order], name), value, "left")


def next_at(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, name: str) -> DataFrame:
    """Each left row with the first right time at or after its own, per key (NULL when none follows).

    An as-of join without pairs: both sides are put in one order by key and
    time, and every row looks ahead inside its slice, then to the key's later
    slices. A key of any size spreads over many slices.
    """
    rows = left.select(key, F.col(left_time).alias("_at"), F.lit(0).alias("_kind"), F.struct(*left.columns).alias("_row")).unionByName(
        right.select(key, F.col(right_time).alias("_at"), F.lit(1).alias("_kind")), allowMissingColumns=True)
    rows = _sliced(rows, [F.col(key), F.col("_at"), F.col("_kind")])
    hit = F.when(F.col("_kind") == 1, F.col("_at"))
    later = rows.groupBy(key, "_slice").agg(F.min(hit).alias("_first"))
    after = Window.partitionBy(key).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = later.select(key, "_slice", F.min("_first").over(after).alias("_later"))
    ahead = Window.partitionBy("_slice", key).orderBy(F.col("_seq").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("_next", F.min(hit).over(ahead)).filter(F.col("_kind") == 0)
    return found.join(later, [key, "_slice"]).select("_row.*", F.coalesce("_next", "_later").alias(name))
