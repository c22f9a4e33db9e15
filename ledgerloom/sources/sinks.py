"""Writing results. Every write goes to a path of its own; no job overwrites what it reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import first_per_key
from ..session import shuffles_freed
from .files import JSON_TIME


def new_rows(target: DataFrame, delivery: DataFrame, key: str | Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Rows of a delivery whose key is not in the target yet, one per key (the first)."""
    keys = [key] if isinstance(key, str) else list(key)
    first = first_per_key(delivery, keys, ordinal).select(*target.columns)
    return first.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(spark: SparkSession, path: str, delivery: DataFrame, key: str | Sequence[str],
                     ordinal: Sequence[str], columns: Sequence[str]) -> int:
    """Append the rows whose key is new; loading the same delivery twice changes nothing.

    Returns the number of rows added. The new rows are written to a side path
    first and appended from there, so the table is never read while written.
    """
    from ..session import materialize
    from .files import path_exists

    if path_exists(spark, path):
        target = spark.read.parquet(path)
        fresh = materialize(new_rows(target, delivery, key, ordinal), "insert")
    else:
        keys = [key] if isinstance(key, str) else list(key)
        fresh = materialize(first_per_key(delivery, keys, ordinal).select(*columns), "insert")
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    with shuffles_freed(df.sparkSession):
        df.write.option("header", True).option("compression", compression).csv(path)


def write_json_documents(df: DataFrame, path: str) -> None:
    """One document per line, times to the microsecond."""
    df.write.option("timestampNTZFormat", JSON_TIME).json(path)


def append_log(df: DataFrame, path: str, time: str = "created_at") -> None:
    """Append audit rows, partitioned by day."""
    df.withColumn("created_date", F.col(time).cast("date")).write.mode("append").partitionBy("created_date").parquet(path)


def recent(df: DataFrame, time: str, key: str, n: int = 50) -> DataFrame:
    """Newest ``n`` rows; the key breaks ties."""
    return df.orderBy(F.col(time).desc(), F.col(key).desc()).limit(n)


def metrics_long(rows: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """A wide metrics frame as (ids, metric, value) rows."""
    values = [c for c in rows.columns if c not in id_columns]
    return rows.unpivot(list(id_columns), [F.col(c).cast("double").alias(c) for c in values], "metric", "value")


def write_metrics(rows: DataFrame, path: str, name: str, id_columns: Sequence[str]) -> None:
    """Write the metrics document ``name`` of a comparison as (ids, metric, value) rows, beside those of other comparisons; a rerun replaces its own."""
    metrics_long(rows, id_columns).write.mode("overwrite").json(f"{path}/document={name}")


def read_metrics(spark: SparkSession, path: str, ids: str, names: Sequence[str] | None = None) -> DataFrame:
    """Rows of all metrics documents, or of ``names``, with the column ``document``; ``ids`` is the DDL of the id columns."""
    df = spark.read.schema(f"{ids}, metric string, value double, document string").json(path)
    return df if names is None else df.filter(F.col("document").isin(list(names)))
