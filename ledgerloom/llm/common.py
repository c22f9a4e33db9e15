"""Shared helpers of the training-data operators: whole-text task functions and stable row numbers."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ledgerloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space of the contracts; words are what stands between it.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict | None], Iterable]], schema: str | StructType, last: bool = False) -> DataFrame:
    """Run ``make()`` once per task and its result on every Arrow batch.

    The function gets a dict of Python lists by column and returns the output
    columns in the order of ``schema``. With ``last`` it is called with None once
    more when the task has seen all its rows.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def task(batches):
        fn = make()
        for batch in chain(batches, [None] * last):
            columns = fn(batch if batch is None else dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns))))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(task, kind)


def map_text(df: DataFrame, make: Callable[[], Callable[[list[str]], Iterable]], new: str, keep: list[str], text: str = "text") -> DataFrame:
    """Keep the columns ``keep`` and add ``new`` (DDL), computed from whole texts; NULL counts as empty."""
    kept = [df.schema[c] for c in keep]
    added = StructType.fromDDL(new)

    def factory():
        fn = make()

        def run(batch: dict) -> list:
            return [*(batch[f.name] for f in kept), *fn([t or "" for t in batch["_text"]])]

        return run

    schema = StructType([*(StructField(f.name, f.dataType, True) for f in kept), *added.fields])
    return map_batches(df.select(*keep, F.col(text).alias("_text")), factory, schema)


def numbered(df: DataFrame, name: str, row: str = "_row") -> DataFrame:
    """Write ``df`` with a number for each row, so that every later reader sees the same numbers."""
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), name)
