"""A table laid out for lookups by key: files hold ranges of the key, and a manifest tells which.

Rows are range-partitioned by the key and sorted inside each file, with a bloom
filter on the key; the manifest has one row per file with the least and the
greatest key. A lookup reads the manifest, then only the files whose range holds
the key. A key of any number of rows spreads over as many files as it needs, if
a second column is given to split it by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, key: str, files: int, then: Sequence[str] = ()) -> None:
    """Write ``df`` to ``path``/data in ``files`` ranges of ``key`` (then of ``then``), and its manifest to ``path``/manifest.

    NULL keys are in the first range. The manifest is written last, so a table
    without one is not finished.
    """
    spark, order = df.sparkSession, [key, *then]
    laid = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    laid.write.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{path}/data")
    written = spark.read.parquet(f"{path}/data")
    ranges = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("n_null"))
    # one row per file
    ranges.coalesce(1).write.parquet(f"{path}/manifest")


def files_with(spark: SparkSession, path: str, value) -> list[str]:
    """Paths of the files whose range holds ``value`` (None: rows without a key)."""
    manifest = spark.read.parquet(f"{path}/manifest")
    hit = F.col("n_null") > 0 if value is None else (F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))
    return [f"{path}/data/{r['file']}" for r in manifest.filter(hit).select("file").orderBy("file").collect()]


def lookup(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """Rows whose ``key`` is ``value`` (None: NULL); only the files that can hold it are opened."""
    schema = spark.read.parquet(f"{path}/data").schema
    found = files_with(spark, path, value)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found).filter(F.col(key).eqNullSafe(F.lit(value)))
