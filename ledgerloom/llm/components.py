"""Connected components of an edge table by alternating star operations.

Every round points the neighbours of a node at the least node among them, first
for larger neighbours, then for smaller ones; edges stay a table in the shared
folder and only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import discard, new_path


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (a, b: integers); the root is the least node of its component.

    Loops, repeated edges and edges in both directions do not matter; a NULL end is no edge.
    """
    spark = edges.sparkSession
    clean = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = new_path(spark, "edges")
    current, seen = _written(clean, path), None
    while True:
        mark = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen or not mark[0]:
            break
        seen, following = mark, new_path(spark, "edges")
        current = _written(_small_star(_large_star(current)), following)
        discard(spark, path)
        path = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
