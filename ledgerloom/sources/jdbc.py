"""Database tables through Spark's JDBC source.

The backend is chosen by the URL. A large read is split on a numeric column so
that each task fetches its own range; writes go in batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Driver class by URL prefix.
DRIVERS = {
    "jdbc:postgresql:": "org.postgresql.Driver",
    "jdbc:mysql:": "com.mysql.cj.jdbc.Driver",
    "jdbc:sqlite:": "org.sqlite.JDBC",
}
BATCH_SIZE = 5000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    driver = next((d for prefix, d in DRIVERS.items() if url.startswith(prefix)), None)
    if driver is None:
        raise ValueError(f"no driver known for {url.split('//')[0]}")
    opts = {"url": url, "dbtable": table, "driver": driver}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def read_table(spark: SparkSession, options: dict[str, str], split_on: str | None = None,
               lower: int | None = None, upper: int | None = None, partitions: int = 1) -> DataFrame:
    reader = spark.read.format("jdbc").options(**options)
    if split_on is not None:
        if lower is None or upper is None:
            raise ValueError("a split read needs the lower and upper bound of its column")
        reader = reader.options(partitionColumn=split_on, lowerBound=str(lower), upperBound=str(upper),
                                numPartitions=str(partitions))
    return reader.load()


def append_table(df: DataFrame, options: dict[str, str], batch_size: int = BATCH_SIZE) -> None:
    df.write.format("jdbc").options(**options).option("batchsize", str(batch_size)).mode("append").save()
