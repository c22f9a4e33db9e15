"""Streams that need only built-in operators: audit log, last feedback per account, payments per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.decisions import feedback_delta
from .epochs import EpochTable


def read_events(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def append_log_stream(events: DataFrame, out: str, checkpoint: str, key: str, time: str, lateness: str = "1 hour") -> StreamingQuery:
    """Append events to a log partitioned by day, each event once."""
    df = events.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key]).withColumn("created_date", F.col(time).cast("date"))
    return df.writeStream.partitionBy("created_date").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet", outputMode="append")


def feedback_table(spark: SparkSession, out: str, account: str, fold_after: int = 8) -> EpochTable:
    """Newest outcome of each account, as ``last`` (time, key, change of probability)."""
    return EpochTable(spark, out, [account], lambda: [F.max("last").alias("last")], fold_after)


def latest_feedback_stream(log: DataFrame, out: str, checkpoint: str, account: str, outcome: str, time: str, key: str, fold_after: int = 8) -> StreamingQuery:
    """Change of probability per account, last outcome wins. Each epoch writes its own newest outcomes; the stream keeps no state."""
    table = feedback_table(log.sparkSession, out, account, fold_after)
    newest = F.max(F.struct(F.col(time).alias("at"), F.col(key).alias("key"), feedback_delta(F.col(outcome)).alias("delta"))).alias("last")

    def save(batch: DataFrame, epoch: int) -> None:
        table.save(batch.groupBy(account).agg(newest), epoch)

    return log.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def latest_feedback(spark: SparkSession, out: str, account: str) -> DataFrame:
    """Current value per account."""
    return feedback_table(spark, out, account).read().select(account, F.col("last.delta").alias("feedback_delta"))


def payment_table(spark: SparkSession, out: str, account: str = "account_id", fold_after: int = 8) -> EpochTable:
    """``paid`` and ``payments`` of each account."""
    return EpochTable(spark, out, [account], lambda: [F.sum("paid").cast("decimal(38,2)").alias("paid"), F.sum("payments").alias("payments")], fold_after)


def payments_per_account_stream(payments: DataFrame, out: str, checkpoint: str, account: str = "account_id", key: str = "payment_id", time: str = "paid_at", lateness: str = "1 hour", fold_after: int = 8) -> StreamingQuery:
    """Total and count of positive payments per account, for reconciliation against balances.

    A payment delivered again within the lateness counts once; the keys seen in
    that time are the only state. Each epoch writes its own sums.
    """
    table = payment_table(payments.sparkSession, out, account, fold_after)
    once = payments.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key]).filter(F.col("amount") > 0)

    def save(batch: DataFrame, epoch: int) -> None:
        table.save(batch.groupBy(account).agg(F.sum("amount").cast("decimal(38,2)").alias("paid"), F.count(F.lit(1)).alias("payments")), epoch)

    return once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
