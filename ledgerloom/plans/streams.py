"""Streaming forms, run over files of the events table and checked against the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from ..streaming import intake, logs
from ..streaming.promises import resolve_promises
from . import ledgers as lg
from .collections import FEEDBACK, feedback_log
from .ledgers import PROMISES
from .registry import Registry
from .tables import with_sql

R = Registry()
FILES = 4  # files per time slice, taken together by one trigger


def _as_files(df: DataFrame, spark: SparkSession, time: str, name: str, parts: int = 4) -> str:
    """The rows as slices in time order, the way a source would deliver them."""
    path = new_path(spark, name)
    bounds = [] if parts == 1 else df.agg(F.expr(f"percentile_approx(unix_micros(cast({time} AS timestamp)), array({', '.join(str(i / parts) for i in range(1, parts))}))").alias("b")).first()["b"]
    at = F.unix_micros(F.col(time).cast("timestamp"))
    edges = [None, *bounds, None]
    for i in range(parts):
        cond = F.lit(True)
        if edges[i] is not None:
            cond = cond & (at > edges[i])
        if edges[i + 1] is not None:
            cond = cond & (at <= edges[i + 1])
        df.filter(cond).repartition(FILES).write.mode("append").parquet(path)
    return path


def _promise_events(spark: SparkSession, sf: str) -> DataFrame:
    ledger = lg.promise_ledger(spark, sf)
    due = (F.date_add(F.col("created_at").cast("date"), lg.KEEP_DAYS + 1)).cast("timestamp")
    return ledger.select(
        F.concat_ws("-", "promise_id", "seq").alias("event_id"), "promise_id", "status", F.col("event_time").cast("timestamp").alias("event_time"),
        F.coalesce(due, F.col("event_time").cast("timestamp")).alias("due"))


def _finish(query) -> None:
    query.awaitTermination()


@R.query("stream_promise_lifecycle", with_sql(PROMISES, body="""
, wm AS (SELECT max(coalesce(kept_at, created_at)) AS m FROM prom)
SELECT promise_id, CASE WHEN kept_at IS NOT NULL THEN 'KEPT' ELSE 'BROKEN' END AS status FROM prom, wm WHERE kept_at IS NOT NULL OR promise_date + 1 <= m - INTERVAL 1 HOUR"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Promises resolved by the stream; a promise whose day the watermark has not passed stays open."""
    events = _promise_events(spark, sf)
    path = _as_files(events, spark, "event_time", "ledger-stream")
    out, checkpoint = new_path(spark, "resolved"), new_path(spark, "resolved-checkpoint")
    stream = resolve_promises(logs.read_events(spark, path, events.schema, FILES))
    _finish(stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet"))
    return spark.read.schema(stream.schema).parquet(out).select("promise_id", "status")


@R.query("stream_promise_out_of_order", with_sql(PROMISES, body="""
, wm AS (SELECT max(coalesce(kept_at, created_at)) AS m FROM prom)
SELECT promise_id, CASE WHEN kept_at IS NOT NULL THEN 'KEPT' ELSE 'BROKEN' END AS status FROM prom, wm WHERE kept_at IS NOT NULL OR promise_date + 1 <= m - INTERVAL 1 HOUR"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same answer, once per promise, when updates overtake their promises and every event comes twice."""
    events = _promise_events(spark, sf)
    path = _as_files(events.filter("status <> 'PENDING'").unionByName(events), spark, "event_time", "ledger-late", parts=1)
    out, checkpoint = new_path(spark, "resolved-late"), new_path(spark, "resolved-late-checkpoint")
    stream = resolve_promises(logs.read_events(spark, path, events.schema, FILES))
    _finish(stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet"))
    return spark.read.schema(stream.schema).parquet(out).select("promise_id", "status")


@R.query("stream_latest_feedback", with_sql(FEEDBACK, body="SELECT SK_ID_CURR, feedback_delta FROM fb"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    log = feedback_log(spark, sf)
    path = _as_files(log, spark, "ts", "feedback-stream")
    out, checkpoint = new_path(spark, "feedback"), new_path(spark, "feedback-checkpoint")
    _finish(logs.latest_feedback_stream(logs.read_events(spark, path, log.schema, FILES), out, checkpoint, "SK_ID_CURR", "outcome", "ts", "event_id"))
    return logs.latest_feedback(spark, out, "SK_ID_CURR")


@R.query("stream_contact_log", """
SELECT event_id AS outcome_id, user_id AS account_id, CAST(ts AS DATE) AS created_date FROM events WHERE event_type = 'click'""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Contact outcomes through a stream that drops repeated deliveries: each is delivered twice here."""
    log = lg.contact_log(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp"))
    path = _as_files(log.unionByName(log), spark, "created_at", "contact-stream")
    out, checkpoint = new_path(spark, "contact-log"), new_path(spark, "contact-log-checkpoint")
    _finish(logs.append_log_stream(logs.read_events(spark, path, log.schema, FILES), out, checkpoint, "outcome_id", "created_at"))
    return spark.read.parquet(out).select("outcome_id", "account_id", F.col("created_date").cast("date").alias("created_date"))


@R.query("stream_payments_per_account", """
SELECT user_id AS account_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS paid, count(*) AS payments FROM events WHERE event_type = 'purchase' AND value > 0 GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a stream in which every payment is delivered twice."""
    pay = lg.payments(spark, sf).withColumn("paid_at", F.col("paid_at").cast("timestamp"))
    path = _as_files(pay.unionByName(pay), spark, "paid_at", "payment-stream")
    out, checkpoint = new_path(spark, "payment-totals"), new_path(spark, "payment-totals-checkpoint")
    _finish(logs.payments_per_account_stream(logs.read_events(spark, path, pay.schema, FILES), out, checkpoint))
    return logs.payment_table(spark, out).read().select("account_id", F.col("paid").cast("double").alias("paid"), "payments")


@R.query("payment_file_reconciliation", with_sql("""
bal AS (SELECT user_id AS account_id, sum(CAST(value AS DECIMAL(18,2))) AS due FROM events WHERE event_type = 'error' GROUP BY 1),
p AS (SELECT user_id AS account_id, CAST(value AS DECIMAL(18,2)) AS amount, event_id % 50 AS k FROM events WHERE event_type = 'purchase'),
r AS (SELECT p.*, due, CASE WHEN k = 1 THEN 'unreadable_account' WHEN k = 0 THEN 'unreadable_amount' WHEN k = 2 OR amount <= 0 THEN 'amount_not_positive' WHEN due IS NULL THEN 'unknown_account' ELSE 'booked' END AS kind
  FROM p LEFT JOIN bal USING (account_id))""", body="""
SELECT kind, account_id, count(*) AS payments, CAST(sum(amount) AS DOUBLE) AS amount, CAST(least(max(due), sum(amount)) AS DOUBLE) AS applied, count(*) AS audit_rows FROM r WHERE kind = 'booked' GROUP BY 1, 2
UNION ALL SELECT kind, NULL, count(*), NULL, NULL, 0 FROM r WHERE kind <> 'booked' GROUP BY 1
UNION ALL SELECT 'missing_columns', NULL, 1, NULL, NULL, 0"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Payments delivered as files under three headers and one that lacks the amount: what was booked, rejects by rule, audit rows."""
    path, out, checkpoint = (new_path(spark, n) for n in ("payment-files", "payment-booking", "payment-booking-checkpoint"))
    k = F.pmod("payment_id", F.lit(50))
    pay = lg.payments(spark, sf).select(
        F.when(k == 1, "x").otherwise(F.col("account_id").cast("string")).alias("a"),
        F.when(k == 0, "n/a").when(k == 2, "-5.00").otherwise(F.col("amount").cast("string")).alias("b"), "paid_at", "payment_id")
    for i, (a, b) in enumerate((("SK_ID_CURR", "Amount"), (" Account_ID ", "amount_paid"), ("client_id", "PAID"))):
        given = pay.filter(F.pmod("payment_id", F.lit(3)) == i).select(F.col("a").alias(a), F.col("b").alias(b), "paid_at", "payment_id")
        given.repartition(FILES).write.option("header", True).csv(f"{path}/header-{i}")
    pay.limit(3).coalesce(1).select(F.col("a").alias("account_id")).write.option("header", True).csv(f"{path}/header-3")
    _finish(intake.book_payment_files(intake.new_files(spark, f"{path}/*/*.csv", FILES), lg.balances(spark, sf), out, checkpoint, fold_after=2))
    audit = intake.read_result(spark, out, "audit").groupBy("account_id").agg(F.count(F.lit(1)).alias("audit_rows"))
    booked = intake.read_result(spark, out, "booked").groupBy("account_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("double").alias("amount"), F.sum(F.col("due_before") - F.col("due_after")).cast("double").alias("applied"))
    rest = intake.read_result(spark, out, "rejected").select("reject_rule").unionByName(intake.read_result(spark, out, "files").select("reject_rule"))
    rules = rest.groupBy(F.col("reject_rule").alias("kind")).agg(F.count(F.lit(1)).alias("payments")).withColumn("audit_rows", F.lit(0).cast("bigint"))
    return booked.join(audit, "account_id").withColumn("kind", F.lit("booked")).unionByName(rules, allowMissingColumns=True).select("kind", "account_id", "payments", "amount", "applied", "audit_rows")
