"""Promise and contact-sequence ledgers in batch form. The day of 'now' is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_window
from .ordered import next_at

# Days after the start on which a sequence step is sent; the step is numbered by its day, the first by 1.
STEPS = [(1, 0), (3, 3), (7, 7), (15, 15)]


def current_promises(ledger: DataFrame) -> DataFrame:
    """State of each promise from its event log: the latest event wins.

    ``ledger`` has ``promise_id``, ``event_time``, ``seq`` (ties), ``status`` and
    the promise's own columns, which only the first event has to carry.
    """
    rest = [c for c in ledger.columns if c not in ("promise_id", "event_time", "seq", "status")]
    order = F.struct("event_time", "seq")
    return ledger.groupBy("promise_id").agg(
        F.max_by("status", order).alias("status"), F.max("event_time").alias("changed_at"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest])


def auto_break(promises: DataFrame, as_of: str) -> DataFrame:
    """A pending promise whose day has passed is broken."""
    late = (F.col("status") == "PENDING") & (F.col("promise_date") < F.lit(as_of).cast("date"))
    return promises.withColumn("status", F.when(late, "BROKEN").otherwise(F.col("status")))


def list_promises(promises: DataFrame, as_of: str, status: str | None = None, officer: str | None = None,
                  account: int | None = None, n: int = 100) -> DataFrame:
    """Newest first, after the automatic breaks; officer by part of the name in any case."""
    out = auto_break(promises, as_of)
    if status:
        out = out.filter(F.upper("status") == status.upper())
    if officer:
        out = out.filter(F.lower("officer_name").contains(officer.lower()))
    if account is not None:
        out = out.filter(F.col("account_id") == account)
    return out.orderBy(F.col("created_at").desc(), "promise_id").limit(n)


def promise_summary(promises: DataFrame, as_of: str) -> DataFrame:
    """Counts, amounts and keep rate after the automatic breaks, in one aggregate."""
    df = auto_break(promises, as_of)
    counts, amounts = [], []
    for s in ("PENDING", "KEPT", "BROKEN"):
        hit = F.col("status") == s
        counts.append(F.count_if(hit).alias(f"{s.lower()}_count"))
        amounts.append(F.coalesce(F.sum(F.when(hit, F.col("amount_fcfa"))), F.lit(0)).cast("double").alias(f"{s.lower()}_amount_fcfa"))
    due = (F.col("status") == "PENDING") & (F.col("promise_date") <= F.lit(as_of).cast("date"))
    out = df.agg(F.count(F.lit(1)).alias("total_promises"), *counts, *amounts, F.count_if(due).alias("overdue_today"))
    return out.withColumn("keep_rate_pct", keep_rate(F.col("kept_count"), F.col("broken_count")))


def keep_rate(kept: Column, broken: Column) -> Column:
    """Kept share of the resolved promises in per cent with one decimal; 0 when none is resolved."""
    return F.coalesce(F.bround(F.try_divide(kept.cast("double"), (kept + broken).cast("double")) * 100, 1), F.lit(0.0))


def reminders_due(promises: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    return promises.filter((F.col("status") == "PENDING") & in_window(F.col("promise_date"), as_of, days))


# ---- contact sequences -------------------------------------------------------------------------

def start_sequences(accounts: DataFrame, started: str = "started_at") -> DataFrame:
    """One row per account with its schedule as a nested array; the first step is sent at once."""
    at = F.col(started)
    steps = [
        F.struct(F.lit(step).alias("step"), F.lit(day).alias("day_offset"), (at + F.make_dt_interval(F.lit(day))).alias("scheduled_at"),
                 F.lit("SENT" if day == 0 else "PENDING").alias("status"), (at if day == 0 else F.lit(None).cast("timestamp_ntz")).alias("sent_at"))
        for step, day in STEPS
    ]
    sent = F.array(F.struct(F.lit(1).alias("step"), F.lit(True).alias("sent")))
    return accounts.withColumns({"status": F.lit("ACTIVE"), "schedule": F.array(*steps), "messages_sent": sent})


def schedule_rows(sequences: DataFrame) -> DataFrame:
    """One row per sequence and step."""
    keep = [c for c in sequences.columns if c not in ("schedule", "messages_sent", "status")]
    return sequences.select(*keep, F.col("status").alias("sequence_status"), F.explode("schedule").alias("_s")).select(
        *keep, "sequence_status", F.col("_s.step").alias("step"), F.col("_s.day_offset").alias("day_offset"),
        F.col("_s.scheduled_at").alias("scheduled_at"), F.col("_s.status").alias("step_status"))


def sends_due(sequences: DataFrame, now: str) -> DataFrame:
    """Steps to send now: active sequence, pending step, time reached."""
    rows = schedule_rows(sequences)
    return rows.filter((F.col("sequence_status") == "ACTIVE") & (F.col("step_status") == "PENDING") & (F.col("scheduled_at") <= F.lit(now).cast("timestamp_ntz")))


def stop_on_payment(sequences: DataFrame, payments: DataFrame, now: str, account: str = "account_id", started: str = "started_at") -> DataFrame:
    """Stop a sequence at the account's first payment after its start.

    Steps that would have been sent at or after the payment leave the schedule.
    """
    made = payments.filter(F.col("paid_at") <= F.lit(now).cast("timestamp_ntz"))
    out = next_at(sequences, made, account, started, "paid_at", "stopped_at")
    paid = F.col("stopped_at").isNotNull()
    kept = F.filter("schedule", lambda s: F.coalesce(s["scheduled_at"] < F.col("stopped_at"), F.lit(True)))
    return out.withColumns({
        "schedule": kept, "status": F.when(paid & (F.col("status") == "ACTIVE"), "STOPPED").otherwise(F.col("status")),
        "stop_reason": F.when(paid, "Payment received")})


def sequence_summary(sequences: DataFrame) -> DataFrame:
    active, stopped = F.col("status") == "ACTIVE", F.col("status") == "STOPPED"
    return sequences.agg(
        F.count(F.lit(1)).alias("total_sequences"), F.count_if(active).alias("active_sequences"), F.count_if(stopped).alias("stopped_sequences"),
        F.coalesce(F.sum(F.size("messages_sent").cast("bigint")), F.lit(0)).alias("total_messages_sent"),
        F.countDistinct(F.when(active, F.col("account_id"))).alias("accounts_in_sequence"))


def accounts_in_sequence(sequences: DataFrame) -> DataFrame:
    """The distinct accounts with an active sequence, as rows rather than one collected list."""
    return sequences.filter(F.col("status") == "ACTIVE").select("account_id").distinct()


def list_sequences(sequences: DataFrame, account: int | None = None, status: str | None = None, limit: int = 50, started: str = "started_at") -> DataFrame:
    """Newest sequences first, of one account or one status (any case) if asked; the account breaks ties. A report of ``limit`` rows."""
    out = sequences
    if account is not None:
        out = out.filter(F.col("account_id") == account)
    if status:
        out = out.filter(F.upper("status") == status.upper())
    return out.orderBy(F.col(started).desc(), "account_id").limit(limit)
