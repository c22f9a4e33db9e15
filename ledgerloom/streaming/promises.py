"""Promise lifecycle as a stream: promises joined with their updates, and broken by event time.

Both sides are streams of built-in operators. A promise waits as PENDING in the
join's state until an update arrives or the watermark passes its day; an update
waits for its promise. State is keyed by the promise itself, so a busy account
spreads over many keys. The batch form is :mod:`ledgerloom.operators.ledgers`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _timed(ledger: DataFrame, kind: Column, time: str, lateness: str) -> DataFrame:
    """Events of one kind, each once. All events move the watermark, so ``kind`` is asked above it: it reads the time, which keeps it from being pushed below."""
    timed = ledger.withColumn("_kind", kind).withWatermark(time, lateness)
    return timed.filter(F.when(F.col("_kind"), F.col(time)).isNotNull()).dropDuplicatesWithinWatermark(["event_id"])


def resolve_promises(ledger: DataFrame, lateness_minutes: int = 60, longest_days: int = 31) -> DataFrame:
    """Resolved promises of a ledger stream, one row each: KEPT when an update says so, BROKEN when the day has passed.

    ``ledger`` has ``event_id``, ``promise_id``, ``status``, ``event_time`` and
    ``due`` (the first moment after the promised day). Repeated deliveries of an
    event are dropped. An update counts up to ``due`` in event time and may come
    before its promise; the first to arrive resolves the promise, and one that
    comes after the promise is broken adds nothing. A quiet stream breaks
    nothing: time moves with the events.

    ``longest_days`` is the longest term of a promise, for so long an update is
    kept for a promise yet to come. A promise with a longer term is an error, one
    without a day has this term.
    """
    lateness = f"{lateness_minutes} minutes"
    pending = F.coalesce(F.col("status") == "PENDING", F.lit(False))
    term = F.make_dt_interval(F.lit(longest_days))
    last = F.col("event_time") + term
    due = F.when(F.col("due") > last, F.raise_error(F.lit(f"a promise has a term of more than {longest_days} days")).cast("timestamp")).otherwise(F.coalesce("due", last))
    # an update is no promise, but its time is the least that days can be over by
    by_day = ledger.withColumn("day_over", F.when(pending, due).otherwise(F.col("event_time")))
    made = _timed(by_day, pending, "day_over", lateness).select("promise_id", "day_over")
    updates = _timed(ledger, ~pending, "event_time", lateness).select(F.col("promise_id").alias("updated_id"), F.col("status").alias("update"), F.col("event_time").alias("changed_at"))
    span = f"INTERVAL {longest_days * 1440 + lateness_minutes} MINUTES"
    met = F.expr(f"promise_id = updated_id AND changed_at <= day_over AND day_over <= changed_at + {span}")
    joined = made.join(updates, met, "left_outer").select("promise_id", "day_over", F.coalesce("update", F.lit("BROKEN")).alias("status"), F.coalesce("changed_at", "day_over").alias("changed_at"))
    return joined.dropDuplicatesWithinWatermark(["promise_id"]).select("promise_id", "status", "changed_at")
