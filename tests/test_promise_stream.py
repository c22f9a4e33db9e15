"""Promises resolved by a join of two streams: order of arrival, repeats, late updates, terms."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from ledgerloom.streaming.logs import read_events
from ledgerloom.streaming.promises import resolve_promises

SCHEMA = "event_id string, promise_id string, status string, event_time timestamp, due timestamp"
T = dt.datetime(2025, 1, 1, 12)


def at(hours):
    return T + dt.timedelta(hours=hours)


def promise(p, made, due):
    return (f"{p}-0", p, "PENDING", at(made), None if due is None else at(due))


def kept(p, when, k=1):
    return (f"{p}-{k}", p, "KEPT", at(when), None)


def resolved(spark, tmp_path, deliveries, **options):
    """Rows of the sink after each delivery was one trigger."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = resolve_promises(read_events(spark, path, SCHEMA), **options)
        stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    return sorted((r.promise_id, r.status, r.changed_at) for r in spark.read.schema("promise_id string, status string, changed_at timestamp").parquet(out).collect())


def test_order_repeats_and_late_updates(spark, tmp_path):
    first = [kept("early", 1), promise("late", 0, 24), promise("twice", 0, 48), promise("twice", 0, 48)]
    second = [promise("early", 0.8, 24), kept("early", 1), kept("twice", 2), kept("twice", 3, k=2), kept("nobody", 2)]
    third = [promise("open", 30, 72), kept("late", 25)]  # kept after its day, while time has not reached it
    fourth = [kept("late", 26, k=2), kept("twice", 31, k=3), promise("other", 31, 90)]
    got = resolved(spark, tmp_path, [first, second, third, fourth])
    by = {p: (s, t) for p, s, t in got}
    assert len(got) == len(by)  # one row each
    assert by.keys() == {"early", "late", "twice"}
    assert by["early"] == ("KEPT", at(1))
    assert by["late"] == ("BROKEN", at(24))
    assert by["twice"][0] == "KEPT" and by["twice"][1] in (at(2), at(3))


def test_updates_without_promises_move_time(spark, tmp_path):
    got = resolved(spark, tmp_path, [[promise("p", 0, 24)], [kept("nobody", 26)]])
    assert got == [("p", "BROKEN", at(24))]


def test_a_term_above_the_longest_is_an_error_and_none_is_the_longest(spark, tmp_path):
    got = resolved(spark, tmp_path, [[promise("p", 0, None)], [kept("nobody", 24 * 3 + 2)]], longest_days=3)
    assert got == [("p", "BROKEN", at(72))]
    with pytest.raises(StreamingQueryException, match="more than 3 days"):
        resolved(spark, tmp_path / "more", [[promise("p", 0, 73)]], longest_days=3)


def test_no_python_in_the_plan(spark, tmp_path):
    spark.createDataFrame([promise("p", 0, 1)], SCHEMA).write.parquet(str(tmp_path / "in"))
    query = resolve_promises(read_events(spark, str(tmp_path / "in"), SCHEMA)).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out"), format="parquet")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in plan and "Python" not in plan and "Pandas" not in plan
