"""Promise, contact and payment ledgers built from the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalise_phone, phone_provider
from ..operators import decisions as dec
from ..operators import ledgers as led
from ..operators import reports as rep
from ..operators import routing
from ..operators.ordered import next_at
from ..session import new_path
from ..sources import schemas
from ..sources.files import read_json_documents
from ..sources.sinks import append_log, recent, write_json_documents
from . import tables as t
from .registry import Registry
from .tables import with_sql

R = Registry()
AS_OF = "2024-01-29"
NOW = "2024-01-20 00:00:00"
KEEP_DAYS = 3


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def officer(user: Column) -> Column:
    k = F.pmod(user, F.lit(7))
    return F.when(k == 0, "System").when(k == 1, "officer").otherwise(F.concat(F.lit("Agent "), k.cast("string")))


def _events(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return t.table(spark, sf, "events").filter(F.col("event_type") == kind)


def payments(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "purchase").select(
        F.col("user_id").alias("account_id"), t.money("value").alias("amount"), F.col("ts").alias("paid_at"), F.col("event_id").alias("payment_id"))


def promise_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Event log of promises: logged at a signup, kept at the user's next purchase inside three days."""
    logged = _events(spark, sf, "signup").select(
        F.col("event_id").cast("string").alias("promise_id"), F.col("user_id").alias("account_id"), officer(F.col("user_id")).alias("officer_name"),
        (t.money("value") * 100).cast("decimal(18,2)").alias("amount_fcfa"), F.date_add(F.col("ts").cast("date"), KEEP_DAYS).alias("promise_date"),
        F.col("ts").alias("created_at"))
    paid = next_at(logged, payments(spark, sf), "account_id", "created_at", "paid_at", "kept_at")
    in_time = F.col("kept_at") <= F.col("created_at") + F.make_dt_interval(F.lit(KEEP_DAYS))
    kept = paid.filter(in_time).select("promise_id", F.lit("KEPT").alias("status"), F.col("kept_at").alias("event_time"), F.lit(1).alias("seq"))
    first = logged.select("*", F.lit("PENDING").alias("status"), F.col("created_at").alias("event_time"), F.lit(0).alias("seq"))
    return first.unionByName(kept, allowMissingColumns=True)


def promises(spark: SparkSession, sf: str) -> DataFrame:
    return led.current_promises(promise_ledger(spark, sf))


def balances(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "error").groupBy(F.col("user_id").alias("account_id")).agg(F.sum(t.money("value")).cast("decimal(38,2)").alias("balance_due"))


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """One contact sequence per account in arrears, started at its first error event."""
    e = _events(spark, sf, "error").groupBy(F.col("user_id").alias("account_id")).agg(F.min("ts").alias("started_at"), F.sum(t.money("value")).alias("overdue"))
    return led.start_sequences(e.withColumn("officer_name", officer(F.col("account_id"))))


def contact_log(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf, "click").select(
        F.col("event_id").alias("outcome_id"), F.col("user_id").alias("account_id"), officer(F.col("user_id")).alias("officer_name"),
        F.lit("CALLED").alias("contact_outcome"), F.col("ts").alias("created_at"))


_OFFICER = "CASE {u} % 7 WHEN 0 THEN 'System' WHEN 1 THEN 'officer' ELSE 'Agent ' || CAST({u} % 7 AS VARCHAR) END"
PROMISES = f"""prom AS (SELECT CAST(e.event_id AS VARCHAR) AS promise_id, e.user_id AS account_id, {_OFFICER.format(u='e.user_id')} AS officer_name,
  CAST(e.value AS DECIMAL(18,2)) * 100 AS amount, CAST(e.ts AS DATE) + 3 AS promise_date, e.ts AS created_at,
  (SELECT min(p.ts) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts >= e.ts AND p.ts <= e.ts + INTERVAL 3 DAY) AS kept_at
  FROM events e WHERE e.event_type = 'signup'),
cur AS (SELECT *, CASE WHEN kept_at IS NOT NULL THEN 'KEPT' ELSE 'PENDING' END AS raw_status,
  CASE WHEN kept_at IS NOT NULL THEN 'KEPT' WHEN promise_date < DATE '{AS_OF}' THEN 'BROKEN' ELSE 'PENDING' END AS status FROM prom)"""


@R.query("promise_states", with_sql(PROMISES, body="""
SELECT promise_id, account_id, officer_name, CAST(amount AS DOUBLE) AS amount_fcfa, promise_date, status, coalesce(kept_at, created_at) AS changed_at FROM cur"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Current state of every promise: the last event, then the automatic breaks."""
    return led.auto_break(promises(spark, sf), AS_OF).select(
        "promise_id", "account_id", "officer_name", _double("amount_fcfa"), "promise_date", "status", "changed_at")


@R.query("promise_summary", with_sql(PROMISES, body=f"""
, s AS (SELECT count(*) AS total_promises, """ + ", ".join(
    f"CAST(count_if(status = '{k}') AS BIGINT) AS {k.lower()}_count, CAST(coalesce(sum(amount) FILTER (WHERE status = '{k}'), 0) AS DOUBLE) AS {k.lower()}_amount_fcfa"
    for k in ("PENDING", "KEPT", "BROKEN")) + f""", CAST(count_if(status = 'PENDING' AND promise_date <= DATE '{AS_OF}') AS BIGINT) AS overdue_today FROM cur)
SELECT *, round_even(CAST(kept_count AS DOUBLE) / (kept_count + broken_count) * 100, 1) AS keep_rate_pct FROM s"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.promise_summary(promises(spark, sf), AS_OF)


@R.query("promise_list_of_an_officer", with_sql(PROMISES, body="""
SELECT promise_id, account_id, officer_name, promise_date, created_at FROM cur WHERE status = 'BROKEN' AND contains(lower(officer_name), 'gent 3') ORDER BY created_at DESC, promise_id LIMIT 100"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.list_promises(promises(spark, sf), AS_OF, "broken", "GENT 3").select("promise_id", "account_id", "officer_name", "promise_date", "created_at")


@R.query("promise_reminders_due", with_sql(PROMISES, body=f"""
SELECT promise_id, account_id, promise_date FROM cur WHERE raw_status = 'PENDING' AND promise_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.reminders_due(promises(spark, sf), AS_OF, 1).select("promise_id", "account_id", "promise_date")


@R.query("promise_document_round_trip", with_sql(PROMISES, body="""
SELECT promise_id, account_id, officer_name, CAST(amount AS DOUBLE) AS amount_fcfa, promise_date, raw_status AS status, created_at FROM cur"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger written as JSON documents and read back with its declared schema; absent fields are NULL."""
    path = new_path(spark, "promises")
    write_json_documents(promises(spark, sf).drop("changed_at").withColumn("amount_fcfa", _double("amount_fcfa")), path)
    return read_json_documents(spark, path, schemas.PROMISES).select(
        "promise_id", "account_id", "officer_name", "amount_fcfa", "promise_date", "status", "created_at")


# ---- contact sequences -------------------------------------------------------------------------

_SEQ = """seq AS (SELECT user_id AS account_id, min(ts) AS started_at FROM events WHERE event_type = 'error' GROUP BY 1),
steps AS (SELECT account_id, started_at, step, CAST(CASE step WHEN 1 THEN 0 ELSE step END AS INTEGER) AS day_offset FROM seq, (VALUES (1), (3), (7), (15)) v(step)),
sched AS (SELECT *, started_at + to_days(day_offset) AS scheduled_at, CASE WHEN step = 1 THEN 'SENT' ELSE 'PENDING' END AS step_status FROM steps)"""


@R.query("sequence_schedule", with_sql(_SEQ, body="SELECT account_id, step, day_offset, scheduled_at, step_status FROM sched"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.schedule_rows(sequences(spark, sf)).select("account_id", "step", "day_offset", "scheduled_at", "step_status")


@R.query("sequence_sends_due", with_sql(_SEQ, body=f"SELECT account_id, step, scheduled_at FROM sched WHERE step_status = 'PENDING' AND scheduled_at <= TIMESTAMP '{NOW}'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.sends_due(sequences(spark, sf), NOW).select("account_id", "step", "scheduled_at")


_STOP = f"""stop AS (SELECT s.*, (SELECT min(p.ts) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = s.account_id AND p.ts >= s.started_at AND p.ts <= TIMESTAMP '2024-01-05 00:00:00') AS stopped_at FROM seq s)"""


@R.query("sequence_steps_after_payment", with_sql(_SEQ, _STOP, body="""
SELECT d.account_id, d.step, d.scheduled_at, CASE WHEN stopped_at IS NULL THEN 'ACTIVE' ELSE 'STOPPED' END AS sequence_status
FROM sched d JOIN stop USING (account_id) WHERE stopped_at IS NULL OR d.scheduled_at < stopped_at"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Steps left after sequences stopped at the first payment."""
    return led.schedule_rows(led.stop_on_payment(sequences(spark, sf), payments(spark, sf), "2024-01-05 00:00:00")).select(
        "account_id", "step", "scheduled_at", "sequence_status")


@R.query("sequence_summary", with_sql(_SEQ, _STOP, body="""
SELECT count(*) AS total_sequences, CAST(count_if(stopped_at IS NULL) AS BIGINT) AS active_sequences, CAST(count_if(stopped_at IS NOT NULL) AS BIGINT) AS stopped_sequences,
  count(*) AS total_messages_sent, count(DISTINCT CASE WHEN stopped_at IS NULL THEN account_id END) AS accounts_in_sequence FROM stop"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.sequence_summary(led.stop_on_payment(sequences(spark, sf), payments(spark, sf), "2024-01-05 00:00:00"))


@R.query("accounts_in_sequence", with_sql(_SEQ, _STOP, body="SELECT account_id FROM stop WHERE stopped_at IS NULL"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return led.accounts_in_sequence(led.stop_on_payment(sequences(spark, sf), payments(spark, sf), "2024-01-05 00:00:00"))


@R.query("sequence_list_of_a_status", with_sql(_SEQ, _STOP, body="""
SELECT account_id, started_at, 'STOPPED' AS status, stopped_at FROM stop WHERE stopped_at IS NOT NULL ORDER BY started_at DESC, account_id LIMIT 50"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The newest stopped sequences, with the payment that stopped each."""
    stopped = led.stop_on_payment(sequences(spark, sf), payments(spark, sf), "2024-01-05 00:00:00")
    return led.list_sequences(stopped, status="stopped").select("account_id", "started_at", "status", "stopped_at")


# ---- payments ----------------------------------------------------------------------------------

_PAY = """bal AS (SELECT user_id AS account_id, sum(CAST(value AS DECIMAL(18,2))) AS due FROM events WHERE event_type = 'error' GROUP BY 1),
pay AS (SELECT user_id AS account_id, CAST(value AS DECIMAL(18,2)) AS amount, ts AS paid_at, event_id AS payment_id FROM events WHERE event_type = 'purchase'),
run AS (SELECT p.*, due, sum(amount) OVER (PARTITION BY account_id ORDER BY paid_at, payment_id) AS paid FROM pay p JOIN bal USING (account_id) WHERE amount > 0),
rec AS (SELECT account_id, payment_id, amount, greatest(0, due - (paid - amount)) AS due_before, greatest(0, due - paid) AS due_after FROM run)"""


@R.query("payment_reconciliation", with_sql(_PAY, body="""
SELECT account_id, payment_id, CAST(amount AS DOUBLE) AS amount, CAST(due_before AS DOUBLE) AS due_before, CAST(due_after AS DOUBLE) AS due_after,
  CASE WHEN due_after = 0 THEN 'PAID_IN_FULL' ELSE 'PARTIAL_PAYMENT' END AS outcome FROM rec"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.reconcile(balances(spark, sf), payments(spark, sf)).select(
        "account_id", "payment_id", _double("amount"), _double("due_before"), _double("due_after"), "outcome")


_LOANS = """loans AS (SELECT user_id AS account_id, event_id % 2 AS loan, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS due FROM events WHERE event_type = 'error' GROUP BY 1, 2),
lpay AS (SELECT user_id AS account_id, event_id % 2 AS loan, CAST(value AS DECIMAL(18,2)) AS amount, ts AS paid_at, event_id AS payment_id FROM events WHERE event_type = 'purchase')"""


def _by_loan(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two loans per account: balances and payments keyed by account and loan."""
    e = t.table(spark, sf, "events").select(F.col("user_id").alias("account_id"), F.pmod("event_id", F.lit(2)).alias("loan"), F.col("value").cast("decimal(18,2)").alias("amount"), F.col("ts").alias("paid_at"), F.col("event_id").alias("payment_id"), "event_type")
    due = e.filter(F.col("event_type") == "error").groupBy("account_id", "loan").agg(F.sum("amount").alias("balance_due"))
    return due, e.filter(F.col("event_type") == "purchase").drop("event_type")


@R.query("payment_reconciliation_by_loan", with_sql(_LOANS, body="""
, run AS (SELECT p.*, due, sum(amount) OVER (PARTITION BY account_id, loan ORDER BY paid_at, payment_id) AS paid FROM lpay p JOIN loans USING (account_id, loan) WHERE amount > 0)
SELECT account_id, loan, payment_id, CAST(amount AS DOUBLE) AS amount, CAST(greatest(0, due - (paid - amount)) AS DOUBLE) AS due_before, CAST(greatest(0, due - paid) AS DOUBLE) AS due_after FROM run"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Payments booked on their own loan of an account that has two."""
    due, pay = _by_loan(spark, sf)
    return dec.reconcile(due, pay, ["account_id", "loan"]).select("account_id", "loan", "payment_id", _double("amount"), _double("due_before"), _double("due_after"))


@R.query("payments_not_booked", with_sql(_LOANS, body="""
, per AS (SELECT account_id, count(*) AS n FROM loans GROUP BY 1),
r AS (SELECT CASE WHEN amount <= 0 THEN 'amount_not_positive' WHEN n IS NULL THEN 'unknown_account' WHEN n > 1 THEN 'ambiguous_account' END AS reject_rule FROM lpay LEFT JOIN per USING (account_id))
SELECT reject_rule, count(*) AS n_payments FROM r WHERE reject_rule IS NOT NULL GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Without the loan a payment on an account of two loans is ambiguous and not booked."""
    due, pay = _by_loan(spark, sf)
    return dec.reconcile_rejects(due, pay, ["account_id"]).groupBy("reject_rule").agg(F.count(F.lit(1)).alias("n_payments"))


@R.query("reconciliation_totals", with_sql(_PAY, PROMISES, body="""
SELECT count(*) AS matched_payments, CAST(count_if(due_after = 0) AS BIGINT) AS payments_on_cleared, CAST(sum(amount) AS DOUBLE) AS total_reconciled,
  (SELECT count(*) FROM bal JOIN (SELECT account_id, sum(amount) AS p FROM pay WHERE amount > 0 GROUP BY 1) USING (account_id) WHERE due <= p) AS accounts_cleared,
  (SELECT count(*) FROM prom WHERE kept_at IS NULL AND account_id IN (SELECT account_id FROM pay WHERE amount > 0)) AS promises_marked_kept FROM rec"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    bal, pay, prom = balances(spark, sf), payments(spark, sf), promises(spark, sf).withColumn("resolution_note", F.lit(""))
    cleared = dec.remaining_balances(bal, pay).filter((F.col("payments") > 0) & (F.col("balance_left") == 0)).agg(F.count(F.lit(1)).alias("c")).scalar()
    settled = dec.settle_promises(prom, pay).agg(F.count_if(F.col("resolution_note") != "").alias("k")).scalar()
    return dec.reconcile(bal, pay).agg(
        F.count(F.lit(1)).alias("matched_payments"), F.count_if(F.col("outcome") == "PAID_IN_FULL").alias("payments_on_cleared"),
        F.sum("amount").cast("double").alias("total_reconciled")).select("*", cleared.alias("accounts_cleared"), settled.alias("promises_marked_kept"))


@R.query("promises_settled_by_payment", with_sql(_PAY, PROMISES, body="""
, f AS (SELECT account_id, arg_min(amount, (paid_at, payment_id)) AS first_amount FROM pay WHERE amount > 0 GROUP BY 1)
SELECT promise_id, account_id, CASE WHEN raw_status = 'PENDING' AND first_amount IS NOT NULL THEN 'KEPT' ELSE raw_status END AS status,
  CASE WHEN raw_status = 'PENDING' AND first_amount IS NOT NULL
    THEN 'Auto-resolved: Payment of ' || format('{:,}', CAST(round_even(CAST(first_amount AS DOUBLE), 0) AS BIGINT)) || ' FCFA received via bulk reconciliation.' ELSE '' END AS resolution_note
FROM cur LEFT JOIN f USING (account_id)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    prom = promises(spark, sf).withColumn("resolution_note", F.lit(""))
    return dec.settle_promises(prom, payments(spark, sf)).select("promise_id", "account_id", "status", "resolution_note")


@R.query("promises_settled_in_full", with_sql(_PAY, PROMISES, body="""
SELECT promise_id, account_id, CASE WHEN raw_status = 'PENDING' AND coalesce((SELECT sum(p.amount) FROM pay p WHERE p.amount > 0 AND p.account_id = cur.account_id AND CAST(p.paid_at AS DATE) <= promise_date), 0) >= amount / 10
  AND account_id IN (SELECT account_id FROM pay WHERE amount > 0) THEN 'KEPT' ELSE raw_status END AS status FROM cur"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The strict form: payments by the promised day must reach the amount (here a tenth of it)."""
    prom = promises(spark, sf).withColumns({"resolution_note": F.lit(""), "amount_fcfa": F.col("amount_fcfa") / 10})
    return dec.settle_promises(prom, payments(spark, sf), require_full=True).select("promise_id", "account_id", "status")


# ---- audit logs and score card -----------------------------------------------------------------

@R.query("contact_log_recent", """
SELECT event_id AS outcome_id, user_id AS account_id, CAST(ts AS DATE) AS created_date FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 50""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Contact outcomes appended to a log partitioned by day; the newest fifty read back."""
    path = new_path(spark, "contacts")
    append_log(contact_log(spark, sf), path)
    return recent(spark.read.parquet(path), "created_at", "outcome_id").select("outcome_id", "account_id", F.col("created_date").cast("date").alias("created_date"))


@R.query("payment_log_by_provider", """
SELECT CASE WHEN user_id % 3 = 0 THEN 'ORANGE_MONEY' ELSE 'MTN_MOMO' END AS provider, count(*) AS n_payments, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Payments appended to the audit log in two batches, with the provider found by phone prefix."""
    path = new_path(spark, "payments")
    prefix = F.when(F.pmod("account_id", F.lit(3)) == 0, "69").otherwise("67")
    phone = normalise_phone(F.concat(prefix, F.lpad(F.col("account_id").cast("string"), 7, "0")))
    log = payments(spark, sf).select(
        F.col("payment_id").cast("string").alias("reference_id"), "account_id", F.col("amount").alias("amount_fcfa"), phone.alias("phone"), F.lit("SUCCESSFUL").alias("status"),
        phone_provider(phone).alias("provider"), F.col("paid_at").alias("created_at"))
    half = F.lit("2024-01-15").cast("date")
    append_log(log.filter(F.col("created_at").cast("date") < half), path)
    append_log(log.filter(F.col("created_at").cast("date") >= half), path)
    return spark.read.parquet(path).groupBy("provider").agg(F.count(F.lit(1)).alias("n_payments"), F.sum("amount_fcfa").cast("double").alias("amount"))


_KPI = f"""names AS (SELECT DISTINCT {_OFFICER.format(u='user_id')} AS officer_name FROM events),
p AS (SELECT officer_name, count(*) AS t, count_if(status = 'KEPT') AS k, count_if(status = 'BROKEN') AS b, count_if(status = 'PENDING') AS n,
  CAST(coalesce(sum(amount) FILTER (WHERE status = 'KEPT'), 0) AS DOUBLE) AS c, CAST(coalesce(sum(amount) FILTER (WHERE status = 'PENDING'), 0) AS DOUBLE) AS pd FROM cur GROUP BY 1),
o AS (SELECT {_OFFICER.format(u='user_id')} AS officer_name, count_if(CAST(ts AS DATE) >= DATE '{AS_OF}' - 7) AS w FROM events WHERE event_type = 'click' GROUP BY 1),
q AS (SELECT {_OFFICER.format(u='user_id')} AS officer_name, count(DISTINCT user_id) AS s FROM events WHERE event_type = 'error' GROUP BY 1),
kpi AS (SELECT officer_name, coalesce(t, 0) AS promises_total, CAST(coalesce(k, 0) AS BIGINT) AS promises_kept, CAST(coalesce(b, 0) AS BIGINT) AS promises_broken, CAST(coalesce(n, 0) AS BIGINT) AS promises_pending,
  coalesce(c, 0) AS fcfa_collected, coalesce(pd, 0) AS fcfa_pending, CAST(coalesce(w, 0) AS BIGINT) AS contacts_this_week, coalesce(s, 0) AS sequences_started,
  coalesce(round_even(CAST(k AS DOUBLE) / CASE WHEN k + b = 0 THEN NULL ELSE k + b END * 100, 1), 0) AS keep_rate_pct FROM names LEFT JOIN p USING (officer_name) LEFT JOIN o USING (officer_name) LEFT JOIN q USING (officer_name)
  WHERE officer_name <> 'System'),
sc AS (SELECT *, CAST(least(100, round_even(keep_rate_pct * 0.40 + least(contacts_this_week * 5, 30) + least(fcfa_collected / 10000, 30.0), 0)) AS INTEGER) AS score FROM kpi)"""


def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rep.officer_kpis(promises(spark, sf), contact_log(spark, sf), sequences(spark, sf), AS_OF)


@R.query("officer_leaderboard", with_sql(PROMISES, _KPI, body="""
SELECT officer_name, score, promises_total, promises_kept, promises_broken, promises_pending, keep_rate_pct, contacts_this_week, fcfa_collected, fcfa_pending, sequences_started,
  CAST(row_number() OVER (ORDER BY score DESC, officer_name) AS INTEGER) AS rank,
  CASE WHEN score >= 85 THEN 'CHAMPION' WHEN score >= 70 THEN 'TOP PERFORMER' WHEN score >= 50 THEN 'ON TRACK' WHEN score >= 30 THEN 'NEEDS SUPPORT' ELSE 'CRITICAL' END AS badge FROM sc ORDER BY score DESC, officer_name LIMIT 20"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.leaderboard(kpis(spark, sf)).select(
        "officer_name", "score", "promises_total", "promises_kept", "promises_broken", "promises_pending", "keep_rate_pct", "contacts_this_week", "fcfa_collected",
        "fcfa_pending", "sequences_started", "rank", "badge")


@R.query("team_summary", with_sql(PROMISES, _KPI, body="""
SELECT count(*) AS total_officers, round(sum(fcfa_collected), 2) AS total_fcfa_collected, CAST(sum(promises_total) AS BIGINT) AS total_promises,
  round_even(sum(keep_rate_pct * promises_total) / greatest(sum(promises_total), 1), 1) AS team_keep_rate_pct, CAST(sum(contacts_this_week) AS BIGINT) AS total_contacts_week FROM sc"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.team_summary(kpis(spark, sf)).withColumn("total_fcfa_collected", F.round("total_fcfa_collected", 2))


@R.query("officer_recent_promises", with_sql(PROMISES, body="""
SELECT promise_id, account_id, status, created_at FROM cur WHERE lower(officer_name) = 'agent 4' ORDER BY created_at DESC, promise_id LIMIT 10"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = led.auto_break(promises(spark, sf), AS_OF).filter(F.lower("officer_name") == "agent 4")
    return p.orderBy(F.col("created_at").desc(), "promise_id").limit(10).select("promise_id", "account_id", "status", "created_at")


# ---- routing of questions ----------------------------------------------------------------------

def _route_sql(c: str) -> str:
    def any_of(words: list[str]) -> str:
        return "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"

    out = f"CASE WHEN num <> '' AND {any_of(routing.ACCOUNT_WORDS)} THEN '{routing.ACCOUNT}'"
    for label, words in routing.KEYWORDS:
        extra = f" OR length(trim({c}, E' \\t\\n\\r\\x0b\\x0c')) < {routing.SHORTEST}" if label == "HELP" else ""
        out += f" WHEN {any_of(words)}{extra} THEN '{label}'"
    return out + f" WHEN num <> '' THEN '{routing.ACCOUNT}' ELSE '{routing.DEFAULT}' END"


def _texts(table: str, key: str) -> str:
    return f"""WITH c AS (SELECT {key}, regexp_replace(lower(trim(text, E' \\t\\n\\r\\x0b\\x0c')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g') AS clean FROM {table}),
n AS (SELECT *, regexp_extract(clean, '(?:^|[^\\p{{L}}\\p{{N}}_])([0-9]{{4,9}})(?:$|[^\\p{{L}}\\p{{N}}_])', 1) AS num FROM c)
SELECT {key}, {_route_sql('clean')} AS label, CAST(nullif(num, '') AS INTEGER) AS number FROM n"""


@R.query("route_conversations", _texts("conversations", "conv_id, turn"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route(t.table(spark, sf, "conversations"), "text").select("conv_id", "turn", "label", "number")


@R.query("route_documents", _texts("documents", "doc_id"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route(t.table(spark, sf, "documents"), "text").select("doc_id", "label", "number")
