"""Loan arrears: events, labels and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import arrears as a
from ..operators.splits import entity_split
from ..session import materialize
from . import tables as t
from .registry import Registry
from .tables import APPLICATIONS, BUREAU, INSTALMENTS, POS_CASH, with_sql

R = Registry()
TIES = ("tie_a", "tie_b")


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return a.arrears_events(t.instalments(spark, sf), TIES)


def sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Instalments and their events, each written once: the features read both several times."""
    inst = materialize(t.instalments(spark, sf), "instalments")
    return inst, materialize(a.arrears_events(inst, TIES), "events")


def most_instalments(spark: SparkSession, sf: str) -> int:
    """No loan has more instalments: the most lines of one bucket of keys times the most orders of one key."""
    def most(name: str, key: Column) -> int:
        n = t.table(spark, sf, name).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return n.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]

    # buckets are few enough to be counted before the shuffle
    return most("lineitem", F.pmod(F.xxhash64("l_orderkey"), F.lit(1 << 16))) * most("orders", F.col("o_orderkey"))


def history(spark: SparkSession, sf: str, as_of: str = "known") -> DataFrame:
    """Events with their history; rows that may be too many of one loan for a task are written and summed by cells."""
    if a.fits_a_task(most_instalments(spark, sf)):
        return a.events_with_history(t.instalments(spark, sf), as_of, TIES)
    inst, ev = sources(spark, sf)
    return a.repayment_history(ev, inst, as_of, TIES)


EVENTS = """late AS (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS days_late, AMT_PAYMENT < AMT_INSTALMENT * CAST(0.95 AS DECIMAL(3,2)) AS underpaid FROM inst),
arr AS (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR, SK_ID_PREV ORDER BY DAYS_INSTALMENT DESC, NUM_INSTALMENT_NUMBER DESC, tie_a DESC, tie_b DESC) AS rn
  FROM late WHERE (coalesce(days_late >= 15, FALSE) OR days_late IS NULL OR coalesce(underpaid AND days_late >= 0, FALSE)) AND AMT_INSTALMENT > 0),
ev AS (SELECT SK_ID_CURR, SK_ID_PREV, CAST(DAYS_INSTALMENT + 15 AS INTEGER) AS observation_day, AMT_INSTALMENT AS overdue_amount,
  CAST(CASE WHEN coalesce(days_late <= 45, FALSE) AND NOT underpaid THEN 1 ELSE 0 END AS INTEGER) AS recovered, NUM_INSTALMENT_NUMBER AS event_number,
  CAST(CASE WHEN coalesce(days_late <= 45, FALSE) AND NOT underpaid THEN greatest(days_late - 15, 0) END AS INTEGER) AS days_to_cure,
  CASE WHEN days_late <= 45 THEN AMT_PAYMENT END AS paid_amount, tie_a, tie_b FROM arr WHERE rn = 1)"""


@R.query("arrears_events", with_sql(INSTALMENTS, EVENTS, body="""
SELECT SK_ID_CURR, SK_ID_PREV, observation_day, CAST(overdue_amount AS DOUBLE) AS overdue_amount, recovered, days_to_cure FROM ev"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("SK_ID_CURR", "SK_ID_PREV", "observation_day", _double("overdue_amount"), "recovered", "days_to_cure")


@R.query("base_recovery_rate", with_sql(INSTALMENTS, EVENTS, body="SELECT CAST(sum(recovered) AS DOUBLE) / count(*) AS base_recovery_rate FROM ev"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return a.base_recovery_rate(events(spark, sf))


_LOANS = """loans AS (SELECT o_orderkey AS id,
  CASE o_orderkey % 6 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default' WHEN 2 THEN 'Late (31-120 days)' WHEN 3 THEN 'Late (16-30 days)' WHEN 4 THEN 'Current' ELSE 'Fully Paid' END AS loan_status,
  o_totalprice AS loan_amnt, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice * 0.75 END AS total_rec_prncp,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 0.5 END AS installment, CASE WHEN o_orderkey % 4 = 0 THEN 100.0::DOUBLE WHEN o_orderkey % 4 = 1 THEN 0.0::DOUBLE END AS recoveries FROM orders)"""


@R.query("loan_state_events", with_sql(_LOANS, body="""
SELECT CAST(id AS VARCHAR) AS SK_ID_CURR, CAST(id AS VARCHAR) AS SK_ID_PREV, 0 AS observation_day, loan_status,
  greatest(loan_amnt - coalesce(total_rec_prncp, 0), coalesce(installment, 100.0)) AS overdue_amount, coalesce(recoveries, 0.0) AS recovery_amount,
  CASE WHEN coalesce(recoveries, 0) > 0 OR loan_status = 'Late (16-30 days)' THEN 1 ELSE 0 END AS recovered
FROM loans WHERE loan_status IN ('Charged Off', 'Default', 'Late (31-120 days)', 'Late (16-30 days)')"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    states = F.array(*[F.lit(s) for s in [*a.ARREARS_STATES, "Current", "Fully Paid"]])
    loans = t.table(spark, sf, "orders").select(
        k.alias("id"), F.element_at(states, F.pmod(k, F.lit(6)).cast("int") + 1).alias("loan_status"), price.alias("loan_amnt"),
        F.when(F.pmod(k, F.lit(7)) != 0, price * 0.75).alias("total_rec_prncp"), F.when(F.pmod(k, F.lit(5)) != 0, price * 0.5).alias("installment"),
        F.when(F.pmod(k, F.lit(4)) == 0, 100.0).when(F.pmod(k, F.lit(4)) == 1, 0.0).alias("recoveries"))
    return a.loan_state_events(loans)


def _history_sql(known: bool) -> str:
    visible = "i.DAYS_ENTRY_PAYMENT <= e.observation_day" if known else "i.DAYS_ENTRY_PAYMENT IS NOT NULL"
    own = "AND NOT (i.DAYS_INSTALMENT + 15 = e.observation_day AND i.NUM_INSTALMENT_NUMBER = e.event_number AND i.tie_a = e.tie_a AND i.tie_b = e.tie_b)" if known else ""
    paid = f"CASE WHEN {visible} THEN i.AMT_PAYMENT ELSE 0 END" if known else "i.AMT_PAYMENT"
    return f"""h AS (SELECT e.SK_ID_CURR, e.SK_ID_PREV, i.NUM_INSTALMENT_NUMBER AS num, i.DAYS_INSTALMENT AS due, i.AMT_INSTALMENT AS amount,
    CASE WHEN {visible} THEN i.DAYS_ENTRY_PAYMENT - i.DAYS_INSTALMENT END AS delay, {paid} AS paid,
    row_number() OVER (PARTITION BY e.SK_ID_CURR, e.SK_ID_PREV ORDER BY i.DAYS_INSTALMENT DESC, i.NUM_INSTALMENT_NUMBER DESC, i.tie_a DESC, i.tie_b DESC) AS rn
  FROM ev e JOIN inst i ON e.SK_ID_CURR = i.SK_ID_CURR AND e.SK_ID_PREV = i.SK_ID_PREV AND i.DAYS_INSTALMENT < e.observation_day {own}),
g AS (SELECT SK_ID_CURR, SK_ID_PREV, count(num) AS c, count_if(delay > 0) AS l, count_if(delay >= 15) AS s, avg(greatest(delay, 0)) FILTER (WHERE delay IS NOT NULL) AS av,
    max(greatest(delay, 0)) FILTER (WHERE delay IS NOT NULL) AS mx, sum(paid) AS p, sum(amount) AS am, count_if(paid < amount * CAST(0.95 AS DECIMAL(3,2))) AS u, max(num) AS mn,
    min(due) FILTER (WHERE delay >= 15) < max(due) FILTER (WHERE delay <= 0) AS cured,
    avg(greatest(delay, 0)) FILTER (WHERE delay IS NOT NULL AND rn <= 3) AS r3, sum(paid) FILTER (WHERE rn <= 3) AS rp, sum(amount) FILTER (WHERE rn <= 3) AS ra FROM h GROUP BY 1, 2),
hist AS (SELECT ev.*, coalesce(c, 0) AS prior_instalments_count, CAST(coalesce(l, 0) AS BIGINT) AS prior_late_count,
    CAST(coalesce(l, 0) AS DOUBLE) / greatest(coalesce(c, 0), 1) AS prior_late_ratio, CAST(coalesce(s, 0) AS BIGINT) AS prior_severe_late_count,
    coalesce(av, 0) AS prior_avg_days_late, CAST(coalesce(mx, 0) AS DOUBLE) AS prior_max_days_late,
    CASE WHEN cured THEN 1 ELSE 0 END AS prior_recovered_before,
    CASE WHEN am IS NULL THEN 1.0 ELSE least(greatest(CAST(p AS DOUBLE) / greatest(CAST(am AS DOUBLE), 1.0), 0.0), 2.0) END AS prior_payment_ratio,
    CAST(coalesce(u, 0) AS BIGINT) AS prior_underpaid_count, coalesce(r3, 0) AS recent_3_avg_late,
    CASE WHEN ra IS NULL THEN 1.0 ELSE least(greatest(CAST(rp AS DOUBLE) / greatest(CAST(ra AS DOUBLE), 1.0), 0.0), 2.0) END AS recent_payment_ratio,
    coalesce(mn, 1) AS instalment_number FROM ev LEFT JOIN g USING (SK_ID_CURR, SK_ID_PREV))"""


_HISTORY = ["prior_instalments_count", "prior_late_count", "prior_late_ratio", "prior_severe_late_count", "prior_avg_days_late", "prior_max_days_late",
            "prior_recovered_before", "prior_payment_ratio", "prior_underpaid_count", "recent_3_avg_late", "recent_payment_ratio", "instalment_number"]

for _name, _as_of in (("repayment_history_known", "known"), ("repayment_history_due", "due")):
    def _make(as_of: str):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return history(spark, sf, as_of).select("SK_ID_CURR", "SK_ID_PREV", *_HISTORY)
        return run

    R.query(_name, with_sql(INSTALMENTS, EVENTS, _history_sql(_as_of == "known"), body=f"SELECT SK_ID_CURR, SK_ID_PREV, {', '.join(_HISTORY)} FROM hist"))(_make(_as_of))


_BORROWER = """bor AS (SELECT hist.*, AMT_INCOME_TOTAL AS amt_income_total, AMT_CREDIT AS amt_credit, AMT_ANNUITY AS amt_annuity, DAYS_EMPLOYED AS days_employed,
    DAYS_BIRTH AS days_birth, coalesce(bd, 0.0) AS bureau_total_debt, coalesce(bo, 0.0) AS bureau_overdue_debt, CAST(coalesce(ba, 0) AS BIGINT) AS bureau_active_loans,
    coalesce(dpd, 0.0) AS pos_cash_max_dpd FROM hist LEFT JOIN app USING (SK_ID_CURR)
  LEFT JOIN (SELECT SK_ID_CURR, CAST(sum(AMT_CREDIT_SUM_DEBT) AS DOUBLE) AS bd, CAST(sum(AMT_CREDIT_SUM_OVERDUE) AS DOUBLE) AS bo, count_if(CREDIT_ACTIVE = 'Active') AS ba FROM bureau GROUP BY 1) b USING (SK_ID_CURR)
  LEFT JOIN (SELECT SK_ID_CURR, CAST(max(SK_DPD) AS DOUBLE) AS dpd FROM pos GROUP BY 1) p USING (SK_ID_CURR))"""
_SEASON = """feat AS (SELECT *, CAST(abs(observation_day) % 8 AS INTEGER) AS market_cycle_day,
    CASE WHEN abs(observation_day) % 365 BETWEEN 240 AND 300 THEN 1 ELSE 0 END AS school_fee_shock,
    CASE WHEN abs(observation_day) % 365 >= 305 OR abs(observation_day) % 365 <= 35 THEN 1 ELSE 0 END AS harvest_season,
    least(greatest(coalesce(amt_annuity, 0.0) / (coalesce(amt_income_total, 1e-6) + 1e-6), 0.0), 5.0) AS annuity_income_ratio,
    least(greatest(CAST(overdue_amount AS DOUBLE) / (coalesce(amt_income_total, 1e-6) + 1e-6), 0.0), 10.0) AS overdue_income_ratio FROM bor)"""
FEATURES_SQL = (INSTALMENTS, APPLICATIONS, BUREAU, POS_CASH, EVENTS, _history_sql(True), _BORROWER, _SEASON)


#: The arrears events alone.
EVENTS_SQL = (INSTALMENTS, EVENTS)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return a.history_features(history(spark, sf), t.applications(spark, sf), t.bureau(spark, sf), t.pos_cash(spark, sf))


@R.query("arrears_features", with_sql(*FEATURES_SQL, body="SELECT SK_ID_CURR, SK_ID_PREV, recovered, " + ", ".join(
    "CAST(overdue_amount AS DOUBLE) AS overdue_amount" if c == "overdue_amount" else c for c in a.FEATURE_COLUMNS) + " FROM feat"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    df = features(spark, sf)
    return df.select("SK_ID_CURR", "SK_ID_PREV", "recovered", *[_double(c) if c == "overdue_amount" else F.col(c) for c in a.FEATURE_COLUMNS])


@R.query("features_without_optional_sources", with_sql(INSTALMENTS, EVENTS, body="""
SELECT SK_ID_CURR, SK_ID_PREV, CAST(NULL AS DOUBLE) AS amt_income_total, 0.0::DOUBLE AS bureau_total_debt, CAST(0 AS BIGINT) AS bureau_active_loans, 0.0::DOUBLE AS pos_cash_max_dpd,
  0.0::DOUBLE AS annuity_income_ratio, 10.0::DOUBLE AS overdue_income_ratio FROM ev"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """No application, bureau or card delivery: defaults, and ratios against a missing income."""
    return a.season_and_ratio_features(a.borrower_features(events(spark, sf))).select(
        "SK_ID_CURR", "SK_ID_PREV", "amt_income_total", "bureau_total_debt", "bureau_active_loans", "pos_cash_max_dpd", "annuity_income_ratio", "overdue_income_ratio")


@R.query("borrower_split", with_sql(INSTALMENTS, EVENTS, body="""
SELECT substr(md5('42:' || SK_ID_CURR), 1, 4) < '4000' AS is_test, count(DISTINCT SK_ID_CURR) AS borrowers, count(*) AS n_events,
  CAST(sum(recovered) AS DOUBLE) / count(*) AS recovery_rate FROM ev GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return entity_split(events(spark, sf), "SK_ID_CURR").groupBy("is_test").agg(
        F.countDistinct("SK_ID_CURR").alias("borrowers"), F.count(F.lit(1)).alias("n_events"), F.avg(F.col("recovered").cast("double")).alias("recovery_rate"))
