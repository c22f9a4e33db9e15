"""Agent network: retention, running totals, rankings, lookups, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import day_of, month_of, month_offset
from ..operators.joins import compare_frames, fanout_report, join_checked
from ..operators.ordered import dense_rank_of
from ..session import new_path
from ..sources.layout import lookup, write_clustered
from . import tables as t
from .registry import Registry
from .tables import AGENTS, LINES, SERVICES, TRANSACTIONS, with_sql

R = Registry()


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


# ---- cohort retention --------------------------------------------------------------------------

def cohort_retention(agents: DataFrame, transactions: DataFrame, first: int = 1, last: int = 6) -> DataFrame:
    """Share of each registration month's agents active ``first``..``last`` months later.

    Activity is reduced to distinct (agent, month) before the join, so a busy
    agent costs no more than one row per month in it.
    """
    cohorts = agents.select("agent_id", month_of(F.col("registered_on")).alias("cohort_month"))
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    activity = transactions.select("agent_id", month_of(F.col("txn_ts")).alias("activity_month")).distinct()
    offsets = cohorts.join(activity, "agent_id").withColumn(
        "month_number", month_offset(F.col("activity_month"), F.col("cohort_month"))
    ).filter(F.col("month_number").between(first, last))
    # (agent, month) is already distinct, so counting rows counts agents
    retained = offsets.groupBy("cohort_month", "month_number").agg(F.count(F.lit(1)).alias("active_agents"))
    return retained.join(sizes, "cohort_month").select(
        "cohort_month", "month_number", "active_agents", "cohort_size",
        F.round(F.col("active_agents") / F.col("cohort_size"), 4).alias("retention_rate"),
    ).orderBy("cohort_month", "month_number")


RETENTION_SQL = with_sql(AGENTS, TRANSACTIONS, body="""
, cohorts AS (SELECT agent_id, CAST(date_trunc('month', registered_on) AS DATE) AS cohort_month FROM agents),
sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM cohorts GROUP BY 1),
act AS (SELECT DISTINCT c.agent_id, c.cohort_month, CAST(date_trunc('month', t.txn_ts) AS DATE) AS m
        FROM cohorts c JOIN transactions t ON t.agent_id = c.agent_id),
off AS (SELECT agent_id, cohort_month,
          CAST((year(m) - year(cohort_month)) * 12 + month(m) - month(cohort_month) AS INTEGER) AS month_number FROM act),
ret AS (SELECT cohort_month, month_number, count(DISTINCT agent_id) AS active_agents
        FROM off WHERE month_number BETWEEN 1 AND 6 GROUP BY 1, 2)
SELECT r.cohort_month, r.month_number, r.active_agents, s.cohort_size,
       round(CAST(r.active_agents AS DOUBLE) / s.cohort_size, 4) AS retention_rate
FROM ret r JOIN sizes s USING (cohort_month)""")


@R.query("cohort_retention", RETENTION_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_retention(t.agents(spark, sf), t.transactions(spark, sf))


@R.query("cohort_retention_sql_text", RETENTION_SQL)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same question as SQL text over named views."""
    agents, txns = t.agents(spark, sf), t.transactions(spark, sf)
    return spark.sql("""
        WITH cohorts AS (SELECT agent_id, trunc(registered_on, 'MM') AS cohort_month FROM {agents}),
        sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM cohorts GROUP BY cohort_month),
        activity AS (SELECT DISTINCT agent_id, trunc(txn_ts, 'MM') AS activity_month FROM {txns}),
        offsets AS (SELECT agent_id, cohort_month, (year(activity_month) - year(cohort_month)) * 12
                      + month(activity_month) - month(cohort_month) AS month_number
                    FROM cohorts JOIN activity USING (agent_id)),
        retained AS (SELECT cohort_month, month_number, count(DISTINCT agent_id) AS active_agents
                     FROM offsets WHERE month_number BETWEEN 1 AND 6 GROUP BY cohort_month, month_number)
        SELECT cohort_month, month_number, active_agents, cohort_size,
               round(active_agents / cohort_size, 4) AS retention_rate
        FROM retained JOIN sizes USING (cohort_month)
        ORDER BY cohort_month, month_number""", agents=agents, txns=txns)


# ---- daily fees --------------------------------------------------------------------------------

def daily_fees(lines: DataFrame) -> DataFrame:
    """Fee per day, running total, and mean daily count over the last seven rows.

    Both windows run on the per-day totals: one row per calendar day, so their
    size is bounded by the calendar and not by the number of transactions.
    """
    daily = lines.groupBy(day_of(F.col("txn_ts")).alias("txn_date")).agg(
        F.sum("fee_xaf").alias("daily_fee"), F.count(F.lit(1)).alias("daily_txn_count"))
    by_day = Window.orderBy("txn_date")
    return daily.select(
        "txn_date", _double("daily_fee"),
        F.sum("daily_fee").over(by_day).cast("double").alias("running_fee_total"), "daily_txn_count",
        F.avg("daily_txn_count").over(by_day.rowsBetween(-6, 0)).alias("moving_avg_7day_txn_volume"),
    ).orderBy("txn_date")


@R.query("daily_fee_running_total", with_sql(LINES, body="""
, daily AS (SELECT CAST(txn_ts AS DATE) AS txn_date, sum(fee_xaf) AS fee, count(*) AS n FROM lines GROUP BY 1)
SELECT txn_date, CAST(fee AS DOUBLE) AS daily_fee,
       CAST(sum(fee) OVER (ORDER BY txn_date) AS DOUBLE) AS running_fee_total, n AS daily_txn_count,
       avg(n) OVER (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7day_txn_volume
FROM daily"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return daily_fees(t.transaction_lines(spark, sf))


# ---- rankings ----------------------------------------------------------------------------------

def agent_totals(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("agent_id").agg(F.sum("amount_xaf").alias("total_value"))


def top_per_division(agents: DataFrame, transactions: DataFrame, n: int = 3) -> DataFrame:
    """Agents ranked 1..n by value in their division; equal values share a rank.

    Values are summed per agent before the join, and the rank filter lets Spark
    cut each task's rows before the shuffle.
    """
    valued = agents.join(agent_totals(transactions), "agent_id")
    w = Window.partitionBy("division").orderBy(F.col("total_value").desc())
    return (
        valued.select("division", "agent_id", "agent_name", "total_value", F.rank().over(w).alias("division_rank"))
        .filter(F.col("division_rank") <= n)
        .select("division", "agent_id", "agent_name", _double("total_value"), "division_rank")
        .orderBy("division", "division_rank")
    )


@R.query("top_agents_per_division", with_sql(AGENTS, TRANSACTIONS, body="""
, v AS (SELECT a.division, a.agent_id, a.agent_name, sum(t.amount_xaf) AS tv
        FROM agents a JOIN transactions t USING (agent_id) GROUP BY 1, 2, 3),
r AS (SELECT *, rank() OVER (PARTITION BY division ORDER BY tv DESC) AS rk FROM v)
SELECT division, agent_id, agent_name, CAST(tv AS DOUBLE) AS total_value, CAST(rk AS INTEGER) AS division_rank
FROM r WHERE rk <= 3"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return top_per_division(t.agents(spark, sf), t.transactions(spark, sf))


def above_average_agents(agents: DataFrame, transactions: DataFrame) -> DataFrame:
    """Agents above the mean agent total, with the total; the mean is a scalar subquery."""
    totals = agent_totals(transactions)
    mean = totals.agg(F.avg("total_value").alias("m")).scalar()
    return agents.join(totals.filter(F.col("total_value") > mean), "agent_id").select(
        "agent_id", "agent_name", _double("total_value"))


_ABOVE = """, tot AS (SELECT agent_id, sum(amount_xaf) AS tv FROM transactions GROUP BY 1),
m AS (SELECT sum(tv) / count(*) AS mean FROM tot)"""


@R.query("above_average_agents", with_sql(AGENTS, TRANSACTIONS, body=_ABOVE + """
SELECT a.agent_id, a.agent_name, CAST(tv AS DOUBLE) AS total_value
FROM agents a JOIN tot USING (agent_id) CROSS JOIN m WHERE tv > mean"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return above_average_agents(t.agents(spark, sf), t.transactions(spark, sf))


@R.query("above_average_agents_nested", with_sql(AGENTS, TRANSACTIONS, body=_ABOVE + """
SELECT agent_id, agent_name FROM agents WHERE agent_id IN (SELECT agent_id FROM tot, m WHERE tv > mean)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Semi-join form: membership in the above-average set."""
    totals = agent_totals(t.transactions(spark, sf))
    mean = totals.agg(F.avg("total_value").alias("m")).scalar()
    return t.agents(spark, sf).join(totals.filter(F.col("total_value") > mean), "agent_id", "left_semi").select(
        "agent_id", "agent_name")


@R.query("transaction_point_lookup", with_sql(TRANSACTIONS, body="""
SELECT txn_id, agent_id, txn_ts, CAST(amount_xaf AS DOUBLE) AS amount_xaf, status FROM transactions
WHERE agent_id = (SELECT max(agent_id) FROM transactions)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All transactions of one agent; the equality reaches the Parquet scan."""
    txns = t.transactions(spark, sf)
    wanted = txns.agg(F.max("agent_id").alias("a")).scalar()
    return txns.filter(F.col("agent_id") == wanted).select("txn_id", "agent_id", "txn_ts", _double("amount_xaf"), "status")


#: The agent that is looked up. Fixed value.
WANTED_AGENT = 7
_LAID_OUT: dict[tuple[str, str], str] = {}


def clustered_transactions(spark: SparkSession, sf: str) -> str:
    """Path of the transactions laid out by agent; written once per application and input."""
    at = spark.sparkContext.applicationId, sf
    if at not in _LAID_OUT:
        path = new_path(spark, "transactions-by-agent")
        write_clustered(t.transactions(spark, sf), path, "agent_id", 16, ["txn_id"])
        _LAID_OUT[at] = path
    return _LAID_OUT[at]


@R.query("transaction_clustered_lookup", with_sql(TRANSACTIONS, body=f"""
SELECT txn_id, agent_id, txn_ts, CAST(amount_xaf AS DOUBLE) AS amount_xaf, status FROM transactions WHERE agent_id = {WANTED_AGENT}"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """All transactions of one agent from a table in ranges of the agent: the manifest names the files to open."""
    found = lookup(spark, clustered_transactions(spark, sf), "agent_id", WANTED_AGENT)
    return found.select("txn_id", "agent_id", "txn_ts", _double("amount_xaf"), "status")


# ---- joined fact with rank and share -----------------------------------------------------------

def ranked_fact(lines: DataFrame, agents: DataFrame, services: DataFrame) -> DataFrame:
    """Each transaction with its agent's total, dense rank and share of the division.

    Totals, ranks and shares are worked out on one row per agent and joined to
    the fact once; no window runs on the fact.
    """
    totals = lines.groupBy("agent_id").agg(F.sum("amount_xaf").alias("agent_total_value"))
    per_agent = join_checked(totals, agents.select("agent_id", "division"), "agent_id", "left", "one_to_one")
    division = per_agent.groupBy("division").agg(F.sum("agent_total_value").alias("division_total"))
    per_agent = dense_rank_of(per_agent.join(division, "division", "left"), "agent_total_value", "agent_rank")
    per_agent = per_agent.withColumn(
        "division_share", F.round(F.col("agent_total_value").cast("double") / F.col("division_total").cast("double"), 4))
    joined = join_checked(lines, services.select("service_code", "service_name", "category"), "service_code", "left")
    return joined.join(per_agent, "agent_id", "left")


@R.query("transactions_with_agent_rank_and_share", with_sql(AGENTS, SERVICES, LINES, body="""
, tot AS (SELECT agent_id, sum(amount_xaf) AS tv FROM lines GROUP BY 1),
rk AS (SELECT tot.agent_id, division, tv, dense_rank() OVER (ORDER BY tv DESC) AS agent_rank,
              sum(tv) OVER (PARTITION BY division) AS dv FROM tot LEFT JOIN agents USING (agent_id))
SELECT txn_id, line_no, l.agent_id, l.service_code, service_name, category, CAST(amount_xaf AS DOUBLE) AS amount_xaf,
       division, CAST(tv AS DOUBLE) AS agent_total_value, CAST(agent_rank AS BIGINT) AS agent_rank,
       round(CAST(tv AS DOUBLE) / CAST(dv AS DOUBLE), 4) AS division_share
FROM lines l LEFT JOIN services USING (service_code) LEFT JOIN rk USING (agent_id)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = ranked_fact(t.transaction_lines(spark, sf), t.agents(spark, sf), t.services(spark, sf))
    return out.select("txn_id", "line_no", "agent_id", "service_code", "service_name", "category", _double("amount_xaf"),
                      "division", _double("agent_total_value"), "agent_rank", "division_share")


# ---- pivot and melt ----------------------------------------------------------------------------

MAX_CATEGORIES = 200


def categories(services: DataFrame) -> list[str]:
    """The categories of the dimension, in order; more than a table can have as columns are an error."""
    found = [r[0] for r in services.select("category").filter(F.col("category").isNotNull()).distinct().orderBy("category").limit(MAX_CATEGORIES + 1).collect()]
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories cannot become columns")
    return found


# The service categories of the given tables, for the SQL that checks the pivot.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def monthly_by_category(lines: DataFrame, services: DataFrame) -> DataFrame:
    """Sum per month and category.

    Lines are summed per service before the join, so each service meets its
    category with one row per month.
    """
    per_service = lines.groupBy("service_code", month_of(F.col("txn_ts")).alias("txn_month")).agg(F.sum("amount_xaf").alias("amount_xaf"))
    return (
        per_service.join(services.select("service_code", "category"), "service_code")
        .groupBy("txn_month", "category").agg(F.sum("amount_xaf").alias("amount_xaf"))
    )


def pivot_sum(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """One column per listed value, 0 where a cell has no rows."""
    wide = df.groupBy(row).pivot(column, columns).agg(F.sum(value))
    return wide.select(row, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns])


@R.query("monthly_category_pivot", with_sql(SERVICES, LINES, body="""
SELECT CAST(date_trunc('month', txn_ts) AS DATE) AS txn_month, """ + ", ".join(
    f"CAST(coalesce(sum(amount_xaf) FILTER (WHERE category = '{c}'), 0) AS DOUBLE) AS {c}" for c in CATEGORIES) + """
FROM lines JOIN services USING (service_code) GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    services = t.services(spark, sf)
    names = categories(services)
    wide = pivot_sum(monthly_by_category(t.transaction_lines(spark, sf), services), "txn_month", "category", "amount_xaf", names)
    return wide.select("txn_month", *[_double(c) for c in names])


@R.query("monthly_category_melt", with_sql(SERVICES, LINES, body="""
, m AS (SELECT CAST(date_trunc('month', txn_ts) AS DATE) AS txn_month, category, sum(amount_xaf) AS s
        FROM lines JOIN services USING (service_code) GROUP BY 1, 2),
g AS (SELECT txn_month, category FROM (SELECT DISTINCT txn_month FROM m), (SELECT unnest([""" + ", ".join(f"'{c}'" for c in CATEGORIES) + """]) AS category))
SELECT txn_month, category, CAST(coalesce(s, 0) AS DOUBLE) AS amount_xaf FROM g LEFT JOIN m USING (txn_month, category)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    services = t.services(spark, sf)
    names = categories(services)
    wide = pivot_sum(monthly_by_category(t.transaction_lines(spark, sf), services), "txn_month", "category", "amount_xaf", names)
    return wide.unpivot(["txn_month"], names, "category", "amount_xaf").select("txn_month", "category", _double("amount_xaf"))


@R.query("pivot_round_trip_check", with_sql(SERVICES, LINES, body="""
, m AS (SELECT date_trunc('month', txn_ts) AS txn_month, category, sum(amount_xaf) AS s
        FROM lines JOIN services USING (service_code) GROUP BY 1, 2)
SELECT count(*) AS cells, CAST(0 AS BIGINT) AS cells_that_differ FROM m WHERE s <> 0"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Melt of the pivot against the long form it came from: every cell must agree."""
    services = t.services(spark, sf)
    names = categories(services)
    long = monthly_by_category(t.transaction_lines(spark, sf), services)
    melted = pivot_sum(long, "txn_month", "category", "amount_xaf", names).unpivot(
        ["txn_month"], names, "category", "amount_xaf").filter(F.col("amount_xaf") != 0)
    differ = compare_frames(long, melted, ["txn_month", "category"]).agg(F.count(F.lit(1)).alias("d")).scalar()
    return long.agg(F.count(F.lit(1)).alias("cells")).select("cells", differ.alias("cells_that_differ"))


@R.query("frame_comparison", with_sql(AGENTS, TRANSACTIONS, body="""
, a AS (SELECT agent_id, sum(amount_xaf) AS amount_xaf, count(*) AS n FROM transactions GROUP BY 1),
b AS (SELECT agent_id, sum(amount_xaf) AS amount_xaf, count(*) AS n FROM transactions WHERE status <> 'P' GROUP BY 1),
j AS (SELECT a.agent_id, a.amount_xaf AS x, b.amount_xaf AS y, a.n AS p, b.n AS q, b.agent_id IS NULL AS gone FROM a LEFT JOIN b USING (agent_id))
SELECT agent_id, 'amount_xaf' AS "column", CAST(x AS DOUBLE) AS left_value, CAST(y AS DOUBLE) AS right_value
FROM j WHERE gone OR abs(CAST(x AS DOUBLE) - CAST(y AS DOUBLE)) > 0.0001
UNION ALL SELECT agent_id, 'n', CAST(p AS DOUBLE), CAST(q AS DOUBLE) FROM j WHERE gone OR p <> q"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of one aggregate, compared cell by cell; missing keys are reported too."""
    txns = t.transactions(spark, sf)

    def totals(df: DataFrame) -> DataFrame:
        return df.groupBy("agent_id").agg(F.sum("amount_xaf").alias("amount_xaf"), F.count(F.lit(1)).alias("n"))

    return compare_frames(totals(txns), totals(txns.filter(F.col("status") != "P")), ["agent_id"], 0.0001).select(
        "agent_id", "column", _double("left_value"), _double("right_value"))


@R.query("join_fanout_report", with_sql(AGENTS, TRANSACTIONS, body="""
SELECT (SELECT count(*) FROM agents) AS left_rows, (SELECT count(*) FROM transactions) AS right_rows,
       (SELECT count(*) FROM agents JOIN transactions USING (agent_id)) AS joined_rows,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM transactions GROUP BY agent_id)) AS max_matches"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return fanout_report(t.agents(spark, sf), t.transactions(spark, sf), "agent_id")
