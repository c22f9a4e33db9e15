"""The plain relational exercises: projections, filters, joins, aggregates, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import above_average, full_outer, left_outer
from . import tables as t
from .registry import Registry
from .tables import AGENTS, LINES, SERVICES, TRANSACTIONS, with_sql

R = Registry()


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


_AGENT_COLUMNS = "agent_id, agent_name, division, registered_on, agent_type, CAST(float_limit_xaf AS DOUBLE) AS float_limit_xaf, status"


def _agents(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).withColumn("float_limit_xaf", F.col("float_limit_xaf").cast("double"))


@R.query("all_agents", with_sql(AGENTS, body=f"SELECT {_AGENT_COLUMNS} FROM agents"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _agents(spark, sf)


@R.query("active_agents", with_sql(AGENTS, body=f"SELECT {_AGENT_COLUMNS} FROM agents WHERE status = 'active'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _agents(spark, sf).filter(F.col("status") == "active")


@R.query("agents_of_a_division", with_sql(AGENTS, body=f"SELECT {_AGENT_COLUMNS} FROM agents WHERE division = 'NATION_3'"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _agents(spark, sf).filter(F.col("division") == "NATION_3")


@R.query("distinct_agent_types", with_sql(AGENTS, body="SELECT DISTINCT agent_type FROM agents"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).select("agent_type").distinct()


@R.query("top_agents_by_float_limit", with_sql(AGENTS, body="""
SELECT agent_id, agent_name, CAST(float_limit_xaf AS DOUBLE) AS float_limit_xaf FROM agents
ORDER BY agents.float_limit_xaf DESC, agent_id LIMIT 10"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _agents(spark, sf).select("agent_id", "agent_name", "float_limit_xaf").orderBy(
        F.col("float_limit_xaf").desc(), "agent_id").limit(10)


@R.query("global_totals", with_sql(AGENTS, TRANSACTIONS, body="""
SELECT count(*) AS total_agents, CAST(sum(float_limit_xaf) AS DOUBLE) / count(float_limit_xaf) AS average_float_limit,
       (SELECT CAST(sum(amount_xaf) AS DOUBLE) FROM transactions) AS total_transaction_amount FROM agents"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    amount = t.transactions(spark, sf).agg(F.sum("amount_xaf").cast("double").alias("x")).scalar()
    return t.agents(spark, sf).agg(
        F.count(F.lit(1)).alias("total_agents"),
        (F.sum("float_limit_xaf").cast("double") / F.count("float_limit_xaf")).alias("average_float_limit"),
    ).select("total_agents", "average_float_limit", amount.alias("total_transaction_amount"))


@R.query("agents_per_type", with_sql(AGENTS, body="SELECT agent_type, count(*) AS total_agents FROM agents GROUP BY 1"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).groupBy("agent_type").agg(F.count(F.lit(1)).alias("total_agents"))


@R.query("agent_types_over_threshold", with_sql(AGENTS, body="""
SELECT agent_type, count(*) AS total_agents FROM agents GROUP BY 1 HAVING count(*) > 300"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).groupBy("agent_type").agg(F.count(F.lit(1)).alias("total_agents")).filter(F.col("total_agents") > 300)


_JOINED = "txn_id, agent_id, agent_name, CAST(amount_xaf AS DOUBLE) AS amount_xaf"


@R.query("transactions_inner_agents", with_sql(AGENTS, TRANSACTIONS, body=f"SELECT {_JOINED} FROM transactions JOIN agents USING (agent_id)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transactions(spark, sf).join(t.agents(spark, sf), "agent_id").select("txn_id", "agent_id", "agent_name", _double("amount_xaf"))


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (t.agents(spark, sf).select("agent_id", "agent_name"),
            t.transactions(spark, sf).select("agent_id", "txn_id", "amount_xaf"))


@R.query("agents_left_transactions", with_sql(AGENTS, TRANSACTIONS, body=f"SELECT {_JOINED} FROM agents LEFT JOIN transactions USING (agent_id)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, tx = _sides(spark, sf)
    return left_outer(a, tx, "agent_id").select("txn_id", "agent_id", "agent_name", _double("amount_xaf"))


@R.query("agents_right_transactions", with_sql(AGENTS, TRANSACTIONS, body=f"SELECT {_JOINED} FROM agents RIGHT JOIN transactions USING (agent_id)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The fact is the preserved side, which adaptive execution can split."""
    a, tx = _sides(spark, sf)
    return a.join(tx, "agent_id", "right").select("txn_id", "agent_id", "agent_name", _double("amount_xaf"))


@R.query("agents_full_transactions", with_sql(AGENTS, TRANSACTIONS, body=f"SELECT {_JOINED} FROM agents FULL JOIN transactions USING (agent_id)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, tx = _sides(spark, sf)
    return full_outer(a, tx, "agent_id").select("txn_id", "agent_id", "agent_name", _double("amount_xaf"))


@R.query("transactions_full_lines", """
SELECT coalesce(o_orderkey, l_orderkey) AS txn_id, o_custkey AS agent_id, l_partkey AS service_code
FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A full outer join in which some transactions have no line."""
    orders = t.table(spark, sf, "orders").select(F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("agent_id"))
    lines = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("txn_id"), F.col("l_partkey").alias("service_code"))
    return full_outer(orders, lines, "txn_id")


@R.query("transactions_with_service", with_sql(SERVICES, LINES, body="""
SELECT txn_id, line_no, service_name, category, CAST(amount_xaf AS DOUBLE) AS amount_xaf FROM lines JOIN services USING (service_code)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transaction_lines(spark, sf).join(t.services(spark, sf), "service_code").select(
        "txn_id", "line_no", "service_name", "category", _double("amount_xaf"))


@R.query("agents_above_average_float", with_sql(AGENTS, body="""
SELECT agent_id, agent_name, CAST(float_limit_xaf AS DOUBLE) AS float_limit_xaf FROM agents
WHERE float_limit_xaf > (SELECT sum(float_limit_xaf) / count(*) FROM agents)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return above_average(t.agents(spark, sf), "float_limit_xaf").select("agent_id", "agent_name", _double("float_limit_xaf"))


@R.query("transactions_above_average_amount", with_sql(TRANSACTIONS, body="""
SELECT txn_id, agent_id, CAST(amount_xaf AS DOUBLE) AS amount_xaf FROM transactions
WHERE amount_xaf > (SELECT sum(amount_xaf) / count(*) FROM transactions)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return above_average(t.transactions(spark, sf), "amount_xaf").select("txn_id", "agent_id", _double("amount_xaf"))


@R.query("agent_types_registered_before", with_sql(AGENTS, body="""
SELECT DISTINCT agent_type FROM agents WHERE registered_on < DATE '1995-02-01'"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).filter(F.col("registered_on") < F.lit("1995-02-01").cast("date")).select("agent_type").distinct()


@R.query("divisions_union_categories", with_sql(AGENTS, SERVICES, body="""
SELECT division AS value FROM agents UNION SELECT category AS value FROM services"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).select(F.col("division").alias("value")).union(
        t.services(spark, sf).select(F.col("category").alias("value"))).distinct()


@R.query("agents_intersect_transactions", with_sql(AGENTS, TRANSACTIONS, body="""
SELECT agent_id FROM agents INTERSECT SELECT agent_id FROM transactions"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.agents(spark, sf).select("agent_id").intersect(t.transactions(spark, sf).select("agent_id"))


@R.query("transactions_except_lines", """SELECT o_orderkey AS txn_id FROM orders EXCEPT SELECT l_orderkey FROM lineitem""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transactions(spark, sf).select("txn_id").subtract(t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("txn_id")))


@R.query("null_aware_counts", """
SELECT count(*) AS total_orders, count(l_orderkey) AS orders_with_lines, count(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS open_orders_with_amount
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    with_lines = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(1))
    return t.table(spark, sf, "orders").join(with_lines, "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("total_orders"), F.count("hit").alias("orders_with_lines"),
        F.count(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("open_orders_with_amount"))


@R.query("amount_per_agent", with_sql(TRANSACTIONS, body="""
SELECT agent_id, CAST(sum(amount_xaf) AS DOUBLE) AS amount_xaf FROM transactions GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transactions(spark, sf).groupBy("agent_id").agg(F.sum("amount_xaf").cast("double").alias("amount_xaf")).orderBy("agent_id")


@R.query("fee_per_agent_and_service", with_sql(LINES, body="""
SELECT agent_id, service_code, CAST(sum(fee_xaf) AS DOUBLE) AS fee_xaf FROM lines GROUP BY 1, 2"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transaction_lines(spark, sf).groupBy("agent_id", "service_code").agg(
        F.sum("fee_xaf").cast("double").alias("fee_xaf")).orderBy("agent_id", "service_code")


@R.query("transactions_per_status", with_sql(TRANSACTIONS, body="SELECT status, count(*) AS txn_count FROM transactions GROUP BY 1"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.transactions(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("txn_count")).orderBy("status")


@R.query("distinct_agents_per_status_and_type", with_sql(AGENTS, TRANSACTIONS, body="""
SELECT agent_type, count(DISTINCT t.agent_id) AS agents, count(DISTINCT t.status) AS statuses, count(*) AS txns
FROM transactions t JOIN agents USING (agent_id) GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Two distinct counts: transactions collapse to (agent, status) before the join."""
    small = t.transactions(spark, sf).groupBy("agent_id", "status").agg(F.count(F.lit(1)).alias("n"))
    return small.join(t.agents(spark, sf).select("agent_id", "agent_type"), "agent_id").groupBy("agent_type").agg(
        F.countDistinct("agent_id").alias("agents"), F.countDistinct("status").alias("statuses"), F.sum("n").alias("txns"))
