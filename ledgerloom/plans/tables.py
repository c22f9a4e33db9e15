"""The given tables, read as the entities the library works on.

Each entity is a Spark projection and, beside it, the same projection as SQL
for the checks. Money is exact decimal on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clearance import container_teu


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


# ---- agents, services, transactions ------------------------------------------------------------

def agents(spark: SparkSession, sf: str) -> DataFrame:
    first_order = (
        table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("registered_on"))
    )
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("agent_id"), F.col("c_name").alias("agent_name"),
            F.col("n_name").alias("division"), "registered_on", F.col("c_mktsegment").alias("agent_type"),
            money("c_acctbal").alias("float_limit_xaf"),
            F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("status"),
        )
    )


def services(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("service_code"), F.col("p_name").alias("service_name"),
        F.col("p_type").alias("category"), F.col("p_size").cast("decimal(5,2)").alias("base_fee_pct"),
    )


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("agent_id"),
        F.col("o_orderdate").alias("txn_ts"), money("o_totalprice").alias("amount_xaf"),
        F.col("o_orderstatus").alias("status"),
    )


def transaction_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line: carries the service and the fee."""
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("txn_id"), F.col("l_linenumber").alias("line_no"),
            F.col("o_custkey").alias("agent_id"), F.col("l_partkey").alias("service_code"),
            F.col("l_suppkey").alias("supplier_id"), F.col("o_orderdate").alias("txn_ts"),
            money("l_extendedprice").alias("amount_xaf"),
            (money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")).alias("fee_xaf"),
            F.col("o_orderstatus").alias("status"),
        )
    )


AGENTS = """agents AS (
  SELECT c_custkey AS agent_id, c_name AS agent_name, n_name AS division, registered_on,
         c_mktsegment AS agent_type, CAST(c_acctbal AS DECIMAL(18,2)) AS float_limit_xaf,
         CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS status
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS registered_on FROM orders GROUP BY o_custkey) r
    ON r.o_custkey = c_custkey)"""
SERVICES = """services AS (
  SELECT p_partkey AS service_code, p_name AS service_name, p_type AS category,
         CAST(p_size AS DECIMAL(5,2)) AS base_fee_pct FROM part)"""
TRANSACTIONS = """transactions AS (
  SELECT o_orderkey AS txn_id, o_custkey AS agent_id, o_orderdate AS txn_ts,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount_xaf, o_orderstatus AS status FROM orders)"""
LINES = """lines AS (
  SELECT l_orderkey AS txn_id, l_linenumber AS line_no, o_custkey AS agent_id, l_partkey AS service_code,
         l_suppkey AS supplier_id, o_orderdate AS txn_ts, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount_xaf,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS fee_xaf, o_orderstatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


# ---- containers --------------------------------------------------------------------------------

def container_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Containers with what their id and weight are made of; :func:`named_containers` adds those two.

    Columns are derived before the joins, so that dates and exact money are shuffled and no texts made from
    them; the join by order is last, so that a join by vessel that follows needs no shuffle of its own.
    """
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("vessel_id"), F.col("l_linenumber").alias("_line"), F.col("l_partkey").alias("_part"),
        F.col("l_suppkey").alias("broker_id"), F.col("l_quantity").alias("_quantity"), money("l_extendedprice").alias("declared_value_xaf"),
        (F.col("l_linestatus") == "O").alias("inspection_selected"), F.col("l_shipdate").cast("date").alias("arrived_on"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("delayed"),
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("_part"), F.col("p_brand").alias("hs_chapter"),
        F.concat(F.when(F.col("p_size") % 2 == 0, "40").otherwise("20"), F.lit("FT "), F.col("p_type")).alias("container_type"),
    ).withColumn("container_teu", container_teu(F.col("container_type")))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("vessel_id"), F.col("o_custkey").alias("importer_id"), F.col("o_orderpriority").alias("origin_port"))
    return lines.join(parts, "_part").join(orders, "vessel_id")


ID_PARTS = ("_line", "_part", "_quantity")


def named_containers(parts: DataFrame) -> DataFrame:
    return parts.withColumns({
        "container_id": F.concat_ws("-", "vessel_id", "_line", "_part", "broker_id", F.col("arrived_on").cast("string"),
                                    F.col("_quantity").cast("int").cast("string")),
        "gross_weight_kg": money("_quantity"),
    })


def containers(spark: SparkSession, sf: str) -> DataFrame:
    return named_containers(container_parts(spark, sf)).select(
        "container_id", "vessel_id", "importer_id", "broker_id", "hs_chapter", "container_type", "origin_port", "gross_weight_kg",
        "declared_value_xaf", "inspection_selected", "arrived_on", "delayed")


def vessels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("vessel_id"), F.col("o_orderdate").cast("date").alias("arrived_on"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("teu_discharged"),
    )


CONTAINERS = """containers AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE), CAST(l_quantity AS INTEGER)) AS container_id, l_orderkey AS vessel_id,
         o_custkey AS importer_id, l_suppkey AS broker_id, p_brand AS hs_chapter,
         (CASE WHEN p_size % 2 = 0 THEN '40' ELSE '20' END) || 'FT ' || p_type AS container_type,
         o_orderpriority AS origin_port, CAST(l_quantity AS DECIMAL(18,2)) AS gross_weight_kg,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS declared_value_xaf, l_linestatus = 'O' AS inspection_selected,
         CAST(l_shipdate AS DATE) AS arrived_on, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS delayed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
VESSELS = """vessels AS (
  SELECT o_orderkey AS vessel_id, CAST(o_orderdate AS DATE) AS arrived_on,
         CAST(floor(o_totalprice / 100) AS INTEGER) AS teu_discharged FROM orders WHERE o_orderstatus <> 'P')"""


# ---- instalments -------------------------------------------------------------------------------

EPOCH = "1995-01-01"


def instalments(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    due = F.datediff("o_orderdate", F.lit(EPOCH).cast("date")) + 30 * F.col("l_linenumber")
    gap = F.datediff("l_shipdate", "o_orderdate")
    unpaid = F.pmod(gap, F.lit(11)) == 0
    half = (money("l_extendedprice") * F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,2)")
    return rows.select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"), due.alias("DAYS_INSTALMENT"),
        F.when(~unpaid, due + F.pmod(gap, F.lit(75)) - 15).alias("DAYS_ENTRY_PAYMENT"),
        money("l_extendedprice").alias("AMT_INSTALMENT"),
        F.when(unpaid, F.lit(0).cast("decimal(18,2)")).when(F.col("l_discount") > 0.08, half)
        .otherwise(money("l_extendedprice")).alias("AMT_PAYMENT"),
        F.col("l_partkey").alias("tie_a"), F.col("l_suppkey").alias("tie_b"),
    )


def applications(spark: SparkSession, sf: str) -> DataFrame:
    credit = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).alias("credit"))
    return table(spark, sf, "customer").join(credit, "c_custkey", "left").select(
        F.col("c_custkey").alias("SK_ID_CURR"), F.col("c_acctbal").alias("AMT_INCOME_TOTAL"),
        F.col("credit").cast("double").alias("AMT_CREDIT"), (F.col("credit").cast("double") / 24).alias("AMT_ANNUITY"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(9)) == 0, 365243).otherwise(-F.pmod(F.col("c_custkey") * 53, F.lit(9000)))
        .cast("int").alias("DAYS_EMPLOYED"),
        (-(6570 + F.pmod(F.col("c_custkey") * 37, F.lit(21900)))).cast("int").alias("DAYS_BIRTH"),
    )


def bureau(spark: SparkSession, sf: str) -> DataFrame:
    late = F.when(F.col("o_orderpriority").startswith("1"), money("o_totalprice"))
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"), money("o_totalprice").alias("AMT_CREDIT_SUM_DEBT"),
        late.alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Closed").alias("CREDIT_ACTIVE"),
    )


def pos_cash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("SK_ID_CURR"), F.pmod("event_id", F.lit(90)).cast("int").alias("SK_DPD"))


GAP = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"
DUE = f"CAST(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) + 30 * l_linenumber AS INTEGER)"
INSTALMENTS = f"""inst AS (
  SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER,
         {DUE} AS DAYS_INSTALMENT,
         CASE WHEN (({GAP} % 11) + 11) % 11 <> 0
              THEN CAST({DUE} + (({GAP} % 75) + 75) % 75 - 15 AS INTEGER) END AS DAYS_ENTRY_PAYMENT,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS AMT_INSTALMENT,
         CASE WHEN (({GAP} % 11) + 11) % 11 = 0 THEN CAST(0 AS DECIMAL(18,2))
              WHEN l_discount > 0.08 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS AMT_PAYMENT,
         l_partkey AS tie_a, l_suppkey AS tie_b
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
APPLICATIONS = """app AS (
  SELECT c_custkey AS SK_ID_CURR, c_acctbal AS AMT_INCOME_TOTAL, CAST(credit AS DOUBLE) AS AMT_CREDIT,
         CAST(credit AS DOUBLE) / 24 AS AMT_ANNUITY,
         CAST(CASE WHEN c_custkey % 9 = 0 THEN 365243 ELSE -((c_custkey * 53) % 9000) END AS INTEGER) AS DAYS_EMPLOYED,
         CAST(-(6570 + (c_custkey * 37) % 21900) AS INTEGER) AS DAYS_BIRTH
  FROM customer LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS credit FROM orders GROUP BY o_custkey) c
    ON o_custkey = c_custkey)"""
BUREAU = """bureau AS (
  SELECT o_custkey AS SK_ID_CURR, CAST(o_totalprice AS DECIMAL(18,2)) AS AMT_CREDIT_SUM_DEBT,
         CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS AMT_CREDIT_SUM_OVERDUE,
         CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE FROM orders)"""
POS_CASH = "pos AS (SELECT user_id AS SK_ID_CURR, CAST(event_id % 90 AS INTEGER) AS SK_DPD FROM events)"


def with_sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body.lstrip()
