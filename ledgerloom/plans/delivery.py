"""Delivered files: dirty CSV copies of the given tables, written and read by Spark, then cleaned and loaded.

The dirt follows from the keys, so the SQL knows which rows must be rejected.
Each query writes its delivery to a new path in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import numbers as n
from ..functions import text as x
from ..operators import loading
from ..operators.quality import Constraints, check_constraints, drop_missing, keep_known, narrow_types, narrowed_types
from ..operators.splits import sample_by_key
from ..session import new_path
from ..sources import files, schemas
from ..sources.sinks import insert_if_absent, write_csv
from . import tables as t
from .registry import Registry
from .tables import AGENTS, CONTAINERS, LINES, TRANSACTIONS, VESSELS, with_sql

R = Registry()


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _deliver(frames: list[DataFrame], spark: SparkSession, name: str, columns: tuple[str, ...]) -> DataFrame:
    """Write the frames as compressed CSV one after the other and read them back as text with their file order."""
    root = new_path(spark, name)
    paths = []
    for i, df in enumerate(frames):
        paths.append(f"{root}/{i:03d}")
        write_csv(df.select(*columns), paths[-1], "gzip")
    read = [files.with_file_order(files.read_csv(spark, p, schemas.raw(columns))) for p in paths]
    return reduce(DataFrame.unionByName, read)


# ---- agents, services, transactions ------------------------------------------------------------

def _mixed_date(c: Column, key: Column) -> Column:
    k = F.pmod(key, F.lit(3))
    return F.when(k == 0, F.date_format(c, "yyyy-MM-dd")).when(k == 1, F.date_format(c, "MM/dd/yyyy")).otherwise(F.date_format(c, "dd MMM yyyy"))


def agent_delivery(spark: SparkSession, sf: str) -> DataFrame:
    a = t.agents(spark, sf)
    k = F.col("agent_id")
    dirty = a.select(
        _text(" a", k, " ").alias("agent_id"), "agent_name", F.lit("Town").alias("town"), "division",
        F.when(F.pmod(k, F.lit(30)) == 2, "not a date").otherwise(_mixed_date(F.col("registered_on"), k)).alias("registered_on"),
        F.lower("agent_type").alias("agent_type"),
        F.when(F.pmod(k, F.lit(17)) == 0, "abc").otherwise(_text("XAF ", F.format_number(F.col("float_limit_xaf"), 2))).alias("float_limit_xaf"),
        F.element_at(F.array(F.lit("Closed"), F.lit("SUSPENDED "), F.lit("open"), F.lit("active")), F.pmod(k, F.lit(4)).cast("int") + 1).alias("status"),
        k.alias("k"),
    )
    again = dirty.filter(F.pmod("k", F.lit(10)) == 0).withColumn("agent_name", F.lit("later copy"))
    respelt = dirty.filter(F.pmod("k", F.lit(10)) == 3).withColumn("agent_id", _text("A", F.col("k")))
    return _deliver([dirty, again, respelt], spark, "agents", schemas.AGENTS)


def service_delivery(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("service_code")
    dirty = t.services(spark, sf).select(
        _text("s", k).alias("service_code"), "service_name", F.lower("category").alias("category"),
        F.when(F.pmod(k, F.lit(40)) == 7, "").otherwise(F.col("base_fee_pct").cast("string")).alias("base_fee_pct"))
    return _deliver([dirty], spark, "services", schemas.SERVICES)


_LINE_KEY = ("txn_id", "line_no", "service_code", "supplier_id")


def transaction_delivery(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("txn_id") * 7 + F.col("line_no")
    dirty = t.transaction_lines(spark, sf).select(
        F.concat_ws("-", *_LINE_KEY).alias("key"),
        _text(" a", F.col("agent_id")).alias("agent_id"), _text("S", F.col("service_code"), " ").alias("service_code"),
        F.when(F.pmod(k, F.lit(10)) == 0, "31/31/2020").otherwise(_mixed_date(F.col("txn_ts"), k)).alias("txn_ts"),
        _text("XAF ", F.format_number("amount_xaf", 2)).alias("amount_xaf"),
        F.when(F.pmod("service_code", F.lit(50)) == 0, "n/a").otherwise(F.format_number("fee_xaf", 2)).alias("fee_xaf"),
        F.lower("status").alias("status"), _text("6", F.lpad(F.col("agent_id").cast("string"), 8, "0")).alias("customer_msisdn"),
        F.pmod(k, F.lit(25)).alias("again"),
    ).withColumnRenamed("key", "txn_id")
    return _deliver([dirty, dirty.filter(F.col("again") == 0)], spark, "transactions", schemas.TRANSACTIONS)


_GOOD_AGENT = "agent_id % 30 <> 2 AND agent_id % 17 <> 0"
_STATUS = "CASE WHEN agent_id % 4 < 2 THEN 'inactive' ELSE 'active' END"
_CLEAN_AGENTS = f"""clean_agents AS (
  SELECT 'A' || agent_id AS agent_id, agent_name, division, registered_on, agent_type,
         CAST(float_limit_xaf AS DOUBLE) AS float_limit_xaf, {_STATUS} AS status, agent_id AS k FROM agents WHERE {_GOOD_AGENT})"""


@R.query("agents_cleaned", with_sql(AGENTS, _CLEAN_AGENTS, body="""
SELECT agent_id, agent_name, division, registered_on, agent_type, float_limit_xaf, status FROM clean_agents"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loading.clean_agents(agent_delivery(spark, sf)).accepted.select(
        "agent_id", "agent_name", "division", "registered_on", "agent_type", _double("float_limit_xaf"), "status")


@R.query("agents_reject_counts", with_sql(AGENTS, body="""
SELECT rule, count(*) AS n_rows FROM (
  SELECT CASE WHEN agent_id % 30 = 2 THEN 'bad_date' WHEN agent_id % 17 = 0 THEN 'missing_float_limit' ELSE 'loaded' END AS rule FROM agents
  UNION ALL SELECT 'duplicate_key' FROM agents WHERE agent_id % 10 = 0
  UNION ALL SELECT 'duplicate_key_after_cleaning' FROM agents WHERE agent_id % 10 = 3) GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loading.clean_agents(agent_delivery(spark, sf)).rejects()


_TXN_BASE = f"""base AS (
  SELECT concat_ws('-', txn_id, line_no, service_code, supplier_id) AS txn_id, agent_id, service_code, CAST(txn_ts AS DATE) AS day,
         amount_xaf, fee_xaf, status, (txn_id * 7 + line_no) AS k FROM lines),
tagged AS (SELECT *, CASE WHEN k % 10 = 0 THEN 'bad_date' WHEN service_code % 50 = 0 THEN 'missing_amount_or_fee'
  WHEN NOT ({_GOOD_AGENT}) THEN 'unknown_agent' WHEN service_code % 40 = 7 THEN 'unknown_service' END AS rule,
  count(*) OVER (PARTITION BY txn_id) AS copies, row_number() OVER (PARTITION BY txn_id) AS copy FROM base)"""


def _loaded(spark: SparkSession, sf: str) -> loading.Cleaned:
    agents = loading.clean_agents(agent_delivery(spark, sf)).accepted
    services = loading.clean_services(service_delivery(spark, sf)).accepted
    return loading.clean_transactions(transaction_delivery(spark, sf), agents, services)


@R.query("transactions_cleaned", with_sql(LINES, _TXN_BASE, body="""
SELECT txn_id, 'A' || agent_id AS agent_id, 'S' || service_code AS service_code, day AS txn_date,
       CAST(amount_xaf AS DOUBLE) AS amount_xaf, status, 'XXXXX' || right('6' || lpad(CAST(agent_id AS VARCHAR), 8, '0'), 4) AS customer_msisdn
FROM tagged WHERE rule IS NULL AND copy = 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf).accepted.select(
        "txn_id", "agent_id", "service_code", F.col("txn_ts").cast("date").alias("txn_date"), _double("amount_xaf"), "status", "customer_msisdn")


@R.query("transactions_reject_counts", with_sql(LINES, _TXN_BASE, body="""
SELECT rule, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT coalesce(rule, 'loaded') AS rule FROM tagged WHERE copy = 1
  UNION ALL SELECT 'duplicate_key' FROM tagged WHERE copy > 1
  UNION ALL SELECT 'duplicate_key' FROM tagged WHERE k % 25 = 0) GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf).rejects()


@R.query("load_twice_is_idempotent", with_sql(AGENTS, _CLEAN_AGENTS, body="""
SELECT (SELECT count(*) FROM clean_agents) AS first_load, CAST(0 AS BIGINT) AS second_load, (SELECT count(*) FROM clean_agents) AS rows_in_table"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Insert-if-absent of the same delivery two times."""
    agents = loading.clean_agents(agent_delivery(spark, sf)).accepted
    path = new_path(spark, "agents-table")
    added = [insert_if_absent(spark, path, agents, "agent_id", ["agent_name"], agents.columns) for _ in range(2)]
    return spark.read.parquet(path).agg(
        F.lit(added[0]).cast("bigint").alias("first_load"), F.lit(added[1]).cast("bigint").alias("second_load"),
        F.count(F.lit(1)).alias("rows_in_table"))


@R.query("typed_csv_round_trip", with_sql(TRANSACTIONS, body="""
SELECT txn_id, agent_id, CAST(txn_ts AS DATE) AS txn_date, CAST(amount_xaf AS DOUBLE) AS amount_xaf FROM transactions"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with a declared schema and date layout; rows that do not fit would be kept aside."""
    path = new_path(spark, "typed")
    write_csv(t.transactions(spark, sf).select("txn_id", "agent_id", F.date_format("txn_ts", "dd/MM/yyyy").alias("txn_date"), "amount_xaf"), path)
    df = files.read_csv(spark, path, "txn_id bigint, agent_id bigint, txn_date date, amount_xaf decimal(18,2)", "dd/MM/yyyy", keep_corrupt=True)
    return files.split_corrupt(df)[0].select("txn_id", "agent_id", "txn_date", _double("amount_xaf"))


@R.query("corrupt_csv_rows", with_sql(TRANSACTIONS, body="""
SELECT CAST(count_if(txn_id % 13 <> 0) AS BIGINT) AS fitting, CAST(count_if(txn_id % 13 = 0) AS BIGINT) AS corrupt FROM transactions"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "corrupt")
    bad = F.when(F.pmod("txn_id", F.lit(13)) == 0, "oops").otherwise(F.col("agent_id").cast("string"))
    write_csv(t.transactions(spark, sf).select("txn_id", bad.alias("agent_id")), path)
    good, bad = files.split_corrupt(files.read_csv(spark, path, "txn_id bigint, agent_id bigint", keep_corrupt=True))
    corrupt = bad.agg(F.count(F.lit(1)).alias("c")).scalar()
    return good.agg(F.count(F.lit(1)).alias("fitting")).select("fitting", corrupt.alias("corrupt"))


@R.query("known_and_complete_rows", """
SELECT user_id, count(*) AS n_rows FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
  AND value >= 5 GROUP BY 1""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Drop rows missing a value, then rows whose user is not known."""
    events = t.table(spark, sf, "events").withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    known = t.table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return keep_known(drop_missing(events, ["user_id", "value"]), "user_id", known, "c_custkey").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))


@R.query("optional_file_default", "SELECT o_custkey AS agent_id, CAST(0 AS DOUBLE) AS bureau_total_debt FROM orders GROUP BY 1")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery that was not made: the default takes its place."""
    missing = files.read_optional(spark, f"{sf}/bureau_not_delivered.parquet", "SK_ID_CURR bigint, debt double")
    ids = t.transactions(spark, sf).select("agent_id").distinct()
    if missing is None:
        return ids.withColumn("bureau_total_debt", F.lit(0.0))
    return ids.join(missing.select(F.col("SK_ID_CURR").alias("agent_id"), F.col("debt").alias("bureau_total_debt")), "agent_id", "left")


@R.query("sample_of_agents", "SELECT o_orderkey AS txn_id, o_custkey AS agent_id FROM orders WHERE substr(md5('7:' || o_custkey), 1, 4) < '3333'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the agents with all their transactions, the distributed form of reading the first N rows."""
    return sample_by_key(t.transactions(spark, sf), "agent_id", 7, 0.2).select("txn_id", "agent_id")


# ---- constraints and types ---------------------------------------------------------------------

def agent_constraints() -> Constraints:
    return Constraints(
        primary_key=["agent_id"], not_null=["agent_name", "division", "registered_on", "agent_type", "float_limit_xaf", "status"],
        checks={"float_limit_not_negative": F.col("float_limit_xaf") >= 0, "status_known": F.col("status").isin("active", "inactive")},
        max_length={"agent_name": 100, "division": 100},
    )


@R.query("constraint_violations", with_sql(AGENTS, LINES, body="""
, v AS (SELECT count_if(float_limit_xaf < 0) AS neg FROM agents),
d AS (SELECT sum(n - 1) AS dup FROM (SELECT count(*) AS n FROM lines GROUP BY txn_id, line_no)),
f AS (SELECT count(*) AS orphan FROM lines WHERE agent_id NOT IN (SELECT agent_id FROM agents WHERE status = 'active'))
SELECT * FROM (VALUES ('agents', 'not_null:agent_name'), ('agents', 'not_null:division'), ('agents', 'not_null:registered_on'),
  ('agents', 'not_null:agent_type'), ('agents', 'not_null:float_limit_xaf'), ('agents', 'not_null:status'), ('agents', 'check:status_known'),
  ('agents', 'length:agent_name'), ('agents', 'length:division'), ('agents', 'primary_key:agent_id'),
  ('lines', 'check:amount_not_negative')) x(table_name, rule), (SELECT CAST(0 AS BIGINT) AS violations)
UNION ALL SELECT 'agents', 'check:float_limit_not_negative', CAST(neg AS BIGINT) FROM v
UNION ALL SELECT 'lines', 'primary_key:txn_id,line_no', CAST(dup AS BIGINT) FROM d
UNION ALL SELECT 'lines', 'foreign_key:agent_id', CAST(orphan AS BIGINT) FROM f"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    agents, lines = t.agents(spark, sf), t.transaction_lines(spark, sf)
    active = agents.filter(F.col("status") == "active")
    line_rules = Constraints(primary_key=["txn_id", "line_no"], checks={"amount_not_negative": F.col("amount_xaf") >= 0},
                             foreign_keys={"agent_id": (active, "agent_id")})
    return check_constraints(agents, agent_constraints(), "agents").unionByName(check_constraints(lines, line_rules, "lines"))


def _int_type(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, CASE WHEN max({c}) < 128 AND min({c}) >= -128 THEN 'tinyint' WHEN max({c}) < 32768 AND min({c}) >= -32768 "
            f"THEN 'smallint' WHEN max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END AS narrow_type FROM lineitem")


_INTS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@R.query("narrowed_column_types", " UNION ALL ".join(_int_type(c) for c in _INTS) + """
UNION ALL SELECT 'l_quantity', CASE WHEN count_if(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) <> l_quantity) = 0 THEN 'float' ELSE 'double' END FROM lineitem
UNION ALL SELECT 'l_extendedprice', CASE WHEN count_if(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) <> l_extendedprice) = 0 THEN 'float' ELSE 'double' END FROM lineitem""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Smallest safe type of each numeric column, from one pass over the data."""
    df = t.table(spark, sf, "lineitem").select(*_INTS, "l_quantity", "l_extendedprice")
    to = narrowed_types(df)
    return spark.createDataFrame([(c, to.get(c, dict(df.dtypes)[c])) for c in df.columns], "column_name string, narrow_type string")


@R.query("narrowed_file_size")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet bytes of the joined fact before and after narrowing."""
    lines = t.transaction_lines(spark, sf).withColumn("fee_xaf", _double("fee_xaf")).withColumn("amount_xaf", _double("amount_xaf"))
    joined = lines.join(t.agents(spark, sf).select("agent_id", "agent_name", "division", "agent_type"), "agent_id")
    sizes, df = [], joined
    for name in ("before", "after"):
        path = new_path(spark, name)
        df.write.parquet(path)
        df = narrow_types(spark.read.schema(joined.schema).parquet(path)) if name == "before" else df  # the join runs once
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        sizes.append((name, p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()))
    return spark.createDataFrame(sizes, "version string, bytes bigint")


# ---- containers --------------------------------------------------------------------------------

def container_delivery(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = t.containers(spark, sf)
    k = F.pmod("vessel_id", F.lit(3))
    day = F.when(k == 0, F.date_format("arrived_on", "yyyy-MM-dd")).when(k == 1, F.date_format("arrived_on", "dd/MM/yyyy")).otherwise(F.date_format("arrived_on", "dd MMM yyyy"))
    flag = F.when(F.col("inspection_selected"), F.when(k == 0, "TRUE").otherwise("yes")).otherwise(F.when(k == 1, "FALSE").otherwise("no"))
    dirty = c.select(
        "container_id", "vessel_id", "importer_id", "broker_id", "hs_chapter", F.lit("goods").alias("goods_description"), "container_type",
        "origin_port", F.format_number("gross_weight_kg", 0).alias("gross_weight_kg"),
        F.when(k == 0, _text("XAF ", F.col("declared_value_xaf"))).otherwise(F.format_number("declared_value_xaf", 2)).alias("declared_value_xaf"),
        flag.alias("inspection_selected"), day.alias("arrived_on"), F.lit("5").alias("days_to_clear"),
        F.when(F.col("delayed") == 1, "YES").otherwise("NO").alias("delayed"),
    )
    containers = _deliver([dirty, dirty.filter(F.pmod("vessel_id", F.lit(20)) == 0)], spark, "containers", schemas.CONTAINERS)
    vessels = _deliver([t.vessels(spark, sf).withColumn("arrived_on", F.date_format("arrived_on", "dd/MM/yyyy"))], spark, "vessels", schemas.VESSELS)
    return containers, vessels


@R.query("containers_cleaned", with_sql(CONTAINERS, VESSELS, body="""
SELECT DISTINCT container_id, CAST(vessel_id AS VARCHAR) AS vessel_id, CAST(importer_id AS VARCHAR) AS importer_id, CAST(broker_id AS VARCHAR) AS broker_id,
       hs_chapter, container_type, CAST(gross_weight_kg AS DOUBLE) AS gross_weight_kg, CAST(declared_value_xaf AS DOUBLE) AS declared_value_xaf,
       inspection_selected, arrived_on, delayed, vessel_id NOT IN (SELECT vessel_id FROM vessels) AS vessel_missing FROM containers"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    containers, vessels = container_delivery(spark, sf)
    out = loading.clean_containers(containers, loading.clean_vessels(vessels))
    return out.select("container_id", "vessel_id", "importer_id", "broker_id", "hs_chapter", "container_type", _double("gross_weight_kg"),
                      _double("declared_value_xaf"), "inspection_selected", "arrived_on", "delayed", "vessel_missing")


@R.query("vessels_cleaned", with_sql(VESSELS, body="SELECT CAST(vessel_id AS VARCHAR) AS vessel_id, arrived_on, teu_discharged FROM vessels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loading.clean_vessels(container_delivery(spark, sf)[1])


@R.query("brokers_and_importers_cleaned", """
SELECT 'broker' AS kind, CAST(s_suppkey AS VARCHAR) AS id, CAST(1990 + s_suppkey % 30 AS INTEGER) AS year, CAST(1 + s_nationkey AS INTEGER) AS staff FROM supplier
UNION ALL SELECT 'importer', CAST(c_custkey AS VARCHAR), CAST(1980 + c_custkey % 40 AS INTEGER), NULL FROM customer""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    brokers = t.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("broker_id"), (F.pmod("s_suppkey", F.lit(30)) + 1990).alias("licence_year"), (F.col("s_nationkey") + 1).alias("staff"))
    importers = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("importer_id"), (F.pmod("c_custkey", F.lit(40)) + 1980).alias("registered_year"))
    b = loading.clean_brokers(_deliver([brokers], spark, "brokers", schemas.BROKERS))
    i = loading.clean_importers(_deliver([importers], spark, "importers", schemas.IMPORTERS))
    return b.select(F.lit("broker").alias("kind"), F.col("broker_id").alias("id"), F.col("licence_year").alias("year"), "staff").unionByName(
        i.select(F.lit("importer").alias("kind"), F.col("importer_id").alias("id"), F.col("registered_year").alias("year")), allowMissingColumns=True)


# ---- column expressions on the given tables ----------------------------------------------------

_PHONE = "CASE WHEN c_custkey % 5 = 0 THEN '+237 6' || lpad(CAST(c_custkey AS VARCHAR), 8, '5') WHEN c_custkey % 5 = 1 THEN CAST(c_custkey AS VARCHAR) " \
         "WHEN c_custkey % 5 = 2 THEN '67' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') ELSE '6-9' || lpad(CAST(c_custkey AS VARCHAR), 7, '1') END"


@R.query("phone_expressions", f"""
WITH p AS (SELECT c_custkey, {_PHONE} AS phone FROM customer),
d AS (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS g FROM p),
f AS (SELECT *, CASE WHEN length(g) = 9 THEN '237' || g ELSE g END AS full_ FROM d),
n AS (SELECT *, CASE WHEN length(full_) = 12 AND starts_with(full_, '237') THEN full_ END AS norm FROM f)
SELECT c_custkey AS agent_id, phone, norm, norm IS NOT NULL AS is_valid,
  CASE WHEN substr(norm, 1, 5) IN ('23767', '23768', '23679') THEN 'MTN_MOMO' WHEN substr(norm, 1, 5) IN ('23765', '23769') THEN 'ORANGE_MONEY' ELSE 'MTN_MOMO' END AS provider,
  CASE WHEN length(phone) <= 4 THEN repeat('X', length(phone)) ELSE repeat('X', length(phone) - 4) || right(phone, 4) END AS masked,
  substr(phone, 1, 6) || 'XXXXXX' AS audit FROM n""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    kt = k.cast("string")
    m = F.pmod(k, F.lit(5))
    phone = (F.when(m == 0, F.concat(F.lit("+237 6"), F.lpad(kt, 8, "5"))).when(m == 1, kt)
             .when(m == 2, F.concat(F.lit("67"), F.lpad(kt, 7, "0"))).otherwise(F.concat(F.lit("6-9"), F.lpad(kt, 7, "1"))))
    p = t.table(spark, sf, "customer").select(k.alias("agent_id"), phone.alias("phone"))
    c = F.col("phone")
    norm = x.normalise_phone(c)
    return p.select("agent_id", "phone", norm.alias("norm"), x.is_valid_phone(c).alias("is_valid"), x.phone_provider(norm).alias("provider"),
                    x.mask_phone(c).alias("masked"), x.audit_mask(c).alias("audit"))


@R.query("number_and_date_expressions", """
SELECT o_orderkey AS txn_id, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, isodow(o_orderdate) >= 6 AS is_weekend,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
  CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS months_since_start,
  CAST(((o_orderkey - 500) % 7 + 7) % 7 AS BIGINT) AS bucket,
  least(greatest(o_totalprice / 1000 - 50, 0.0), 200.0) AS clipped,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / (o_orderkey % 4) END AS divided,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS nan_as_null,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE greatest(o_totalprice, 250000.0) END AS max_or_null,
  round(1 / (1 + exp(-(ln((o_orderkey % 97 + 1) / 100.0 / (1 - (o_orderkey % 97 + 1) / 100.0)) + 0.18))), 9) AS shifted,
  round(pow(o_totalprice, 0.65), 6) AS powered,
  CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-31' AS in_window FROM orders""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    key, day, price = F.col("o_orderkey"), F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    holed = n.nan_to_null(F.when(F.pmod(key, F.lit(6)) == 0, F.lit(float("nan"))).otherwise(price))
    p = (F.pmod(key, F.lit(97)) + 1) / F.lit(100.0)
    return t.table(spark, sf, "orders").select(
        key.alias("txn_id"), F.weekday(day).alias("weekday"), (F.weekday(day) >= 5).alias("is_weekend"), d.month_of(day).alias("month_start"),
        d.month_offset(day, F.lit("1995-01-01").cast("date")).alias("months_since_start"), n.bucket_of(key - 500, 7).alias("bucket"),
        n.clip(price / 1000 - 50, 0.0, 200.0).alias("clipped"), n.safe_divide(price, F.pmod(key, F.lit(4))).alias("divided"),
        holed.alias("nan_as_null"), n.max_of(holed, F.lit(250000.0)).alias("max_or_null"), F.round(n.shift_log_odds(p, 0.18), 9).alias("shifted"),
        F.round(n.power_score(F.lit(1.0), price), 6).alias("powered"), d.in_window(day, "1998-01-01", 30).alias("in_window"))


@R.query("amount_and_percent_text", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  format('{:,}', CAST(round_even(l_quantity * 1500, 0) AS BIGINT)) AS amount, CAST(CAST(round_even(l_discount * 100, 0) AS INTEGER) AS VARCHAR) || '%' AS pct FROM lineitem""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 x.amount_text(F.col("l_quantity") * 1500).alias("amount"), x.percent_text(F.col("l_discount")).alias("pct"))
