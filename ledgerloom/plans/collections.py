"""Decisions on the arrears book: contact, ranking, messages, policy comparison, portfolio reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import decisions as dec
from ..operators import reports as rep
from ..operators import templates as tpl
from ..operators.arrears import FEATURE_COLUMNS
from ..operators.metrics import compare_policies, ranking_metrics, at_k
from ..operators.splits import entity_split
from ..sources.files import REQUIRED, resolve_columns
from . import arrears as ar
from . import tables as t
from .registry import Registry
from .tables import APPLICATIONS, INSTALMENTS, with_sql

R = Registry()
KEY = ["SK_ID_CURR", "SK_ID_PREV"]


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _money(c: str) -> str:
    return f"format('{{:,}}', CAST(round_even({c}, 0) AS BIGINT))"


def _pct(c: str) -> str:
    return f"CAST(CAST(round_even({c} * 100, 0) AS INTEGER) AS VARCHAR) || '%'"


def book(spark: SparkSession, sf: str) -> DataFrame:
    """The arrears events with a probability and a settlement ratio that follow from the loan number."""
    loan = F.col("SK_ID_PREV")
    app = t.applications(spark, sf).select("SK_ID_CURR", F.col("DAYS_BIRTH").alias("days_birth"), F.col("DAYS_EMPLOYED").alias("days_employed"))
    return ar.events(spark, sf).join(app, "SK_ID_CURR", "left").select(
        *KEY, "recovered", "observation_day", (F.col("overdue_amount") * 3).cast("double").alias("overdue_amount"),
        (F.pmod(loan * 37, F.lit(1000)).cast("double") / 1000).alias("recovery_probability"),
        (F.lit(0.35) + F.pmod(loan, F.lit(66)).cast("double") / 100).alias("partial_recovery_ratio"), "days_birth", "days_employed",
        F.element_at(F.array(*[F.lit(o) for o in dec.OFFICERS]), F.pmod(loan, F.lit(3)).cast("int") + 1).alias("assigned_officer"))


BOOK = f"""book AS (SELECT SK_ID_CURR, SK_ID_PREV, recovered, observation_day, CAST(overdue_amount * 3 AS DOUBLE) AS overdue_amount,
  CAST((SK_ID_PREV * 37) % 1000 AS DOUBLE) / 1000 AS recovery_probability, 0.35::DOUBLE + CAST(SK_ID_PREV % 66 AS DOUBLE) / 100 AS partial_recovery_ratio,
  DAYS_BIRTH AS days_birth, DAYS_EMPLOYED AS days_employed,
  CASE SK_ID_PREV % 3 WHEN 0 THEN {_sql_text(dec.OFFICERS[0])} WHEN 1 THEN {_sql_text(dec.OFFICERS[1])} ELSE {_sql_text(dec.OFFICERS[2])} END AS assigned_officer
  FROM ev LEFT JOIN app USING (SK_ID_CURR))"""
BASE = (INSTALMENTS, APPLICATIONS, ar.EVENTS, BOOK)

_A, _P = "overdue_amount", "recovery_probability"
CONTACT = f"""why AS (SELECT *, CASE WHEN coalesce(abs(days_birth) / 365.25, 40) >= 60 THEN '{dec.SENIOR}' WHEN days_employed >= 0 THEN '{dec.UNEMPLOYED}'
    WHEN {_P} < 0.05 AND {_A} > 200000 THEN '{dec.DISTRESS}' ELSE 'Standard' END AS why,
    least(0.99, {_P} * 1.0) * {_A} - 50 AS n1, least(0.99, {_P} * 1.25) * {_A} - 500 AS n2, least(0.99, {_P} * 1.45) * {_A} - 5000 AS n3 FROM book),
chan AS (SELECT *, why <> 'Standard' AS is_vulnerable, CASE WHEN why <> 'Standard' THEN CASE WHEN {_A} >= 20000 THEN 'CALL' ELSE 'SMS' END
    WHEN {_A} >= 25000 AND {_P} >= 0.10 AND n3 > greatest(n1, n2) THEN 'FIELD_VISIT' WHEN n2 > n1 THEN 'CALL' ELSE 'SMS' END AS recommended_channel FROM why),
contact AS (SELECT *, CAST(CASE recommended_channel WHEN 'FIELD_VISIT' THEN 5000 WHEN 'CALL' THEN 500 ELSE 50 END AS DOUBLE) AS channel_cost_fcfa,
    CASE recommended_channel WHEN 'FIELD_VISIT' THEN n3 WHEN 'CALL' THEN n2 ELSE n1 END AS expected_net_recovery_fcfa,
    CASE WHEN is_vulnerable THEN why || ' - Friendly outreach & restructuring inquiry.'
      WHEN recommended_channel = 'FIELD_VISIT' THEN 'High recoverable debt (' || {_money(_A)} || ' FCFA, ' || {_pct(_P)} || ' cure prob). Justifies 5,000 FCFA transit.'
      WHEN recommended_channel = 'CALL' THEN 'Moderate balance (' || {_money(_A)} || ' FCFA, ' || {_pct(_P)} || ' cure prob). Call resolves delay efficiently.'
      ELSE 'High auto-cure probability (' || {_pct(_P)} || ') or modest debt. Automated SMS reminder sufficient.' END AS action_reason FROM chan)"""


@R.query("vulnerability_screen", with_sql(*BASE, CONTACT, body="SELECT SK_ID_CURR, SK_ID_PREV, why AS reason FROM why"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return book(spark, sf).select(*KEY, dec.vulnerability(F.col(_P), F.col(_A), F.col("days_birth"), F.col("days_employed")).alias("reason"))


@R.query("contact_recommendation", with_sql(*BASE, CONTACT, body="""
SELECT SK_ID_CURR, SK_ID_PREV, recommended_channel, channel_cost_fcfa, expected_net_recovery_fcfa, is_vulnerable, action_reason FROM contact"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.recommend_channel(book(spark, sf)).select(
        *KEY, "recommended_channel", "channel_cost_fcfa", "expected_net_recovery_fcfa", "is_vulnerable", "action_reason")


_ZONE = "CASE SK_ID_CURR % 5 " + " ".join(f"WHEN {i} THEN {_sql_text(z)}" for i, (z, _) in enumerate(dec.ZONES)) + " END"
_BADGE = "CASE SK_ID_CURR % 5 " + " ".join(f"WHEN {i} THEN {_sql_text(b)}" for i, (_, b) in enumerate(dec.ZONES)) + " END"


@R.query("zone_and_travel_note", with_sql(*BASE, body=f"SELECT SK_ID_CURR, SK_ID_PREV, {_ZONE} AS zone, {_BADGE} AS security_badge FROM book"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.add_zone(book(spark, sf)).select(*KEY, "zone", "security_badge")


@R.query("route_savings_per_officer", with_sql(*BASE, CONTACT, body=f"""
, v AS (SELECT assigned_officer, count_if(recommended_channel = 'FIELD_VISIT') AS n, count(DISTINCT CASE WHEN recommended_channel = 'FIELD_VISIT' THEN SK_ID_CURR % 5 END) AS z FROM contact GROUP BY 1),
s AS (SELECT *, n * 6.5::DOUBLE AS u, CASE WHEN n > 0 THEN z * 4.0::DOUBLE + n * 1.5::DOUBLE ELSE 0 END AS c FROM v), d AS (SELECT *, greatest(0.0, u - c) AS k FROM s)
SELECT assigned_officer, CAST(n AS BIGINT) AS n_field_visits, round_even(u, 1) AS unclustered_km, round_even(c, 1) AS clustered_km, round_even(k, 1) AS km_saved,
  round_even(k / 30.0, 2) AS fuel_saved_liters, round_even(k / 30.0 * 850.0, 0) AS fuel_cash_saved_fcfa, round_even(k / greatest(1.0, u) * 100.0, 1) AS pct_distance_saved FROM d"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.route_savings(dec.add_zone(dec.recommend_channel(book(spark, sf))))


_UPLIFT = f"(least(greatest({_P} * 1.25, 0.0), 0.99) - {_P})"
_SEGMENT = f"CASE WHEN {_P} >= 0.70 THEN 'Self-Curer (SMS Only)' WHEN {_UPLIFT} >= 0.08 AND {_P} >= 0.10 THEN 'Persuadable (High Priority)' WHEN {_P} < 0.05 THEN 'Lost Cause (Restructure)' ELSE 'Moderate Yield' END"


@R.query("uplift_and_segment", with_sql(*BASE, body=f"SELECT SK_ID_CURR, SK_ID_PREV, {_UPLIFT} AS causal_uplift, {_SEGMENT} AS behavioral_segment FROM book"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return book(spark, sf).select(*KEY, dec.uplift(F.col(_P)).alias("causal_uplift"), dec.segment(F.col(_P)).alias("behavioral_segment"))


@R.query("repayment_plan", with_sql(*BASE, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, round_even({_A} / 30.0, 0) AS daily_payment_fcfa, round_even({_A} / 30.0, 0) * 7 AS weekly_subtotal_fcfa FROM book"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return book(spark, sf).select(*KEY, *[c.alias(n) for n, c in dec.repayment_plan(F.col(_A)).items()])


_DRIVERS = """drv AS (SELECT *, [
  CASE WHEN prior_payment_ratio >= 0.90 THEN '+High Historical Repayment Compliance (+24.5%)' WHEN prior_payment_ratio < 0.60 THEN '-Low Historical Payment Ratio (-21.0%)' END,
  CASE WHEN prior_avg_days_late <= 2 THEN '+Punctual Prior Payment History (+14.0%)' WHEN prior_avg_days_late >= 15 THEN '-Chronic Past Payment Delays (-16.5%)' END,
  CASE WHEN harvest_season = 1 THEN '+Cash Crop Harvest Liquidity Window (+16.8%)' END,
  CASE WHEN school_fee_shock = 1 THEN '-School Fee Season Cash Drain (-12.5%)' END,
  CASE WHEN bureau_total_debt > 250000 THEN '-Heavy Cross-Institutional Bureau Debt (-18.2%)' WHEN bureau_active_loans = 0 THEN '+Zero External Credit Overhang (+10.2%)' END,
  CASE WHEN overdue_amount > 300000 THEN '-High Arrears Balance Magnitude (-14.0%)' WHEN overdue_amount < 50000 THEN '+Modest Arrears Principal (+12.0%)' END,
  CASE WHEN prior_recovered_before = 1 THEN '+Demonstrated Prior Arrears Resolution (+11.5%)' END,
  CASE WHEN market_cycle_day IN (0, 4) THEN '+Traditional Market Day Cash Inflow (+8.5%)' END] AS d FROM feat),
pn AS (SELECT *, list_filter(d, lambda v: v IS NOT NULL AND starts_with(v, '+'))[1:3] AS pos, list_filter(d, lambda v: v IS NOT NULL AND starts_with(v, '-'))[1:3] AS neg FROM drv)"""


@R.query("score_drivers", with_sql(*ar.FEATURES_SQL, _DRIVERS, body="""
SELECT SK_ID_CURR, SK_ID_PREV,
  CASE WHEN len(pos) = 0 THEN 'Active Credit Union Account History (+7.5%)' ELSE array_to_string(list_transform(pos, lambda v: v[2:]), ' | ') END AS xai_top_positive,
  CASE WHEN len(neg) = 0 THEN 'Unassisted Arrears Inertia (-8.0%)' ELSE array_to_string(list_transform(neg, lambda v: v[2:]), ' | ') END AS xai_top_negative FROM pn"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.top_drivers(ar.features(spark, sf)).select(*KEY, "xai_top_positive", "xai_top_negative")


# ---- adaptation and ranking --------------------------------------------------------------------

# Outcome texts an officer can report.
OUTCOMES = ["Cured & Settled", "Promise to Pay", "Severe Hardship", "Disputed", "Switched Off", "No Answer"]


def feedback_log(spark: SparkSession, sf: str) -> DataFrame:
    """Click events as reported outcomes on the user's account."""
    e = t.table(spark, sf, "events").filter(F.col("event_type") == "click")
    text = F.element_at(F.array(*[F.lit(o) for o in OUTCOMES]), F.pmod("event_id", F.lit(6)).cast("int") + 1)
    return e.select(F.col("user_id").alias("SK_ID_CURR"), text.alias("outcome"), "ts", "event_id")


_DELTA = "CASE event_id % 6 WHEN 0 THEN 0.40 WHEN 1 THEN 0.15 WHEN 2 THEN -0.35 WHEN 3 THEN -0.20 WHEN 4 THEN -0.10 ELSE 0 END"
FEEDBACK = f"fb AS (SELECT user_id AS SK_ID_CURR, CAST(arg_max({_DELTA}, (ts, event_id)) AS DOUBLE) AS feedback_delta FROM events WHERE event_type = 'click' GROUP BY 1)"


@R.query("feedback_per_account", with_sql(FEEDBACK, body="SELECT SK_ID_CURR, feedback_delta FROM fb"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.latest_feedback(feedback_log(spark, sf), "SK_ID_CURR", "outcome", "ts", "event_id")


@R.query("adapted_probability", with_sql(*BASE, FEEDBACK, body=f"""
, s AS (SELECT SK_ID_CURR, SK_ID_PREV, least(greatest({_P}, 1e-6), 1 - 1e-6) AS q FROM book),
a AS (SELECT *, least(greatest(1 / (1 + exp(-(ln(q / (1 - q)) + 0.28))) * 1.05::DOUBLE, 0.01), 0.99) AS p FROM s)
SELECT SK_ID_CURR, SK_ID_PREV, round(CASE WHEN feedback_delta IS NULL THEN p ELSE least(greatest(p + feedback_delta, 0.01), 0.99) END, 9) AS adapted_probability
FROM a LEFT JOIN fb USING (SK_ID_CURR)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    feedback = dec.latest_feedback(feedback_log(spark, sf), "SK_ID_CURR", "outcome", "ts", "event_id")
    out = dec.adapt_probability(book(spark, sf), _P, "Civil Servant", dec.season_factor(0.10, 0.05), feedback)
    return out.select(*KEY, F.round("adapted_probability", 9).alias("adapted_probability"))


@R.query("features_filled_when_missing", with_sql(*BASE, body="""
SELECT SK_ID_CURR, SK_ID_PREV, overdue_amount, coalesce(CAST(days_birth AS DOUBLE), 0.0) AS days_birth, 0.0::DOUBLE AS prior_late_count FROM book"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dec.fill_missing_features(book(spark, sf), FEATURE_COLUMNS).select(*KEY, "overdue_amount", "days_birth", "prior_late_count")


_LIVE = f"""nv AS (SELECT *, {_P} * partial_recovery_ratio * {_A} - 50.0 AS s1, least(0.99, {_P} * 1.25) * partial_recovery_ratio * {_A} - 500.0 AS s2,
    least(0.99, {_P} * 1.45) * partial_recovery_ratio * {_A} - 5050.0 AS s3 FROM contact),
live AS (SELECT *, CASE WHEN is_vulnerable THEN CASE WHEN {_A} >= 25000 THEN 'CALL' ELSE 'SMS' END WHEN s3 > greatest(s1, s2) AND {_A} >= 40000 AND {_P} >= 0.10 THEN 'FIELD_VISIT'
    WHEN s2 > s1 THEN 'CALL' ELSE 'SMS' END AS ch, {_P} * partial_recovery_ratio * {_A} AS gross FROM nv),
cost AS (SELECT *, CAST(CASE ch WHEN 'FIELD_VISIT' THEN 5050 WHEN 'CALL' THEN 500 ELSE 50 END AS DOUBLE) AS cc FROM live)"""
_ORDERS = {"cash": "gross DESC", "cures": f"{_P} DESC", "balanced": f"{_UPLIFT} * pow({_A}, 0.65) DESC", "vulnerable": "is_vulnerable DESC, gross DESC"}


def _ranker(objective: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = dec.rank_portfolio(dec.recommend_channel(book(spark, sf)), _P, objective)
        return out.select(*KEY, "rank", "recommended_channel", "channel_cost_fcfa", "expected_gross_recovery_fcfa", "expected_net_recovery_fcfa")
    return run


for _o in dec.OBJECTIVES:
    R.query(f"portfolio_ranking_{_o}", with_sql(*BASE, CONTACT, _LIVE, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, row_number() OVER (ORDER BY {_ORDERS[_o]}, SK_ID_CURR, SK_ID_PREV) AS rank, ch AS recommended_channel, cc AS channel_cost_fcfa,
  gross AS expected_gross_recovery_fcfa, gross - cc AS expected_net_recovery_fcfa FROM cost"""))(_ranker(_o))


_WEEKLY = f"""wk AS (SELECT *, row_number() OVER (ORDER BY {_P} * partial_recovery_ratio * {_A} DESC, SK_ID_CURR, SK_ID_PREV) AS rank FROM book),
weekly AS (SELECT *, {_P} * partial_recovery_ratio * {_A} AS gross FROM wk WHERE rank <= 400)"""


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    b = book(spark, sf).drop("assigned_officer")
    return dec.weekly_book(b.withColumn("expected_gross_recovery_fcfa", F.col(_P) * F.col("partial_recovery_ratio") * F.col(_A)))


@R.query("weekly_book", with_sql(*BASE, _WEEKLY, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, CAST(rank AS INTEGER) AS rank, gross AS expected_gross_recovery_fcfa,
  CASE (rank - 1) % 3 WHEN 0 THEN {_sql_text(dec.OFFICERS[0])} WHEN 1 THEN {_sql_text(dec.OFFICERS[1])} ELSE {_sql_text(dec.OFFICERS[2])} END AS assigned_officer FROM weekly"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return weekly(spark, sf).select(*KEY, "rank", "expected_gross_recovery_fcfa", "assigned_officer")


# ---- messages ----------------------------------------------------------------------------------

def account_values(debt: Column, account: Column, loan: Column, officer: Column) -> dict[str, Column]:
    """Placeholder values shared by all account messages."""
    codes = tpl.payment_codes(debt)
    return {"account": account, "loan": loan, "amount": x.amount_text(debt), "officer": tpl.officer_first_name(officer),
            "daily": x.amount_text(debt / F.lit(30.0)), "mtn": codes["mtn"], "orange": codes["orange"], "branch": F.lit("Main Branch")}


def _fill_sql(template: str) -> str:
    out = template
    whole = f"CAST(CAST(round_even({_A}, 0) AS BIGINT) AS VARCHAR)"
    values = {"account": "CAST(SK_ID_CURR AS VARCHAR)", "loan": "CAST(SK_ID_PREV AS VARCHAR)", "amount": _money(_A), "daily": _money(f"({_A} / 30.0)"),
              "officer": "split_part(split_part(assigned_officer, ' - ', 2), ' ', 1)", "mtn": f"('*126*9*705001*' || {whole} || '#')",
              "orange": f"('*150*1*705001*' || {whole} || '#')", "branch": "'Main Branch'"}
    for name, v in values.items():
        out = f"replace({out}, '{{{name}}}', {v})"
    return out


def _templates_sql(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_sql_text(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


_BRANCH = f"CASE WHEN is_vulnerable THEN 'vulnerable' WHEN contains({_SEGMENT}, 'Self-Curer') THEN 'self_curer' ELSE 'standard' END"


def _messages(spark: SparkSession, sf: str, templates: list[tuple], two_branches: bool) -> DataFrame:
    b = dec.recommend_channel(book(spark, sf)).withColumn("behavioral_segment", dec.segment(F.col(_P)))
    branch = tpl.message_branch(F.col("is_vulnerable"), F.col("behavioral_segment"))
    if two_branches:
        branch = F.when(F.col("is_vulnerable"), "vulnerable").otherwise("standard")
    values = account_values(F.col(_A), F.col("SK_ID_CURR"), F.col("SK_ID_PREV"), F.col("assigned_officer"))
    return tpl.render_templates(b.withColumn("branch", branch), templates, "branch string, language string, template string", ["branch"], values).select(
        *KEY, "branch", "language", "message")


@R.query("account_messages", with_sql(*BASE, CONTACT, body=f"""
, b AS (SELECT *, {_BRANCH} AS branch FROM contact), m(branch, language, template) AS (VALUES {_templates_sql(tpl.ACCOUNT_TEMPLATES)})
SELECT SK_ID_CURR, SK_ID_PREV, branch, language, {_fill_sql('template')} AS message FROM b JOIN m USING (branch)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf, tpl.ACCOUNT_TEMPLATES, False)


@R.query("call_prompts", with_sql(*BASE, CONTACT, body=f"""
, b AS (SELECT *, CASE WHEN is_vulnerable THEN 'vulnerable' ELSE 'standard' END AS branch FROM contact), m(branch, language, template) AS (VALUES {_templates_sql(tpl.CALL_TEMPLATES)})
SELECT SK_ID_CURR, SK_ID_PREV, branch, language, {_fill_sql('template')} AS message FROM b JOIN m USING (branch)"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf, tpl.CALL_TEMPLATES, True)


@R.query("payment_codes_and_sponsor_message", with_sql(*BASE, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, {_fill_sql("'{mtn}'")} AS mtn_ussd, {_fill_sql("'{orange}'")} AS orange_ussd, {_fill_sql(_sql_text(tpl.PAY_INSTRUCTIONS[0][1]))} AS instruction_en,
  {_fill_sql(_sql_text(tpl.PAY_INSTRUCTIONS[1][1]))} AS instruction_pidgin, {_fill_sql(_sql_text(tpl.SPONSOR_TEMPLATE))} AS sponsor_message FROM book"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    b = book(spark, sf)
    v = account_values(F.col(_A), F.col("SK_ID_CURR"), F.col("SK_ID_PREV"), F.col("assigned_officer"))
    return b.select(*KEY, v["mtn"].alias("mtn_ussd"), v["orange"].alias("orange_ussd"), tpl.fill(F.lit(tpl.PAY_INSTRUCTIONS[0][1]), v).alias("instruction_en"),
                    tpl.fill(F.lit(tpl.PAY_INSTRUCTIONS[1][1]), v).alias("instruction_pidgin"), tpl.fill(F.lit(tpl.SPONSOR_TEMPLATE), v).alias("sponsor_message"))


_STEP_VALUES = {"name": "'Client #' || CAST(SK_ID_CURR AS VARCHAR)", "amount": _money(_A), "half": _money(f"({_A} / 2)"),
                "pay_url": "'https://pay.example/' || CAST(SK_ID_CURR AS VARCHAR)", "lender": "'Credit Union'"}


def _step_sql() -> str:
    out = "template"
    for name, v in _STEP_VALUES.items():
        out = f"replace({out}, '{{{name}}}', {v})"
    return out


@R.query("sequence_step_messages", with_sql(*BASE, _WEEKLY, body=f"""
, m(step, language, template) AS (VALUES {_templates_sql(tpl.STEP_TEMPLATES)})
SELECT SK_ID_CURR, SK_ID_PREV, step, language, {_step_sql()} AS message FROM weekly, m"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The four steps of a sequence for each account of the weekly book."""
    a = F.col(_A)
    steps = weekly(spark, sf).withColumn("step", F.explode(F.array(*[F.lit(s) for s, _, _ in tpl.STEP_TEMPLATES])))
    values = {"name": F.concat(F.lit("Client #"), F.col("SK_ID_CURR").cast("string")), "amount": x.amount_text(a), "half": x.amount_text(a / 2),
              "pay_url": F.concat(F.lit("https://pay.example/"), F.col("SK_ID_CURR").cast("string")), "lender": F.lit("Credit Union")}
    return tpl.render_templates(steps, tpl.STEP_TEMPLATES, "step int, language string, template string", ["step"], values).select(*KEY, "step", "language", "message")


@R.query("full_action_plan", with_sql(*BASE, CONTACT, body=f"""
, b AS (SELECT *, {_BRANCH} AS branch FROM contact), m(branch, language, template) AS (VALUES {_templates_sql(tpl.ACCOUNT_TEMPLATES)})
SELECT b.SK_ID_CURR, b.SK_ID_PREV, recommended_channel, channel_cost_fcfa, expected_net_recovery_fcfa, is_vulnerable, action_reason, {_ZONE} AS zone, {_BADGE} AS security_badge,
  {_fill_sql('e.template')} AS script_english, {_fill_sql('p.template')} AS script_pidgin, {_fill_sql("'{mtn}'")} AS ussd_mtn
FROM b JOIN m e ON e.branch = b.branch AND e.language = 'english' JOIN m p ON p.branch = b.branch AND p.language = 'pidgin'"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Channel, reason, zone, both scripts and payment code on every row of the book."""
    b = dec.add_zone(dec.recommend_channel(book(spark, sf)))
    b = b.withColumn("branch", tpl.message_branch(F.col("is_vulnerable"), dec.segment(F.col(_P))))
    v = account_values(F.col(_A), F.col("SK_ID_CURR"), F.col("SK_ID_PREV"), F.col("assigned_officer"))
    for language in ("english", "pidgin"):
        rows = [(br, text) for br, lang, text in tpl.ACCOUNT_TEMPLATES if lang == language]
        b = tpl.render_templates(b, rows, "branch string, template string", ["branch"], v, f"script_{language}")
    return b.select(*KEY, "recommended_channel", "channel_cost_fcfa", "expected_net_recovery_fcfa", "is_vulnerable", "action_reason", "zone", "security_badge",
                    "script_english", "script_pidgin", v["mtn"].alias("ussd_mtn"))


# ---- ranking metrics and policies --------------------------------------------------------------

@R.query("ranking_metrics_by_split", with_sql(*BASE, body=f"""
, s AS (SELECT substr(md5('42:' || SK_ID_CURR), 1, 4) < '4000' AS is_test, {_P} AS score, sum(recovered) AS pos, sum(1 - recovered) AS neg FROM book GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM s WINDOW w AS (PARTITION BY is_test ORDER BY score DESC))
SELECT is_test, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, round(sum(neg * (cp - pos) + neg * pos / 2.0) / (sum(pos) * sum(neg)), 9) AS roc_auc,
  round(sum(pos * (cp / (cp + cn))) / sum(pos), 9) AS pr_auc FROM c GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    scored = entity_split(book(spark, sf), "SK_ID_CURR")
    return ranking_metrics(scored, _P, "recovered", ["is_test"]).select("is_test", "n_pos", "n_neg", F.round("roc_auc", 9).alias("roc_auc"), F.round("pr_auc", 9).alias("pr_auc"))


@R.query("precision_and_money_at_100", with_sql(*BASE, body=f"""
, k AS (SELECT * FROM book ORDER BY {_P} * {_A} DESC, SK_ID_PREV LIMIT 100)
SELECT CAST(sum(recovered) AS DOUBLE) / count(*) AS precision, round(sum({_A} * recovered), 4) AS money_recovered FROM k"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return at_k(book(spark, sf), F.col(_P) * F.col(_A), "recovered", _A, "SK_ID_PREV", 100).withColumn("money_recovered", F.round("money_recovered", 4))


_POLICY = {"prob": f"{_P} DESC", "ev": f"{_P} * {_A} DESC", "incumbent": f"{_A} DESC", "random": "substr(md5('42:' || SK_ID_PREV), 1, 8) DESC"}


@R.query("policy_comparison", with_sql(*BASE, body=", r AS (SELECT recovered AS y, overdue_amount AS a, " + ", ".join(
    f"row_number() OVER (ORDER BY {o}, SK_ID_PREV) AS r_{n}" for n, o in _POLICY.items()) + " FROM book), k(k) AS (VALUES (50), (100), (200), (400)), g AS (SELECT k, " + ", ".join(
    f"CAST(sum(y) FILTER (WHERE r_{n} <= k) AS DOUBLE) / count(*) FILTER (WHERE r_{n} <= k) AS precision_{n}, sum(a * y) FILTER (WHERE r_{n} <= k) AS m_{n}" for n in _POLICY)
    + " FROM r, k GROUP BY k) SELECT k, " + ", ".join(f"precision_{n}, round(m_{n}, 4) AS money_recovered_{n}" for n in _POLICY) + """,
  round(precision_ev / greatest(precision_incumbent, 0.001), 9) AS precision_gain_ratio, round(m_ev - m_incumbent, 4) AS money_lift,
  round((m_ev - m_incumbent) / greatest(m_incumbent, 1.0) * 100.0, 6) AS money_lift_pct FROM g"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = compare_policies(book(spark, sf), _P, "recovered", _A, "SK_ID_PREV")
    money = [c for c in out.columns if c.startswith("money_recovered")] + ["money_lift"]
    return out.withColumns({**{c: F.round(c, 4) for c in money}, "money_lift_pct": F.round("money_lift_pct", 6), "precision_gain_ratio": F.round("precision_gain_ratio", 9)})


# ---- portfolio reports -------------------------------------------------------------------------

AS_OF_DAY = 2000


def open_instalments(spark: SparkSession, sf: str) -> DataFrame:
    """Instalments not paid by the report day, with days past due (0 when not due yet)."""
    i = t.instalments(spark, sf).filter(F.col("DAYS_ENTRY_PAYMENT").isNull() | (F.col("DAYS_ENTRY_PAYMENT") > AS_OF_DAY))
    return i.select("SK_ID_CURR", F.col("AMT_INSTALMENT").alias("balance"), F.greatest(F.lit(AS_OF_DAY) - F.col("DAYS_INSTALMENT"), F.lit(0)).alias("days_past_due"))


_OPEN = f"""opn AS (SELECT SK_ID_CURR, AMT_INSTALMENT AS balance, greatest({AS_OF_DAY} - DAYS_INSTALMENT, 0) AS dpd FROM inst
  WHERE DAYS_ENTRY_PAYMENT IS NULL OR DAYS_ENTRY_PAYMENT > {AS_OF_DAY})"""
_RATE = "CASE WHEN dpd < 15 THEN 0 WHEN dpd < 30 THEN 0.10 WHEN dpd < 90 THEN 0.25 WHEN dpd < 180 THEN 0.50 ELSE 1 END"


@R.query("portfolio_at_risk", with_sql(INSTALMENTS, _OPEN, body="""
, k(k) AS (VALUES (15), (30), (90)), r AS (SELECT k, CAST(coalesce(sum(balance) FILTER (WHERE dpd > k), 0) AS DOUBLE) AS a, count(*) FILTER (WHERE dpd > k) AS n, CAST(sum(balance) AS DOUBLE) AS t FROM opn, k GROUP BY k),
p AS (SELECT *, round_even(a / t * 100, 2) AS pct FROM r)
SELECT k AS threshold_days, a AS amount_fcfa, n AS n_accounts, pct AS par_pct,
  CASE WHEN pct <= 3 THEN 'EXCELLENT' WHEN pct <= 5 THEN 'COMPLIANT' WHEN pct <= 8 THEN 'WARNING' ELSE 'NON-COMPLIANT' END AS status FROM p"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.portfolio_at_risk(open_instalments(spark, sf))


@R.query("provisions_by_bucket", with_sql(INSTALMENTS, _OPEN, body=f"""
SELECT CASE WHEN dpd < 15 THEN '0-14' WHEN dpd < 30 THEN '15-29' WHEN dpd < 90 THEN '30-89' WHEN dpd < 180 THEN '90-179' ELSE '180+' END AS bucket,
  count(*) AS n_accounts, CAST(sum(balance) AS DOUBLE) AS balance, CAST(sum(balance * CAST({_RATE} AS DECIMAL(3,2))) AS DOUBLE) AS provision FROM opn GROUP BY 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.provisions(open_instalments(spark, sf))


@R.query("regulator_export", with_sql(INSTALMENTS, _OPEN, body=f"""
SELECT '06/2000' AS period, CAST(sum(balance) AS DOUBLE) AS total_outstanding, CAST(sum(balance) FILTER (WHERE dpd >= 30) AS DOUBLE) AS doubtful_outstanding,
  count(DISTINCT SK_ID_CURR) AS n_debtors, CAST(sum(balance * CAST({_RATE} AS DECIMAL(3,2))) AS DOUBLE) AS provisions FROM opn"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.regulator_export(open_instalments(spark, sf), "2000-06-23")


_EV_TOTAL = ", tt AS (SELECT CAST(sum(overdue_amount) AS DOUBLE) AS t FROM ev)"


@R.query("provision_savings", with_sql(INSTALMENTS, ar.EVENTS, body=_EV_TOTAL + """
, p AS (SELECT t * (1.0::DOUBLE - 0.12::DOUBLE) * 0.20::DOUBLE AS w, greatest(0.0, t - t * (0.12::DOUBLE * (1.0::DOUBLE + 0.656::DOUBLE))) * 0.20::DOUBLE AS a FROM tt)
SELECT round_even(w, 0) AS unassisted_provision_fcfa, round_even(a, 0) AS assisted_provision_fcfa, round_even(w - a, 0) AS capital_saved_fcfa,
  round_even((w - a) / greatest(1.0, w) * 100.0, 1) AS capital_preservation_pct FROM p"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.provision_savings(ar.events(spark, sf), "overdue_amount")


@R.query("audit_manifest", with_sql(*BASE, CONTACT, body="""
, e AS (SELECT CAST(sum(CAST(overdue_amount AS DECIMAL(18,2))) AS DOUBLE) AS t, round_even(CAST(count_if(is_vulnerable) AS DOUBLE) / count(*) * 100, 1) AS v FROM contact)
SELECT t AS delinquent_book_fcfa, t * 0.8806::DOUBLE AS unassisted_exposure_fcfa, t * 0.8806::DOUBLE * 0.20::DOUBLE AS unassisted_provision_fcfa,
  t * (1.0::DOUBLE - 0.656::DOUBLE) AS assisted_exposure_fcfa, t * (1.0::DOUBLE - 0.656::DOUBLE) * 0.20::DOUBLE AS assisted_provision_fcfa,
  t * 0.8806::DOUBLE * 0.20::DOUBLE - t * (1.0::DOUBLE - 0.656::DOUBLE) * 0.20::DOUBLE AS capital_preserved_fcfa, v AS vulnerable_shielded_pct FROM e"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    b = dec.recommend_channel(book(spark, sf)).withColumn("overdue_amount", F.col("overdue_amount").cast("decimal(18,2)"))
    return rep.audit_manifest(b, "overdue_amount")


@R.query("sensitive_accounts", with_sql(*BASE, CONTACT, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, {_A}, recommended_channel FROM contact WHERE {_P} < 0.5 AND {_A} < 15000 ORDER BY {_A} DESC, SK_ID_PREV LIMIT 8"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.sensitive_accounts(dec.recommend_channel(book(spark, sf)), _P, _A, "SK_ID_PREV").select(*KEY, _A, "recommended_channel")


@R.query("recovery_forecast", with_sql(*BASE, body=f"""
, f AS (SELECT count(*) AS n, round(sum({_P} * {_A}), 4) AS g, round(sum({_A}), 4) AS t FROM book)
SELECT n AS n_accounts, g AS expected_gross_fcfa, t AS total_overdue_fcfa, round(greatest(0.0, g - t * 0.52), 3) AS lift_over_baseline_fcfa, round_even(g / t * 100, 1) AS recovery_rate_pct FROM f"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = rep.recovery_forecast(book(spark, sf))
    return out.withColumns({"expected_gross_fcfa": F.round("expected_gross_fcfa", 4), "total_overdue_fcfa": F.round("total_overdue_fcfa", 4),
                            "lift_over_baseline_fcfa": F.round("lift_over_baseline_fcfa", 3)})


@R.query("channel_breakdown", with_sql(*BASE, CONTACT, body="SELECT recommended_channel, count(*) AS n_accounts FROM contact GROUP BY 1"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.channel_breakdown(dec.recommend_channel(book(spark, sf)))


@R.query("vulnerable_totals", with_sql(*BASE, CONTACT, body=f"""
SELECT CAST(count_if(is_vulnerable) AS BIGINT) AS n_vulnerable, round(sum({_A}) FILTER (WHERE is_vulnerable), 2) AS vulnerable_overdue_fcfa FROM contact"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    out = rep.vulnerable_totals(dec.recommend_channel(book(spark, sf)))
    return out.withColumn("vulnerable_overdue_fcfa", F.round("vulnerable_overdue_fcfa", 2))


@R.query("top_priority_accounts", with_sql(*BASE, CONTACT, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, {_A}, {_P}, recommended_channel FROM contact ORDER BY {_P} * partial_recovery_ratio * {_A} DESC, SK_ID_CURR, SK_ID_PREV LIMIT 5"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    b = dec.recommend_channel(book(spark, sf))
    return b.orderBy((F.col(_P) * F.col("partial_recovery_ratio") * F.col(_A)).desc(), *KEY).limit(5).select(*KEY, _A, _P, "recommended_channel")


@R.query("account_lookup_nearest", with_sql(*BASE, body=f"""
SELECT SK_ID_CURR, SK_ID_PREV, {_A}, FALSE AS found FROM book ORDER BY abs(SK_ID_CURR - 99999999), SK_ID_CURR, SK_ID_PREV LIMIT 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rep.account_lookup(book(spark, sf), 99999999).select(*KEY, _A, "found")


@R.query("campaign_totals", with_sql(*BASE, CONTACT, body=f"""
, o AS (SELECT *, CASE WHEN SK_ID_CURR % 11 = 0 THEN 'FAILED' ELSE 'DELIVERED' END AS st, SK_ID_PREV % 24 AS h FROM contact)
SELECT 'Weekly recovery' AS campaign, recommended_channel AS channel, count(*) AS total_messages, CAST(count_if(st = 'DELIVERED') AS BIGINT) AS sent_count, CAST(count_if(st = 'FAILED') AS BIGINT) AS failed_count,
  round(sum({_A}), 2) AS total_debt_fcfa, count(*) * 50.0::DOUBLE AS cost_fcfa, CAST(count_if(h < 8 OR h >= 18) AS BIGINT) AS outside_send_window FROM o GROUP BY 2"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """One outbox row per account of the book; an account without a valid phone fails."""
    phone = F.when(F.pmod("SK_ID_CURR", F.lit(11)) == 0, F.lit("none")).otherwise(F.concat(F.lit("67"), F.lpad(F.col("SK_ID_CURR").cast("string"), 7, "0")))
    sent = F.when(x.is_valid_phone(phone), "DELIVERED").otherwise("FAILED")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.pmod("SK_ID_PREV", F.lit(24)).cast("int"))
    outbox = dec.recommend_channel(book(spark, sf)).select(
        F.lit("Weekly recovery").alias("campaign"), F.col("recommended_channel").alias("channel"), F.col(_A).alias("overdue"), sent.alias("status"), at.alias("send_at"))
    return rep.campaign_totals(outbox, 50.0).withColumn("total_debt_fcfa", F.round("total_debt_fcfa", 2))


@R.query("campaign_audit_rows", with_sql(*BASE, CONTACT, body="""
SELECT SK_ID_CURR AS account_id, SK_ID_PREV AS loan_id, 'Campaign Automation' AS officer_name, 'CAMPAIGN_MESSAGE_SENT' AS contact_outcome, recommended_channel, is_vulnerable,
  'Dispatched via bulk campaign: ' || chr(39) || 'Weekly recovery' || chr(39) AS notes, CAST(0 AS INTEGER) AS added_by_rerun FROM contact WHERE SK_ID_CURR % 11 <> 0"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows of a campaign that was run twice; the second run adds none."""
    from ..operators.outbox import dispatch
    from ..session import materialize, new_path

    phone = F.when(F.pmod("SK_ID_CURR", F.lit(11)) == 0, F.lit("none")).otherwise(F.concat(F.lit("67"), F.lpad(F.col("SK_ID_CURR").cast("string"), 7, "0")))
    messages = materialize(dec.recommend_channel(book(spark, sf)).select(
        F.col("SK_ID_CURR").alias("account_id"), F.col("SK_ID_PREV").alias("loan_id"), F.col("recommended_channel").alias("channel"), "is_vulnerable", F.col(_A).alias("overdue"),
        x.is_valid_phone(phone).alias("deliverable")), "messages")
    path = new_path(spark, "campaign")
    runs = [dispatch(spark, path, messages, "Weekly recovery", "2024-01-01 09:00:00") for _ in range(2)]
    return spark.read.parquet(f"{path}/audit").select(
        "account_id", "loan_id", "officer_name", "contact_outcome", "recommended_channel", "is_vulnerable", "notes", F.lit(sum(runs[1])).alias("added_by_rerun"))


def uploaded(df: DataFrame) -> DataFrame:
    """An uploaded book under any of the known headers, with the defaults of the missing ones."""
    spec = {
        "id": (["id", "account_id", "member_id"], "bigint", REQUIRED),
        "overdue": (["overdue_amount", "loan_amnt", "overdue"], "double", 25000.0),
        "prob": (["cure_probability", "prob"], "double", 0.88),
        "officer": (["officer", "officer_name"], "string", "Unassigned"),
        "channel": (["channel"], "string", F.when(F.col("overdue") > 15000, "CALL").otherwise("SMS")),
        "vulnerable": (["vulnerable"], "boolean", False),
        "age": (["age"], "int", 45),
    }
    out = resolve_columns(df, spec)
    net = F.col("overdue") * F.col("prob") - 1500.0
    return out.withColumns({"net": F.greatest(F.lit(0.0), net), "gross": F.col("overdue") * F.col("prob")})


@R.query("upload_with_aliases", with_sql(BOOK_ROWS := "u AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice ELSE 25000.0 END AS overdue FROM orders)", body="""
SELECT id, overdue, 0.88::DOUBLE AS prob, 'Unassigned' AS officer, CASE WHEN overdue > 15000 THEN 'CALL' ELSE 'SMS' END AS channel, FALSE AS vulnerable, 45 AS age,
  greatest(0.0, overdue * 0.88::DOUBLE - 1500.0) AS net, overdue * 0.88::DOUBLE AS gross FROM u ORDER BY gross DESC, id LIMIT 60"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The first sixty accounts of an upload whose columns carry other names; bad numbers take the default."""
    return upload(spark, sf).orderBy(F.col("gross").desc(), "id").limit(60)


def upload(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = t.table(spark, sf, "orders").select(k.alias("member_id"), F.when(F.pmod(k, F.lit(8)) == 0, "?").otherwise(F.col("o_totalprice").cast("string")).alias("loan_amnt"))
    return uploaded(raw)


@R.query("upload_summary", with_sql(BOOK_ROWS, body="SELECT count(*) AS account_count, round(sum(overdue), 2) AS total_overdue_fcfa FROM u"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return upload(spark, sf).agg(F.count(F.lit(1)).alias("account_count"), F.round(F.sum("overdue"), 2).alias("total_overdue_fcfa"))


@R.query("metric_documents_side_by_side", with_sql(*BASE, body=f"""
, a AS (SELECT *, substr(md5('42:' || SK_ID_CURR), 1, 4) < '4000' AS is_test FROM book),
m AS (SELECT is_test, CAST(observation_day % 4 AS INTEGER) AS k, count(*) AS n, CAST(sum(recovered) AS DOUBLE) / count(*) AS r FROM a GROUP BY 1, 2),
l AS (SELECT is_test, k, 'n_events' AS metric, CAST(n AS DOUBLE) AS v FROM m UNION ALL SELECT is_test, k, 'recovery_rate', r FROM m)
SELECT k, metric, max(v) FILTER (WHERE NOT is_test) AS train, max(v) FILTER (WHERE is_test) AS test FROM l GROUP BY 1, 2"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.sinks import metrics_long

    b = entity_split(book(spark, sf), "SK_ID_CURR").withColumn("k", F.pmod("observation_day", F.lit(4)).cast("int"))

    def document(df: DataFrame) -> DataFrame:
        return metrics_long(df.groupBy("k").agg(F.count(F.lit(1)).alias("n_events"), F.avg(F.col("recovered").cast("double")).alias("recovery_rate")), ["k"])

    return rep.compare_metrics(document(b.filter(~F.col("is_test"))), document(b.filter("is_test")), ("train", "test"))
