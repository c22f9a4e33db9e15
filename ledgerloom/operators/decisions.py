"""Decisions on a book of overdue accounts, all as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import age_years
from ..functions.numbers import bucket_of, clip, power_score, shift_log_odds
from ..functions.text import amount_text, join_first, percent_text
from .ordered import running_sum, with_position
from .quality import tag_first_failure

# Channels in order of cost, with their cost and lift, and the gates of a visit.
CHANNELS = [("SMS", 50.0, 1.00), ("CALL", 500.0, 1.25), ("FIELD_VISIT", 5000.0, 1.45)]
VISIT_MIN_DEBT, VISIT_MIN_PROB = 25000.0, 0.10
VULNERABLE_CALL_DEBT = 20000.0
SENIOR_AGE = 60
DISTRESS_PROB, DISTRESS_DEBT = 0.05, 200000.0
# Reasons of protection.
STANDARD = "Standard"
SENIOR = "Senior Borrower (Hardship Review)"
UNEMPLOYED = "Income Disruption / Unemployed"
DISTRESS = "Severe Distress (Restructuring Recommended)"

# Zones by account number, and the travel note of each zone.
ZONES = [
    ("Commercial Avenue / Food Market (Zone 1)", "L1: Safe Transit"),
    ("Nkwen / Mile 2 - Mile 4 (Zone 2)", "L2: Daytime Caution"),
    ("Up Station / Administrative (Zone 3)", "L1: Secure Corridor"),
    ("Mankon / Small Mankon (Zone 4)", "L2: Daylight Only"),
    ("Old Council / Hospital Roundabout (Zone 5)", "L1: Safe Transit"),
]
OFFICERS = ["Officer 1 - John N.", "Officer 2 - Beatrice M.", "Officer 3 - Emmanuel K."]


def vulnerability(prob: Column, debt: Column, days_birth: Column, days_employed: Column) -> Column:
    """Reason of protection; the first rule that holds wins, ``Standard`` when none does."""
    return (
        F.when(age_years(days_birth) >= SENIOR_AGE, SENIOR)
        .when(F.coalesce(days_employed >= 0, F.lit(False)), UNEMPLOYED)
        .when((prob < DISTRESS_PROB) & (debt > DISTRESS_DEBT), DISTRESS)
        .otherwise(STANDARD)
    )


def channel_value(prob: Column, debt: Column, cost: float, lift: float) -> Column:
    """Net value of a channel; a missing probability has no value, and the cheapest channel is chosen for it."""
    return clip(prob * F.lit(lift), high=0.99) * debt - F.lit(cost)


def recommend_channel(df: DataFrame, prob: str = "recovery_probability", debt: str = "overdue_amount") -> DataFrame:
    """Channel, its cost and net expected value, and the reason in words.

    The best net value wins and ties keep the cheaper channel. A visit needs a
    debt and a chance worth the trip and is never sent to a protected borrower,
    who gets a friendly call or message instead. The value reported is that of
    the channel chosen.
    """
    p, a = F.col(prob).cast("double"), F.col(debt).cast("double")
    out = df.withColumn("_why", vulnerability(p, a, F.col("days_birth"), F.col("days_employed")))
    out = out.withColumn("is_vulnerable", F.col("_why") != STANDARD)
    values = {n: channel_value(p, a, c, lift) for n, c, lift in CHANNELS}
    visit_open = (a >= VISIT_MIN_DEBT) & (p >= VISIT_MIN_PROB)
    best_two = F.greatest(values["SMS"], values["CALL"])
    chosen = (
        F.when(F.col("is_vulnerable"), F.when(a >= VULNERABLE_CALL_DEBT, "CALL").otherwise("SMS"))
        .when(visit_open & (values["FIELD_VISIT"] > best_two), "FIELD_VISIT")
        .when(values["CALL"] > values["SMS"], "CALL")
        .otherwise("SMS")
    )
    out = out.withColumn("recommended_channel", chosen)
    ch = F.col("recommended_channel")
    cost = F.when(ch == "FIELD_VISIT", CHANNELS[2][1]).when(ch == "CALL", CHANNELS[1][1]).otherwise(CHANNELS[0][1])
    value = F.when(ch == "FIELD_VISIT", values["FIELD_VISIT"]).when(ch == "CALL", values["CALL"]).otherwise(values["SMS"])
    money, pct = amount_text(a), percent_text(p)
    reason = (
        F.when(F.col("is_vulnerable"), F.concat("_why", F.lit(" - Friendly outreach & restructuring inquiry.")))
        .when(ch == "FIELD_VISIT", F.concat(F.lit("High recoverable debt ("), money, F.lit(" FCFA, "), pct, F.lit(" cure prob). Justifies 5,000 FCFA transit.")))
        .when(ch == "CALL", F.concat(F.lit("Moderate balance ("), money, F.lit(" FCFA, "), pct, F.lit(" cure prob). Call resolves delay efficiently.")))
        .otherwise(F.concat(F.lit("High auto-cure probability ("), pct, F.lit(") or modest debt. Automated SMS reminder sufficient.")))
    )
    return out.withColumns({"channel_cost_fcfa": cost, "expected_net_recovery_fcfa": value, "action_reason": reason}).drop("_why")


def _pick(values: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def zone_of(account: Column) -> Column:
    return _pick([z for z, _ in ZONES], bucket_of(account, len(ZONES)))


def zone_table(spark) -> DataFrame:
    return spark.createDataFrame(ZONES, "zone string, security_badge string")


def add_zone(df: DataFrame, account: str = "SK_ID_CURR") -> DataFrame:
    """Zone by account number and its travel note, from a five-row table."""
    out = df.withColumn("zone", zone_of(F.col(account)))
    return out.join(F.broadcast(zone_table(df.sparkSession)), "zone", "left")


def route_savings(df: DataFrame, officer: str = "assigned_officer") -> DataFrame:
    """Distance and fuel saved per officer when visits are grouped by zone."""
    visit = F.col("recommended_channel") == "FIELD_VISIT"
    n = df.groupBy(officer).agg(F.count_if(visit).alias("n_field_visits"), F.countDistinct(F.when(visit, F.col("zone"))).alias("_zones"))
    spread = F.col("n_field_visits") * F.lit(6.5)
    grouped = F.when(F.col("n_field_visits") > 0, F.col("_zones") * F.lit(4.0) + F.col("n_field_visits") * F.lit(1.5)).otherwise(0.0)
    saved = F.greatest(F.lit(0.0), spread - grouped)
    return n.select(
        officer, "n_field_visits", F.bround(spread, 1).alias("unclustered_km"), F.bround(grouped, 1).alias("clustered_km"),
        F.bround(saved, 1).alias("km_saved"), F.bround(saved / 30.0, 2).alias("fuel_saved_liters"),
        F.bround(saved / 30.0 * 850.0, 0).alias("fuel_cash_saved_fcfa"),
        F.bround(saved / F.greatest(F.lit(1.0), spread) * 100.0, 1).alias("pct_distance_saved"))


def uplift(prob: Column, lift: float = 1.25) -> Column:
    """Gain in probability from a contact."""
    return clip(prob * F.lit(lift), 0.0, 0.99) - prob


def segment(prob: Column, lift: float = 1.25) -> Column:
    # Names of the segments, in the order they are tried.
    tau = uplift(prob, lift)
    return (
        F.when(prob >= 0.70, "Self-Curer (SMS Only)")
        .when((tau >= 0.08) & (prob >= 0.10), "Persuadable (High Priority)")
        .when(prob < 0.05, "Lost Cause (Restructure)")
        .otherwise("Moderate Yield")
    )


def score_drivers(feature=F.col) -> Column:
    """All factors that speak for or against an account, in rule order, as an array of structs."""
    def item(factor: str, impact: str, direction: str, val: Column, desc: Column) -> Column:
        return F.struct(F.lit(factor).alias("factor"), F.lit(impact).alias("impact"), F.lit(direction).alias("direction"),
                        val.cast("double").alias("val"), desc.alias("desc"))

    def days(c: Column) -> Column:
        return F.format_string("%.1f", F.bround(c, 1))

    ratio, late, debt = feature("prior_payment_ratio").cast("double"), feature("prior_avg_days_late").cast("double"), feature("overdue_amount").cast("double")
    ext, loans, market = feature("bureau_total_debt").cast("double"), feature("bureau_active_loans"), feature("market_cycle_day")
    L = F.lit
    # Factors, impacts, thresholds and wording.
    return F.array_compact(F.array(
        F.when(ratio >= 0.90, item("High Historical Repayment Compliance", "+24.5%", "positive", ratio, F.concat(L("Client paid "), percent_text(ratio), L(" of past scheduled dues in full."))))
        .when(ratio < 0.60, item("Low Historical Payment Ratio", "-21.0%", "negative", ratio, F.concat(L("Historically settled only "), percent_text(ratio), L(" of scheduled dues.")))),
        F.when(late <= 2.0, item("Punctual Prior Payment History", "+14.0%", "positive", late, F.concat(L("Average historical payment delay is only "), days(late), L(" days."))))
        .when(late >= 15.0, item("Chronic Past Payment Delays", "-16.5%", "negative", late, F.concat(L("Past instalments averaged "), days(late), L(" days past due.")))),
        F.when(feature("harvest_season") == 1, item("Cash Crop Harvest Liquidity Window", "+16.8%", "positive", L(1), L("Regional coffee/cocoa crop cycle enhances local cash flow."))),
        F.when(feature("school_fee_shock") == 1, item("School Fee Season Cash Drain", "-12.5%", "negative", L(1), L("September/October tuition expenditures strain household liquidity."))),
        F.when(ext > 250000, item("Heavy Cross-Institutional Bureau Debt", "-18.2%", "negative", ext, F.concat(L("Borrower carries "), amount_text(ext), L(" FCFA across "), loans.cast("string"), L(" external loans."))))
        .when(loans == 0, item("Zero External Credit Overhang", "+10.2%", "positive", L(0), L("No competing debt obligations in other financial institutions."))),
        F.when(debt > 300000, item("High Arrears Balance Magnitude", "-14.0%", "negative", debt, F.concat(L("Substantial overdue principal ("), amount_text(debt), L(" FCFA) requires liquidity restructuring."))))
        .when(debt < 50000, item("Modest Arrears Principal", "+12.0%", "positive", debt, F.concat(L("Manageable overdue sum ("), amount_text(debt), L(" FCFA) easily settled in single installment.")))),
        F.when(feature("prior_recovered_before") == 1, item("Demonstrated Prior Arrears Resolution", "+11.5%", "positive", L(1), L("Borrower previously cured a 15+ day delinquency."))),
        F.when(market.isin(0, 4), item("Traditional Market Day Cash Inflow", "+8.5%", "positive", market, L("Observation coincides with main Bamenda food & cattle market turnover."))),
    ))


def _in_direction(direction: str):
    return lambda x: x["direction"] == direction


def top_drivers(df: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` drivers for and against each account, in rule order, as arrays and as text."""
    def default(factor: str, impact: str, direction: str, val: float, desc: str) -> Column:
        return F.array(F.struct(F.lit(factor).alias("factor"), F.lit(impact).alias("impact"), F.lit(direction).alias("direction"),
                                F.lit(val).alias("val"), F.lit(desc).alias("desc")))

    # What is shown when no rule holds.
    none_for = default("Active Credit Union Account History", "+7.5%", "positive", 1.0, "Ongoing member relationship and cooperative equity.")
    none_against = default("Unassisted Arrears Inertia", "-8.0%", "negative", 0.0, "Accounts past 15 days require contact stimulus to avert default.")
    out = df.withColumn("_d", score_drivers())
    for name, direction, fallback in (("top_positive", "positive", none_for), ("top_negative", "negative", none_against)):
        kept = F.slice(F.filter("_d", _in_direction(direction)), 1, n)
        out = out.withColumn(name, F.when(F.size(kept) == 0, fallback).otherwise(kept))
        parts = F.transform(F.col(name), lambda x: F.concat(x["factor"], F.lit(" ("), x["impact"], F.lit(")")))
        out = out.withColumn(f"xai_{name}", join_first(parts, n))
    return out.drop("_d")


# Log-odds shift by kind of branch.
BRANCH_OFFSETS = [("Urban Commercial", 0.18), ("Agrarian Rural", -0.12), ("Civil Servant", 0.28)]
# Change of probability by reported outcome, first match wins.
FEEDBACK_DELTAS = [("Cured & Settled", 0.40), ("Promise to Pay", 0.15), ("Severe Hardship", -0.35), ("Disputed", -0.20), ("Switched Off", -0.10)]


def branch_offset(branch: str) -> float:
    return next((v for name, v in BRANCH_OFFSETS if name in branch), 0.0)


def season_factor(harvest_boost: float = 0.0, school_fee_drag: float = 0.0) -> float:
    return max(0.5, 1.0 + harvest_boost - school_fee_drag)


def feedback_delta(outcome: Column) -> Column:
    out = None
    for text, v in FEEDBACK_DELTAS:
        hit = outcome.contains(text)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out.otherwise(0.0)


def latest_feedback(log: DataFrame, account: str, outcome: str, time: str, key: str) -> DataFrame:
    """Change of probability per account: the last reported outcome counts."""
    return log.groupBy(account).agg(F.max_by(feedback_delta(F.col(outcome)), F.struct(time, key)).alias("feedback_delta"))


def adapt_probability(df: DataFrame, prob: str, branch: str = "", season: float = 1.0, feedback: DataFrame | None = None,
                      account: str = "SK_ID_CURR", name: str = "adapted_probability") -> DataFrame:
    """Branch shift on the log-odds, season factor, then feedback per account, each within 0.01..0.99."""
    p = clip(shift_log_odds(F.col(prob), branch_offset(branch)) * F.lit(season), 0.01, 0.99)
    out = df.withColumn(name, p)
    if feedback is not None:
        out = out.join(feedback.select(account, "feedback_delta"), account, "left")
        out = out.withColumn(name, F.when(F.col("feedback_delta").isNotNull(), clip(F.col(name) + F.col("feedback_delta"), 0.01, 0.99)).otherwise(F.col(name))).drop("feedback_delta")
    return out


def fill_missing_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns a delivery lacks become 0, and so do missing values."""
    out = df
    for c in features:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0))
    return out


OBJECTIVES = ("cash", "cures", "balanced", "vulnerable")


def channel_with_live_costs(df: DataFrame, prob: str, fuel_price: float = 850.0, airtime: float = 500.0) -> DataFrame:
    """Channel by net value with the partial-recovery ratio and today's fuel and airtime cost."""
    # Officer fee, litres per visit, message cost, gates.
    visit_cost, sms_cost = 2500.0 + 3.0 * fuel_price, 50.0
    p, ratio, debt = F.col(prob), F.col("partial_recovery_ratio"), F.col("overdue_amount").cast("double")
    sms = p * ratio * debt - sms_cost
    call = clip(p * 1.25, high=0.99) * ratio * debt - airtime
    visit = clip(p * 1.45, high=0.99) * ratio * debt - visit_cost
    chosen = (
        F.when(F.coalesce(F.col("is_vulnerable"), F.lit(False)), F.when(debt >= 25000, "CALL").otherwise("SMS"))
        .when((visit > F.greatest(sms, call)) & (debt >= 40000) & (p >= 0.10), "FIELD_VISIT")
        .when(call > sms, "CALL")
        .otherwise("SMS")
    )
    out = df.withColumn("recommended_channel", chosen)
    ch = F.col("recommended_channel")
    out = out.withColumn("channel_cost_fcfa", F.when(ch == "FIELD_VISIT", visit_cost).when(ch == "CALL", airtime).otherwise(sms_cost))
    out = out.withColumn("expected_gross_recovery_fcfa", p * ratio * debt)
    return out.withColumn("expected_net_recovery_fcfa", F.col("expected_gross_recovery_fcfa") - F.col("channel_cost_fcfa"))


def objective_order(objective: str, prob: str) -> list[Column]:
    gross = F.col("expected_gross_recovery_fcfa")
    if objective == "cures":
        return [F.col(prob).desc()]
    if objective == "balanced":
        return [power_score(uplift(F.col(prob)), F.col("overdue_amount").cast("double")).desc()]
    if objective == "vulnerable":
        return [F.coalesce(F.col("is_vulnerable"), F.lit(False)).desc(), gross.desc()]
    if objective == "cash":
        return [gross.desc()]
    raise ValueError(f"objective must be one of {OBJECTIVES}, not {objective!r}")


def rank_portfolio(df: DataFrame, prob: str, objective: str = "cash", key: Sequence[str] = ("SK_ID_CURR", "SK_ID_PREV"),
                   fuel_price: float = 850.0, airtime: float = 500.0) -> DataFrame:
    """The whole book with its rank under an objective; the key breaks ties."""
    out = channel_with_live_costs(df, prob, fuel_price, airtime)
    return with_position(out, [*objective_order(objective, prob), *[F.col(k) for k in key]], "rank")


def weekly_book(df: DataFrame, size: int = 400, key: Sequence[str] = ("SK_ID_CURR", "SK_ID_PREV"), officers: Sequence[str] = tuple(OFFICERS)) -> DataFrame:
    """The ``size`` accounts of highest expected recovery, ranked and dealt to the officers in turn."""
    order = [F.col("expected_gross_recovery_fcfa").desc(), *[F.col(k) for k in key]]
    top = df.orderBy(*order).limit(size)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most ``size`` rows
    return ranked.withColumn("assigned_officer", _pick(officers, F.pmod(F.col("rank") - 1, F.lit(len(officers)))))


def repayment_plan(debt: Column, days: int = 30) -> dict[str, Column]:
    daily = F.bround(debt / F.lit(float(days)), 0)
    return {"daily_payment_fcfa": daily, "weekly_subtotal_fcfa": daily * 7}


# ---- payment reconciliation --------------------------------------------------------------------

def reconcile(balances: DataFrame, payments: DataFrame, on: Sequence[str] = ("account_id",)) -> DataFrame:
    """Each payment on a known balance with the amount due before and after it.

    ``payments`` has the key, ``amount``, ``paid_at`` and a unique
    ``payment_id``. Only payments whose key names exactly one balance are
    booked; the others are in :func:`reconcile_rejects`. The balance falls to a
    floor of 0; because payments are positive, the floor of the running balance
    equals flooring it at every step.
    """
    on = list(on)
    tagged = _tag_payments(balances, payments, on)
    valid = tagged.filter(F.col("reject_rule").isNull()).select(*on, "amount", "paid_at", "payment_id")
    run = running_sum(valid, on, [F.col("paid_at"), F.col("payment_id")], "amount", "_paid")
    due = F.col("balance_due")
    zero = F.lit(0).cast("decimal(38,2)")
    out = run.join(balances, on).withColumns({
        "due_before": F.greatest(zero, due - (F.col("_paid") - F.col("amount"))), "due_after": F.greatest(zero, due - F.col("_paid"))})
    return out.withColumn("outcome", F.when(F.col("due_after") == 0, "PAID_IN_FULL").otherwise("PARTIAL_PAYMENT")).select(
        *on, "payment_id", "paid_at", "amount", "due_before", "due_after", "outcome")


def _tag_payments(balances: DataFrame, payments: DataFrame, on: list[str]) -> DataFrame:
    """Payments with the first rule they break; balances are counted per key before the join."""
    amount = F.col("amount").try_cast("decimal(18,2)")
    held = balances.groupBy(*on).agg(F.count(F.lit(1)).alias("_balances"))
    df = payments.select(*on, amount.alias("amount"), "paid_at", "payment_id").join(held, on, "left")
    return tag_first_failure(df, [
        ("unreadable_amount", F.col("amount").isNull()), ("amount_not_positive", F.col("amount") <= 0),
        ("unknown_account", F.col("_balances").isNull()), ("ambiguous_account", F.col("_balances") > 1)]).drop("_balances")


def reconcile_rejects(balances: DataFrame, payments: DataFrame, on: Sequence[str] = ("account_id",)) -> DataFrame:
    """Payments that were not booked, with the first rule they break."""
    return _tag_payments(balances, payments, list(on)).filter(F.col("reject_rule").isNotNull())


def remaining_balances(balances: DataFrame, payments: DataFrame, account: str = "account_id") -> DataFrame:
    """Balance per account after all its payments; needs only one sum per account."""
    amount = F.col("amount").try_cast("decimal(18,2)")
    paid = payments.filter(amount > 0).groupBy(account).agg(F.sum(amount).alias("paid"), F.count(F.lit(1)).alias("payments"))
    zero = F.lit(0).cast("decimal(38,2)")
    return balances.join(paid, account, "left").select(
        account, "balance_due", F.coalesce("paid", zero).alias("paid"), F.coalesce("payments", F.lit(0)).alias("payments"),
        F.greatest(zero, F.col("balance_due") - F.coalesce("paid", zero)).alias("balance_left"))


def settle_promises(promises: DataFrame, payments: DataFrame, account: str = "account_id", require_full: bool = False) -> DataFrame:
    """Pending promises of accounts that paid become KEPT, with the account's first payment in the note.

    With ``require_full`` a promise is kept only when the payments made by its
    date reach its amount: payments per day and promises stand in one order per
    account, and a running sum over it gives what was paid by each promise's day.
    """
    amount = F.col("amount").try_cast("decimal(18,2)")
    valid = payments.withColumn("amount", amount).filter(F.col("amount") > 0)
    first = valid.groupBy(account).agg(F.min_by("amount", F.struct("paid_at", "payment_id")).alias("_first"))
    out = promises.join(first, account, "left")
    kept = (F.col("status") == "PENDING") & F.col("_first").isNotNull()
    if require_full:
        daily = valid.groupBy(account, F.col("paid_at").cast("date").alias("_at")).agg(F.sum("amount").alias("_d"))
        pending = promises.filter(F.col("status") == "PENDING").select(account, F.col("promise_date").alias("_at"), "promise_id")
        both = daily.withColumn("_kind", F.lit(0)).unionByName(pending.withColumn("_kind", F.lit(1)), allowMissingColumns=True).withColumn("_d", F.coalesce("_d", F.lit(0)))
        run = running_sum(both, [account], [F.col("_at"), F.col("_kind"), F.col("promise_id")], "_d", "_sum")
        out = out.join(run.filter(F.col("_kind") == 1).select("promise_id", "_sum"), "promise_id", "left")
        kept = kept & (F.coalesce("_sum", F.lit(0)) >= F.col("amount_fcfa"))
    note = F.concat(F.lit("Auto-resolved: Payment of "), amount_text(F.col("_first")), F.lit(" FCFA received via bulk reconciliation."))
    return out.withColumns({"resolution_note": F.when(kept, note).otherwise(F.col("resolution_note")), "status": F.when(kept, "KEPT").otherwise(F.col("status"))}).select(*promises.columns)
