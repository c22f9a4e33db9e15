"""Reports on officers, portfolio risk, provisions and campaigns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import within_last
from .ledgers import auto_break, keep_rate

# Names that are not officers.
RESERVED = ["system", "officer", ""]


def officer_names(promises: DataFrame, outcomes: DataFrame, sequences: DataFrame) -> DataFrame:
    """Names seen in any ledger; the sequence ledger leaves out ``system`` only."""
    def names(df: DataFrame, reserved: Sequence[str]) -> DataFrame:
        name = F.trim("officer_name")
        return df.select(name.alias("officer_name")).filter(F.col("officer_name").isNotNull() & ~F.lower("officer_name").isin(*reserved)).distinct()

    # spellings of a name that differ in case are one officer, shown by the least of them
    every = names(promises, RESERVED).union(names(outcomes, RESERVED)).union(names(sequences, ["system", ""]))
    return every.groupBy(F.lower("officer_name")).agg(F.min("officer_name").alias("officer_name")).select("officer_name")


def badge(score: Column) -> Column:
    # Badges and their lower bounds.
    return (
        F.when(score >= 85, "CHAMPION").when(score >= 70, "TOP PERFORMER").when(score >= 50, "ON TRACK")
        .when(score >= 30, "NEEDS SUPPORT").otherwise("CRITICAL")
    )


def officer_kpis(promises: DataFrame, outcomes: DataFrame, sequences: DataFrame, as_of: str) -> DataFrame:
    """Score card per officer: three aggregates by lower-cased name, joined to the names seen."""
    p = auto_break(promises, as_of)
    status, amount = F.col("status"), F.col("amount_fcfa")
    by = F.lower("officer_name").alias("_who")

    def total(s: str) -> Column:
        return F.coalesce(F.sum(F.when(status == s, amount)), F.lit(0)).cast("double")

    mine = p.groupBy(by).agg(
        F.count(F.lit(1)).alias("promises_total"), F.count_if(status == "KEPT").alias("promises_kept"),
        F.count_if(status == "BROKEN").alias("promises_broken"), F.count_if(status == "PENDING").alias("promises_pending"),
        total("KEPT").alias("fcfa_collected"), total("PENDING").alias("fcfa_pending"))
    seen = outcomes.groupBy(by).agg(F.count_if(within_last(F.col("created_at").cast("date"), as_of, 7)).alias("contacts_this_week"))
    begun = sequences.groupBy(by).agg(F.count(F.lit(1)).alias("sequences_started"))
    out = officer_names(promises, outcomes, sequences).withColumn("_who", F.lower("officer_name"))
    for part in (mine, seen, begun):
        out = out.join(part, "_who", "left")
    out = out.drop("_who").fillna(0)
    out = out.withColumn("keep_rate_pct", keep_rate(F.col("promises_kept"), F.col("promises_broken")))
    points = F.col("keep_rate_pct") * 0.40 + F.least(F.col("contacts_this_week") * 5, F.lit(30)) + F.least(F.col("fcfa_collected") / 10000, F.lit(30.0))
    out = out.withColumn("score", F.least(F.lit(100), F.bround(points, 0).cast("int")))
    return out.withColumn("badge", badge(F.col("score")))


def leaderboard(kpis: DataFrame, n: int = 20) -> DataFrame:
    """Best officers with their rank; the name breaks ties."""
    order = [F.col("score").desc(), F.col("officer_name")]
    top = kpis.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most ``n`` rows


def team_summary(kpis: DataFrame) -> DataFrame:
    """Totals over all officers; the keep rate is weighted by promises."""
    weighted = F.sum(F.col("keep_rate_pct") * F.col("promises_total")) / F.greatest(F.sum("promises_total"), F.lit(1))
    return kpis.agg(
        F.count(F.lit(1)).alias("total_officers"), F.sum("fcfa_collected").alias("total_fcfa_collected"),
        F.sum("promises_total").alias("total_promises"), F.bround(weighted, 1).alias("team_keep_rate_pct"),
        F.sum("contacts_this_week").alias("total_contacts_week"))


# ---- portfolio risk and provisions -------------------------------------------------------------

def par_status(pct: Column) -> Column:
    # Bands of the risk ratio.
    return F.when(pct <= 3.0, "EXCELLENT").when(pct <= 5.0, "COMPLIANT").when(pct <= 8.0, "WARNING").otherwise("NON-COMPLIANT")


def portfolio_at_risk(book: DataFrame, thresholds: Sequence[int] = (15, 30, 90), balance: str = "balance", dpd: str = "days_past_due") -> DataFrame:
    """Balance more than each number of days past due, and its share of the book, in one pass."""
    late = [F.coalesce(F.sum(F.when(F.col(dpd) > t, F.col(balance))), F.lit(0)).cast("double").alias(f"a{t}") for t in thresholds]
    n = [F.count_if(F.col(dpd) > t).alias(f"n{t}") for t in thresholds]
    one = book.agg(F.coalesce(F.sum(balance), F.lit(0)).cast("double").alias("total"), *late, *n)
    rows = [F.struct(F.lit(t).alias("threshold_days"), F.col(f"a{t}").alias("amount_fcfa"), F.col(f"n{t}").alias("n_accounts")) for t in thresholds]
    out = one.select("total", F.explode(F.array(*rows)).alias("_r")).select("_r.*", "total")
    pct = F.coalesce(F.bround(F.try_divide(F.col("amount_fcfa"), F.col("total")) * 100, 2), F.lit(0.0))
    out = out.withColumn("par_pct", pct)
    return out.select("threshold_days", "amount_fcfa", "n_accounts", "par_pct", par_status(F.col("par_pct")).alias("status"))


# Upper day of each bucket and its provision rate.
PROVISION_BUCKETS = [("0-14", 15, "0.00"), ("15-29", 30, "0.10"), ("30-89", 90, "0.25"), ("90-179", 180, "0.50"), ("180+", None, "1.00")]


def _ladder(dpd: Column, value) -> Column:
    out = None
    for name, upper, rate in PROVISION_BUCKETS:
        v = value(name, rate)
        if upper is None:
            return out.otherwise(v)
        out = F.when(dpd < upper, v) if out is None else out.when(dpd < upper, v)
    return out


def provision_rate(dpd: Column) -> Column:
    return _ladder(dpd, lambda name, rate: F.lit(rate).cast("decimal(3,2)"))


def provisions(book: DataFrame, balance: str = "balance", dpd: str = "days_past_due") -> DataFrame:
    """Balance and required provision per bucket of days past due."""
    bucket = _ladder(F.col(dpd), lambda name, rate: F.lit(name))
    return book.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_accounts"), F.sum(balance).cast("double").alias("balance"),
        F.sum(F.col(balance) * provision_rate(F.col(dpd))).cast("double").alias("provision"))


def regulator_export(book: DataFrame, as_of: str, balance: str = "balance", dpd: str = "days_past_due", debtor: str = "SK_ID_CURR") -> DataFrame:
    """The monthly declaration in one row; doubtful means 30 or more days past due, debtors are counted."""
    return book.agg(
        F.sum(balance).cast("double").alias("total_outstanding"),
        F.coalesce(F.sum(F.when(F.col(dpd) >= 30, F.col(balance))), F.lit(0)).cast("double").alias("doubtful_outstanding"),
        F.countDistinct(debtor).alias("n_debtors"),
        F.sum(F.col(balance) * provision_rate(F.col(dpd))).cast("double").alias("provisions"),
    ).select(F.date_format(F.lit(as_of).cast("date"), "MM/yyyy").alias("period"), "*")


def provision_savings(book: DataFrame, amount: str, lift: float = 0.656, base: float = 0.12) -> DataFrame:
    """Provision at the flat 20 % rate without and with the lift, on the portfolio total."""
    total = book.agg(F.sum(amount).cast("double").alias("t"))
    t = F.col("t")
    without = t * (1.0 - base) * 0.20
    with_ = F.greatest(F.lit(0.0), t - t * (base * (1.0 + lift))) * 0.20
    return total.select(
        F.bround(without, 0).alias("unassisted_provision_fcfa"), F.bround(with_, 0).alias("assisted_provision_fcfa"),
        F.bround(without - with_, 0).alias("capital_saved_fcfa"),
        F.bround((without - with_) / F.greatest(F.lit(1.0), without) * 100.0, 1).alias("capital_preservation_pct"))


def audit_manifest(book: DataFrame, amount: str) -> DataFrame:
    """Exposure and flat provision with and without assistance; the protected share is counted."""
    one = book.agg(F.sum(amount).cast("double").alias("t"), F.avg(F.col("is_vulnerable").cast("double")).alias("_v"))
    t = F.col("t")
    # Share that slips without assistance, lift of assistance, flat rate.
    alone, helped = t * 0.8806, t * (1.0 - 0.656)
    return one.select(
        t.alias("delinquent_book_fcfa"), alone.alias("unassisted_exposure_fcfa"), (alone * 0.20).alias("unassisted_provision_fcfa"),
        helped.alias("assisted_exposure_fcfa"), (helped * 0.20).alias("assisted_provision_fcfa"),
        (alone * 0.20 - helped * 0.20).alias("capital_preserved_fcfa"), F.bround(F.col("_v") * 100, 1).alias("vulnerable_shielded_pct"))


def sensitive_accounts(book: DataFrame, prob: str, amount: str, key: str, n: int = 8) -> DataFrame:
    """Small balances unlikely to cure, largest first."""
    return book.filter((F.col(prob) < 0.5) & (F.col(amount) < 15000)).orderBy(F.col(amount).desc(), key).limit(n)


def recovery_forecast(book: DataFrame, amount: str = "overdue_amount") -> DataFrame:
    """Expected recovery from the best column at hand, and its lift over a naive 52 %."""
    a = F.col(amount).cast("double")
    if "expected_gross_recovery_fcfa" in book.columns:
        gross = F.sum("expected_gross_recovery_fcfa")
    elif "recovery_probability" in book.columns:
        gross = F.sum(F.col("recovery_probability") * a)
    else:
        gross = F.sum(a) * 0.72
    one = book.agg(F.count(F.lit(1)).alias("n_accounts"), F.coalesce(gross, F.lit(0.0)).alias("expected_gross_fcfa"), F.coalesce(F.sum(F.col(amount)).cast("double"), F.lit(0.0)).alias("total_overdue_fcfa"))
    g, total = F.col("expected_gross_fcfa"), F.col("total_overdue_fcfa")
    return one.select("n_accounts", "expected_gross_fcfa", "total_overdue_fcfa", F.greatest(F.lit(0.0), g - total * 0.52).alias("lift_over_baseline_fcfa"),
                      F.coalesce(F.bround(F.try_divide(g, total) * 100, 1), F.lit(0.0)).alias("recovery_rate_pct"))


def channel_breakdown(book: DataFrame) -> DataFrame:
    return book.groupBy("recommended_channel").agg(F.count(F.lit(1)).alias("n_accounts"))


def vulnerable_totals(book: DataFrame, amount: str = "overdue_amount") -> DataFrame:
    v = F.col("is_vulnerable")
    return book.agg(F.count_if(v).alias("n_vulnerable"), F.coalesce(F.sum(F.when(v, F.col(amount))), F.lit(0)).cast("double").alias("vulnerable_overdue_fcfa"))


def account_lookup(book: DataFrame, wanted: int, key: str = "SK_ID_CURR", tie: str = "SK_ID_PREV") -> DataFrame:
    """The account's rows, or the row of the nearest account number when it is not in the book.

    The nearest number is found by two aggregates, one on each side of the wanted number.
    """
    near = book.agg(F.max(F.when(F.col(key) <= wanted, F.col(key))).alias("lo"), F.min(F.when(F.col(key) >= wanted, F.col(key))).alias("hi"))
    below, above = F.lit(wanted) - F.col("lo"), F.col("hi") - F.lit(wanted)
    pick = near.select(F.when(F.col("lo").isNull() | (above < below), F.col("hi")).otherwise(F.col("lo")).alias("k")).scalar()
    first = book.filter(F.col(key) == pick).orderBy(tie).limit(1)
    return first.withColumn("found", F.col(key) == wanted)


def campaign_totals(outbox: DataFrame, rate: float) -> DataFrame:
    """Messages sent and failed, debt addressed, cost, and messages outside the 08:00-18:00 window."""
    sent = F.col("status") == "DELIVERED"
    hour = F.hour("send_at")
    return outbox.groupBy("campaign", "channel").agg(
        F.count(F.lit(1)).alias("total_messages"), F.count_if(sent).alias("sent_count"), F.count_if(~sent).alias("failed_count"),
        F.sum("overdue").cast("double").alias("total_debt_fcfa"), (F.count(F.lit(1)) * F.lit(rate)).alias("cost_fcfa"),
        F.count_if((hour < 8) | (hour >= 18)).alias("outside_send_window"))


def compare_metrics(a: DataFrame, b: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two long metrics tables side by side, one row per key."""
    return a.withColumn("source", F.lit(names[0])).unionByName(b.withColumn("source", F.lit(names[1]))).groupBy("k", "metric").pivot("source", list(names)).agg(F.first("value"))
