"""Arrears events, their recovery label, and features of the repayment history before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions.numbers import clip, max_of
from .quality import last_per_key

# Days overdue that open a case, days it has to recover, share that counts as paid.
ARREARS_DAYS = 15
RECOVERY_WINDOW = 30
PAID_SHARE = "0.95"
# Loan states that are in arrears, and the one that counts as recovered by itself.
ARREARS_STATES = ["Charged Off", "Default", "Late (31-120 days)", "Late (16-30 days)"]
CURED_STATE = "Late (16-30 days)"

LOAN = ["SK_ID_CURR", "SK_ID_PREV"]
_LOAN_ROWS = 1 << 20  # rows of a loan that may meet in one task

# The columns a model may see, and those known only after contact.
FEATURE_COLUMNS = [
    "overdue_amount", "prior_instalments_count", "prior_late_count", "prior_late_ratio", "prior_severe_late_count",
    "prior_avg_days_late", "prior_max_days_late", "prior_recovered_before", "prior_payment_ratio", "prior_underpaid_count",
    "recent_3_avg_late", "recent_payment_ratio", "instalment_number", "amt_income_total", "amt_credit", "amt_annuity",
    "days_employed", "days_birth", "annuity_income_ratio", "overdue_income_ratio", "bureau_total_debt", "bureau_overdue_debt",
    "bureau_active_loans", "pos_cash_max_dpd", "market_cycle_day", "school_fee_shock", "harvest_season",
]
FORBIDDEN_POST_CONTACT = [
    "recovered", "contact_method", "contact_outcome", "promise_to_pay", "payment_after_contact", "days_to_recovery",
    "amount_recovered", "TARGET", "observation_day",
]


def _underpaid() -> Column:
    paid = F.coalesce(F.col("AMT_PAYMENT"), F.lit(0))
    due = F.coalesce(F.col("AMT_INSTALMENT"), F.lit(0))
    return paid < due * F.lit(PAID_SHARE).cast("decimal(3,2)")


def _in_arrears() -> Column:
    return (
        F.coalesce(F.col("days_late") >= ARREARS_DAYS, F.lit(False)) | F.col("days_late").isNull()
        | F.coalesce(F.col("underpaid") & (F.col("days_late") >= 0), F.lit(False))
    ) & (F.coalesce(F.col("AMT_INSTALMENT"), F.lit(0)) > 0)


def _event_columns(ties: Sequence[str]) -> dict[str, Column]:
    """What an event takes from its instalment, beside the loan."""
    cured = F.coalesce(F.col("days_late") <= ARREARS_DAYS + RECOVERY_WINDOW, F.lit(False)) & ~F.col("underpaid")
    return {
        "observation_day": F.col("DAYS_INSTALMENT") + ARREARS_DAYS, "overdue_amount": F.col("AMT_INSTALMENT"),
        "recovered": F.when(cured, 1).otherwise(0), "event_number": F.col("NUM_INSTALMENT_NUMBER"),
        "days_to_cure": F.when(cured, F.greatest(F.col("days_late") - ARREARS_DAYS, F.lit(0))),
        "paid_amount": F.when(F.col("days_late") <= ARREARS_DAYS + RECOVERY_WINDOW, F.col("AMT_PAYMENT")),
    } | {c: F.col(c) for c in ties}


def arrears_events(inst: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """One event per loan: its most recent instalment in arrears.

    An instalment is in arrears when it was paid 15 or more days late, never
    paid, or underpaid on or after its due day. It counts as recovered when
    paid in full within 45 days of the due day. A missing payment day makes a
    comparison false, which is written out because SQL would leave it NULL.
    """
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    rows = inst.withColumn("days_late", late).withColumn("underpaid", _underpaid())
    events = rows.filter(_in_arrears()).select(*LOAN, *[value.alias(c) for c, value in _event_columns(ties).items()])
    return last_per_key(events, LOAN, ["observation_day", "event_number", *ties])


def base_recovery_rate(events: DataFrame) -> DataFrame:
    """Share of events that recover; 0 when there are none."""
    return events.agg(F.coalesce(F.avg(F.col("recovered").cast("double")), F.lit(0.0)).alias("base_recovery_rate"))


def loan_state_events(loans: DataFrame) -> DataFrame:
    """Arrears events from a table of loan states, one per loan in arrears.

    Columns that a delivery may lack take the defaults of the full form.
    """
    cols = set(loans.columns)
    df = loans.filter(F.col("loan_status").isin(ARREARS_STATES))
    if {"total_rec_prncp", "loan_amnt"} <= cols:
        unpaid = F.col("loan_amnt") - F.coalesce(F.col("total_rec_prncp"), F.lit(0))
        overdue = max_of(unpaid.cast("double"), F.coalesce(F.col("installment").cast("double"), F.lit(100.0)))
    else:
        overdue = F.col("loan_amnt").cast("double")
    recovered = F.coalesce(F.col("recoveries").cast("double"), F.lit(0.0)) if "recoveries" in cols else F.lit(0.0)
    return df.select(
        F.col("id").cast("string").alias("SK_ID_CURR"), F.col("id").cast("string").alias("SK_ID_PREV"),
        F.lit(0).alias("observation_day"), "loan_status", overdue.alias("overdue_amount"), recovered.alias("recovery_amount"),
        F.when((recovered > 0) | (F.col("loan_status") == CURED_STATE), 1).otherwise(0).alias("recovered"),
    )


def repayment_history(events: DataFrame, inst: DataFrame, as_of: str = "known", ties: Sequence[str] = ()) -> DataFrame:
    """Twelve features of each loan's instalments before its event.

    ``as_of="due"`` takes every instalment due before the observation day with
    whatever is recorded for it, so the overdue instalment itself and payments
    made later leak in. ``as_of="known"`` leaves the event's own instalment out
    and treats a payment entered after the observation day as not made yet.

    Where every loan has few enough rows for one task, the rows meet their
    events and are summed where they meet, so they are shuffled once. Otherwise
    instalments collapse to one cell per loan, due day and payment day before
    they meet the events, so a loan adds a bounded number of rows to a task.
    """
    if as_of not in ("due", "known"):
        raise ValueError(f"as_of must be 'due' or 'known', not {as_of!r}")
    largest = inst.groupBy(*LOAN).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    history = _history_of_rows if fits_a_task(largest) else _history_of_cells
    return _filled_history(history(events, inst, as_of, ties), events.columns)


def fits_a_task(rows: int) -> bool:
    """Whether a loan of so many instalments may meet in one task."""
    return rows <= _LOAN_ROWS


def _instalment_rows(inst: DataFrame, ties: Sequence[str], *more: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return inst.select(
        *LOAN, F.col("DAYS_INSTALMENT").alias("due"), F.col("DAYS_ENTRY_PAYMENT").alias("pay"),
        F.col("NUM_INSTALMENT_NUMBER").alias("num"), F.coalesce("AMT_PAYMENT", zero).alias("paid"),
        F.coalesce("AMT_INSTALMENT", zero).alias("amount"), *[F.col(c).alias(f"_own_{c}") for c in ties], *more,
    )


def _visible(as_of: str) -> Column:
    """Whether a row's payment counts."""
    return F.coalesce(F.col("pay") <= F.col("observation_day"), F.lit(False)) if as_of == "known" else F.lit(True)


def _history_of_rows(events: DataFrame, inst: DataFrame, as_of: str, ties: Sequence[str]) -> DataFrame:
    """Sums per event over the joined rows; join, ranks and sums are all by loan."""
    return _sums_of_rows(events.join(_instalment_rows(inst, ties), LOAN, "left"), events.columns, as_of, ties)


def events_with_history(inst: DataFrame, as_of: str = "known", ties: Sequence[str] = ()) -> DataFrame:
    """:func:`arrears_events` with their :func:`repayment_history`, for loans of few enough rows for one task.

    Instalments are brought together by loan once. Each row gets its loan's event from a window, and what
    follows keeps that order, so events are not shuffled back to the rows they came from.
    """
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    rows = inst.withColumn("days_late", late).withColumn("underpaid", _underpaid())
    columns = _event_columns(ties)
    order = ["observation_day", "event_number", *ties]
    rest = [c for c in columns if c not in order]
    event = F.when(_in_arrears(), F.struct(*[columns[c].alias(c) for c in order + rest]))
    whole = _newest_first("DAYS_INSTALMENT", "NUM_INSTALMENT_NUMBER", ties).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_event", F.max(event).over(whole)).filter(F.col("_event").isNotNull())
    rows = _instalment_rows(rows, ties, "_event").select("*", *[F.col(f"_event.{c}").alias(c) for c in columns]).drop("_event")
    names = [*LOAN, *columns]
    return _filled_history(_sums_of_rows(rows, names, as_of, ties), names)


def _newest_first(due: str, number: str, ties: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*LOAN).orderBy(F.col(due).desc(), F.col(number).desc(), *[F.col(c).desc() for c in ties])


def _sums_of_rows(rows: DataFrame, columns: Sequence[str], as_of: str, ties: Sequence[str]) -> DataFrame:
    """Sums per event, named by ``columns``, over rows that hold an instalment and its loan's event."""
    before = F.col("due") < F.col("observation_day")
    if as_of == "known":
        own = (F.col("due") + ARREARS_DAYS == F.col("observation_day")) & (F.col("num") == F.col("event_number"))
        for c in ties:
            own = own & (F.col(f"_own_{c}") == F.col(c))
        before = before & ~F.coalesce(own, F.lit(False))
    for c in LOAN:
        before = before & F.col(c).isNotNull()  # a loan without a key has no history
    before, visible, open_amount = F.coalesce(before, F.lit(False)), _visible(as_of), F.col("amount") > 0
    rows = rows.withColumn("_before", before)
    so_far = _newest_first("due", "num", [f"_own_{c}" for c in ties]).rowsBetween(Window.unboundedPreceding, 0)
    underpaid = F.col("paid") < F.col("amount") * F.lit(PAID_SHARE).cast("decimal(3,2)")
    rows = rows.select(
        *columns, "due", "num", "amount", "_before", (F.count_if("_before").over(so_far) <= 3).alias("_recent"),
        F.when(visible, F.col("pay") - F.col("due")).alias("delay"), F.when(visible, F.col("paid")).otherwise(F.lit(0)).alias("paid"),
        F.when(visible, underpaid).otherwise(open_amount).alias("_short"),
    )

    def prior(value: Column) -> Column:
        return F.when(F.col("_before"), value)

    def recent(value: Column) -> Column:
        return F.when(F.col("_before") & F.col("_recent"), value)

    due, delay, clipped = F.col("due"), F.col("delay"), clip(F.col("delay"), 0)
    return rows.groupBy(*columns).agg(  # one event per loan
        F.count(prior(F.col("num"))).alias("prior_instalments_count"),
        F.count_if(prior(delay > 0)).alias("prior_late_count"),
        F.count_if(prior(delay >= ARREARS_DAYS)).alias("prior_severe_late_count"),
        F.try_divide(F.sum(prior(clipped)).cast("double"), F.count(prior(delay)).cast("double")).alias("prior_avg_days_late"),
        F.max(prior(clipped)).cast("double").alias("prior_max_days_late"),
        F.sum(prior(F.col("paid"))).alias("_paid"), F.sum(prior(F.col("amount"))).alias("_amount"),
        F.count_if(prior(F.col("_short"))).alias("prior_underpaid_count"),
        F.max(prior(F.col("num"))).alias("instalment_number"),
        F.coalesce(F.min(prior(F.when(delay >= ARREARS_DAYS, due))) < F.max(prior(F.when(delay <= 0, due))), F.lit(False)).alias("_cured"),
        F.avg(recent(clipped)).alias("recent_3_avg_late"), F.sum(recent(F.col("paid"))).alias("_rp"), F.sum(recent(F.col("amount"))).alias("_ra"),
    )


def _history_of_cells(events: DataFrame, inst: DataFrame, as_of: str, ties: Sequence[str]) -> DataFrame:
    keys = events.select(*LOAN, "observation_day")
    if as_of == "known":
        own = events.select(*LOAN, (F.col("observation_day") - ARREARS_DAYS).alias("DAYS_INSTALMENT"),
                            F.col("event_number").alias("NUM_INSTALMENT_NUMBER"), *ties)
        inst = inst.join(own, [*LOAN, "DAYS_INSTALMENT", "NUM_INSTALMENT_NUMBER", *ties], "left_anti")
    zero = F.lit(0).cast("decimal(18,2)")
    rows = inst.select(
        *LOAN, F.col("DAYS_INSTALMENT").alias("due"), F.col("DAYS_ENTRY_PAYMENT").alias("pay"),
        F.col("NUM_INSTALMENT_NUMBER").alias("num"), F.coalesce("AMT_PAYMENT", zero).alias("paid"),
        F.coalesce("AMT_INSTALMENT", zero).alias("amount"), _underpaid().alias("underpaid"), *ties,
    )
    open_amount = F.col("amount") > 0
    cells = rows.groupBy(*LOAN, "due", "pay").agg(
        F.count("num").alias("n"), F.count(F.lit(1)).alias("rows"), F.sum("paid").alias("paid"), F.sum("amount").alias("amount"),
        F.count_if("underpaid").alias("n_underpaid"), F.count_if(open_amount).alias("n_open"), F.max("num").alias("last_num"),
    )
    hist = keys.join(cells, LOAN).filter(F.col("due") < F.col("observation_day"))
    visible = (F.col("pay") <= F.col("observation_day")) if as_of == "known" else F.lit(True)
    visible = F.coalesce(visible, F.lit(as_of == "due"))

    def seen(df: DataFrame) -> DataFrame:
        return df.withColumn("delay", F.when(visible, F.col("pay") - F.col("due"))).withColumn(
            "paid", F.when(visible, F.col("paid")).otherwise(zero))

    hist = seen(hist)
    hist = hist.withColumn("n_underpaid", F.when(visible, F.col("n_underpaid")).otherwise(F.col("n_open")))
    late, severe, on_time = F.col("delay") > 0, F.col("delay") >= ARREARS_DAYS, F.col("delay") <= 0
    clipped = clip(F.col("delay"), 0)
    agg = hist.groupBy(*LOAN).agg(
        F.sum("n").alias("prior_instalments_count"),
        F.coalesce(F.sum(F.when(late, F.col("rows"))), F.lit(0)).alias("prior_late_count"),
        F.coalesce(F.sum(F.when(severe, F.col("rows"))), F.lit(0)).alias("prior_severe_late_count"),
        F.try_divide(F.sum(clipped * F.col("rows")).cast("double"), F.sum(F.when(F.col("delay").isNotNull(), F.col("rows"))).cast("double")).alias("prior_avg_days_late"),
        F.max(clipped).cast("double").alias("prior_max_days_late"),
        F.sum("paid").alias("_paid"), F.sum("amount").alias("_amount"), F.sum("n_underpaid").alias("prior_underpaid_count"),
        F.max("last_num").alias("instalment_number"),
        F.coalesce(F.min(F.when(severe, F.col("due"))) < F.max(F.when(on_time, F.col("due"))), F.lit(False)).alias("_cured"),
    )

    # three latest rows per loan: at most three per due day can be among them
    per_day = Window.partitionBy(*LOAN, "due").orderBy(F.col("num").desc(), *[F.col(c).desc() for c in ties])
    latest = rows.withColumn("_k", F.row_number().over(per_day)).filter(F.col("_k") <= 3).drop("_k")
    latest = keys.join(latest, LOAN).filter(F.col("due") < F.col("observation_day"))
    per_loan = Window.partitionBy(*LOAN).orderBy(F.col("due").desc(), F.col("num").desc(), *[F.col(c).desc() for c in ties])
    latest = seen(latest.withColumn("_k", F.row_number().over(per_loan)).filter(F.col("_k") <= 3))
    recent = latest.groupBy(*LOAN).agg(
        F.avg(clip(F.col("delay"), 0)).alias("recent_3_avg_late"), F.sum("paid").alias("_rp"), F.sum("amount").alias("_ra"))

    return events.join(agg, LOAN, "left").join(recent, LOAN, "left")


def _filled_history(out: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The twelve features with the values of a loan without a history filled in."""

    def ratio(paid: str, amount: str) -> Column:
        return clip(F.col(paid).cast("double") / F.greatest(F.col(amount).cast("double"), F.lit(1.0)), 0.0, 2.0)

    n = F.coalesce(F.col("prior_instalments_count"), F.lit(0))
    late_n = F.coalesce(F.col("prior_late_count"), F.lit(0))
    return out.select(
        *columns, n.alias("prior_instalments_count"), late_n.alias("prior_late_count"),
        (late_n.cast("double") / F.greatest(n, F.lit(1))).alias("prior_late_ratio"),
        F.coalesce("prior_severe_late_count", F.lit(0)).alias("prior_severe_late_count"),
        F.coalesce("prior_avg_days_late", F.lit(0.0)).alias("prior_avg_days_late"),
        F.coalesce("prior_max_days_late", F.lit(0.0)).alias("prior_max_days_late"),
        F.when(F.col("_cured"), 1).otherwise(0).alias("prior_recovered_before"),
        F.coalesce(ratio("_paid", "_amount"), F.lit(1.0)).alias("prior_payment_ratio"),
        F.coalesce("prior_underpaid_count", F.lit(0)).alias("prior_underpaid_count"),
        F.coalesce("recent_3_avg_late", F.lit(0.0)).alias("recent_3_avg_late"),
        F.coalesce(ratio("_rp", "_ra"), F.lit(1.0)).alias("recent_payment_ratio"),
        F.coalesce("instalment_number", F.lit(1)).alias("instalment_number"),
    )


_APPLICATION = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_EMPLOYED", "DAYS_BIRTH"]


def borrower_features(events: DataFrame, application: DataFrame | None = None, bureau: DataFrame | None = None,
                      pos_cash: DataFrame | None = None) -> DataFrame:
    """Application columns, external debt and worst days past due; absent sources give the defaults."""
    out = events
    if application is not None:
        have = [c for c in _APPLICATION if c in application.columns]
        out = out.join(application.select("SK_ID_CURR", *[F.col(c).alias(c.lower()) for c in have]), "SK_ID_CURR", "left")
    else:
        have = []
    for c in _APPLICATION:
        if c not in have:
            out = out.withColumn(c.lower(), F.lit(None).cast("double"))
    if bureau is not None:
        debt = bureau.groupBy("SK_ID_CURR").agg(
            F.sum("AMT_CREDIT_SUM_DEBT").cast("double").alias("bureau_total_debt"),
            F.sum("AMT_CREDIT_SUM_OVERDUE").cast("double").alias("bureau_overdue_debt"),
            F.count_if(F.col("CREDIT_ACTIVE") == "Active").alias("bureau_active_loans"))
        out = out.join(debt, "SK_ID_CURR", "left")
    else:
        out = out.withColumns({"bureau_total_debt": F.lit(0.0), "bureau_overdue_debt": F.lit(0.0), "bureau_active_loans": F.lit(0).cast("bigint")})
    if pos_cash is not None:
        out = out.join(pos_cash.groupBy("SK_ID_CURR").agg(F.max("SK_DPD").cast("double").alias("pos_cash_max_dpd")), "SK_ID_CURR", "left")
    else:
        out = out.withColumn("pos_cash_max_dpd", F.lit(0.0))
    return out.fillna({"bureau_total_debt": 0.0, "bureau_overdue_debt": 0.0, "bureau_active_loans": 0, "pos_cash_max_dpd": 0.0})


def season_and_ratio_features(df: DataFrame) -> DataFrame:
    """Market day, school-fee and harvest flags, and burden against income.

    A missing income is taken as 1e-6, so its ratios end at their upper bound.
    """
    eps = 1e-6
    income = F.coalesce(F.col("amt_income_total").cast("double"), F.lit(eps)) + F.lit(eps)

    def burden(amount: str, cap: float) -> Column:
        return clip(F.try_divide(F.coalesce(F.col(amount).cast("double"), F.lit(0.0)), income), 0.0, cap)

    day = F.col("observation_day")
    return df.withColumns({
        "market_cycle_day": d.market_cycle_day(day), "school_fee_shock": d.school_fee_season(day), "harvest_season": d.harvest_season(day),
        "annuity_income_ratio": burden("amt_annuity", 5.0), "overdue_income_ratio": burden("overdue_amount", 10.0),
    })


def arrears_features(events: DataFrame, inst: DataFrame, application: DataFrame | None = None, bureau: DataFrame | None = None,
                     pos_cash: DataFrame | None = None, as_of: str = "known", ties: Sequence[str] = ()) -> DataFrame:
    """All feature columns beside the event's own columns."""
    return history_features(repayment_history(events, inst, as_of, ties), application, bureau, pos_cash)


def history_features(events: DataFrame, application: DataFrame | None = None, bureau: DataFrame | None = None,
                     pos_cash: DataFrame | None = None) -> DataFrame:
    """All feature columns of events that have their history."""
    return season_and_ratio_features(borrower_features(events, application, bureau, pos_cash))
