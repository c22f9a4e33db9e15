"""Features of a container at the moment it arrives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import prefix_code
from ..session import condensed, materialize
from .history import prior_percentile, prior_rates, prior_sums, sums_to_rates, trailing_count

BROKER = {"broker_id": ("broker_prior_count", "broker_delay_rate")}
IMPORTER = {"importer_id": ("importer_prior_count", "importer_delay_rate")}


def add_calendar(df: DataFrame) -> DataFrame:
    day = F.col("arrived_on")
    return df.withColumns({
        "arrival_day_of_week": F.weekday(day), "arrival_month": F.month(day), "arrival_is_weekend": F.weekday(day) >= 5})


def _with_density(df: DataFrame) -> DataFrame:
    value = F.try_divide(F.col("declared_value_xaf").cast("double"), F.col("gross_weight_kg").cast("double"))
    return df.withColumn("value_per_kg", value)


def add_value_density(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Value per kilogram and its percentile among the chapter's earlier days."""
    return prior_percentile(_with_density(df), "hs_chapter", "arrived_on", "value_per_kg", "value_per_kg_pct_in_chapter",
                            None if facts is None else _with_density(facts))


def add_congestion(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    return trailing_count(df, "arrived_on", 7, "port_same_day_count", "port_trailing_week_count", facts)


def flag_vessel(df: DataFrame, vessels: DataFrame) -> DataFrame:
    """Vessel discharge, and whether the vessel is missing, in one join."""
    out = df.join(vessels.select("vessel_id", "teu_discharged", F.lit(True).alias("_known")), "vessel_id", "left")
    return out.withColumn("vessel_missing", F.col("_known").isNull()).drop("_known")


def container_teu(container_type: Column) -> Column:
    return prefix_code(container_type, "40", 2, 1)


def _with_share(df: DataFrame) -> DataFrame:
    return df.withColumn("vessel_teu_share", F.try_divide(F.col("container_teu").cast("double"), F.col("teu_discharged").cast("double")))


def add_vessel(df: DataFrame, vessels: DataFrame) -> DataFrame:
    """Vessel discharge and the container's share of it; NULL when the vessel is unknown."""
    out = flag_vessel(df, vessels).drop("vessel_missing")
    return _with_share(out.withColumn("container_teu", container_teu(F.col("container_type"))))


def add_broker_history(df: DataFrame) -> DataFrame:
    return prior_rates(df, BROKER, "arrived_on", "delayed")


def add_importer_history(df: DataFrame) -> DataFrame:
    return prior_rates(df, IMPORTER, "arrived_on", "delayed")


def build_features(containers: DataFrame, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """All features of containers that :func:`flag_vessel` has met.

    The containers are written once, and once more with their importers' sums, which takes the place of the first; so
    one shuffle of the rows is there at a time. Every history is counted from rows to which nothing but sums was added.
    What needs a shuffle comes first, and columns that follow from others (``derive``, ratios, the calendar) come after it.
    """
    who = IMPORTER | BROKER

    def with_importers() -> DataFrame:
        rows = materialize(containers, "containers")
        return prior_sums(rows, who, "importer_id", "arrived_on", "delayed", rows)

    facts = condensed(with_importers, "containers")
    out = derive(sums_to_rates(prior_sums(facts, who, "broker_id", "arrived_on", "delayed", facts), who))
    out = add_congestion(add_value_density(out, derive(facts)), facts)
    return add_calendar(_with_share(out))
