"""Date expressions. The calendar day of 'now' is always an argument, never the clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Accepted layouts. The order decides how 11/10/2025 is read.
MONTH_FIRST = ["yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "d MMM yyyy", "MMM d, yyyy"]
DAY_FIRST = ["yyyy-M-d", "d/M/yyyy", "d MMM yyyy"]
TIMESTAMP_LAYOUTS = ["yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss", "yyyy-M-d H:mm"]


def parse_dates(c: Column, layouts: Sequence[str]) -> Column:
    """First layout that fits, NULL when none does. Month names in any case."""
    s = F.initcap(strip(c))
    return F.coalesce(*[F.try_to_date(s, f) for f in layouts])


def parse_timestamps(c: Column, date_layouts: Sequence[str]) -> Column:
    """Wall-clock timestamp from a date-time or a plain date text, NULL when neither fits."""
    s = strip(c)
    tries = [F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in TIMESTAMP_LAYOUTS]
    return F.coalesce(*tries, parse_dates(c, date_layouts).cast("timestamp_ntz"))


def month_of(c: Column) -> Column:
    return F.trunc(c, "MM")


def day_of(c: Column) -> Column:
    return c.cast("date")


def month_offset(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates, whatever the day of the month."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def day_number(c: Column) -> Column:
    """Days since 1970-01-01, an integer usable in RANGE frames."""
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def age_years(days_birth: Column, missing: float = 40.0) -> Column:
    return F.coalesce(F.abs(days_birth) / F.lit(365.25), F.lit(missing))


def school_fee_season(day: Column) -> Column:
    d = F.pmod(F.abs(day), F.lit(365))
    return F.when(d.between(240, 300), 1).otherwise(0)


def harvest_season(day: Column) -> Column:
    d = F.pmod(F.abs(day), F.lit(365))
    return F.when((d >= 305) | (d <= 35), 1).otherwise(0)


def market_cycle_day(day: Column) -> Column:
    return F.pmod(F.abs(day), F.lit(8))


def in_window(c: Column, as_of: str, days: int) -> Column:
    """``as_of`` to ``as_of + days``, both ends included."""
    start = F.lit(as_of).cast("date")
    return c.between(start, F.date_add(start, days))


def within_last(c: Column, as_of: str, days: int) -> Column:
    """On or after ``as_of - days``."""
    return c >= F.date_sub(F.lit(as_of).cast("date"), days)
