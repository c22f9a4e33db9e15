"""Number expressions, written so that NULL means missing and nothing raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip

MONEY = T.DecimalType(18, 2)


def clean_money(c: Column, to: T.DataType = MONEY) -> Column:
    """Keep digits, point and minus; NULL when what is left is not a number."""
    return F.regexp_replace(c, "[^0-9.-]", "").try_cast(to)


def clean_numeric(c: Column, prefix: str | None = None, to: T.DataType = MONEY) -> Column:
    """Drop an optional currency prefix and thousands commas; NULL when not a number."""
    s = strip(c)
    if prefix:
        s = strip(F.replace(s, F.lit(prefix), F.lit("")))
    return F.replace(s, F.lit(","), F.lit("")).try_cast(to)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(a, b)


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (``greatest`` alone would turn it into the bound)."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def max_of(a: Column, b: Column) -> Column:
    """Greater of two values, NULL when either is."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def shift_log_odds(p: Column, offset: float, eps: float = 1e-6) -> Column:
    q = clip(p, eps, 1.0 - eps)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.log(q / (F.lit(1.0) - q)) + F.lit(offset))))


def power_score(uplift: Column, amount: Column, exponent: float = 0.65) -> Column:
    return uplift * F.pow(amount, F.lit(exponent))


def bucket_of(c: Column, n: int) -> Column:
    """Non-negative remainder, also for negative numbers."""
    return F.pmod(c, F.lit(n))


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)
