"""Column expressions on hand-built values."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as d
from ledgerloom.functions import numbers as n
from ledgerloom.functions import text as x
from ledgerloom.operators.loading import STATUS_SPELLINGS

D = datetime.date


def run(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("s"))).collect()]


CASES = [
    ("trim and upper", [" a001 ", "a002", " A003", "\ta4\n"], x.clean_text, ["A001", "A002", "A003", "A4"]),
    ("status", ["Closed", "SUSPENDED", "open", "active", "odd"], lambda c: x.clean_status(c, STATUS_SPELLINGS), ["inactive", "inactive", "active", "active", "odd"]),
    ("money", ["XAF 1,000", "500", "2,500.50", "abc", "", None], lambda c: n.clean_money(c).cast("double"), [1000.0, 500.0, 2500.5, None, None, None]),
    ("month first", ["2025-01-15", "15/01/2025", "not a date", "11/10/2025"], lambda c: d.parse_dates(c, d.MONTH_FIRST), [D(2025, 1, 15), D(2025, 1, 15), None, D(2025, 11, 10)]),
    ("day first", ["2025-08-16", "11/10/2025", "08 Apr 2026", "08 APR 2026", "nope"], lambda c: d.parse_dates(c, d.DAY_FIRST), [D(2025, 8, 16), D(2025, 10, 11), D(2026, 4, 8), D(2026, 4, 8), None]),
    ("weight", ["11,358", "8917", "1,234,567", "x"], lambda c: n.clean_numeric(c).cast("int"), [11358, 8917, 1234567, None]),
    ("prefixed", ["XAF 21260033", "20,483,071"], lambda c: n.clean_numeric(c, "XAF").cast("int"), [21260033, 20483071]),
    ("flag", ["TRUE", "FALSE", "yes", "no", "maybe"], x.flag_to_boolean, [True, False, True, False, None]),
    ("yes or no", ["YES", "NO", "YES", "yes"], x.yes_no_to_int, [1, 0, 1, None]),
    ("mask", ["670123456", "12", ""], x.mask_phone, ["XXXXX3456", "XX", ""]),
    ("phone", ["677 12-34-56", "670123456", "+237670123456", "123", "999670123456"], x.normalise_phone, ["237677123456", "237670123456", "237670123456", None, None]),
    ("provider", ["237670000000", "237690000000", "237990000000"], x.phone_provider, ["MTN_MOMO", "ORANGE_MONEY", "MTN_MOMO"]),
    ("audit mask", ["237670123456"], x.audit_mask, ["237670XXXXXX"]),
    ("number", ["check 103380 now", "no digits", "1234567890", "a1234"], x.first_number, [103380, None, None, None]),
    ("teu", ["40FT HC", "20FT", None], lambda c: x.prefix_code(c, "40", 2, 1), [2, 1, None]),
]


@pytest.mark.parametrize("name,values,expr,want", CASES, ids=[c[0] for c in CASES])
def test_text(spark, name, values, expr, want):
    assert run(spark, values, expr) == want


def test_numbers(spark):
    assert run(spark, [1.0, float("nan"), 3.0], n.nan_to_null, "double") == [1.0, None, 3.0]
    assert run(spark, [None, -2.0, 5.0, 9.0], lambda c: n.clip(c, 0.0, 6.0), "double") == [None, 0.0, 5.0, 6.0]
    assert run(spark, [0.0, 2.0], lambda c: n.safe_divide(F.lit(4.0), c), "double") == [None, 2.0]
    assert run(spark, [2.5, 3.5], n.round_half_even, "double") == [2.0, 4.0]
    assert run(spark, [-3, 8], lambda c: n.bucket_of(c, 5), "int") == [2, 3]
    assert run(spark, [75000.0, 1234.5], x.amount_text, "double") == ["75,000", "1,234"]
    assert run(spark, [0.125, 0.9], x.percent_text, "double") == ["12%", "90%"]


def test_dates(spark):
    monday = D(2025, 1, 6)
    assert run(spark, [monday], F.weekday, "date") == [0]
    assert run(spark, [240, 300, 301, 20, -250], d.school_fee_season, "int") == [1, 1, 0, 0, 1]
    assert run(spark, [305, 35, 100], d.harvest_season, "int") == [1, 1, 0]
    assert run(spark, [None, -365 * 2], lambda c: F.round(d.age_years(c), 1), "int") == [40.0, 2.0]
