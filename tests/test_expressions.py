import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from waterline.functions import calendar, money, text


def values(spark, rows, ddl, expression):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expression(F.col("x"))).collect()]


def test_currency_text(spark):
    given = ["$1,234.50 ", "(5)", "-", "", None, "12", "$-3.5"]
    got = values(spark, [(g,) for g in given], "x string", money.parse_currency)
    assert got == [Decimal(v) for v in ("1234.50", "0", "0", "0", "0", "12.00", "-3.50")]


def test_currency_format(spark):
    got = values(
        spark, [(1234.5,), (-5.0,), (None,), (0.0,)], "x double", money.format_currency
    )
    assert got == ["$1,234.50", "$-5.00", "N/A", "$0.00"]


@pytest.mark.parametrize(
    "policy, expected",
    [("inf", [0.0, float("inf"), float("-inf"), 2.5]), ("null", [0.0, None, None, 2.5]),
     ("zero", [0.0, 0.0, 0.0, 2.5])],
)
def test_ratio(spark, policy, expected):
    df = spark.createDataFrame([(0.0, 0), (10.0, 0), (-10.0, 0), (10.0, 4)], "a double, n bigint")
    got = [r[0] for r in df.select(money.ratio(F.col("a"), F.col("n"), policy)).collect()]
    assert got == expected


def test_average_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (200, 3), (-1, 2)], "c bigint, n bigint")
    got = [r[0] for r in df.select(money.average_cents(F.col("c"), F.col("n"))).collect()]
    assert got == [0.01, 0.02, 0.67, 0.0]


def test_time_keys(spark):
    days = [(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),)]
    df = spark.createDataFrame(days, "x date")
    rows = df.select(*[key(F.col("x")) for key in calendar.TIME_KEYS.values()]).collect()
    assert [tuple(r) for r in rows] == [
        ("2023-12-31", "2024-01", "2024Q1", "2024"),
        ("2024-01-07", "2024-01", "2024Q1", "2024"),
    ]


def test_month_index_round_trip(spark):
    days = [(dt.date(y, m, 17),) for y in (1999, 2000, 2024) for m in range(1, 13)]
    index = calendar.month_index(F.col("x"))
    df = spark.createDataFrame(days, "x date").select(
        calendar.month_label(index).alias("label"),
        calendar.month_key(F.col("x")).alias("key"),
        calendar.label_index(calendar.month_key(F.col("x"))).alias("back"),
        index.alias("idx"),
        calendar.days_in_month(index).alias("days"),
    )
    rows = df.collect()
    assert all(r.label == r.key and r.back == r.idx for r in rows)
    assert [r.days for r in rows if r.key.endswith("-02")] == [28, 29, 29]


def test_dates_and_sites(spark):
    texts = ["2024-01-05", "1/5/2024", "2024-01-05 00:00:00", "x", None, "2024-02-30"]
    got = values(spark, [(t,) for t in texts], "x string", calendar.parse_date)
    assert got == [dt.date(2024, 1, 5)] * 3 + [None] * 3
    sites = ["12.0", "12", "12.7", "North", None, "nan"]
    got = values(spark, [(s,) for s in sites], "x string", text.site_id)
    assert got == ["12", "12", "12", "North", None, "nan"]
    ends = [(dt.date(2999, 12, 31),), (dt.date(2024, 1, 1),), (None,)]
    got = values(spark, ends, "x date", lambda c: calendar.effective_end(c, dt.date(2020, 1, 1)))
    assert got == [dt.date(2020, 1, 1), dt.date(2024, 1, 1), dt.date(2020, 1, 1)]
    cap = dt.date(2099, 12, 31)
    got = values(spark, ends, "x date", lambda c: calendar.open_as_date(c, cap))
    assert got == [cap, dt.date(2024, 1, 1), None]
