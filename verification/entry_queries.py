"""What the readers and filters make of odd values, varied by key over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from verification.fixtures import table
from waterline.config import UNUSED_COLUMNS
from waterline.functions.calendar import parse_date
from waterline.functions.money import cents
from waterline.functions.text import site_id
from waterline.operators import cleaning, filters
from waterline.sources.contracts import canonical_name

FORMS = ("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd", "yyyyMMdd", "yyyy-M-d", "M/d/yy", "dd-MMM-yy", "M/d/yyyy HH:mm")


def date_text(spark, sf):
    """Order dates as text, each key in a form of its own; every ninth form is no date."""
    day, form = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % (len(FORMS) + 1)
    text = F.lit("soon")
    for i, pattern in enumerate(FORMS):
        text = F.when(form == i, F.date_format(day, pattern)).otherwise(text)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), form.alias("form"), text.alias("start_date"))


def _date_forms(spark, sf):
    read = date_text(spark, sf).withColumn("day", F.coalesce(parse_date(F.col("start_date")).cast("string"), F.lit("")))
    return read.groupBy("form", "day").agg(F.count("*").alias("n"))


def _rejected_rows(spark, sf):
    return filters.rejected_starts(date_text(spark, sf)).select("order_key", "start_date")


def _site_ids(spark, sf):
    key = F.col("s_suppkey").cast("string")
    kind = F.col("s_suppkey") % 5
    text = (
        F.when(kind == 0, key)
        .when(kind == 1, F.concat(key, F.lit(".0")))
        .when(kind == 2, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(kind == 3, F.concat(key, F.lit("f")))
        .otherwise(F.concat(key, F.lit(".7")))
    )
    return table(spark, sf, "supplier").select("s_suppkey", site_id(text).alias("site"))


def _double_prices(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", cents(F.col("l_extendedprice")).alias("cents"))
    return lines.groupBy("l_returnflag").agg(F.sum("cents").alias("total_cents"))


def _with_gaps(spark, sf):
    tax = F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).when(F.col("l_linenumber") != 2, F.col("l_tax"))
    return table(spark, sf, "lineitem").select(tax.alias("tax"))


def _nan_medians(spark, sf):
    gaps = _with_gaps(spark, sf)
    profile = cleaning.missing_profile(gaps).select("column_name", "missing_count")
    return cleaning.medians(gaps, ["tax"]).join(profile, "column_name")


def _dropped_columns(spark, sf):
    """Customers under the names the reader gives to titles that are of no use."""
    names = [canonical_name(c) for c in UNUSED_COLUMNS]
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("account_number"), *[F.lit("x").alias(n) for n in names])
    profile = cleaning.missing_profile(filters.drop_unused_columns(customers).withColumn("rows", F.lit(1)))
    total = customers.agg(F.count("*").alias("n"))
    rows = total.withColumn("column_name", F.explode(F.array(F.lit("account_number"), F.lit("rows"), *[F.lit(n) for n in names])))
    return profile.select("column_name", "missing_count").join(rows, "column_name")


QUERIES = {
    "date_forms": _date_forms,
    "rejected_rows": _rejected_rows,
    "site_ids": _site_ids,
    "double_prices": _double_prices,
    "nan_medians": _nan_medians,
    "dropped_columns": _dropped_columns,
}

ORACLE = {
    "date_forms": f"""SELECT o_orderkey % {len(FORMS) + 1} AS form,
        CASE WHEN o_orderkey % {len(FORMS) + 1} = {len(FORMS)} THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
        count(*) AS n FROM orders GROUP BY ALL""",
    "rejected_rows": f"SELECT o_orderkey AS order_key, 'soon' AS start_date FROM orders WHERE o_orderkey % {len(FORMS) + 1} = {len(FORMS)}",
    "site_ids": """SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || CASE s_suppkey % 5 WHEN 3 THEN 'f' ELSE '' END AS site
        FROM supplier""",
    "double_prices": """SELECT l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM lineitem GROUP BY ALL""",
    "nan_medians": """SELECT 'tax' AS column_name, median(l_tax) FILTER (l_linenumber > 2) AS median,
        count(*) FILTER (l_linenumber <= 2) AS missing_count FROM lineitem""",
    "dropped_columns": """SELECT unnest(['account_number', 'rows']) AS column_name, CAST(0 AS BIGINT) AS missing_count, count(*) AS n
        FROM customer""",
}
