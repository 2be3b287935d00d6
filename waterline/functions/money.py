"""Money as exact integers: prices are summed in cents and divided once at the end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waterline.schema import PRICE


def parse_currency(text: Column) -> Column:
    """``"$1,234.50 "`` to 1234.50; anything that is not a number counts as 0."""
    bare = F.trim(F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit("")))
    return F.coalesce(bare.try_cast(PRICE), F.lit(0).cast(PRICE))


def format_currency(amount: Column) -> Column:
    """``1234.5`` to ``"$1,234.50"``, negative amounts to ``"$-5.00"``, NULL to ``"N/A"``."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 2)), F.lit("N/A"))


def cents(price: Column) -> Column:
    """Whole cents; a DOUBLE price is rounded to the cent first, so 19.99 is 1999."""
    return (price.cast(PRICE) * 100).cast("bigint")


def dollars(total_cents: Column) -> Column:
    return total_cents.cast("double") / F.lit(100.0)


def floor_div(a: Column, b: Column) -> Column:
    """Floor division of bigints (``b`` positive) that never goes through a double."""
    return F.call_function("div", a - F.pmod(a, b), b)


def average_cents(total_cents: Column, n: Column) -> Column:
    """``total / n`` in dollars, rounded half up to the cent without leaving the integers."""
    return dollars(floor_div(2 * total_cents + n, 2 * n))


def ratio(amount: Column, count: Column, zero_denominator: str = "inf") -> Column:
    """Amount per unit. 0/0 is 0; x/0 follows the policy (signed infinity, NULL or 0)."""
    if zero_denominator == "inf":
        by_zero = F.when(amount > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    elif zero_denominator == "null":
        by_zero = F.lit(None).cast("double")
    else:
        by_zero = F.lit(0.0)
    return (
        F.when(count != 0, F.try_divide(amount, count.cast("double")))
        .when(amount == 0, F.lit(0.0))
        .otherwise(by_zero)
    )


def finite(value: Column) -> Column:
    """NULL, NaN and infinities become 0."""
    value = value.cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, F.lit(0.0)).otherwise(value)
