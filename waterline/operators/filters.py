"""Business filters on contract rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.config import CORE_PACKAGES, UNUSED_COLUMNS
from waterline.functions.calendar import TIME_KEYS, open_as_null, parse_date
from waterline.sources.contracts import canonical_name


def drop_unused_columns(df: DataFrame, columns: Sequence[str] = UNUSED_COLUMNS) -> DataFrame:
    """Drop by file title and by the name the readers give it."""
    return df.drop(*columns, *[canonical_name(c) for c in columns])


def core_package(packages: Sequence[str] = CORE_PACKAGES) -> Column:
    return F.col("package_group").isin(*packages)


def not_test() -> Column:
    return F.col("test_flag") == 0


def valid_period() -> Column:
    return F.col("end_date").isNull() | (F.col("start_date") <= F.col("end_date"))


def _as_date(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_date(F.col(name))
    return F.col(name).cast("date")


def parse_dates(df: DataFrame) -> DataFrame:
    """Both dates as DATE. An unreadable or open-ended end is NULL."""
    return df.withColumns(
        {
            "start_date": _as_date(df, "start_date"),
            "end_date": open_as_null(_as_date(df, "end_date")),
        }
    )


def rejected_starts(df: DataFrame) -> DataFrame:
    """Rows whose start date is missing or unreadable; the filters leave them out."""
    return df.filter(_as_date(df, "start_date").isNull())


def apply_business_filters(
    df: DataFrame, packages: Sequence[str] = CORE_PACKAGES
) -> DataFrame:
    """Core packages, no test accounts, a readable start and a start not after the end."""
    return (
        df.transform(drop_unused_columns)
        .filter(core_package(packages) & not_test())
        .transform(parse_dates)
        .filter(F.col("start_date").isNotNull() & valid_period())
    )


def add_time_keys(df: DataFrame) -> DataFrame:
    """Week, month, quarter and year of the start date, as text."""
    return df.withColumns({name: key(F.col("start_date")) for name, key in TIME_KEYS.items()})
