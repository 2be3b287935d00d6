"""Features of monthly series. Frames hold one row per ``tier`` (the series) and ``month``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.config import BAD_MONTHS, GOOD_MONTHS, TIER_SEGMENTS
from waterline.functions.money import finite
from waterline.sources.monthly import tier_series

PERFORMANCE_TIERS = tuple(TIER_SEGMENTS)
GROWTH_STEPS = {"growth_1m": 1, "growth_3m": 3, "growth_6m": 6}


def calendar_columns(month_number: Column) -> dict[str, Column]:
    return {
        "h2_indicator": (month_number > 6).cast("bigint"),
        "good_months": month_number.isin(*GOOD_MONTHS).cast("bigint"),
        "bad_months": month_number.isin(*BAD_MONTHS).cast("bigint"),
    }


def add_calendar_features(df: DataFrame) -> DataFrame:
    """Month number, quarter, second half, good and bad months."""
    number = F.substring("month", 6, 2).cast("bigint")
    return df.withColumns(
        {
            "month_number": number,
            "quarter": F.ceil(number / 3).cast("bigint"),
            **calendar_columns(number),
        }
    )


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """A series' own median; a series holds one value per month."""
    median = F.median(column).over(Window.partitionBy("tier"))
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), median))


def add_trend_features(df: DataFrame) -> DataFrame:
    return fill_median(df, "month_sequential").withColumn(
        "month_sequential_squared", F.col("month_sequential") * F.col("month_sequential")
    )


def add_tier_features(
    df: DataFrame,
    monthly: DataFrame,
    column: str = "net_new_mrr",
    tiers: Sequence[str] = PERFORMANCE_TIERS,
) -> DataFrame:
    """``<tier>_<column>`` of the same month from the tiers' own series; absent ones count 0."""
    series = tier_series(monthly, tiers, column, column)
    joined = df.join(series, "month", "left")
    return joined.na.fill(0.0, subset=[f"{t}_{column}" for t in tiers])


def add_quality_ratios(df: DataFrame, column: str = "net_new_mrr") -> DataFrame:
    """Share of high and moderate performers, and of underperformers, in the sum of all three."""
    high, moderate, under = (F.col(f"{t}_{column}") for t in PERFORMANCE_TIERS)
    total = F.col("total_segment_mrr")
    return (
        df.withColumn("quality_mrr", high + moderate)
        .withColumn("total_segment_mrr", F.col("quality_mrr") + under)
        .withColumn("total_segment_mrr", F.when(total == 0, F.lit(1.0)).otherwise(total))
        .withColumns(
            {
                "quality_ratio": F.col("quality_mrr") / total,
                "under_ratio": under / total,
            }
        )
        .withColumn("quality_weighted", F.col("quality_ratio") * total)
    )


def add_high_to_under(df: DataFrame, column: str = "net_new_mrr", log: bool = False) -> DataFrame:
    """High performers relative to underperformers, on a linear or a logarithmic scale."""
    high, under = F.col(f"high_performers_{column}"), F.abs(F.col(f"underperformers_{column}"))
    if log:
        value = F.when(high > -1, F.log1p(high) / F.log1p(under + 100))
    else:
        value = high / (under + 100)
    return df.withColumn("high_to_under", finite(value))


def add_growth_features(df: DataFrame, column: str = "ending_mrr") -> DataFrame:
    """Relative change over 1, 3 and 6 months; 0 where there is no (or a zero) predecessor."""
    order = Window.partitionBy("tier").orderBy("month")
    value = F.col(column)
    return df.withColumns(
        {
            name: F.coalesce(F.try_divide(value, F.lag(value, step).over(order)) - 1, F.lit(0.0))
            for name, step in GROWTH_STEPS.items()
        }
    )


def clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing and non-finite values become 0."""
    return df.withColumns({c: finite(F.col(c)) for c in columns})
