"""Monthly tables as written, and the series models are fitted on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.schema import MONTHLY_COUNTS, MONTHLY_TITLES
from waterline.sources.runs import read_current


def read_monthly_csv(spark: SparkSession, path: str, tier: str) -> DataFrame:
    """One tier's monthly CSV with its original titles."""
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    columns = []
    for title, name in MONTHLY_TITLES.items():
        text = F.col(f"`{title}`")
        if name == "month":
            value = F.substring(text, 1, 7)
        elif name in MONTHLY_COUNTS:
            value = text.try_cast("double").cast("bigint")
        else:
            value = text.try_cast("double")
        columns.append(value.alias(name))
    return raw.select(F.lit(tier).alias("tier"), *columns)


def read_monthly(spark: SparkSession, path: str, tiers: Sequence[str] | None = None) -> DataFrame:
    """The all-tiers table written by :func:`waterline.sources.sinks.write_by_tier`, as it stands now."""
    return read_current(spark, path, tiers)


def complete_months(monthly: DataFrame) -> DataFrame:
    """Without each series' last month, which is still running."""
    last = F.max("month").over(Window.partitionBy("tier"))
    return monthly.withColumn("_last", last).filter("month < _last").drop("_last")


def tier_series(
    monthly: DataFrame, tiers: Sequence[str], column: str, suffix: str
) -> DataFrame:
    """``(month, <tier>_<suffix> ...)`` of complete months; an absent tier or month counts 0."""
    pivoted = complete_months(monthly).filter(F.col("tier").isin(*tiers)).groupBy("month").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("tier") == t, F.col(column))), F.lit(0.0)).alias(
                f"{t}_{suffix}"
            )
            for t in tiers
        ]
    )
    return pivoted
