"""Site tables: one wide row per site, or one row per site and segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import SEGMENTS
from waterline.functions.calendar import parse_date
from waterline.functions.text import site_id
from waterline.sources.contracts import read_text_csv


def to_long(wide: DataFrame) -> DataFrame:
    """``Site``, ``Date`` and segment columns ``1``..``53`` (those present) to long form.

    Rows without a site or a date go.
    """
    segments = [str(s) for s in SEGMENTS if str(s) in wide.columns]
    named = wide.select(
        site_id(F.trim(F.col("Site").cast("string"))).alias("site"),
        F.coalesce(
            parse_date(F.col("Date").cast("string")), F.col("Date").try_cast("date")
        ).alias("release_date"),
        *[
            F.col(f"`{s}`").cast("string").try_cast("double").cast("bigint").alias(s)
            for s in segments
        ],
    ).na.drop(subset=["site", "release_date"])
    return named.unpivot(["site", "release_date"], segments, "segment", "base").select(
        "site",
        "release_date",
        F.col("segment").cast("int").alias("cxn_code"),
        F.coalesce("base", F.lit(0).cast("bigint")).alias("base"),
    )


def read_sites_csv(spark: SparkSession, path: str) -> DataFrame:
    return to_long(read_text_csv(spark, path))


def read_sites_parquet(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.parquet(path)
    return raw if "cxn_code" in raw.columns else to_long(raw)
