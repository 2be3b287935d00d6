"""Price-change tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waterline.schema import PRICE_CHANGE_SCHEMA


def read_price_changes(spark: SparkSession, path: str) -> DataFrame:
    """A CSV ``seq,package,effective_date,old_price,new_price`` of any length; a malformed row is an error."""
    return (
        spark.read.schema(PRICE_CHANGE_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
