"""What the operators share: reading tables and numbering rows without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.shipping import ship

# The words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Rows a Python worker gets at once: texts are long, and one batch is held on both sides.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Before the first Python function of a session: send the package, keep batches of texts small."""
    ship(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition on equal columns, where null equals null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
