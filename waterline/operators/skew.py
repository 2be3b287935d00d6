"""Joining per-key results back to rows when a few keys may own most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Slices per shuffle partition that the rows of hot keys are dealt to; several, so that they spread evenly.
SLICES = 50


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    weight: str,
    partitions: int | None = None,
) -> DataFrame:
    """Left-join ``values`` of ``table`` (one row per key, ``weight`` = its number of rows).

    A key is hot if it owns a ``partitions``-th of the table's rows or more (default: the number of
    shuffle partitions). There are at most that many, which bounds their broadcast, and any other key
    has fewer rows than an average partition. Rows of hot keys already hold the answer when they
    reach the shuffle join, so there they only need to be dealt evenly: by partition and content,
    which a retried task repeats exactly.
    """
    keys, values = list(keys), list(values)
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    # Both sides of the table keep the same columns, so that it is computed once.
    answer = F.struct(*values, weight)
    table = table.filter(known)
    total = table.agg(F.sum(weight)).scalar()
    hot = table.filter(F.col(weight) * partitions >= total).select(*keys, answer.alias("_hot"))
    # A computed zero: as a literal it would be folded out of the join keys, and with it the spread.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    cold = table.select(*keys, zero.alias("_slice"), answer.alias("_cold"))
    deal = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(SLICES * partitions)) + 1
    spread = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_slice", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(deal.cast("int"))
    )
    answered = spread.join(cold, [*keys, "_slice"], "left").withColumn(
        "_value", F.coalesce("_hot", "_cold")
    )
    return answered.select(*rows.columns, *[F.col(f"_value.{v}").alias(v) for v in values])
