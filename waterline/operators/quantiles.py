"""Exact quantiles of unbounded columns.

The built-in exact percentile holds every distinct value of a group in one aggregation buffer.
Here a quantile sketch only proposes cut points; the exact counts between them say which interval
holds each wanted rank, and only that interval is ranked. A poor sketch costs time, never accuracy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.sources.staging import materialise

SKETCH_ACCURACY = 100_000


def exact_quantiles(
    values: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per ``by`` group, one DOUBLE column per named probability.

    Linear interpolation between the two nearest ranks; NULL values are ignored. The tables that
    describe a group, with a row per group or per wanted rank, are written, so that their sizes are
    known: the planner broadcasts them if they are small, and joins by shuffle otherwise.
    """
    by = list(by)
    rows = values.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    margin = 4.0 / accuracy
    cuts = sorted(
        {
            min(max(p + shift, 0.0), 1.0)
            for p in probabilities.values()
            for shift in (-margin, margin)
        }
    )
    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.array_sort(F.percentile_approx("_v", cuts, accuracy)).alias("_cuts"),
    )
    sketch = materialise(sketch, "sketch")
    # Copies of a value collapse before the shuffle.
    counted = rows.groupBy(*by, "_v").agg(F.count("*").alias("_copies"))
    placed = counted.join(sketch.select(*by, "_cuts"), by).withColumn(
        "_interval",
        F.aggregate(
            "_cuts", F.lit(0), lambda acc, cut: acc + (cut < F.col("_v")).cast("int")
        ),
    ).drop("_cuts")

    order = Window.partitionBy(*by).orderBy("_interval")
    intervals = (
        placed.groupBy(*by, "_interval")
        .agg(F.sum("_copies").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(order))
        .withColumn("_before", F.col("_upto") - F.col("_in"))
    )
    wanted = sketch.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("_name"),
                        side.alias("_side"),
                        F.lit(p).alias("_p"),
                        F.col("_n"),
                        rank(F.lit(p) * (F.col("_n") - 1)).cast("bigint").alias("_rank"),
                    )
                    for name, p in probabilities.items()
                    for side, rank in ((F.lit("low"), F.floor), (F.lit("high"), F.ceil))
                ]
            )
        ),
    )
    # One row per group, name and side: the interval that holds the rank.
    located = wanted.join(intervals, by).filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_upto"))
    )
    asked = located.groupBy(*by, "_interval", "_before").agg(
        F.collect_set("_rank").alias("_ranks")
    )
    asked = materialise(asked, "asked")
    inside = Window.partitionBy(*by, "_interval").orderBy("_v")
    ranked = (
        placed.join(asked, [*by, "_interval"])
        .withColumn("_end", F.col("_before") + F.sum("_copies").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_copies"))
        .select(*by, "_v", "_start", "_end", F.explode("_ranks").alias("_rank"))
        .filter((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))
        .select(*by, "_rank", F.col("_v").cast("double").alias("_v"))
    )
    position = F.col("_p") * (F.col("_n") - 1)
    pairs = (
        wanted.join(ranked, [*by, "_rank"])
        .groupBy(*by, "_name", "_p", "_n")
        .agg(
            F.max(F.when(F.col("_side") == "low", F.col("_v"))).alias("_low"),
            F.max(F.when(F.col("_side") == "high", F.col("_v"))).alias("_high"),
        )
        .withColumn("_share", position - F.floor(position))
        .withColumn("_q", F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share"))
    )
    return pairs.groupBy(*by).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name) for name in probabilities]
    )
