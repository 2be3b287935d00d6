"""Expansion, contraction and churn revenue by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.config import CHANGE_OF_SERVICE, DOWNGRADE, UPGRADE, RunConfig
from waterline.functions.calendar import month_key
from waterline.functions.money import cents, dollars
from waterline.operators.tiers import add_tiers, tiers_of


# column -> reason, and whether prices move up
MOVES = {"expansion": (UPGRADE, True), "contraction": (DOWNGRADE, False)}


def price_moves(
    contracts: DataFrame, cfg: RunConfig, names: Sequence[str] = tuple(MOVES)
) -> DataFrame:
    """``(tier, month, <name>, <name>_count ...)`` of upgrades and downgrades, in one pass.

    A move is the positive difference between an account's successive changes of one kind; accounts
    without one still count. The predecessor of a change is found within its day, and for a day's
    first change among the last ones of earlier days. So no window is longer than an account's
    number of distinct changes in a day, or of days with changes, however many rows it has.
    """
    reason = F.col("reason_group")
    rises = reason.isin(*[r for r, up in MOVES.values() if up])

    def gain(price: Column, before: Column) -> Column:
        delta = F.when(rises, price - before).otherwise(before - price)
        return F.greatest(F.coalesce(delta, F.lit(0)), F.lit(0))

    rows = contracts.filter(
        (F.col("wo_type_group") == CHANGE_OF_SERVICE)
        & (F.col("test_flag") == 0)
        & reason.isin(*[MOVES[n][0] for n in names])
    )
    # Copies of a change do not move the price. They leave before the shuffle, and tiers come after it:
    # a change is in the tiers of all segments it has copies in.
    kinds = ["account_number", "reason_group", "start_date", "end_date", "cents", "month_key"]
    changes = rows.withColumn("cents", cents(F.col("price"))).groupBy(*kinds).agg(F.collect_set("cxn_code").alias("codes"))
    within = F.flatten(F.transform("codes", lambda code: tiers_of(code, cfg.tiers)))
    # rows without a segment are in the full set only
    within = F.array_union(tiers_of(F.lit(None).cast("int"), cfg.tiers), within)
    distinct = changes.withColumn("tier", F.explode(F.array_distinct(within))).drop("codes")
    account = ["account_number", "tier", "reason_group"]
    day = Window.partitionBy(*account, "start_date").orderBy(
        F.col("end_date").asc_nulls_first(), "cents", "month_key"
    )
    days = (
        distinct.withColumns(
            {"before": F.lag("cents").over(day), "after": F.lead("cents").over(day)}
        )
        .groupBy(*account, "start_date", "month_key")
        .agg(
            F.sum(gain(F.col("cents"), F.col("before"))).alias("within"),
            F.max(F.when(F.col("before").isNull(), F.col("cents"))).alias("opens"),
            F.max(F.when(F.col("after").isNull(), F.col("cents"))).alias("closes"),
        )
        .withColumn("day", F.unix_date("start_date"))
    )
    earlier = (
        Window.partitionBy(*account)
        .orderBy("day")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    moved = days.withColumn("previous", F.last("closes", ignorenulls=True).over(earlier)).withColumn(
        "move", F.col("within") + gain(F.col("opens"), F.col("previous"))
    )
    per_account = moved.groupBy(*account, "month_key").agg(F.sum("move").alias("move"))

    def of(name: str, value: Column) -> Column:
        return F.when(reason == MOVES[name][0], value)

    return per_account.groupBy("tier", F.col("month_key").alias("month")).agg(
        *[
            column
            for name in names
            for column in (
                dollars(F.sum(of(name, F.col("move")))).alias(name),
                F.count(of(name, F.lit(1))).alias(f"{name}_count"),
            )
        ]
    )


def expansion_revenue(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, expansion, expansion_count)`` of upgrades."""
    return price_moves(contracts, cfg, ["expansion"])


def contraction_revenue(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, contraction, contraction_count)`` of downgrades."""
    return price_moves(contracts, cfg, ["contraction"])


def churn_revenue(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, churn, churn_count)``: all contracts of an account in its churn month."""
    # summed by segment before tiers multiply the rows
    per_segment = (
        contracts.filter("churn_flag = 1")
        .groupBy(month_key(F.col("churn_date")).alias("month"), "account_number", "cxn_code")
        .agg(F.sum(cents(F.col("price"))).alias("cents"))
    )
    per_account = (
        add_tiers(per_segment.repartition("month", "account_number"), cfg.tiers)
        .groupBy("tier", "month", "account_number")
        .agg(F.sum("cents").alias("cents"))
    )
    return per_account.groupBy("tier", "month").agg(
        dollars(F.sum("cents")).alias("churn"), F.count("*").alias("churn_count")
    )
