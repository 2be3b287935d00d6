"""Site openings, customer base and take rate.

Sites come in long form ``(site, release_date, cxn_code, base)``. Only sites seen in a tier's
contracts count for the tier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from waterline.config import FULL, SEGMENTS, RunConfig
from waterline.functions.calendar import month_key
from waterline.functions.money import ratio
from waterline.functions.text import site_id
from waterline.operators.tiers import tier_bits, tiers_of_bits


def seen_sites(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(site, tiers)`` of the contracts: a site's segments meet as bits, whatever their number."""
    bits = tier_bits(F.col("cxn_code"), cfg.tiers)
    names = [f"_bits{n}" for n in range(len(bits))]
    per_site = (
        contracts.filter(F.col("site").isNotNull())
        .groupBy(site_id(F.col("site")).alias("site"))
        .agg(F.count("*").alias("n_rows"), *[F.bit_or(b).alias(n) for b, n in zip(bits, names, strict=True)])
    )
    return per_site.select("site", tiers_of_bits([F.col(n) for n in names], cfg.tiers).alias("tiers"))


def _released(sites: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(site, month, bases)`` for each month of release: a base per tier, in the order of :func:`_listed`.

    A site is one short row, whatever the number of its segments.
    """
    rows = sites.filter(F.col("site").isNotNull() & F.col("release_date").isNotNull()).select(
        site_id(F.col("site")).alias("site"), month_key(F.col("release_date")).alias("month"), "cxn_code", "base"
    )
    if not isinstance(rows.schema["base"].dataType, T.IntegralType):
        # a segment's fraction is cut off
        rows = rows.groupBy("site", "month", "cxn_code").agg(F.sum("base").cast("bigint").alias("base"))
    code = F.col("cxn_code")
    known = code.between(SEGMENTS[0], SEGMENTS[-1])

    def base_of(tier: str) -> Column:
        within = known if tier == FULL else known & code.isin(*[int(c) for c in cfg.tiers[tier]])
        return F.coalesce(F.sum(F.when(within, F.col("base").cast("bigint"))), F.lit(0))

    return rows.groupBy("site", "month").agg(F.array(*[base_of(tier) for tier in _listed(cfg)]).alias("bases"))


def _listed(cfg: RunConfig) -> list[str]:
    return [*dict.fromkeys(cfg.tier_names())]


def site_metrics(contracts: DataFrame, sites: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, site_opens, base)`` by month of release: distinct sites and their base.

    A site counts in every tier it was seen in, if only with base 0: opening does not depend on
    segments. Sites are copied to those tiers only, after their segments are one row. The planner takes
    a site file for much smaller than its rows are, so it is told not to broadcast them.
    """
    seen = seen_sites(contracts, cfg)
    opened = _released(sites, cfg).hint("merge").join(seen, "site").select("month", "bases", F.explode("tiers").alias("tier"))
    place = F.array_position(F.lit(_listed(cfg)), F.col("tier")).cast("int")
    return (
        opened.select("tier", "month", F.get("bases", place - 1).alias("base"))
        .groupBy("tier", "month")
        .agg(F.count("*").alias("site_opens"), F.sum("base").cast("bigint").alias("base"))
    )


def site_opens(contracts: DataFrame, sites: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, site_opens)``."""
    return site_metrics(contracts, sites, cfg).drop("base")


def base_added(contracts: DataFrame, sites: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, base)``."""
    return site_metrics(contracts, sites, cfg).drop("site_opens")


def add_take_rate(monthly: DataFrame) -> DataFrame:
    """Running base over the tier's months and ending accounts per unit of it (0 without base)."""
    order = Window.partitionBy("tier").orderBy("month")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    based = monthly.withColumn("base", F.coalesce("base", F.lit(0)).cast("bigint")).withColumn(
        "cumulative_base", F.sum("base").over(running)
    )
    rate = ratio(F.col("ending_count").cast("double"), F.col("cumulative_base"))
    return based.withColumn(
        "take_rate", F.when(F.col("cumulative_base") > 0, rate).otherwise(F.lit(0.0))
    )
