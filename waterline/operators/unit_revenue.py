"""Revenue per account: ARPU by period, ratios of the waterfall, cumulative ARPU."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.config import RunConfig
from waterline.functions.money import average_cents, cents, dollars, format_currency, ratio
from waterline.operators.quantiles import exact_quantiles
from waterline.operators.tiers import add_tiers, tier_bits, tiers_of_bits
from waterline.sources.staging import materialise

# ratio -> (amount, count)
PARPU = {
    "starting_parpu": ("starting_mrr", "starting_count"),
    "new_parpu": ("new_mrr", "new_count"),
    "expansion_parpu": ("expansion", "expansion_count"),
    "contraction_parpu": ("contraction", "contraction_count"),
    "churn_parpu": ("churn", "churn_count"),
    "net_parpu": ("net_new_mrr", "net_count"),
    "ending_parpu": ("ending_mrr", "ending_count"),
}


def _per_account(contracts: DataFrame, cfg: RunConfig, *keys: str) -> DataFrame:
    """``(tier, *keys, account_number, cents)``: summed by segment and brought together before tiers multiply the rows."""
    per_segment = contracts.groupBy(*keys, "account_number", "cxn_code").agg(
        F.sum(cents(F.col("price"))).alias("cents")
    )
    return (
        add_tiers(per_segment.repartition(*keys, "account_number"), cfg.tiers)
        .groupBy("tier", *keys, "account_number")
        .agg(F.sum("cents").alias("cents"))
    )


def arpu(contracts: DataFrame, cfg: RunConfig, time_key: str = "month_key") -> DataFrame:
    """``(tier, <time_key>, total_period_activation, unique_accounts, arpu)``.

    Amounts need no account and are summed by segment. A period's accounts are told apart once, each
    with the tiers of all its segments as bits; tiers multiply only the counts of those.
    """
    amounts = contracts.groupBy(time_key, "cxn_code").agg(F.sum(cents(F.col("price"))).alias("cents"))
    bits = tier_bits(F.col("cxn_code"), cfg.tiers)
    names = [f"_bits{n}" for n in range(len(bits))]
    accounts = (
        contracts.filter(F.col("account_number").isNotNull())
        .groupBy(time_key, "account_number")
        .agg(F.count("*").alias("n_rows"), *[F.bit_or(b).alias(n) for b, n in zip(bits, names, strict=True)])
        .groupBy(time_key, *names)
        .agg(F.count("*").alias("accounts"))
        .select(F.explode(tiers_of_bits([F.col(n) for n in names], cfg.tiers)).alias("tier"), time_key, "accounts")
    )
    per_key = (
        add_tiers(amounts, cfg.tiers)
        .select("tier", time_key, "cents")
        .unionByName(accounts, allowMissingColumns=True)
        .groupBy("tier", time_key)
        .agg(F.sum("cents").alias("cents"), F.coalesce(F.sum("accounts"), F.lit(0)).alias("unique_accounts"))
    )
    return per_key.select(
        "tier",
        time_key,
        dollars(F.col("cents")).alias("total_period_activation"),
        "unique_accounts",
        average_cents(F.col("cents"), F.col("unique_accounts")).alias("arpu"),
    )


def add_parpu(monthly: DataFrame, zero_denominator: str = "inf") -> DataFrame:
    return monthly.withColumns(
        {
            name: ratio(F.col(amount), F.col(count), zero_denominator)
            for name, (amount, count) in PARPU.items()
        }
    )


def cumulative_arpu(contracts: DataFrame, cfg: RunConfig, ranked: bool = True) -> DataFrame:
    """``(tier, account_number, cumulative_arpu)``: all revenue of an account.

    Largest first if ``ranked``, which is a global sort: for reports. Other steps need no order.
    """
    listed = _per_account(contracts, cfg).select(
        "tier", "account_number", dollars(F.col("cents")).alias("cumulative_arpu")
    )
    return listed.orderBy("tier", F.desc("cumulative_arpu"), "account_number") if ranked else listed


def cumulative_arpu_summary(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per tier: number of customers, mean, median, total, extremes, 90th percentile.

    Accounts' sums are written once: the quantiles read them several times.
    """
    accounts = materialise(_per_account(contracts, cfg).select("tier", "cents"), "accounts")
    n, total = F.count("*"), F.sum("cents")
    plain = accounts.groupBy("tier").agg(
        n.alias("total_customers"),
        (total.cast("double") / (n * 100).cast("double")).alias("average_cumulative_arpu"),
        dollars(total).alias("total_revenue"),
        dollars(F.max("cents")).alias("max_customer_value"),
        dollars(F.min("cents")).alias("min_customer_value"),
    )
    ranked = exact_quantiles(
        accounts.withColumn("value", dollars(F.col("cents"))),
        ["tier"],
        "value",
        {"median_cumulative_arpu": 0.5, "top_10_percent_arpu": 0.9},
    )
    return plain.join(ranked, "tier")


def format_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns that exist as currency text."""
    return df.withColumns({c: format_currency(F.col(c)) for c in columns if c in df.columns})
