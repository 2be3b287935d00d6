"""The registered queries: every operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verification.fixtures import (
    AS_OF,
    CHANGES,
    CONFIG,
    EARLY_CONFIG,
    PACKAGES,
    contracts,
    long_changes,
    raw_contracts,
    sites,
    table,
)
from waterline.config import FULL, SEGMENTS, RunConfig
from waterline.functions.calendar import month_key
from waterline.functions.money import format_currency
from waterline.operators import (
    churn,
    cleaning,
    dedupe,
    filters,
    movements,
    pricing,
    tiers,
    unit_revenue,
    waterfall,
)
from waterline.operators import sites as site_ops
from waterline.operators.recent import last_rows
from waterline.plans import monthly, prep
from waterline.schema import WATERFALL_COLUMNS
from waterline.sources import sinks
from waterline.sources.contracts import read_contracts_csv
from waterline.sources.sites import to_long
from waterline.sources.staging import materialise, scratch

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates as text, money as DOUBLE, whole numbers as BIGINT."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.coalesce(column.cast("string"), F.lit(""))
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def business(spark: SparkSession, sf: str) -> DataFrame:
    return filters.apply_business_filters(contracts(spark, sf), PACKAGES)


def keyed(spark: SparkSession, sf: str) -> DataFrame:
    return filters.add_time_keys(business(spark, sf))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return churn.identify_churned(keyed(spark, sf), AS_OF)


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return prep.tag_contracts(contracts(spark, sf), CONFIG)


def deduped(spark: SparkSession, sf: str, cfg: RunConfig = CONFIG) -> DataFrame:
    return prep.prepare_contracts(contracts(spark, sf), cfg)


def staged(spark: SparkSession, sf: str, cfg: RunConfig = CONFIG, repriced=False) -> DataFrame:
    """Prepared rows written once, for queries that use them in several branches."""
    rows = deduped(spark, sf, cfg)
    if repriced:
        rows = pricing.reprice(rows, CHANGES)
    return materialise(rows, "contracts")


def flow(spark: SparkSession, sf: str, cfg: RunConfig = CONFIG, repriced=False) -> DataFrame:
    return waterfall.waterfall(staged(spark, sf, cfg, repriced), cfg)


def combined(spark: SparkSession, sf: str, repriced=False) -> DataFrame:
    rows = staged(spark, sf, CONFIG, repriced)
    return monthly.combined_metrics(rows, sites(spark, sf), CONFIG)


def _currency_parse(spark, sf):
    raw = raw_contracts(spark, sf).select(F.col("price").alias("price_text"), "price")
    return cleaning.parse_price(raw).groupBy("price_text", "price").agg(F.count("*").alias("n"))


def _currency_format(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), format_currency(F.col("o_totalprice")).alias("total")
    )


def _drop_sparse(spark, sf):
    kept = cleaning.drop_sparse_columns(raw_contracts(spark, sf))
    profile = cleaning.missing_profile(kept)
    return profile.groupBy("column_name").agg(F.count("*").alias("n_columns"))


def _fill_unknown(spark, sf):
    filled = cleaning.fill_text(cleaning.fill_packages(raw_contracts(spark, sf)))
    return filled.groupBy("package_group", "wo_type_group", "reason_group").agg(
        F.count("*").alias("n")
    )


def _fill_median(spark, sf):
    columns = ["test_flag", "cxn_code", "discount", "tax"]
    raw = raw_contracts(spark, sf).select("order_key", "line_number", "part_key", *columns)
    filled = cleaning.fill_medians(raw, fill_ids=True, columns=columns)
    return filled.withColumns({c: F.col(c).cast("double") for c in columns})


def _medians(spark, sf):
    columns = ["test_flag", "cxn_code", "discount", "tax", "order_key", "part_key"]
    return cleaning.medians(raw_contracts(spark, sf), columns)


def _cleaned(spark, sf):
    cleaned = cleaning.handle_missing_data(raw_contracts(spark, sf))
    return cleaned.na.fill(-1, subset=["test_flag", "cxn_code"])


def _prepared_from_raw(spark, sf):
    out = prep.clean_and_prepare(raw_contracts(spark, sf), CONFIG)
    return out.drop("discount", "tax")


def _csv_round_trip(spark, sf):
    """Out as a file with titles and text prices, and back in."""
    rows = contracts(spark, sf)
    path = scratch(spark, "csv")
    text = sinks.titled(
        rows.withColumn("price", format_currency(F.col("price"))), sinks.CONTRACT_FILE_TITLES
    )
    text.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    back = cleaning.parse_price(filters.parse_dates(read_contracts_csv(spark, path)))
    keys = ["order_key", "line_number", "part_key"]
    return back.withColumns({k: F.col(k).cast("bigint") for k in keys})


def wide_sites(spark: SparkSession, sf: str) -> DataFrame:
    """One row per site with a column per segment, as site files hold them."""
    return (
        sites(spark, sf)
        .groupBy(F.col("site").alias("Site"), F.col("release_date").alias("Date"))
        .pivot("cxn_code", list(SEGMENTS))
        .agg(F.sum("base"))
    )


def _wide_sites(spark, sf):
    return to_long(wide_sites(spark, sf)).select(
        "site", month_key(F.col("release_date")).alias("month"), "cxn_code", "base"
    )


def _churn_summary(spark, sf):
    per_account = churn.account_status(keyed(spark, sf), AS_OF)
    return per_account.groupBy("churn_flag").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count("*").alias("accounts"),
        F.min("churn_date").alias("first_churn"),
        F.max("churn_date").alias("last_churn"),
    )


def _tier_month_counts(spark, sf):
    rows = tiers.add_tiers(deduped(spark, sf))
    per_account = rows.groupBy("tier", F.col("month_key").alias("month"), "account_number").agg(
        F.count("*").alias("n")
    )
    return per_account.groupBy("tier", "month").agg(
        F.sum("n").alias("contracts"), F.count("*").alias("accounts")
    )


def _parpu(spark, sf):
    rows = unit_revenue.add_parpu(flow(spark, sf))
    return rows.select("tier", "month", *unit_revenue.PARPU)


def _arpu(key: str) -> Query:
    return lambda spark, sf: unit_revenue.arpu(deduped(spark, sf), CONFIG, key)


QUERIES: dict[str, Query] = {
    # cleaning
    "contracts": contracts,
    "missing_profile": lambda s, d: cleaning.missing_profile(raw_contracts(s, d)),
    "currency_parse": _currency_parse,
    "currency_format": _currency_format,
    "drop_sparse_columns": _drop_sparse,
    "fill_unknown": _fill_unknown,
    "fill_median": _fill_median,
    "medians": _medians,
    "cleaned_contracts": _cleaned,
    "prepared_from_raw": _prepared_from_raw,
    "csv_round_trip": _csv_round_trip,
    "wide_sites": _wide_sites,
    # filters, churn, tagging, dedupe
    "business_filter": business,
    "time_keys": keyed,
    "churn_accounts": lambda s, d: churn.account_status(keyed(s, d), AS_OF),
    "churn_summary": _churn_summary,
    "churned_without_date": lambda s, d: churn.churned_without_date(flagged(s, d)),
    "revenue_category": tagged,
    "dedupe_category": lambda s, d: dedupe.dedupe_category(tagged(s, d)),
    "dedupe_overlap": lambda s, d: dedupe.dedupe_overlap(tagged(s, d)),
    "deduped_contracts": deduped,
    "exclusivity_check": lambda s, d: dedupe.exclusivity_conflicts(tagged(s, d)),
    "tier_rows": lambda s, d: tiers.add_tiers(deduped(s, d)),
    "tier_filter": lambda s, d: tiers.filter_on_tier(deduped(s, d), "moderate_performers"),
    "tier_month_counts": _tier_month_counts,
    # price changes
    "reprice_new": lambda s, d: pricing.apply_price_changes(deduped(s, d), CHANGES),
    "split_contracts": lambda s, d: pricing.reprice(deduped(s, d), CHANGES),
    "price_change_impact": lambda s, d: pricing.price_change_impact(deduped(s, d), CHANGES),
    "tail": lambda s, d: last_rows(combined(s, d).select("tier", "month", "ending_mrr", "starting_count"), ["tier"], ["month"], 5),
    "split_contracts_long_list": lambda s, d: pricing.reprice(deduped(s, d), long_changes(s, d)),
    "split_contracts_by_table": lambda s, d: pricing.reprice(deduped(s, d), pricing.price_change_table(s, CHANGES)),
    "price_change_impact_of_table": lambda s, d: pricing.price_change_impact(
        deduped(s, d), pricing.price_change_table(s, CHANGES)
    ),
    "split_summary": lambda s, d: pricing.split_summary(deduped(s, d), CHANGES),
    # monthly revenue
    "calendar_spine": lambda s, d: waterfall.calendar_spine(deduped(s, d), CONFIG),
    "mrr_start_new": lambda s, d: waterfall.start_new_mrr(staged(s, d), CONFIG),
    "mrr_start_new_early": lambda s, d: waterfall.start_new_mrr(
        staged(s, d, EARLY_CONFIG), EARLY_CONFIG
    ),
    "mrr_start_new_explode": lambda s, d: waterfall.start_new_mrr(staged(s, d), CONFIG, "explode"),
    "active_accounts": lambda s, d: waterfall.active_accounts(deduped(s, d), CONFIG),
    "expansion": lambda s, d: movements.expansion_revenue(deduped(s, d), CONFIG),
    "contraction": lambda s, d: movements.contraction_revenue(deduped(s, d), CONFIG),
    "price_moves": lambda s, d: movements.price_moves(deduped(s, d), CONFIG),
    "churn_revenue": lambda s, d: movements.churn_revenue(deduped(s, d), CONFIG),
    "mrr_waterfall": lambda s, d: flow(s, d)
    .filter(F.col("tier") == FULL)
    .select(*WATERFALL_COLUMNS),
    "mrr_waterfall_by_tier": flow,
    "mrr_waterfall_early": lambda s, d: flow(s, d, EARLY_CONFIG),
    "mrr_waterfall_repriced": lambda s, d: flow(s, d, repriced=True),
    "arr": lambda s, d: waterfall.arr(flow(s, d)),
    # unit revenue and sites
    "arpu_week": _arpu("week_key"),
    "arpu_month": _arpu("month_key"),
    "arpu_quarter": _arpu("quarter_key"),
    "arpu_year": _arpu("year_key"),
    "parpu": _parpu,
    "combined_metrics": combined,
    "combined_metrics_repriced": lambda s, d: combined(s, d, repriced=True),
    "cumulative_arpu": lambda s, d: unit_revenue.cumulative_arpu(deduped(s, d), CONFIG, ranked=False),
    "cumulative_arpu_summary": lambda s, d: unit_revenue.cumulative_arpu_summary(
        deduped(s, d), CONFIG
    ),
    "site_opens": lambda s, d: site_ops.site_opens(deduped(s, d), sites(s, d), CONFIG),
    "base_added": lambda s, d: site_ops.base_added(deduped(s, d), sites(s, d), CONFIG),
    "take_rate": lambda s, d: combined(s, d).select(
        "tier", "month", "base", "cumulative_base", "take_rate"
    ),
}


def shown(registered: dict[str, Query]) -> dict[str, Query]:
    def wrap(query: Query) -> Query:
        return lambda spark, sf_dir: present(query(spark, sf_dir))

    return {name: wrap(query) for name, query in registered.items()}
