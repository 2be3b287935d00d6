"""The monthly metrics of all tiers in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import TIER_KEYS, RunConfig
from waterline.operators.cleaning import handle_missing_data
from waterline.operators.dedupe import exclusivity_conflicts
from waterline.operators.filters import rejected_starts
from waterline.operators.pricing import Changes, reprice
from waterline.operators.sites import add_take_rate, site_metrics
from waterline.operators.unit_revenue import add_parpu, arpu
from waterline.operators.waterfall import align, arr, waterfall
from waterline.plans.prep import prepare_contracts
from waterline.schema import MONTHLY_TITLES
from waterline.sources import sinks
from waterline.sources.contracts import read_contracts_csv, unreadable_records, validate
from waterline.sources.layout import Layout
from waterline.sources.runs import Run
from waterline.sources.sites import read_sites_csv
from waterline.sources.staging import drop_shuffles, materialise, release


def combine(
    flow: DataFrame, contracts: DataFrame, sites: DataFrame, cfg: RunConfig
) -> DataFrame:
    """Waterfall plus ARPU, per-unit ratios, site openings, base and take rate: 29 columns."""
    monthly_arpu = arpu(contracts, cfg).select("tier", F.col("month_key").alias("month"), "arpu")
    joined = (
        align(flow, monthly_arpu, site_metrics(contracts, sites, cfg))
        .transform(add_parpu, cfg.zero_denominator)
        .na.fill(0, subset=["site_opens"])
    )
    return add_take_rate(joined).select("tier", *MONTHLY_TITLES.values())


def combined_metrics(contracts: DataFrame, sites: DataFrame, cfg: RunConfig) -> DataFrame:
    """The combined monthly table from deduplicated contracts."""
    return combine(waterfall(contracts, cfg), contracts, sites, cfg)


@dataclass(frozen=True)
class MonthlyRun:
    contracts: DataFrame
    exclusivity_errors: DataFrame
    waterfall: DataFrame
    combined: DataFrame
    arr: DataFrame
    # input rows without a readable start date; no metric counts them
    rejects: DataFrame
    # how many conflicting and rejected rows were written; unknown without a layout
    conflicting: int | None = None
    rejected: int | None = None


def select_tiers(cfg: RunConfig, keys: Sequence[int] | None = None) -> list[str]:
    """Tier names by number (0 Full, 1 high, 2 moderate, 3 under); unknown numbers are ignored."""
    names = cfg.tier_names()
    if keys is None:
        return names
    return [TIER_KEYS[k] for k in keys if k in TIER_KEYS and TIER_KEYS[k] in names]


def monthly_run(
    contracts: DataFrame,
    sites: DataFrame,
    cfg: RunConfig,
    changes: Changes = (),
    tiers: Sequence[str] | None = None,
    layout: Layout | None = None,
) -> MonthlyRun:
    """Prepare, reprice, compute and, with a layout, write the monthly metrics.

    Churn and duplicates are settled on all rows before tiers are told apart, so one pass over the
    prepared rows serves every tier. Those rows and the waterfall are written once and read back,
    because several steps use them.
    """
    wanted = list(tiers) if tiers is not None else cfg.tier_names()
    unknown = set(wanted) - set(cfg.tier_names())
    if unknown:
        raise ValueError(f"unknown performance tier: {', '.join(sorted(unknown))}")
    # other tiers are never computed
    cfg = replace(cfg, tiers={name: segments for name, segments in cfg.tiers.items() if name in wanted})
    rejects = rejected_starts(contracts)
    rows = prepare_contracts(contracts, cfg)
    repriced = isinstance(changes, DataFrame) or bool(changes)
    if repriced:
        rows = reprice(rows, changes, cfg.split_open, cfg.chain_changes, cfg.rekey_splits)
    if layout is None:
        rows = materialise(rows, "contracts")
    else:
        run = Run(rows.sparkSession, layout)
        path = sinks.write_contracts(rows, layout, repriced=repriced, run=run)
        rows = run.back(rows.schema, path)

    conflicting = rejected = None
    picked = F.col("tier").isin(*wanted)
    flow = materialise(waterfall(rows, cfg).filter(picked), "waterfall")
    combined = materialise(combine(flow, rows, sites, cfg), "combined")
    # without a layout nobody may ask for them
    errors = exclusivity_conflicts(rows, staged=layout is not None)
    if layout is not None:
        sinks.write_waterfall(flow, layout, repriced, run, wanted)
        sinks.write_combined(combined, layout, repriced, run, wanted)
        _, conflicting = sinks.write_exclusivity_errors(errors, layout)
        _, rejected = sinks.write_rejects(rejects, layout)
        run.finish()
    return MonthlyRun(rows, errors, flow, combined, arr(combined), rejects, conflicting, rejected)


def batch_run(
    contracts: DataFrame,
    sites: DataFrame,
    cfg: RunConfig,
    keys: Sequence[int] | None = None,
    changes: Changes = (),
    layout: Layout | None = None,
) -> MonthlyRun:
    """:func:`monthly_run` for tiers given by number; all of them by default."""
    return monthly_run(contracts, sites, cfg, changes, select_tiers(cfg, keys), layout)


def run_from_files(
    spark: SparkSession,
    contracts_csv: str,
    sites_csv: str,
    cfg: RunConfig,
    layout: Layout,
    keys: Sequence[int] | None = None,
    changes: Changes = (),
    fill_ids: bool = False,
) -> MonthlyRun:
    """Everything from raw files to written results, with the monthly tables as CSV per tier too."""
    # profile, medians and cleaning each read the rows; text is parsed only once
    raw = materialise(validate(read_contracts_csv(spark, contracts_csv)), "raw")
    sinks.write_unreadable(unreadable_records(spark, contracts_csv), layout)
    cleaned = handle_missing_data(raw, fill_ids)
    path = sinks.write_cleaned(cleaned, layout)
    cleaned = spark.read.schema(cleaned.schema).parquet(path)
    # the cleaned rows take their place
    release(raw)
    drop_shuffles(spark)
    run = batch_run(cleaned, read_sites_csv(spark, sites_csv), cfg, keys, changes, layout)
    tiers = select_tiers(cfg, keys)
    repriced = isinstance(changes, DataFrame) or bool(changes)
    sinks.export_csv(run.waterfall, layout, tiers, repriced)
    sinks.export_csv(run.combined, layout, tiers, repriced)
    return run
