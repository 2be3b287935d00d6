"""Writing results: one Parquet table for all tiers, or CSV per tier with the original titles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waterline.config import FULL
from waterline.operators.tiers import add_tiers, filter_on_tier
from waterline.schema import CONTRACT_TITLES, DERIVED_TITLES, MONTHLY_TITLES, WATERFALL_COLUMNS
from waterline.sources.layout import Layout
from waterline.sources.runs import Run, file_system

CONTRACT_FILE_TITLES = {
    name: title for title, name in {**CONTRACT_TITLES, **DERIVED_TITLES}.items()
}
MONTHLY_FILE_TITLES = {name: title for title, name in MONTHLY_TITLES.items()}


def scenario_prefix(repriced: bool, contracts: bool = False) -> str:
    """Results without price changes are the baseline; repriced contract rows are marked too."""
    if not repriced:
        return "baseline_"
    return "price_" if contracts else ""


def titled(df: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(titles.get(c, c)) for c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """With header; quotes are doubled and texts keep the blanks and breaks at their ends."""
    options = {"header": True, "encoding": "ISO-8859-1", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def write_cleaned(contracts: DataFrame, layout: Layout, tier: str = FULL) -> str:
    """Cleaned contract rows, before any filter."""
    path = f"{layout.tier(tier, 'raw_cleaned')}/cleaned_data"
    contracts.write.mode("overwrite").parquet(path)
    return path


def _written(df: DataFrame, layout: Layout, path: str, run: Run | None, tiers: Sequence[str] | None = None) -> str:
    """Write within a run, or as a run of its own."""
    own = run or Run(df.sparkSession, layout)
    own.write(df, path, tiers)
    if run is None:
        own.finish()
    return path


def write_contracts(
    contracts: DataFrame,
    layout: Layout,
    tiers: Mapping[str, Sequence[int]] | None = None,
    repriced: bool = False,
    run: Run | None = None,
) -> str:
    """Prepared contract rows; with ``tiers`` one partition per tier a row belongs to."""
    name = f"{scenario_prefix(repriced, contracts=True)}filtered_data"
    if tiers is None:
        return _written(contracts, layout, f"{layout.tier(FULL, 'filtered_data')}/{name}", run)
    return _written(add_tiers(contracts, tiers), layout, f"{layout.all_tiers('filtered_data')}/{name}", run)


def write_by_tier(df: DataFrame, layout: Layout, stage: str, name: str, run: Run | None = None, tiers: Sequence[str] = ()) -> str:
    """A monthly table as Parquet, one partition per tier; other tiers' earlier rows stay.

    ``tiers`` names those the table stands for, also without rows. Read it with ``read_monthly``.
    """
    return _written(df, layout, f"{layout.all_tiers(stage)}/{name}", run, tiers)


def write_waterfall(df: DataFrame, layout: Layout, repriced: bool = False, run: Run | None = None, tiers: Sequence[str] = ()) -> str:
    name = f"{scenario_prefix(repriced)}mrr_waterfall_results"
    return write_by_tier(df, layout, "mrr_waterfall", name, run, tiers)


def write_combined(df: DataFrame, layout: Layout, repriced: bool = False, run: Run | None = None, tiers: Sequence[str] = ()) -> str:
    name = f"{scenario_prefix(repriced)}combined_mrr_arpu_results"
    return write_by_tier(df, layout, "combined_results", name, run, tiers)


def export_csv(
    monthly: DataFrame, layout: Layout, tiers: Sequence[str], repriced: bool = False
) -> list[str]:
    """One CSV per tier with the original titles: the combined table or the waterfall."""
    combined = "arpu" in monthly.columns
    stage = "combined_results" if combined else "mrr_waterfall"
    name = "combined_mrr_arpu_results" if combined else "mrr_waterfall_results"
    columns = list(MONTHLY_FILE_TITLES) if combined else list(WATERFALL_COLUMNS)
    paths = []
    for tier in tiers:
        path = f"{layout.tier(tier, stage)}/{scenario_prefix(repriced)}{name}"
        rows = monthly.filter(F.col("tier") == tier).select(*columns).orderBy("month")
        # a row per month: one file
        write_csv(titled(rows.coalesce(1), MONTHLY_FILE_TITLES), path)
        paths.append(path)
    return paths


def export_contracts_csv(
    contracts: DataFrame,
    layout: Layout,
    tier: str,
    tiers: Mapping[str, Sequence[int]],
    repriced: bool = False,
) -> str:
    """One tier's contract rows as CSV with the original titles."""
    name = f"{scenario_prefix(repriced, contracts=True)}filtered_data"
    path = f"{layout.tier(tier, 'filtered_data')}/{name}"
    write_csv(titled(filter_on_tier(contracts, tier, tiers), CONTRACT_FILE_TITLES), path)
    return path


def _if_any(rows: DataFrame, path: str) -> tuple[str | None, int]:
    """Contract rows as CSV, counted while they are written; nothing stays if there are none."""
    seen = Observation()
    write_csv(titled(rows.observe(seen, F.count(F.lit(1)).alias("rows")), CONTRACT_FILE_TITLES), path)
    count = seen.get["rows"]
    if not count:
        files, target = file_system(rows.sparkSession, path)
        files.delete(target, True)
    return (path if count else None), count


def write_rejects(rejects: DataFrame, layout: Layout) -> tuple[str | None, int]:
    """Rows without a readable start date, and how many; no file if there are none."""
    return _if_any(rejects, f"{layout.root}/Rejected_Rows")


def write_unreadable(records: DataFrame, layout: Layout) -> tuple[str | None, int]:
    """Records of an input file that could not be read, and how many; no file if there are none."""
    return _if_any(records, f"{layout.root}/Unreadable_Records")


def write_exclusivity_errors(conflicts: DataFrame, layout: Layout) -> tuple[str | None, int]:
    """Conflicting rows, and how many; no file if there are none."""
    return _if_any(conflicts, f"{layout.root}/Mutual_Exclusivity_Errors")


def write_predictions(trend: DataFrame, layout: Layout, target: str) -> str:
    """History, projection and trend line of every tier."""
    name = f"{target.replace(' ', '_')}_predictions"
    return write_by_tier(trend, layout, "forecasts", name)
