"""From raw contract rows to rows that count revenue once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waterline.config import RunConfig
from waterline.operators.churn import identify_churned, signs
from waterline.operators.cleaning import handle_missing_data
from waterline.operators.dedupe import best_of_kind, settle, together
from waterline.operators.filters import add_time_keys, apply_business_filters
from waterline.operators.tagging import category_if_staying, tag_revenue_category


def tag_contracts(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """Filters, time keys, churn and revenue category; duplicates still in."""
    return (
        contracts.transform(apply_business_filters, cfg.core_packages)
        .transform(add_time_keys)
        .transform(identify_churned, cfg.as_of)
        .transform(tag_revenue_category)
    )


def prepare_contracts(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """Clean, typed contract rows to deduplicated, tagged rows. One lazy plan, no action.

    Whatever becomes of an account, of its rows of one package, start and kind only the best can stay.
    So those meet first, with what the others say of the account; then they are brought together by
    account once and sorted once, and churn and both rules for duplicates find their rows in place.
    Time keys follow from the start and are neither shuffled nor sorted.
    """
    rows = contracts.transform(apply_business_filters, cfg.core_packages)
    keyed = add_time_keys(rows).columns
    best = best_of_kind(rows, category_if_staying(), signs(cfg.as_of), cfg.open_wins)
    return (
        best.transform(together, cfg.open_wins)
        .transform(identify_churned, cfg.as_of)
        .transform(tag_revenue_category)
        .transform(settle, cfg.open_wins)
        .transform(add_time_keys)
        .select(*keyed, "churn_flag", "churn_date", "revenue_category")
    )


def clean_and_prepare(raw: DataFrame, cfg: RunConfig, fill_ids: bool = False) -> DataFrame:
    """Raw text rows all the way; profile and medians run as two small jobs first."""
    return prepare_contracts(handle_missing_data(raw, fill_ids), cfg)
