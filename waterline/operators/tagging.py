"""Revenue category of a contract row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.config import (
    ACTIVATE,
    CATEGORY_PRIORITY,
    CHANGE_OF_SERVICE,
    CHURN,
    CONTRACTION,
    DOWNGRADE,
    EXPANSION,
    NEW,
    OTHER,
    UPGRADE,
)


def category_if_staying() -> Column:
    """The category of a row whose account has not churned."""
    wo, reason = F.col("wo_type_group"), F.col("reason_group")
    changed = wo == CHANGE_OF_SERVICE
    return (
        F.when(changed & (reason == UPGRADE), EXPANSION)
        .when(changed & (reason == DOWNGRADE), CONTRACTION)
        .when(wo == ACTIVATE, NEW)
        .otherwise(OTHER)
    )


def revenue_category() -> Column:
    return F.when(F.col("churn_flag") == 1, CHURN).otherwise(category_if_staying())


def category_rank() -> Column:
    """Smaller wins when one key carries several categories."""
    rank = F.lit(max(CATEGORY_PRIORITY.values()) + 1)
    for category, priority in CATEGORY_PRIORITY.items():
        rank = F.when(F.col("revenue_category") == category, priority).otherwise(rank)
    return rank


def tag_revenue_category(contracts: DataFrame) -> DataFrame:
    """Add ``revenue_category``; rows without one of the four revenue categories go."""
    tagged = contracts.withColumn("revenue_category", revenue_category())
    return tagged.filter(F.col("revenue_category") != OTHER)
