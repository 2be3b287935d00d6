"""Account-level churn."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.config import ACTIVATE, CHANGE_OF_SERVICE, CHURN_GRACE_DAYS
from waterline.functions.calendar import open_as_null
from waterline.operators import skew

# What rows that stand for several carry of them, see ``signs``.
STAYS, FIRST_END = "_stays", "_first_end"


def signs(as_of: dt.date) -> dict[str, Column]:
    """Aggregates over contract rows that tell whether their account stays, and its first end."""
    wo, start = F.col("wo_type_group"), F.col("start_date")
    end = open_as_null(F.col("end_date"))
    stays = (
        ((wo == ACTIVATE) & (end.isNull() | (end > F.lit(as_of))))
        | (wo == CHANGE_OF_SERVICE)
        | (start >= F.lit(as_of))
    )
    return {STAYS: F.bool_or(F.coalesce(stays, F.lit(False))), FIRST_END: F.min(end)}


def _churned(stays: Column, first_end: Column, as_of: dt.date) -> Column:
    last_safe = as_of - dt.timedelta(days=CHURN_GRACE_DAYS)
    return ~stays & (first_end < F.lit(last_safe))


def account_status(contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per account: ``n_rows``, ``churn_flag`` and, where churned, ``churn_date``.

    An account stays if an activation is still open or ends after ``as_of``, if its service ever
    changed, or if a contract starts on or after ``as_of``. Otherwise it left on its first end date,
    once that lies more than 30 days back.
    """
    churned = _churned(F.col(STAYS), F.col(FIRST_END), as_of)
    return (
        contracts.groupBy("account_number")
        .agg(F.count("*").alias("n_rows"), *[sign.alias(name) for name, sign in signs(as_of).items()])
        .select(
            "account_number",
            "n_rows",
            F.coalesce(churned, F.lit(False)).cast("int").alias("churn_flag"),
            F.when(churned, F.col(FIRST_END)).alias("churn_date"),
        )
    )


def identify_churned(contracts: DataFrame, as_of: dt.date, **spread: int) -> DataFrame:
    """Contract rows plus ``churn_flag`` (0/1) and ``churn_date`` of their account.

    Rows that stand for several (``dedupe.best_of_kind``) carry the signs of them, and an account has
    no more of those than it has starts, packages and kinds: they are brought together by account.
    """
    if STAYS in contracts.columns:
        account = Window.partitionBy("account_number")
        signs_of = [F.bool_or(STAYS).over(account), F.min(FIRST_END).over(account)]
        gone = F.col("account_number").isNotNull() & _churned(F.col(STAYS), F.col(FIRST_END), as_of)
        return (
            contracts.withColumns(dict(zip((STAYS, FIRST_END), signs_of, strict=True)))
            .withColumns({"churn_flag": F.coalesce(gone, F.lit(False)).cast("int"), "churn_date": F.when(gone, F.col(FIRST_END))})
            .drop(STAYS, FIRST_END)
        )
    churned = account_status(contracts, as_of).filter(F.col("churn_flag") == 1)
    tagged = skew.attach(
        contracts, churned, ["account_number"], ["churn_flag", "churn_date"], "n_rows", **spread
    )
    return tagged.withColumn("churn_flag", F.coalesce("churn_flag", F.lit(0)))


def churned_without_date(tagged: DataFrame) -> DataFrame:
    """Data-quality check: rows flagged as churned that carry no date. Should be empty."""
    return tagged.filter((F.col("churn_flag") == 1) & F.col("churn_date").isNull())
