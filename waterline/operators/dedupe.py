"""Removing contract rows that would count the same revenue twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.functions.calendar import month_index
from waterline.operators import skew
from waterline.operators.churn import FIRST_END, STAYS
from waterline.operators.tagging import category_rank
from waterline.sources.staging import materialise

MONTH_KEY = ("account_number", "package_group", "month_key")
START_KEY = ("account_number", "package_group", "start_date")


def _latest_end_first(df: DataFrame, open_wins: bool) -> list[Column]:
    """Total order of the rows of one package and start: latest end, then every other column."""
    end = F.col("end_date")
    by_end = end.desc_nulls_first() if open_wins else end.desc_nulls_last()
    rest = [c for c in df.columns if c not in {*START_KEY, "end_date", "price"}]
    return [by_end, F.col("price").asc(), *[F.col(c).asc() for c in rest]]


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key. The planner keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_of_kind(df: DataFrame, kind: Column, carried: dict[str, Column], open_wins: bool = False) -> DataFrame:
    """The row :func:`dedupe` prefers of each account, package, start and kind, with aggregates of all of them.

    Copies leave before the shuffle, as in :func:`_first`, but what they say of their account goes along.
    """
    rest = [c for c in df.columns if c not in {*START_KEY, "end_date", "price"}]
    end = F.col("end_date")
    # smallest first in the order of _latest_end_first
    ranked = F.struct(
        (end.isNotNull() if open_wins else end.isNull()).alias("_later"),
        (-F.unix_date(end)).alias("_end"),
        "price",
        *rest,
    )
    best = df.groupBy(*START_KEY, kind.alias("_kind")).agg(
        F.min(ranked).alias("_best"), *[column.alias(name) for name, column in carried.items()]
    )
    values = {c: F.col(f"_best.{c}") for c in ("price", *rest)} | {"end_date": F.date_from_unix_date(-F.col("_best._end"))}
    return best.select(*[values[c].alias(c) if c in values else F.col(c) for c in df.columns], *carried)


def dedupe_overlap(df: DataFrame, open_wins: bool = False) -> DataFrame:
    """Per account, package and start date keep the row with the latest end."""
    return _first(df, START_KEY, _latest_end_first(df, open_wins))


def dedupe_category(df: DataFrame, open_wins: bool = False, **spread: int) -> DataFrame:
    """Per account, package and month with several categories keep the row of the first one.

    Keys with a single category keep all their rows.
    """
    per_key = df.groupBy(*MONTH_KEY).agg(
        F.count("*").alias("n_rows"),
        (F.min("revenue_category") != F.max("revenue_category")).alias("conflict"),
    )
    conflicts = per_key.filter("conflict")
    marked = skew.attach(df, conflicts, MONTH_KEY, ["conflict"], "n_rows", **spread)
    clean = marked.filter(F.col("conflict").isNull()).drop("conflict")
    order = [category_rank(), F.col("start_date"), *_latest_end_first(df, open_wins)]
    winners = _first(marked.filter("conflict").drop("conflict"), MONTH_KEY, order)
    return clean.unionByName(winners)


def together(best: DataFrame, open_wins: bool = False) -> DataFrame:
    """Rows of :func:`best_of_kind` by account, each package's months in the order :func:`settle` needs.

    One sort serves the account's window and that of its months.
    """
    rows = best.withColumn(_MONTH, month_index(F.col("start_date")))
    return rows.repartition("account_number").sortWithinPartitions(*_MONTHS, *_in_month(rows, open_wins))


_MONTH = "_month"
_MONTHS = ("account_number", "package_group", _MONTH)
# what is known of a row only after its account has been looked at
_LATER = ("churn_flag", "churn_date", "revenue_category", "_rank", _MONTH, STAYS, FIRST_END)


def _in_month(df: DataFrame, open_wins: bool) -> list[Column]:
    return [F.col("start_date").asc(), *_latest_end_first(df.drop(*_LATER), open_wins)]


def settle(df: DataFrame, open_wins: bool = False) -> DataFrame:
    """:func:`dedupe` of rows that :func:`together` has sorted, flagged and tagged since.

    A start has one row per kind. Those of an account that left are all churn, the first of them
    stays; else kinds are categories, and of a month with several the best one's first row stays.
    """
    month = Window.partitionBy(*_MONTHS).orderBy(*_in_month(df, open_wins))
    whole = month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = month.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("_rank")
    ranked = df.withColumn("_rank", category_rank()).withColumns(
        {
            "_copy": F.coalesce((F.lag("start_date").over(month) == F.col("start_date")) & (F.lag("_rank").over(month) == rank), F.lit(False)),
            "_conflict": F.min("_rank").over(whole) != F.max("_rank").over(whole),
            "_wins": (rank == F.min("_rank").over(whole)) & (F.coalesce(F.min("_rank").over(before), rank + 1) > rank),
        }
    )
    return ranked.filter(~F.col("_copy") & (~F.col("_conflict") | F.col("_wins"))).drop(_MONTH, "_rank", "_copy", "_conflict", "_wins")


def dedupe(df: DataFrame, open_wins: bool = False) -> DataFrame:
    """:func:`dedupe_category` followed by :func:`dedupe_overlap`, without joins.

    Both rank the rows of one package, start and category alike, so first only the best of those
    survives (one row per key and task enters the shuffle, however many copies a key has). A month
    then holds at most one row per day and category, and a small window settles the conflicts.
    """
    by_end = _latest_end_first(df, open_wins)
    best = _first(df, [*START_KEY, "revenue_category"], by_end)
    month = Window.partitionBy(*MONTH_KEY)
    ranked = best.withColumns(
        {
            "_conflict": F.min("revenue_category").over(month)
            != F.max("revenue_category").over(month),
            "_rn": F.row_number().over(
                month.orderBy(category_rank(), F.col("start_date"), *by_end)
            ),
        }
    )
    return ranked.filter(~F.col("_conflict") | (F.col("_rn") == 1)).drop("_conflict", "_rn")


def exclusivity_conflicts(df: DataFrame, staged: bool = False, **spread: int) -> DataFrame:
    """Rows of an account, package and start date with several categories, with their number.

    ``staged`` writes the conflicting keys first: they are few as a rule, and once their size is known
    the planner leaves the rows where they are.
    """
    per_key = df.groupBy(*START_KEY).agg(
        F.count("*").alias("n_rows"),
        # at most one entry per revenue category
        F.size(F.collect_set("revenue_category")).cast("bigint").alias("n_categories"),
    )
    conflicts = per_key.filter("n_categories > 1")
    if staged:
        conflicts = materialise(conflicts, "conflicts")
    marked = skew.attach(df, conflicts, START_KEY, ["n_categories"], "n_rows", **spread)
    return marked.filter(F.col("n_categories").isNotNull())
