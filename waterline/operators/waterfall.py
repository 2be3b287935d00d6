"""Monthly recurring revenue: calendar spine, starting and new revenue, waterfall and ARR.

Revenue of a contract in a month is ``price * active days / days in month``. Days in the month are
the same for all rows of a month, so the numerators are summed as integers (cents times days) and
divided once: exact, and independent of the order of summation.

Two physical forms give the same numbers:

* ``difference`` (default): a contract adds its price at its first full month and takes it away
  after the last, so it contributes three events whatever its length; a running sum over the
  calendar restores the months. Distinct accounts come the same way from merged intervals.
* ``explode``: one row per contract and month. Simple, but as long as the contracts are; sums are
  combined and an account's months told apart before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.config import RunConfig
from waterline.functions.calendar import (
    days_in_month,
    effective_end,
    label_index,
    month_index,
    month_label,
    open_as_null,
)
from waterline.functions.money import cents
from waterline.operators.movements import churn_revenue, price_moves
from waterline.operators.tiers import add_tiers, tiers_of
from waterline.schema import WATERFALL_COLUMNS

KEYS = ["tier", "month_idx"]


def _terms(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """What the monthly sums need of a contract.

    ``s``/``e``: month of start and end; ``first``: first month it can start with; ``end_days`` and
    ``new_days``: active days in the month of the end and of the start.
    """
    start = F.col("start_date")
    end = effective_end(F.col("end_date"), cfg.as_of)
    on_first = F.lit(False) if cfg.exclusive_start else F.dayofmonth(start) == 1
    return contracts.select(
        "account_number",
        "cxn_code",
        cents(F.col("price")).alias("cents"),
        month_index(start).alias("s"),
        month_index(end).alias("e"),
        (month_index(start) + F.when(on_first, 0).otherwise(1)).alias("first"),
        F.dayofmonth(end).alias("end_days"),
        F.greatest(F.datediff(F.least(end, F.last_day(start)), start) + 1, F.lit(0)).alias(
            "new_days"
        ),
    )


def _spine_of(bounds: DataFrame) -> DataFrame:
    """Gapless months per tier from ``first_idx`` to ``last_idx``."""
    return bounds.filter("first_idx <= last_idx").select(
        "tier",
        "first_idx",
        F.explode(F.sequence("first_idx", "last_idx")).alias("month_idx"),
    )


def calendar_spine(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month)`` from the first start to the last effective end, without gaps."""
    start = month_index(F.col("start_date"))
    end = month_index(effective_end(F.col("end_date"), cfg.as_of))
    per_segment = contracts.groupBy("cxn_code").agg(
        F.min(start).alias("first_idx"), F.max(end).alias("last_idx")
    )
    bounds = (
        add_tiers(per_segment, cfg.tiers)
        .groupBy("tier")
        .agg(F.min("first_idx").alias("first_idx"), F.max("last_idx").alias("last_idx"))
    )
    return _spine_of(bounds).select("tier", month_label(F.col("month_idx")).alias("month"))


def _account_events(starts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month_idx, accounts, new_accounts)``: changes in the number of distinct accounts.

    ``starts`` holds, per account, segment and month ``s`` of a start, the months ``lo..hi`` covered
    by those contracts. In order of start each row adds only the months its account does not cover
    yet; what remains is disjoint and can be counted by its ends. A window is as long as an account
    has starting months. If ``starts`` has a ``last_idx``, so has the result: its maximum per month.
    """
    bounds = [c for c in ("last_idx",) if c in starts.columns]
    # accounts first: a sort by tier first would compare whole rows
    account = Window.partitionBy("account_number", "tier").orderBy("s", "lo")
    covered = F.max("hi").over(account.rowsBetween(Window.unboundedPreceding, -1))
    # brought together before tiers multiply them: a tier's accounts are then in place
    rows = add_tiers(starts.repartition("account_number"), cfg.tiers).select(
        "tier",
        "s",
        F.greatest(F.col("lo"), covered + 1).alias("lo"),
        "hi",
        F.lag("s").over(account).alias("previous"),
        *bounds,
    )

    def event(month, accounts, new_accounts):
        return F.struct(
            month.alias("month_idx"),
            F.lit(accounts).alias("accounts"),
            F.lit(new_accounts).alias("new_accounts"),
            *bounds,
        )

    s, lo, hi = F.col("s"), F.col("lo"), F.col("hi")
    fields = "".join(f",{c}:int" for c in bounds)
    none = F.array().cast(f"array<struct<month_idx:int,accounts:int,new_accounts:int{fields}>>")
    first = F.when(F.col("previous").isNull() | (F.col("previous") < s), F.array(event(s, 0, 1))).otherwise(
        F.array(event(s, 0, 0)) if bounds else none
    )
    spell = F.when(lo <= hi, F.array(event(lo, 1, 0), event(hi + 1, -1, 0))).otherwise(none)
    return (
        rows.select("tier", F.inline(F.concat(first, spell)))
        .groupBy(*KEYS)
        .agg(
            F.sum("accounts").alias("accounts"),
            F.sum("new_accounts").alias("new_accounts"),
            *[F.max(c).alias(c) for c in bounds],
        )
    )


def _fill_months(
    events: DataFrame, running: Sequence[str], spot: Sequence[str]
) -> DataFrame:
    """Every month of a tier from its events: ``running`` columns add up, ``spot`` ones do not.

    ``events`` has one row per tier and month with events, and the bounds ``first_idx`` and
    ``last_idx``. An event's state lasts until the next one, so each row supplies the months up to
    it; the calendar needs no join.
    """
    tier = Window.partitionBy("tier")
    order = tier.orderBy("month_idx")
    last = F.max("last_idx").over(tier)
    lasting = events.select(
        *KEYS,
        last.alias("last"),
        F.lead("month_idx").over(order).alias("next"),
        *[F.sum(F.coalesce(c, F.lit(0))).over(order).alias(c) for c in running],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in spot],
    ).filter("month_idx <= last")
    until = F.least(F.coalesce(F.col("next") - 1, F.col("last")), F.col("last"))
    filled = lasting.withColumn("m", F.explode(F.sequence(F.col("month_idx"), until)))
    own = F.col("m") == F.col("month_idx")
    return filled.select(
        "tier",
        F.col("m").alias("month_idx"),
        *running,
        *[F.when(own, F.col(c)).otherwise(0).alias(c) for c in spot],
    )


def _starts(terms: DataFrame) -> DataFrame:
    """``(account_number, cxn_code, s, lo, hi)``: the months covered by an account's starts of one month.

    One row per account, segment and starting month, however many contracts. Those that can start
    in the month itself and those from the next one on meet, so together they cover one interval;
    contracts that end before they can start cover nothing.
    """
    lasting = F.col("first") <= F.col("e")
    return terms.groupBy("account_number", "cxn_code", "s").agg(
        F.min(F.when(lasting, F.col("first"))).alias("lo"),
        F.max(F.when(lasting, F.col("e"))).alias("hi"),
    )


def _start_new_difference(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    terms = _terms(contracts, cfg)
    zero = F.lit(0).cast("bigint")

    def event(month, step, part, new):
        return F.struct(
            month.alias("month_idx"), step.alias("step"), part.alias("part"), new.alias("new")
        )

    c = F.col("cents")
    started = event(F.col("s"), zero, zero, c * F.col("new_days"))
    lasting = F.col("first") <= F.col("e")
    events = terms.select(
        "cxn_code",
        "s",
        "e",
        F.inline(
            F.when(
                lasting,
                F.array(
                    started,
                    event(F.col("first"), c, zero, zero),
                    event(F.col("e"), -c, c * F.col("end_days"), zero),
                ),
            ).otherwise(F.array(started))
        ),
    )
    # Combined before the shuffle to segments x months rows; tiers multiply only those.
    amounts = add_tiers(
        events.groupBy("cxn_code", "month_idx").agg(
            F.sum("step").alias("step"),
            F.sum("part").alias("part"),
            F.sum("new").alias("new"),
            F.min("s").alias("first_idx"),
            F.max("e").alias("last_idx"),
        ),
        cfg.tiers,
    ).drop("cxn_code")
    both = amounts.unionByName(_account_events(_starts(terms), cfg), allowMissingColumns=True)
    columns = ["step", "part", "new", "accounts", "new_accounts"]
    per_month = both.groupBy(*KEYS).agg(
        *[F.sum(x).alias(x) for x in columns],
        F.min("first_idx").alias("first_idx"),
        F.max("last_idx").alias("last_idx"),
    )
    months = _fill_months(per_month, ["step", "accounts"], ["part", "new", "new_accounts"])
    days = days_in_month(F.col("month_idx"))
    return months.select(
        *KEYS,
        (F.col("step") * days + F.col("part")).alias("starting_num"),
        F.col("new").alias("new_num"),
        F.col("accounts").alias("starting_count"),
        F.col("new_accounts").alias("new_count"),
    )


def _start_new_explode(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    terms = _terms(contracts, cfg)
    s, e, m, c = F.col("s"), F.col("e"), F.col("month_idx"), F.col("cents")
    months = terms.withColumn("month_idx", F.explode(F.sequence(s, F.greatest(s, e))))
    active = (m >= F.col("first")) & (m <= e)
    days = F.when(m < e, days_in_month(m)).otherwise(F.col("end_days"))
    # Amounts need no account: combined before the shuffle to segments x months rows.
    amounts = add_tiers(
        months.groupBy("cxn_code", "month_idx").agg(
            F.sum(F.when(active, c * days).otherwise(0)).alias("starting_num"),
            F.sum(F.when(m == s, c * F.col("new_days")).otherwise(0)).alias("new_num"),
        ),
        cfg.tiers,
    ).drop("cxn_code")
    counts = _exploded_accounts(_starts(terms), cfg)
    per_month = (
        amounts.unionByName(counts, allowMissingColumns=True)
        .groupBy(*KEYS)
        .agg(*[F.sum(x).alias(x) for x in ("starting_num", "new_num", "starting_count", "new_count")])
    )
    bounds = (
        add_tiers(
            terms.groupBy("cxn_code").agg(
                F.min("s").alias("first_idx"), F.max("e").alias("last_idx")
            ),
            cfg.tiers,
        )
        .groupBy("tier")
        .agg(F.min("first_idx").alias("first_idx"), F.max("last_idx").alias("last_idx"))
    )
    return _spine_of(bounds).select(*KEYS).join(per_month, KEYS, "left")


def _exploded_accounts(starts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month_idx, starting_count, new_count)``: distinct accounts, month by month.

    An account's starts meet in one row, at most one entry per segment and starting month; its months
    are told apart there, so what is as long as the contracts are is added up before it is shuffled.
    """
    accounts = starts.groupBy("account_number").agg(
        F.collect_list(F.struct("cxn_code", "s", "lo", "hi")).alias("spans")
    )
    tiers = F.flatten(F.transform("spans", lambda x: tiers_of(x["cxn_code"], cfg.tiers)))
    rows = accounts.withColumn("tier", F.explode(F.array_distinct(tiers)))
    own = F.filter("spans", lambda x: F.array_contains(tiers_of(x["cxn_code"], cfg.tiers), F.col("tier")))
    lasting = F.filter("own", lambda x: x["lo"] <= x["hi"])
    active = F.array_distinct(F.flatten(F.transform(lasting, lambda x: F.sequence(x["lo"], x["hi"]))))
    new = F.array_distinct(F.transform("own", lambda x: x["s"]))

    def counted(months: Column, starting: int, started: int) -> Column:
        one = [F.lit(starting).cast("bigint").alias("starting_count"), F.lit(started).cast("bigint").alias("new_count")]
        return F.transform(months, lambda x: F.struct(x.alias("month_idx"), *one))

    each = rows.withColumn("own", own).select("tier", F.inline(F.concat(counted(active, 1, 0), counted(new, 0, 1))))
    return each.groupBy(*KEYS).agg(F.sum("starting_count").alias("starting_count"), F.sum("new_count").alias("new_count"))


def start_new_mrr(contracts: DataFrame, cfg: RunConfig, form: str = "difference") -> DataFrame:
    """``(tier, month, starting_mrr, new_mrr, new_count, starting_count)``, every month present.

    Starting: contracts active on the first of the month. New: contracts starting in it.
    """
    forms = {"difference": _start_new_difference, "explode": _start_new_explode}
    sums = forms[form](contracts, cfg)
    scale = (days_in_month(F.col("month_idx")) * 100).cast("double")

    def amount(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("double") / scale

    def number(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    return sums.select(
        "tier",
        month_label(F.col("month_idx")).alias("month"),
        amount("starting_num").alias("starting_mrr"),
        amount("new_num").alias("new_mrr"),
        number("new_count"),
        number("starting_count"),
    )


def active_accounts(contracts: DataFrame, cfg: RunConfig) -> DataFrame:
    """``(tier, month, active_accounts)``: distinct accounts active on any day of the month.

    Months run from the first start to the last dated end; contracts without an end stay active.
    """
    end = month_index(open_as_null(F.col("end_date")))
    forever = F.lit(10**6)
    # the last dated end goes along with the starts, so contracts are read once
    starts = contracts.groupBy(
        "account_number", "cxn_code", month_index(F.col("start_date")).alias("s")
    ).agg(F.max(F.coalesce(end, forever)).alias("hi"), F.max(end).alias("last_idx"))
    events = _account_events(starts.withColumn("lo", F.col("s")), cfg)
    return _fill_months(events, ["accounts"], []).select(
        "tier",
        month_label(F.col("month_idx")).alias("month"),
        F.col("accounts").cast("bigint").alias("active_accounts"),
    )


def align(months: DataFrame, *others: DataFrame) -> DataFrame:
    """Left-join tables with one row per tier and month, in a single shuffle.

    Stacking the tables and grouping once does what a chain of equi-joins on the same keys would.
    """
    keys = ["tier", "month"]
    stacked = months.withColumn("_kept", F.lit(1))
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in (*keys, "_kept")]
    return (
        stacked.groupBy(*keys)
        .agg(F.max("_kept").alias("_kept"), *[F.max(c).alias(c) for c in values])
        .filter("_kept = 1")
        .drop("_kept")
    )


def mrr_waterfall(start_new: DataFrame, *movements: DataFrame) -> DataFrame:
    """Align expansion, contraction and churn with the calendar; derive net and ending figures.

    Every month starts from its own Starting MRR; nothing is carried forward.
    """
    joined = align(start_new, *movements).na.fill(
        0,
        subset=[
            "expansion",
            "expansion_count",
            "contraction",
            "contraction_count",
            "churn",
            "churn_count",
        ],
    )
    net = F.col("new_mrr") + F.col("expansion") - F.col("contraction") - F.col("churn")
    return joined.withColumns(
        {"net_new_mrr": net, "net_count": F.col("new_count") - F.col("churn_count")}
    ).withColumns(
        {
            "ending_mrr": F.col("starting_mrr") + F.col("net_new_mrr"),
            "ending_count": F.col("starting_count") + F.col("net_count"),
        }
    )


def add_month_numbers(monthly: DataFrame) -> DataFrame:
    """Calendar month and position 1..n. Months have no gaps, so the position is a difference."""
    index = label_index(F.col("month"))
    first = F.min(index).over(Window.partitionBy("tier"))
    return monthly.withColumns(
        {
            "month_number": F.substring("month", 6, 2).cast("bigint"),
            "month_sequential": (index - first + 1).cast("bigint"),
        }
    )


def waterfall(contracts: DataFrame, cfg: RunConfig, form: str = "difference") -> DataFrame:
    """The monthly waterfall of every tier, from deduplicated contracts."""
    flow = mrr_waterfall(
        start_new_mrr(contracts, cfg, form),
        price_moves(contracts, cfg),
        churn_revenue(contracts, cfg),
    )
    return add_month_numbers(flow).select("tier", *WATERFALL_COLUMNS)


def arr(monthly: DataFrame) -> DataFrame:
    """``(tier, month, arr)``: twelve times the Ending MRR of the last but one month."""
    latest = Window.partitionBy("tier").orderBy(F.desc("month"))
    return (
        monthly.withColumn("_rn", F.row_number().over(latest))
        .filter("_rn = 2")
        .select("tier", "month", (F.col("ending_mrr") * 12).alias("arr"))
    )
