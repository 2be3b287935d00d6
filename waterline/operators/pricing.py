"""Price-change scenarios: repricing of new contracts and splitting of running ones.

Changes are a list or a table of any length. They are compiled once into an index by package and
price: what a price becomes, as steps over the start date, and the changes that cut a contract, by date.
A contract meets its row of the index in an equi-join (broadcast if that is known to be small) and finds
its place by binary search, so its cost hardly follows the number of changes. Chained cuts and the
impact counters walk the changes of a package.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waterline.functions.calendar import TIME_KEYS
from waterline.schema import PRICE, PRICE_CHANGE_SCHEMA
from waterline.shipping import ship
from waterline.sources.staging import materialise

# A list of at most so many changes, of some 40 bytes each, is broadcast; longer ones, and tables that
# the planner does not know to be small, meet the contracts in a shuffle.
BROADCAST_CHANGES = 50_000

# Successive changes of a table compiled at once, and days of a block: a task holds a number per price and day.
CHUNK_CHANGES = 16_384
BLOCK_DAYS = 128
# Beyond all days, and a missing new price; prices of 18 digits are larger.
LAST_DAY = 1 << 40
NO_PRICE = -(1 << 62)

_TERM = "struct<seq:int,eff:date,old:decimal(18,2),new:decimal(18,2)>"


@dataclass(frozen=True)
class PriceChange:
    package: str
    effective_date: dt.date
    old_price: Decimal
    new_price: Decimal

    @classmethod
    def of(cls, package: str, effective_date, old_price, new_price) -> PriceChange:
        """Validate and convert text, numbers or dates."""
        package = str(package).strip()
        if not package:
            raise ValueError("a price change needs a package")
        if not isinstance(effective_date, dt.date):
            effective_date = dt.datetime.strptime(str(effective_date), "%Y-%m-%d").date()
        old, new = (Decimal(str(p)).quantize(Decimal("0.01")) for p in (old_price, new_price))
        return cls(package, effective_date, old, new)


Changes = Sequence[PriceChange] | DataFrame


def price_changes(terms: Iterable[Sequence]) -> list[PriceChange]:
    """``(package, effective date, old price, new price)`` tuples, in the order they apply."""
    return [PriceChange.of(*t) for t in terms]


def price_change_table(spark: SparkSession, changes: Sequence[PriceChange]) -> DataFrame:
    rows = [
        (i, c.package, c.effective_date, c.old_price, c.new_price)
        for i, c in enumerate(changes, 1)
    ]
    return spark.createDataFrame(rows, PRICE_CHANGE_SCHEMA)


def as_table(spark: SparkSession, changes: Changes) -> DataFrame:
    return changes if isinstance(changes, DataFrame) else price_change_table(spark, changes)


_STEPS = "package_group string, _at decimal(18,2), _starts array<date>, _prices array<decimal(18,2)>"
# The days a price changes on, or a contract is cut on, and what the price becomes then. Two plain arrays: a
# field of an array of structs is copied as a whole wherever one entry of it is looked at.
_CUTS = {"_days": "array<date>", "_becomes": "array<decimal(18,2)>"}


def compile_steps(terms: Iterable[tuple[dt.date, Decimal, Decimal]]) -> dict[Decimal, tuple[list, list]]:
    """What each price becomes, as steps over the start date, for ``(date, old, new)`` in list order.

    From the last change to the first: a change sends contracts at its old price that start on its
    date or later to the steps of its new price; all other steps stay.
    """
    steps: dict[Decimal, tuple[list, list]] = {}
    for eff, old, new in reversed(list(terms)):
        if eff is None or old is None:
            continue
        starts, prices = steps.get(old, ([], []))
        later, becomes = steps.get(new, ([], []))
        before, at = bisect_left(starts, eff), bisect_right(later, eff)
        joined = [*zip(starts[:before], prices[:before], strict=True), (eff, becomes[at - 1] if at else new)]
        joined += zip(later[at:], becomes[at:], strict=True)
        kept, last = [], old
        for start, price in joined:
            if price != last:
                kept.append((start, price))
            last = price
        steps[old] = ([x for x, _ in kept], [x for _, x in kept])
    return {price: found for price, found in steps.items() if found[0]}


class _Block:
    """What prices become on the days of one block, a row of days per price, as later changes leave it."""

    def __init__(self, block: int) -> None:
        self.first, self.rows, self.table = block * BLOCK_DAYS, {}, np.empty((16, BLOCK_DAYS), np.int64)

    def _at(self, prices: np.ndarray) -> np.ndarray:
        known, place = np.unique(prices, return_inverse=True)
        for price in known.tolist():
            if price not in self.rows:
                row = self.rows[price] = len(self.rows)
                if row == len(self.table):
                    self.table = np.concatenate([self.table, np.empty_like(self.table)])
                self.table[row] = price
        return np.array([self.rows[price] for price in known.tolist()])[place]

    def add(self, runs: list[pd.DataFrame]) -> None:
        """Put a chunk of changes before those that are in: its prices go to what their new prices become."""
        chunk = pd.concat(runs)
        low = np.clip(chunk["low"].to_numpy() - self.first, 0, BLOCK_DAYS)
        size = np.clip(chunk["until"].to_numpy() - self.first, 0, BLOCK_DAYS) - low
        both = self._at(np.concatenate([chunk["old"].to_numpy(), chunk["new"].to_numpy()]))
        days = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - low, size)
        old, new = (np.repeat(rows, size) for rows in np.split(both, 2))
        self.table[old, days] = self.table[new, days]

    def steps(self, package: str) -> pd.DataFrame:
        table = self.table[: len(self.rows)]
        changed = np.ones(table.shape, dtype=bool)
        changed[:, 1:] = table[:, 1:] != table[:, :-1]
        row, day = np.nonzero(changed)
        prices = np.fromiter(self.rows, np.int64, len(self.rows))
        return pd.DataFrame({"package_group": package, "old": prices[row], "low": self.first + day, "new": table[row, day]})


def _compile_chunks(size: int):
    """The steps of every ``size`` successive changes of a package, as intervals of days."""

    def compiled(package: str, number: int, held: list[tuple]) -> pd.DataFrame:
        rows = [
            (package, number, old, low, until, new)
            for old, (starts, prices) in compile_steps(held).items()
            for low, until, new in zip(starts, [*starts[1:], LAST_DAY], prices, strict=True)
        ]
        return pd.DataFrame(rows, columns=["package_group", "chunk", "old", "low", "until", "new"])

    def chunks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, package, held = TaskContext.get().partitionId() << 32, None, []
        for batch in batches:
            for name, rows in batch.groupby("package_group", sort=False):
                terms = list(zip(*(rows[c].tolist() for c in ("day", "old", "new")), strict=True))
                while terms:
                    if held and (name != package or len(held) >= size):
                        yield compiled(package, number, held)
                        number, held = number + 1, []
                    package, room = name, size - len(held)
                    held, terms = held + terms[:room], terms[room:]
        if held:
            yield compiled(package, number, held)

    return chunks


def _fold_chunks(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Steps of each package and block of days, from its chunks, the last one first."""
    key, chunk, held, block = None, None, [], None
    for batch in batches:
        for (package, number, part), rows in batch.groupby(["package_group", "block", "chunk"], sort=False):
            if held and ((package, number) != key or part != chunk):
                block.add(held)
                held = []
            if (package, number) != key:
                if block is not None:
                    yield block.steps(key[0])
                key, block = (package, number), _Block(number)
            chunk = part
            held.append(rows)
    if block is not None:
        block.add(held)
        yield block.steps(key[0])


def _table_steps(changes: DataFrame) -> DataFrame:
    """The steps of a table of changes, of which a package may have any number.

    Successive changes are compiled chunk by chunk. What a chunk makes of a price on a day is then put
    before what the later chunks make of it, separately for every block of days. A task holds a chunk, or a
    package's prices on the days of a block.
    """
    ship(changes.sparkSession)
    cents = [F.coalesce((F.col(c) * 100).cast("bigint"), F.lit(NO_PRICE)).alias(c) for c in ("old", "new")]
    terms = _named(changes).filter("eff is not null and old is not null").select("package_group", "seq", F.unix_date("eff").cast("bigint").alias("day"), *cents)
    last = F.when(F.col("new") == NO_PRICE, 1).otherwise(0)
    order = ["package_group", F.col("seq").asc_nulls_last(), "day", "old", last, "new"]
    listed = terms.repartitionByRange(*order).sortWithinPartitions(*order).drop("seq")
    chunks = listed.mapInPandas(_compile_chunks(CHUNK_CHANGES), "package_group string, chunk long, old long, low long, until long, new long")
    blocks = terms.groupBy("package_group").agg(F.collect_set(F.floor(F.col("day") / BLOCK_DAYS)).alias("blocks"))
    inside = F.filter("blocks", lambda b: (b >= F.floor(F.col("low") / BLOCK_DAYS)) & (b * BLOCK_DAYS < F.col("until")))
    dealt = chunks.join(blocks, "package_group").withColumn("block", F.explode(inside)).drop("blocks")
    dealt = dealt.repartition("package_group", "block").sortWithinPartitions("package_group", "block", F.desc("chunk"))
    steps = dealt.mapInPandas(_fold_chunks, "package_group string, old long, low long, new long")
    before = F.lag("new").over(Window.partitionBy("package_group", "old").orderBy("low"))
    kept = steps.withColumn("before", F.coalesce(before, "old")).filter("new != before")
    ordered = kept.groupBy("package_group", "old").agg(F.array_sort(F.collect_list(F.struct("low", "new"))).alias("steps"))

    def price(value: Column) -> Column:
        return F.when(value != NO_PRICE, (value.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(PRICE))

    return ordered.select(
        "package_group",
        price(F.col("old")).alias("_at"),
        F.transform("steps", lambda x: F.date_from_unix_date(x["low"].cast("int"))).alias("_starts"),
        F.transform("steps", lambda x: price(x["new"])).alias("_prices"),
    )


def _steps(spark: SparkSession, changes: Changes) -> DataFrame:
    if isinstance(changes, DataFrame):
        # written once: the planner then knows whether it is small
        return materialise(_table_steps(changes), "price-steps")
    packages: dict[str, list[tuple]] = {}
    for c in changes:
        packages.setdefault(c.package, []).append((c.effective_date, c.old_price, c.new_price))
    rows = [(name, price, *found) for name, terms in packages.items() for price, found in compile_steps(terms).items()]
    return _small(spark.createDataFrame(rows, _STEPS), sum(len(r[2]) for r in rows))


def _cut_lists(spark: SparkSession, changes: Changes) -> DataFrame:
    """``(package_group, _at, _days, _becomes)``: the changes of a price by date, the last of a day only."""
    if isinstance(changes, DataFrame):
        last = F.max_by("new", F.struct("seq", "new")).alias("new")
        days = _named(changes).filter("eff is not null and old is not null").groupBy("package_group", F.col("old").alias("_at"), "eff").agg(last)
        lists = days.groupBy("package_group", "_at").agg(F.array_sort(F.collect_list(F.struct("eff", "new"))).alias("_changes"))
        plain = lists.select("package_group", "_at", F.col("_changes.eff").alias("_days"), F.col("_changes.new").alias("_becomes"))
        return materialise(plain, "price-cuts")
    lists: dict[tuple, dict] = {}
    for c in changes:
        lists.setdefault((c.package, c.old_price), {})[c.effective_date] = c.new_price
    rows = [(*key, *map(list, zip(*sorted(days.items()), strict=True))) for key, days in lists.items()]
    schema = ", ".join(["package_group string", "_at decimal(18,2)", *[f"{name} {kind}" for name, kind in _CUTS.items()]])
    return _small(spark.createDataFrame(rows, schema), sum(len(r[2]) for r in rows))


def _small(index: DataFrame, entries: int) -> DataFrame:
    return F.broadcast(index) if entries <= BROADCAST_CHANGES else index


def _named(changes: DataFrame) -> DataFrame:
    """``(package_group, seq, eff, old, new)`` of a table of changes."""
    return changes.filter(F.col("package").isNotNull()).select(
        F.trim("package").alias("package_group"),
        F.col("seq").cast("int").alias("seq"),
        F.col("effective_date").cast("date").alias("eff"),
        F.col("old_price").cast(PRICE).alias("old"),
        F.col("new_price").cast(PRICE).alias("new"),
    )


def _none(changes: Changes) -> bool:
    return not isinstance(changes, DataFrame) and not changes


def _looked_up(contracts: DataFrame, index: DataFrame) -> DataFrame:
    """Contracts with the index columns of their package and price, null without any."""
    own = contracts.withColumn("_own", F.col("price").cast(PRICE))
    found = index.withColumnRenamed("package_group", "_package")
    joined = own.join(found, (F.col("package_group") == F.col("_package")) & (F.col("_own") == F.col("_at")), "left")
    return joined.drop("_package", "_at", "_own")


def _count_until(sorted_dates: Column, value: Column, inclusive: bool) -> Column:
    """How many of the sorted dates are at most (or below) the value, by binary search."""
    size = F.size(sorted_dates)

    def narrowed(acc: Column, _: Column) -> Column:
        middle = F.floor((acc.low + acc.high) / 2).cast("int")
        there = F.get(sorted_dates, middle)
        below = there <= value if inclusive else there < value
        halved = F.when(below, F.struct((middle + 1).alias("low"), acc.high.alias("high"))).otherwise(
            F.struct(acc.low.alias("low"), middle.alias("high"))
        )
        return F.when(acc.low < acc.high, halved).otherwise(acc)

    steps = F.sequence(F.lit(0), F.floor(F.log2(size)).cast("int"))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), narrowed, lambda acc: acc.low)
    return F.when((size > 0) & value.isNotNull(), found).otherwise(0)


def _at_new_price(contracts: DataFrame, changes: Changes) -> DataFrame:
    if _none(changes):
        return contracts.withColumn("price", F.col("price").cast(PRICE))
    held = _looked_up(contracts, _steps(contracts.sparkSession, changes))
    place = _count_until(F.col("_starts"), F.col("start_date"), True)
    found = F.get(F.col("_prices"), place - 1)
    return held.withColumn("price", F.coalesce(F.when(place > 0, found), F.col("price").cast(PRICE))).drop("_starts", "_prices")


def _with_cuts(contracts: DataFrame, changes: Changes, split_open: str, chain: bool) -> DataFrame:
    """Contracts plus ``_days`` and ``_becomes``: when changes cut them, one a day, and the price from then on."""
    none = {name: F.array().cast(kind) for name, kind in _CUTS.items()}
    if _none(changes):
        return contracts.withColumns(none)
    if chain:
        held = _with_terms(contracts, changes).withColumn("_hits", _chained(split_open))
        cuts = held.withColumn("_cuts", _one_per_day(F.col("_hits")))
        return cuts.withColumns({"_days": F.transform("_cuts", lambda t: t.eff), "_becomes": F.transform("_cuts", lambda t: t.new)}).drop("_hits", "_cuts", "_terms")
    held = _looked_up(contracts, _cut_lists(contracts.sparkSession, changes))
    first = _count_until(F.col("_days"), F.col("start_date"), True)
    past = _count_until(F.col("_days"), F.col("end_date"), False)
    if split_open == "open":
        past = F.when(F.col("end_date").isNull(), F.size("_days")).otherwise(past)
    held = held.withColumns({"_first": first, "_past": past})
    inside = F.col("start_date").isNotNull() & (F.size("_days") > 0) & (F.col("_past") > F.col("_first"))
    own = {c: F.when(inside, F.slice(c, F.col("_first") + 1, F.col("_past") - F.col("_first"))) for c in _CUTS}
    return held.withColumns({c: F.coalesce(column, none[c]) for c, column in own.items()}).drop("_first", "_past")


def _per_package(spark: SparkSession, changes: Changes) -> DataFrame:
    """``(package_group, _terms)``: the changes of a package in list order."""
    if isinstance(changes, DataFrame):
        term = F.struct("seq", "eff", "old", "new")
        return _named(changes).groupBy("package_group").agg(F.array_sort(F.collect_list(term)).alias("_terms"))
    packages: dict[str, list[tuple]] = {}
    for seq, c in enumerate(changes, 1):
        packages.setdefault(c.package, []).append((seq, c.effective_date, c.old_price, c.new_price))
    table = spark.createDataFrame(list(packages.items()), f"package_group string, _terms array<{_TERM}>")
    return F.broadcast(table) if len(changes) <= BROADCAST_CHANGES else table


def _with_terms(contracts: DataFrame, changes: Changes) -> DataFrame:
    """Contracts plus ``_terms``, the changes of their package in list order; none is an empty array."""
    none = F.array().cast(f"array<{_TERM}>")
    if not isinstance(changes, DataFrame) and not changes:
        return contracts.withColumn("_terms", none)
    joined = contracts.join(_per_package(contracts.sparkSession, changes), "package_group", "left")
    return joined.select(*[contracts[c] for c in contracts.columns], F.coalesce("_terms", none).alias("_terms"))


def _by_date() -> Column:
    """``_terms`` by date, those of a day in list order."""
    dated = F.transform("_terms", lambda t: F.struct(t.eff.alias("eff"), t.seq.alias("seq"), t.old.alias("old"), t.new.alias("new")))
    return F.transform(F.array_sort(dated), lambda t: F.struct(t.seq.alias("seq"), t.eff.alias("eff"), t.old.alias("old"), t.new.alias("new")))


def apply_price_changes(contracts: DataFrame, changes: Changes) -> DataFrame:
    """Reprice contracts that start on or after a change's date at its old price.

    Changes apply one after the other in list order, so a later one sees the earlier one's price.
    """
    return _at_new_price(contracts, changes).select(*contracts.columns)


def _inside(eff: Column, split_open: str) -> Column:
    start, end = F.col("start_date"), F.col("end_date")
    before_end = eff < end
    if split_open == "open":
        before_end = end.isNull() | before_end
    return F.coalesce((start < eff) & before_end, F.lit(False))


def _chained(split_open: str) -> Column:
    """The changes that cut a contract in date order, each seeing the price of the one before."""
    start = F.struct(
        F.col("price").cast(PRICE).alias("now"),
        F.array().cast(f"array<{_TERM}>").alias("hits"),
    )
    return F.aggregate(
        _by_date(),
        start,
        lambda acc, t: F.when(
            (t.old == acc.now) & _inside(t.eff, split_open),
            F.struct(t.new.alias("now"), F.concat(acc.hits, F.array(t)).alias("hits")),
        ).otherwise(acc),
        lambda acc: acc.hits,
    )


def _cuts(split_open: str, chain: bool) -> Column:
    """All changes that cut a contract, in date order, several a day too."""
    if chain:
        return _chained(split_open)
    return F.filter(_by_date(), lambda t: (t.old == F.col("price")) & _inside(t.eff, split_open))


def _one_per_day(hits: Column) -> Column:
    def last_of_day(term: Column, i: Column) -> Column:
        following = F.get(hits, i + 1)
        return following.isNull() | (following.eff != term.eff)

    return F.filter(hits, last_of_day)


def split_contracts(
    contracts: DataFrame,
    changes: Changes,
    split_open: str = "never",
    chain: bool = False,
    rekey: bool = False,
) -> DataFrame:
    """Cut contracts at price changes strictly inside them, one row per price period.

    Without ``chain`` only changes of the contract's original price count. All other columns, time
    keys included, are copied to every period unless ``rekey``.
    """
    return _split(_with_cuts(contracts, changes, split_open, chain), contracts.columns, rekey)


def _split(cut: DataFrame, columns: Sequence[str], rekey: bool) -> DataFrame:
    number = F.col("_period")
    periods = cut.withColumn("_period", F.explode(F.sequence(F.lit(0), F.size("_days"))))
    values = {
        "start_date": F.when(number == 0, F.col("start_date")).otherwise(F.get("_days", number - 1)),
        "end_date": F.when(number == F.size("_days"), F.col("end_date")).otherwise(F.date_sub(F.get("_days", number), 1)),
        "price": F.when(number == 0, F.col("price").cast(PRICE)).otherwise(F.get("_becomes", number - 1)),
    }
    out = periods.select(*[values[c].alias(c) if c in values else F.col(c) for c in columns])
    if rekey:
        out = out.withColumns(
            {k: key(F.col("start_date")) for k, key in TIME_KEYS.items() if k in out.columns}
        )
    return out


def reprice(
    contracts: DataFrame,
    changes: Changes,
    split_open: str = "never",
    chain: bool = False,
    rekey: bool = False,
) -> DataFrame:
    """New contracts first, then the running ones."""
    held = _with_cuts(_at_new_price(contracts, changes), changes, split_open, chain)
    return _split(held, contracts.columns, rekey)


_COUNTERS = ("package_matches", "date_matches", "price_matches", "contracts_repriced", "contracts_cut")


def _event(kind: str, key: Column, at: Column, delta: int) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), key.cast("string").alias("key"), at.cast("long").alias("at"), F.lit(delta).cast("long").alias("delta")
    )


def _events(held: DataFrame, split_open: str, chain: bool) -> DataFrame:
    """``(kind, key, at, delta)``, summed: what each contract adds to the counters of changes.

    A counter of a change is the sum of its kind and key up to its place. Starts count backwards, so
    a date's place follows all later starts. A price is held from the change that sets it to the one
    that replaces it; a change still sees the price it replaces.
    """
    walked = F.aggregate(
        F.col("_terms"),
        F.struct(F.col("price").cast(PRICE).alias("now"), F.array().cast(f"array<{_TERM}>").alias("hits")),
        lambda acc, t: F.when(
            (F.col("start_date") >= t.eff) & (acc.now == t.old),
            F.struct(t.new.alias("now"), F.concat(acc.hits, F.array(t)).alias("hits")),
        ).otherwise(acc),
    )
    rows = held.withColumn("_walked", walked)
    hits = F.col("_walked.hits")
    first = F.array(
        _event("package_matches", F.col("package_group"), F.lit(0), 1),
        _event("date_matches", F.lit(""), -F.unix_date("start_date"), 1),
        _event("price_matches", F.col("price").cast(PRICE), F.lit(0), 1),
    )
    known = F.filter(first, lambda e: e.key.isNotNull() & e["at"].isNotNull())
    replaced = F.transform(hits, lambda t: _event("price_matches", t.old, t.seq + 1, -1))
    taken = F.transform(hits, lambda t: _event("price_matches", t.new, t.seq + 1, 1))
    repriced = F.transform(hits, lambda t: _event("contracts_repriced", t.seq, F.lit(0), 1))
    # cuts are looked for in the price the contract ends with
    rows = rows.select("_terms", "start_date", "end_date", F.col("_walked.now").alias("price"), F.concat(known, replaced, taken, repriced).alias("_events"))
    cut = F.transform(_cuts(split_open, chain), lambda t: _event("contracts_cut", t.seq, F.lit(0), 1))
    each = rows.select(F.inline(F.concat("_events", cut)))
    return each.groupBy("kind", "key", "at").agg(F.sum("delta").alias("delta"))


def price_change_impact(
    contracts: DataFrame,
    changes: Changes,
    split_open: str = "never",
    chain: bool = False,
) -> DataFrame:
    """Per change: rows matching its package, date and price, rows repriced and contracts cut.

    Prices are matched against the state the preceding changes leave. Contracts are read once,
    however many changes there are; their events are summed before they meet the changes.
    """
    table = as_table(contracts.sparkSession, changes)
    asked = F.array(
        _event("package_matches", F.trim("package"), F.lit(0), 0),
        _event("date_matches", F.lit(""), -F.unix_date(F.col("effective_date").cast("date")), 0),
        _event("price_matches", F.col("old_price").cast(PRICE), F.col("seq"), 0),
        _event("contracts_repriced", F.col("seq"), F.lit(0), 0),
        _event("contracts_cut", F.col("seq"), F.lit(0), 0),
    )
    places = table.select("seq", F.inline(asked))
    events = _events(_with_terms(contracts, changes), split_open, chain)
    both = events.withColumn("seq", F.lit(None).cast("int")).unionByName(places)
    # at most one row per distinct start, price state or change
    upto = Window.partitionBy("kind", "key").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = both.withColumn("n", F.sum("delta").over(upto)).filter(F.col("seq").isNotNull())
    counts = sums.groupBy("seq").agg(*[F.max(F.when(F.col("kind") == c, F.col("n"))).alias(c) for c in _COUNTERS])
    return table.join(counts, "seq")


def split_summary(
    contracts: DataFrame,
    changes: Changes,
    split_open: str = "never",
    chain: bool = False,
) -> DataFrame:
    """One row: contracts cut, periods made of them, and rows after splitting."""
    held = _with_cuts(_at_new_price(contracts, changes), changes, split_open, chain)
    return held.select((F.size("_days") + 1).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("contracts_cut"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("periods_created"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("contracts_after"),
    )
