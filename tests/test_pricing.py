import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import contract
from pyspark.sql import functions as F

from waterline.operators import filters, pricing
from waterline.operators.pricing import price_changes


def periods(df):
    return sorted(
        (r.account_number, str(r.start_date), str(r.end_date), str(r.price)) for r in df.collect()
    )


ONE = price_changes([("P", "2024-07-01", 50, 55)])


def test_validation():
    for bad in [("", "2024-01-01", 1, 2), ("P", "01/02/2024", 1, 2), ("P", "2024-01-01", "x", 2)]:
        with pytest.raises(Exception):
            price_changes([bad])
    assert ONE[0].new_price == Decimal("55.00")


def test_new_contracts_chain_in_list_order(contracts):
    df = contracts(
        contract("both", start="2024-08-01", price="50"),
        contract("first", start="2024-07-10", price="50"),
        contract("on the day", start="2024-07-01", price="50"),
        contract("early", start="2024-06-30", price="50"),
        contract("other price", start="2024-08-01", price="51"),
        contract("other package", package="Q", start="2024-08-01", price="50"),
    )
    forward = price_changes([("P", "2024-07-01", 50, 55), ("P", "2024-08-01", 55, 60)])
    got = {r.account_number: int(r.price) for r in pricing.apply_price_changes(df, forward).collect()}
    assert got == {
        "both": 60, "first": 55, "on the day": 55, "early": 50, "other price": 51,
        "other package": 50,
    }
    # the other way round the second change never sees a 55
    got = {r.account_number: int(r.price) for r in pricing.apply_price_changes(df, forward[::-1]).collect()}
    assert got["both"] == 55
    assert periods(pricing.apply_price_changes(df, [])) == periods(df)


def test_split(contracts):
    df = contracts(
        contract("cut", start="2024-06-01", end="2024-08-01", price="50"),
        contract("starts on it", start="2024-07-01", end="2024-08-01", price="50"),
        contract("ends on it", start="2024-06-01", end="2024-07-01", price="50"),
        contract("open", start="2024-06-01", price="50"),
    )
    keep = [
        ("ends on it", "2024-06-01", "2024-07-01", "50.00"),
        ("starts on it", "2024-07-01", "2024-08-01", "50.00"),
    ]
    cut = [
        ("cut", "2024-06-01", "2024-06-30", "50.00"),
        ("cut", "2024-07-01", "2024-08-01", "55.00"),
    ]
    never = [("open", "2024-06-01", "None", "50.00")]
    infinite = [
        ("open", "2024-06-01", "2024-06-30", "50.00"),
        ("open", "2024-07-01", "None", "55.00"),
    ]
    assert periods(pricing.split_contracts(df, ONE)) == sorted(cut + keep + never)
    assert periods(pricing.split_contracts(df, ONE, "open")) == sorted(cut + keep + infinite)
    assert periods(pricing.split_contracts(df, [])) == periods(df)


def test_split_several_changes(contracts):
    df = contracts(contract("A", start="2024-06-01", end="2024-09-01", price="50"))
    rising = price_changes([("P", "2024-07-15", 55, 60), ("P", "2024-07-01", 50, 55)])
    plain = [("A", "2024-06-01", "2024-06-30", "50.00"), ("A", "2024-07-01", "2024-09-01", "55.00")]
    assert periods(pricing.split_contracts(df, rising)) == plain
    assert periods(pricing.split_contracts(df, rising, chain=True)) == [
        ("A", "2024-06-01", "2024-06-30", "50.00"),
        ("A", "2024-07-01", "2024-07-14", "55.00"),
        ("A", "2024-07-15", "2024-09-01", "60.00"),
    ]
    # several changes of the original price all cut; on one day the last in the list counts
    same = price_changes(
        [("P", "2024-08-01", 50, 70), ("P", "2024-07-01", 50, 55), ("P", "2024-07-01", 50, 56)]
    )
    assert periods(pricing.split_contracts(df, same)) == [
        ("A", "2024-06-01", "2024-06-30", "50.00"),
        ("A", "2024-07-01", "2024-07-31", "56.00"),
        ("A", "2024-08-01", "2024-09-01", "70.00"),
    ]
    day = price_changes([("P", "2024-07-01", 50, 55), ("P", "2024-07-01", 55, 60)])
    assert periods(pricing.split_contracts(df, day, chain=True)) == [
        ("A", "2024-06-01", "2024-06-30", "50.00"),
        ("A", "2024-07-01", "2024-09-01", "60.00"),
    ]


def test_split_keeps_days_and_keys(contracts):
    df = filters.add_time_keys(
        contracts(
            *[
                contract(f"A{i}", start=f"2024-{i % 9 + 1:02d}-{i + 1:02d}", end="2024-12-24", price="50")
                for i in range(20)
            ]
        )
    )
    changes = price_changes([("P", f"2024-{m:02d}-10", 50, 50 + m) for m in (3, 5, 8)])
    out = pricing.split_contracts(df, changes)
    days = F.sum(F.datediff("end_date", "start_date") + 1)
    assert out.agg(days).first()[0] == df.agg(days).first()[0]
    assert out.columns == df.columns and out.count() > df.count()
    starts = {(r.account_number, r.month_key) for r in df.collect()}
    assert {(r.account_number, r.month_key) for r in out.collect()} == starts
    rekeyed = pricing.split_contracts(df, changes, rekey=True)
    assert all(r.month_key == str(r.start_date)[:7] for r in rekeyed.collect())


def test_impact(contracts):
    df = contracts(
        contract("new", start="2024-07-02", price="50"),
        contract("cut", start="2024-06-01", end="2024-08-01", price="50"),
        contract("other", package="Q", start="2024-08-01", price="50"),
    )
    row = pricing.price_change_impact(df, ONE).first()
    assert (row.package_matches, row.date_matches, row.price_matches) == (2, 2, 3)
    assert (row.contracts_repriced, row.contracts_cut) == (1, 1)
    assert tuple(pricing.split_summary(df, ONE).first()) == (1, 2, 4)
    assert pricing.price_change_impact(df, []).count() == 0


def test_changes_from_a_table(contracts, spark):
    listed = price_changes([("P", "2024-03-10", 50, 55), ("P", "2024-05-10", 55, 60), ("Q", "2024-04-01", 50, 51)])
    table = pricing.price_change_table(spark, listed)
    df = contracts(*[contract(f"A{i}", package="PQR"[i % 3], start=f"2024-{i % 9 + 1:02d}-05", end="2024-12-24", price="50") for i in range(30)])
    for operator in (pricing.apply_price_changes, pricing.split_contracts, pricing.reprice, pricing.price_change_impact, pricing.split_summary):
        assert sorted(map(tuple, operator(df, table).collect()), key=str) == sorted(map(tuple, operator(df, listed).collect()), key=str)


def test_impact_of_many_changes(contracts):
    """Any number of changes, against the rule spelled out row by row."""
    rng = random.Random(5)
    terms = [(rng.choice("PQ"), f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", rng.randint(1, 6), rng.randint(1, 6)) for _ in range(60)]
    starts = [(rng.choice("PQR"), f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", rng.randint(1, 6)) for _ in range(80)]
    df = contracts(*[contract(f"A{i}", package=p, start=s, end="2024-12-31", price=str(v)) for i, (p, s, v) in enumerate(starts)])
    state = [v for _, _, v in starts]
    expected = []
    for package, day, old, new in terms:
        hits = [[p == package, s >= day, now == old] for (p, s, _), now in zip(starts, state, strict=True)]
        expected.append((*(sum(column) for column in zip(*hits, strict=True)), sum(map(all, hits))))
        state = [new if all(h) else now for h, now in zip(hits, state, strict=True)]
    got = pricing.price_change_impact(df, price_changes(terms)).orderBy("seq").collect()
    assert [(r.package_matches, r.date_matches, r.price_matches, r.contracts_repriced) for r in got] == expected
    cut = [sum(p == package and s < day < "2024-12-31" and now == old for (p, s, _), now in zip(starts, state, strict=True)) for package, day, old, _ in terms]
    assert [r.contracts_cut for r in got] == cut


def test_twenty_thousand_changes(contracts, spark):
    long = price_changes([(f"P{i % 4000}", f"20{i // 4000 + 10}-01-01", i // 4000, i // 4000 + 1) for i in range(20_000)])
    df = contracts(*[contract(f"A{i}", package=f"P{i}", start="2024-01-01", price="0") for i in range(5)])
    for changes in (long, pricing.price_change_table(spark, long)):
        assert {int(r.price) for r in pricing.apply_price_changes(df, changes).collect()} == {5}
    assert pricing.price_change_impact(df, long).agg(F.sum("contracts_repriced")).first()[0] == 25


def walked(terms, price, start):
    for eff, old, new in terms:
        if start is not None and start >= eff and price == old:
            price = new
    return price


def cut(terms, price, start, end, split_open):
    """Periods of a contract by going through all changes."""
    days = {}
    for eff, old, new in terms:
        open_end = end is None and split_open == "open"
        if old == price and start is not None and start < eff and (open_end or (end is not None and eff < end)):
            days[eff] = new
    edges = [(start, price), *sorted(days.items())]
    ends = [e - dt.timedelta(1) for e, _ in edges[1:]] + [end]
    return [(s, e, p) for (s, p), e in zip(edges, ends, strict=True)]


@pytest.mark.parametrize("split_open", ["never", "open"])
def test_index_against_all_changes(contracts, spark, split_open):
    """Hundreds of changes of a package among few prices and dates, as a list and as a table."""
    draw = random.Random(7)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(draw.randrange(60))
    listed = price_changes([(draw.choice("PQ"), day(), draw.randrange(6), draw.randrange(6)) for _ in range(300)])
    terms = {p: [(c.effective_date, c.old_price, c.new_price) for c in listed if c.package == p] for p in "PQ"}
    rows = []
    for i in range(120):
        start = day()
        end = None if i % 5 == 0 else start + dt.timedelta(draw.randrange(40))
        rows.append(contract(f"A{i}", package=draw.choice("PQR"), start=str(start), end=end and str(end), price=str(draw.randrange(8))))
    rows.append((*contract("A999")[:2], None, *contract("A999")[3:]))
    df = contracts(*rows)
    new = {r[0]: walked(terms.get(r[1], []), Decimal(r[4]), r[2]) for r in rows}
    want = sorted((r[0], *map(str, p)) for r in rows for p in cut(terms.get(r[1], []), new[r[0]], r[2], r[3], split_open))
    for changes in (listed, pricing.price_change_table(spark, listed)):
        assert {r.account_number: r.price for r in pricing.apply_price_changes(df, changes).collect()} == new
        got = pricing.reprice(df, changes, split_open).collect()
        assert sorted((r.account_number, str(r.start_date), str(r.end_date), str(Decimal(r.price).normalize() + 0 if r.price % 1 else int(r.price))) for r in got) == sorted(
            (a, s, e, str(int(Decimal(p)))) for a, s, e, p in want
        )
        total = pricing.split_summary(df, changes, split_open).first()
        assert total.contracts_after == len(want)


def test_steps_are_as_short_as_they_can_be():
    terms = [(dt.date(2024, 1, 1) + dt.timedelta(i), Decimal(1), Decimal(2)) for i in range(4000)]
    assert pricing.compile_steps(terms) == {Decimal(1): ([dt.date(2024, 1, 1)], [Decimal(2)])}
    there_and_back = [(dt.date(2024, 1, 1), Decimal(1), Decimal(2)), (dt.date(2024, 1, 1), Decimal(2), Decimal(1))]
    assert Decimal(1) not in pricing.compile_steps(there_and_back)


def test_a_long_table_is_compiled_in_chunks(spark, monkeypatch):
    """No task holds a package's changes; chunks and blocks of days give the steps of the whole list."""
    monkeypatch.setattr(pricing, "CHUNK_CHANGES", 7)
    rng = random.Random(3)
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(900)) for _ in range(40)]
    prices = [Decimal(n) / 100 for n in range(1000, 1012)] + [None]
    rows = [
        (rng.choice([i, i // 2]), rng.choice(["P", " Q "]), rng.choice([*days, None]), rng.choice(prices), rng.choice(prices))
        for i in range(300)
    ]
    table = spark.createDataFrame(rows, "seq int, package string, effective_date date, old_price decimal(18,2), new_price decimal(18,2)")
    got = {(r[0], r[1]): (r[2], r[3]) for r in pricing._steps(spark, table).collect()}
    expected = {}
    for package in "PQ":
        own = [(seq, eff, old, new is None, new or 0, new) for seq, name, eff, old, new in rows if name.strip() == package and eff and old]
        steps = pricing.compile_steps([(eff, old, new) for _, eff, old, _, _, new in sorted(own)])
        expected |= {(package, price): found for price, found in steps.items()}
    assert got == expected
    plan = pricing._table_steps(table)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInPandas" in plan
