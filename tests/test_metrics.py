import datetime as dt
import random
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest
from conftest import as_dicts, contract

from waterline.operators import filters, sites, unit_revenue
from waterline.plans.monthly import batch_run, monthly_run, select_tiers
from waterline.schema import MONTHLY_TITLES
from waterline.sources.sites import to_long

SITE_DDL = "site string, release_date date, cxn_code int, base bigint"


def full(df, key, column):
    return {r[key]: r[column] for r in as_dicts(df) if r["tier"] == "Full"}


def test_arpu(contracts, cfg):
    df = filters.add_time_keys(
        contracts(
            contract("A", start="2024-01-06", price="10.00"),
            contract("A", start="2024-01-07", price="5.00"),
            contract("B", start="2024-01-08", price="5.01"),
        )
    )
    by_month = as_dicts(unit_revenue.arpu(df, cfg))
    row = next(r for r in by_month if r["tier"] == "Full")
    assert (row["total_period_activation"], row["unique_accounts"], row["arpu"]) == (20.01, 2, 10.01)
    assert full(unit_revenue.arpu(df, cfg, "week_key"), "week_key", "unique_accounts") == {
        "2023-12-31": 1,
        "2024-01-07": 2,
    }


def test_arpu_of_accounts_in_several_segments(contracts, cfg):
    cfg = replace(cfg, tiers={"one": (1,), "both": (1, 2), "none": (9,)})
    rows = [contract("A", code=1), contract("A", code=2), contract("B", code=2), contract(None, code=1), contract("C", code=None)]
    got = as_dicts(unit_revenue.arpu(filters.add_time_keys(contracts(*rows)), cfg))
    assert {r["tier"]: (r["total_period_activation"], r["unique_accounts"]) for r in got} == {
        "Full": (50.0, 3), "one": (20.0, 1), "both": (40.0, 2),
    }


def test_cumulative_arpu(contracts, cfg):
    rng = random.Random(2)
    rows = [
        contract("hot" if i % 3 == 0 else f"A{rng.randrange(30)}", price=f"{rng.randrange(100, 900) / 100}")
        for i in range(300)
    ]
    df = contracts(*rows).repartition(5)
    sums = defaultdict(float)
    for r in rows:
        sums[r[0]] += float(r[4])
    listed = [r for r in as_dicts(unit_revenue.cumulative_arpu(df, cfg)) if r["tier"] == "Full"]
    assert {r["account_number"]: r["cumulative_arpu"] for r in listed} == pytest.approx(dict(sums))
    amounts = [r["cumulative_arpu"] for r in listed]
    assert amounts == sorted(amounts, reverse=True)
    got = next(r for r in as_dicts(unit_revenue.cumulative_arpu_summary(df, cfg)) if r["tier"] == "Full")
    values = list(sums.values())
    assert got == {
        "tier": "Full",
        "total_customers": len(values),
        "average_cumulative_arpu": pytest.approx(np.mean(values)),
        "total_revenue": pytest.approx(sum(values)),
        "max_customer_value": pytest.approx(max(values)),
        "min_customer_value": pytest.approx(min(values)),
        "median_cumulative_arpu": pytest.approx(np.median(values)),
        "top_10_percent_arpu": pytest.approx(np.quantile(values, 0.9)),
    }


def test_format_columns(spark):
    df = spark.createDataFrame([(1.5, None)], "a double, b double")
    assert tuple(unit_revenue.format_columns(df, ["a", "b", "c"]).first()) == ("$1.50", "N/A")


@pytest.fixture
def site_table(spark):
    rows = [
        ("1", dt.date(2024, 1, 5), 5, 100),
        ("1", dt.date(2024, 1, 5), 7, 10),
        ("2.0", dt.date(2024, 1, 9), 5, 50),
        ("2.0", dt.date(2024, 1, 9), 20, 3),
        ("3", dt.date(2024, 3, 1), 7, 8),
        ("9", dt.date(2024, 1, 1), 5, 1000),
        (None, dt.date(2024, 1, 1), 5, 1),
        ("1", None, 5, 1),
    ]
    return spark.createDataFrame(rows, SITE_DDL)


def test_sites(contracts, cfg, site_table):
    df = contracts(
        contract(site="1", code=5), contract(site="2", code=5), contract(site="3.0", code=7),
        contract(site=None, code=7),
    )
    opens = {(r.tier, r.month): r.site_opens for r in sites.site_opens(df, site_table, cfg).collect()}
    assert opens == {
        ("Full", "2024-01"): 2,
        ("Full", "2024-03"): 1,
        ("high_performers", "2024-01"): 2,
        ("underperformers", "2024-03"): 1,
    }
    base = {(r.tier, r.month): r.base for r in sites.base_added(df, site_table, cfg).collect()}
    assert base == {
        ("Full", "2024-01"): 163,
        ("Full", "2024-03"): 8,
        ("high_performers", "2024-01"): 150,
        ("underperformers", "2024-03"): 8,
    }


def test_bases_by_tier(contracts, cfg, spark):
    cfg = replace(cfg, tiers={"one": (1,), "both": (1, 2), "beyond": (54,)})
    df = contracts(contract(site="1", code=1), contract(site="1", code=54), contract(site="2", code=2))
    rows = [("1", 1, 1.6), ("1", 1, 1.6), ("1", 2, 2.5), ("1", 54, 7.0), ("1", None, 9.0), ("1.0", 2, None), ("2", 2, 4.0)]
    table = spark.createDataFrame([(s, dt.date(2024, 1, 5), *r) for s, *r in rows], SITE_DDL.replace("bigint", "double"))
    assert {r.tier: (r.site_opens, r.base) for r in sites.site_metrics(df, table, cfg).collect()} == {
        "Full": (2, 9), "one": (1, 3), "both": (2, 9), "beyond": (1, 0),
    }
    [row] = sites._released(table.filter("site <> '2'"), cfg).collect()
    # a number per tier, whatever the segments
    assert row.bases == [5, 3, 5, 0]


def test_wide_sites(spark):
    wide = spark.createDataFrame(
        [("1.0", "2024-01-05", "7", None), (None, "2024-01-05", "1", "1"), ("2", "bad", "1", "1")],
        "Site string, Date string, `1` string, `53` string",
    )
    assert sorted(map(tuple, to_long(wide).collect())) == [
        ("1", dt.date(2024, 1, 5), 1, 7),
        ("1", dt.date(2024, 1, 5), 53, 0),
    ]


def test_take_rate(spark):
    df = spark.createDataFrame(
        [("t", "2024-01", 4, None), ("t", "2024-02", 6, 10), ("t", "2024-03", 6, 2)],
        "tier string, month string, ending_count bigint, base bigint",
    )
    rows = sites.add_take_rate(df).orderBy("month").collect()
    assert [(r.base, r.cumulative_base, r.take_rate) for r in rows] == [
        (0, 0, 0.0), (10, 10, 0.6), (2, 12, 0.5),
    ]


def test_tiers_together_equal_each_alone(contracts, cfg, site_table):
    rng = random.Random(4)
    df = contracts(
        *[
            contract(
                f"A{rng.randrange(25)}",
                start=f"2024-{rng.randrange(1, 6):02d}-{rng.randrange(1, 28):02d}",
                end=f"2024-{rng.randrange(7, 13):02d}-05",
                wo=rng.choice(["Activate", "Change of Service"]),
                reason=rng.choice(["Upgrade", "Downgrade"]),
                price=str(rng.randrange(10, 60)),
                code=rng.choice([5, 7, 24]),
                site=rng.choice("123"),
            )
            for _ in range(150)
        ]
    )
    together = monthly_run(df, site_table, cfg)
    assert together.combined.columns == ["tier", *MONTHLY_TITLES.values()]
    rows = sorted(map(str, together.combined.collect()))
    alone = [
        str(r)
        for key in range(4)
        for r in batch_run(df, site_table, cfg, keys=[key, 17]).combined.collect()
    ]
    assert rows == sorted(alone)
    assert {r.tier for r in together.arr.collect()} == set(cfg.tier_names())
    assert together.exclusivity_errors.isEmpty()
    with pytest.raises(ValueError):
        monthly_run(df, site_table, cfg, tiers=["nobody"])


def test_tier_numbers(cfg):
    assert select_tiers(cfg) == ["Full", "high_performers", "moderate_performers", "underperformers"]
    assert select_tiers(cfg, [3, 0, 99]) == ["underperformers", "Full"]
