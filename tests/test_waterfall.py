import calendar
import datetime as dt
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from conftest import as_dicts, contract
from pyspark.sql import functions as F

from waterline.config import TIER_SEGMENTS
from waterline.operators import filters, movements, waterfall

FORMS = ["difference", "explode"]


def keyed(df):
    return filters.add_time_keys(df).withColumns(
        {"churn_flag": F.lit(0), "churn_date": F.lit(None).cast("date")}
    )


def full(df, column):
    return {r["month"]: r[column] for r in as_dicts(df) if r["tier"] == "Full"}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    "start, end, price, month, starting, new",
    [
        ("2024-01-01", None, "31.00", "2024-01", 31.0, 31.0),
        ("2024-01-16", "2024-03-10", "31.00", "2024-01", 0.0, 16.0),
        ("2024-01-16", "2024-03-10", "31.00", "2024-03", 10.0, 0.0),
        ("2024-02-10", "2024-02-20", "29.00", "2024-02", 0.0, 11.0),
        ("2024-01-05", None, "30.00", "2024-06", 15.0, 0.0),
    ],
)
def test_proration(contracts, cfg, form, start, end, price, month, starting, new):
    df = contracts(contract(start=start, end=end, price=price))
    out = waterfall.start_new_mrr(df, cfg, form)
    assert full(out, "starting_mrr")[month] == starting
    assert full(out, "new_mrr")[month] == new


@pytest.mark.parametrize("form", FORMS)
def test_start_after_the_analysis_date(contracts, cfg, form):
    late = contract("late", start="2024-08-01", price="50.00")
    assert "2024-08" not in full(
        waterfall.start_new_mrr(contracts(late, contract()), cfg, form), "new_count"
    )
    longer = contracts(late, contract(end="2024-10-05"))
    out = waterfall.start_new_mrr(longer, cfg, form)
    assert full(out, "new_count")["2024-08"] == 1 and full(out, "new_mrr")["2024-08"] == 0.0
    assert full(out, "starting_count")["2024-08"] == 1
    assert waterfall.start_new_mrr(contracts(late), cfg, form).count() == 0


@pytest.mark.parametrize("form", FORMS)
def test_only_contracts_that_last_cover_months(contracts, cfg, form):
    rows = [
        # starts on the first after the analysis date, open: never active
        contract("A", start="2024-08-01"),
        # same account and month, active from the month after
        contract("A", package="Q", start="2024-08-09", end="2024-10-05"),
        contract("A", start="2024-01-10", end="2024-02-10"),
    ]
    out = waterfall.start_new_mrr(contracts(*rows), cfg, form)
    counts = full(out, "starting_count")
    assert counts == {m: v[3] for m, v in brute_force(rows, cfg.as_of).items()}
    assert (counts["2024-02"], counts["2024-08"], counts["2024-09"]) == (1, 0, 1)


def random_rows(seed, n=300, hot=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = "hot" if hot and i % 3 == 0 else f"A{rng.randrange(40)}"
        start = dt.date(2022, 1, 1) + dt.timedelta(days=rng.randrange(1000))
        if rng.random() < 0.2:
            start = start.replace(day=1)
        end = None if rng.random() < 0.2 else start + dt.timedelta(days=rng.randrange(500))
        rows.append(
            contract(
                account,
                rng.choice("PQ"),
                str(start),
                None if end is None else str(end),
                f"{rng.randrange(1000, 9000) / 100:.2f}",
                rng.choice(["Activate", "Change of Service"]),
                rng.choice(["Upgrade", "Downgrade"]),
                code=rng.choice([2, 20, 24, 27, 53]),
            )
        )
    return rows


def brute_force(rows, as_of, codes=None, exclusive=False):
    """Month by month over all rows, as the definitions read."""
    rows = [r for r in rows if codes is None or r[8] in codes]
    stops = [as_of if r[3] is None else r[3] for r in rows]
    month, last = min(r[2] for r in rows).replace(day=1), max(stops).replace(day=1)
    out = {}
    while month <= last:
        n = calendar.monthrange(month.year, month.month)[1]
        end = month.replace(day=n)
        starting = new = 0.0
        active, fresh = set(), set()
        for r, stop in zip(rows, stops, strict=True):
            price = float(r[4])
            if (r[2] < month or (r[2] == month and not exclusive)) and stop >= month:
                active.add(r[0])
                starting += price * ((min(stop, end) - month).days + 1) / n
            if month <= r[2] <= end:
                fresh.add(r[0])
                new += price * max((min(stop, end) - r[2]).days + 1, 0) / n
        out[month.strftime("%Y-%m")] = (starting, new, len(fresh), len(active))
        month = (month + dt.timedelta(days=32)).replace(day=1)
    return out


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize(
    "exclusive, as_of", [(False, "2024-06-15"), (True, "2024-06-15"), (False, "2022-09-01")]
)
def test_against_brute_force(contracts, cfg, form, exclusive, as_of):
    rows = random_rows(7, 500)
    cfg = replace(cfg, as_of=dt.date.fromisoformat(as_of))
    settings = replace(cfg, exclusive_start=exclusive)
    out = as_dicts(waterfall.start_new_mrr(contracts(*rows).repartition(5), settings, form))
    tiers = {"Full": None, **TIER_SEGMENTS}
    tiers.pop("moderate_performers")  # only segment 24
    for tier, codes in {**tiers, "moderate_performers": (24,)}.items():
        expected = brute_force(rows, cfg.as_of, codes, exclusive)
        got = {
            r["month"]: (r["starting_mrr"], r["new_mrr"], r["new_count"], r["starting_count"])
            for r in out
            if r["tier"] == tier
        }
        assert set(got) == set(expected)
        for month, values in expected.items():
            assert got[month] == pytest.approx(values), (tier, month)


def test_spine_and_active_accounts(contracts, cfg):
    rows = random_rows(3)
    df = contracts(*rows)
    spine = full(waterfall.calendar_spine(df, cfg), "month")
    assert set(spine) == set(brute_force(rows, cfg.as_of))
    got = full(waterfall.active_accounts(df, cfg), "active_accounts")
    dated = [r[3] for r in rows if r[3] is not None]
    assert max(got) == max(dated).strftime("%Y-%m") and min(got) == min(spine)
    for month, n in got.items():
        first = dt.date.fromisoformat(f"{month}-01")
        last = first.replace(day=calendar.monthrange(first.year, first.month)[1])
        active = {r[0] for r in rows if r[2] <= last and (r[3] is None or r[3] >= first)}
        assert n == len(active), month


def test_expansion_example(contracts, cfg):
    def change(start, price, reason="Upgrade"):
        return contract(start=start, price=price, wo="Change of Service", reason=reason)

    df = keyed(
        contracts(
            change("2024-01-05", "40"),
            change("2024-02-05", "55"),
            change("2024-03-05", "50"),
            change("2024-02-10", "30", "Downgrade"),
            change("2024-04-10", "10", "Downgrade"),
            contract(start="2024-02-20", price="500"),
        )
    )
    up = movements.expansion_revenue(df, cfg)
    assert full(up, "expansion") == {"2024-01": 0.0, "2024-02": 15.0, "2024-03": 0.0}
    assert set(full(up, "expansion_count").values()) == {1}
    down = movements.contraction_revenue(df, cfg)
    assert full(down, "contraction") == {"2024-02": 0.0, "2024-04": 20.0}


def test_moves_against_brute_force(contracts, cfg):
    rows = random_rows(11, 600)
    rows += [r[:2] + (dt.date(2023, 5, 5),) + r[3:] for r in rows[:120]]  # busy days
    rows += rows[:60]  # copies
    out = as_dicts(movements.price_moves(keyed(contracts(*rows)).repartition(6), cfg))
    got = {r["month"]: r for r in out if r["tier"] == "Full"}
    for name, reason, sign in (("expansion", "Upgrade", 1), ("contraction", "Downgrade", -1)):
        sums, accounts = defaultdict(float), defaultdict(set)
        chosen = [r for r in rows if r[5] == "Change of Service" and r[6] == reason]
        chosen.sort(key=lambda r: (r[0], r[2], r[3] or dt.date.min, r[4]))
        previous = {}
        for r in chosen:
            month = r[2].strftime("%Y-%m")
            accounts[month].add(r[0])
            if r[0] in previous:
                sums[month] += max(sign * float(r[4] - previous[r[0]]), 0.0)
            previous[r[0]] = r[4]
        for month, members in accounts.items():
            assert got[month][f"{name}_count"] == len(members)
            assert got[month][name] == pytest.approx(sums[month])


def test_waterfall_identities_and_arr(contracts, cfg):
    rows = random_rows(5)
    df = keyed(contracts(*rows)).withColumns(
        {
            "churn_flag": (F.col("account_number") == "A1").cast("int"),
            "churn_date": F.when(F.col("account_number") == "A1", F.lit(dt.date(2023, 4, 9))),
        }
    )
    out = [r for r in as_dicts(waterfall.waterfall(df, cfg)) if r["tier"] == "Full"]
    out.sort(key=lambda r: r["month"])
    assert [r["month_sequential"] for r in out] == list(range(1, len(out) + 1))
    for r in out:
        assert r["ending_mrr"] - r["starting_mrr"] == pytest.approx(r["net_new_mrr"])
        assert r["ending_count"] - r["starting_count"] == r["new_count"] - r["churn_count"]
        assert r["month_number"] == int(r["month"][5:])
    churned = [r for r in out if r["churn_count"]]
    own = sum(float(r[4]) for r in rows if r[0] == "A1")
    assert [(r["month"], r["churn"]) for r in churned] == [("2023-04", pytest.approx(own))]
    arr = {r["tier"]: r for r in as_dicts(waterfall.arr(waterfall.waterfall(df, cfg)))}
    assert arr["Full"]["month"] == out[-2]["month"]
    assert arr["Full"]["arr"] == pytest.approx(out[-2]["ending_mrr"] * 12)


def test_no_movements_at_all(contracts, cfg):
    out = as_dicts(waterfall.waterfall(keyed(contracts(contract(end="2024-03-10"))), cfg))
    assert {r["expansion"] for r in out} == {0.0} and {r["churn_count"] for r in out} == {0}


def test_exploded_months_are_summed_before_the_shuffle(contracts, cfg):
    df = contracts(contract(), contract("A2", start="2023-05-06", end="2024-02-03"))
    text = waterfall.start_new_mrr(df, cfg, "explode")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("account_number" in line and "month_idx" in line for line in dealt)


def test_exploded_accounts_count_once_per_tier(contracts, cfg):
    rows = [
        contract("A1", code=None, start="2024-01-15", end="2024-04-02"),
        contract("A1", code=5, start="2024-01-01", end="2024-03-02"),
        contract(None, code=5, start="2024-02-01", end="2024-02-02"),
        contract("A2", code=99, start="2024-03-31", end="2024-03-31"),
    ]
    forms = [waterfall.start_new_mrr(contracts(*rows), cfg, form) for form in FORMS]
    assert sorted(forms[0].collect()) == sorted(forms[1].collect())
    assert full(forms[1], "starting_count") == {"2024-01": 1, "2024-02": 2, "2024-03": 1, "2024-04": 1}
    assert full(forms[1], "new_count") == {"2024-01": 1, "2024-02": 1, "2024-03": 1, "2024-04": 0}


def test_active_accounts_read_the_contracts_once(contracts, cfg):
    rows = [
        contract("A1", start="2024-01-15", end="2024-02-02"),
        contract("A1", start="2024-01-01", end="2024-05-02"),
        contract("A1", start="2024-01-20", end="2024-03-02"),
        contract("A2", start="2024-03-05"),
    ]
    out = waterfall.active_accounts(contracts(*rows), cfg)
    assert full(out, "active_accounts") == {"2024-01": 1, "2024-02": 1, "2024-03": 2, "2024-04": 2, "2024-05": 2}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + out._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1
    assert waterfall.active_accounts(contracts(contract()), cfg).count() == 0
