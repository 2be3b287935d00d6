"""What the physical plans must and must not contain."""

import pytest
from conftest import SMALL

from verification.fixtures import CHANGES, CONFIG, contracts, sites
from waterline.operators import dedupe, movements, pricing, unit_revenue, waterfall
from waterline.operators import sites as site_ops
from waterline.operators.recent import last_rows
from waterline.plans.monthly import combined_metrics
from waterline.plans.prep import prepare_contracts, tag_contracts
from waterline.sources.staging import materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "FileScan parquet" in line]


@pytest.fixture(scope="module")
def prepared(spark):
    return materialise(prepare_contracts(contracts(spark, SMALL), CONFIG), "plans")


def test_no_nested_loops_and_no_python(spark, prepared):
    frames = [
        prepare_contracts(contracts(spark, SMALL), CONFIG),
        pricing.reprice(prepared, CHANGES),
        waterfall.waterfall(prepared, CONFIG),
        combined_metrics(prepared, sites(spark, SMALL), CONFIG),
        unit_revenue.cumulative_arpu_summary(prepared, CONFIG),
    ]
    for frame in frames:
        text = plan(frame)
        for banned in ("NestedLoop", "Cartesian", "EvalPython", "InPandas"):
            assert banned not in text


def test_price_changes_do_not_shuffle(prepared):
    text = plan(pricing.reprice(prepared, CHANGES))
    # the index of new prices and that of cuts
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange" not in text.replace("BroadcastExchange", "")


def test_a_look_at_one_cut_does_not_copy_all(spark, prepared):
    for changes in (CHANGES, pricing.price_change_table(spark, CHANGES)):
        index = pricing._cut_lists(spark, changes)
        assert dict(index.dtypes) == {"package_group": "string", "_at": "decimal(18,2)", "_days": "array<date>", "_becomes": "array<decimal(18,2)>"}
        cut = pricing.reprice(prepared, changes)
        # a field of an array of structs is taken anew by every step of the search
        assert ".eff" not in plan(cut) and "transform(" not in plan(cut)


def test_scans_read_what_is_used(spark, prepared):
    [scan] = {s.split("FileScan")[1].split("[")[1].split("]")[0] for s in scans(plan(waterfall.calendar_spine(prepared, CONFIG)))}
    assert {c.split("#")[0] for c in scan.split(",")} == {"start_date", "end_date", "cxn_code"}
    found = scans(plan(waterfall.waterfall(prepared, CONFIG)))
    # sums and counts, price moves, churn
    assert len(found) == 4
    moves = [s for s in found if "EqualTo(wo_type_group,Change of Service)" in s]
    assert len(moves) == 1 and "test_flag" in moves[0]
    assert any("EqualTo(churn_flag,1)" in s for s in found)


def test_filters_reach_the_scan(spark):
    text = plan(tag_contracts(contracts(spark, SMALL), CONFIG))
    assert any("In(p_type, [ECONOMY,LARGE,MEDIUM,PROMO,STANDARD])" in s for s in scans(text))


def test_duplicates_leave_before_the_shuffle(spark):
    rows = tag_contracts(contracts(spark, SMALL), CONFIG)
    for frame in (dedupe.dedupe(rows), dedupe.dedupe_overlap(rows), dedupe.dedupe_category(rows)):
        text = plan(frame)
        assert "WindowGroupLimit" in text and ", Partial" in text


def test_account_status_is_computed_once(spark):
    from verification.queries import flagged

    frame = flagged(spark, SMALL)
    frame.collect()
    assert "ReusedExchange" in plan(frame)


def test_price_moves_meet_tiers_after_the_first_sums(prepared):
    text = plan(movements.price_moves(prepared, CONFIG))
    below = text[text.rindex("HashAggregate") :]
    assert "Generate" in text and "Generate" not in below
    # copies leave, accounts are brought together, months are summed
    assert text.count("Exchange hashpartitioning") <= 4


def test_last_rows_leave_before_the_shuffle(prepared):
    text = plan(last_rows(prepared.select("cxn_code", "start_date", "price"), ["cxn_code"], ["start_date"], 3))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_preparation_reads_lines_once_and_meets_by_account_once(spark):
    text = plan(prepare_contracts(contracts(spark, SMALL), CONFIG))
    assert len([s for s in scans(text) if "l_orderkey" in s]) == 1
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "account_number" in line]
    # accounts, and below them the best of each kind
    assert len(shuffles) == 2
    assert "package_group" not in shuffles[0] and "package_group" in shuffles[1]


def test_accounts_meet_before_tiers_multiply_them(prepared):
    frames = (
        waterfall.start_new_mrr(prepared, CONFIG),
        waterfall.active_accounts(prepared, CONFIG),
        unit_revenue.arpu(prepared, CONFIG),
        movements.churn_revenue(prepared, CONFIG),
    )
    for frame in frames:
        shuffles = [line for line in plan(frame).splitlines() if "Exchange hashpartitioning" in line]
        assert any("account_number" in line for line in shuffles)
        assert not any("tier" in line and "account_number" in line for line in shuffles)


def test_staged_conflicts_do_not_shuffle_the_rows(prepared):
    text = plan(dedupe.exclusivity_conflicts(prepared, staged=True))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_preparation_sorts_an_account_once(spark):
    text = plan(prepare_contracts(contracts(spark, SMALL), CONFIG))
    above = text[: text.index("Exchange hashpartitioning(account_number")]
    # one order serves churn and both rules for duplicates; texts of time follow from the start
    assert above.count("Sort [") == 1
    assert "quarter_key" not in above[above.index("Sort [") :]


def test_tiers_multiply_counts_not_accounts(prepared):
    for frame, key in ((unit_revenue.arpu(prepared, CONFIG), "account_number"), (site_ops.seen_sites(prepared, CONFIG), "_groupingexpression")):
        text = plan(frame)
        [shuffle] = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and key in line]
        assert "Generate" not in text[text.index(shuffle) :]
        assert "cxn_code" not in shuffle and "SortAggregate" not in text


def test_sites_are_not_broadcast(spark, prepared):
    # a site file looks small to the planner, its rows by segment need not be
    text = plan(site_ops.site_metrics(prepared, sites(spark, SMALL), CONFIG))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
