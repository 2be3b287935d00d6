import datetime as dt
import random
from dataclasses import replace

import pytest
from conftest import as_dicts, contract
from pyspark.sql import functions as F

from waterline.config import TIER_SEGMENTS
from waterline.operators import churn, dedupe, filters, skew, tagging, tiers
from waterline.plans.prep import prepare_contracts, tag_contracts

AS_OF = dt.date(2024, 6, 15)


def test_business_filters(contracts, cfg):
    df = contracts(
        contract(account="ok"),
        contract(account="other package", package="X"),
        contract(account="test", test=1),
        contract(account="reversed", start="2024-03-02", end="2024-03-01"),
        contract(account="one day", start="2024-03-02", end="2024-03-02"),
        contract(account="open", end="2999-12-31"),
    )
    got = {r.account_number: r.end_date for r in filters.apply_business_filters(df, cfg.core_packages).collect()}
    assert got == {"ok": None, "one day": dt.date(2024, 3, 2), "open": None}


def test_unreadable_starts_are_rejected_not_fatal(spark, cfg):
    df = spark.createDataFrame(
        [("A", "P", "2024-01-01", "junk", 0), ("B", "P", "junk", None, 0), ("C", "P", None, None, 0)],
        "account_number string, package_group string, start_date string, end_date string,"
        " test_flag int",
    )
    kept = filters.apply_business_filters(df, cfg.core_packages).collect()
    assert [(r.account_number, r.end_date) for r in kept] == [("A", None)]
    assert {r.account_number for r in filters.rejected_starts(df).collect()} == {"B", "C"}


CHURN_ROWS = [
    contract("dated", end="2024-05-15"),
    contract("dated", end="2024-06-01"),
    contract("grace", end="2024-05-16"),
    contract("changed", end="2023-01-01"),
    contract("changed", end="2023-01-01", wo="Change of Service"),
    contract("open", end="2023-01-01"),
    contract("open"),
    contract("sentinel", end="2023-01-01"),
    contract("sentinel", end="2999-12-31"),
    contract("disconnect", wo="Disconnect"),
    contract("disconnect", start="2022-01-01", end="2023-01-01"),
    contract("future end", end="2024-06-16"),
    contract("ends today", start="2023-01-01", end="2023-02-01"),
    contract("ends today", end="2024-06-15"),
    contract("new start", end="2023-01-01"),
    contract("new start", start="2024-06-15", end="2024-06-15"),
    contract("never dated", wo="Disconnect"),
]
CHURNED = {
    "dated": dt.date(2024, 5, 15),
    "disconnect": dt.date(2023, 1, 1),
    "ends today": dt.date(2023, 2, 1),
}


def test_churn_rules(contracts):
    df = contracts(*CHURN_ROWS)
    status = churn.account_status(df, AS_OF).collect()
    assert {r.account_number: r.churn_date for r in status if r.churn_flag} == CHURNED
    flagged = churn.identify_churned(df, AS_OF)
    assert flagged.count() == len(CHURN_ROWS)
    for r in flagged.collect():
        assert r.churn_flag == int(r.account_number in CHURNED)
        assert r.churn_date == CHURNED.get(r.account_number)
    assert churn.churned_without_date(flagged).isEmpty()


def test_hot_keys_give_the_same_result(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top")).filter("k <> 'k1'")
    plain = rows.join(table.drop("n"), "k", "left").select("k", "v", "top")
    for settings in ({}, {"partitions": 1}, {"partitions": 3}, {"partitions": 1000}):
        got = skew.attach(rows, table, ["k"], ["top"], "n", **settings)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_hot_rows_are_dealt_by_slice(spark):
    """The slice must be part of the shuffle key; folded away, it would spread nothing."""
    # copies of one row: only the slice can tell them apart
    rows = spark.range(0, 40000, 1, 20).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    table = spark.createDataFrame([("hot", 40000, 1)], "k string, n bigint, x int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.attach(rows, table, ["k"], ["x"], "n")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_slice" in plan.split("hashpartitioning(")[1].split(")")[0]
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 30000


def test_category_precedence(contracts):
    df = contracts(
        contract(),
        contract(wo="Change of Service", reason="Upgrade"),
        contract(wo="Change of Service", reason="Downgrade"),
        contract(wo="Change of Service"),
        contract(wo="Disconnect"),
    )
    kept = [r.revenue_category for r in tagging.tag_revenue_category(df.withColumn("churn_flag", F.lit(0))).collect()]
    assert kept == ["New MRR", "Expansion", "Contraction"]
    all_churned = tagging.tag_revenue_category(df.withColumn("churn_flag", F.lit(1))).collect()
    assert [r.revenue_category for r in all_churned] == ["Churn"] * 5


def dedupe_rows(contracts):
    df = contracts(
        # one month, two categories: the activation stays although it is the later row
        contract("conflict", start="2024-01-02", wo="Change of Service", reason="Upgrade"),
        contract("conflict", start="2024-01-20", price="7.00"),
        contract("conflict", start="2024-01-21", price="8.00"),
        contract("conflict", start="2024-02-01", wo="Change of Service", reason="Upgrade"),
        # one category: all starts stay
        contract("clean", start="2024-01-02"),
        contract("clean", start="2024-01-20"),
        # same start: the latest end wins, an open one comes last
        contract("same start", start="2024-01-05", end="2024-02-01"),
        contract("same start", start="2024-01-05", end="2024-03-01"),
        contract("same start", start="2024-01-05"),
        # other package, other key
        contract("clean", package="Q", start="2024-01-02", wo="Change of Service", reason="Downgrade"),
    )
    keyed = filters.add_time_keys(df).withColumns({"churn_flag": F.lit(0), "churn_date": F.lit(None).cast("date")})
    return tagging.tag_revenue_category(keyed)


def summary(df):
    return sorted(
        (r.account_number, r.package_group, str(r.start_date), str(r.end_date), str(r.price))
        for r in df.collect()
    )


def test_dedupe(contracts):
    rows = dedupe_rows(contracts)
    got = summary(dedupe.dedupe(rows))
    assert got == [
        ("clean", "P", "2024-01-02", "None", "10.00"),
        ("clean", "P", "2024-01-20", "None", "10.00"),
        ("clean", "Q", "2024-01-02", "None", "10.00"),
        ("conflict", "P", "2024-01-20", "None", "7.00"),
        ("conflict", "P", "2024-02-01", "None", "10.00"),
        ("same start", "P", "2024-01-05", "2024-03-01", "10.00"),
    ]
    assert summary(dedupe.dedupe_overlap(dedupe.dedupe_category(rows))) == got
    assert summary(dedupe.dedupe_overlap(dedupe.dedupe_category(rows, partitions=1_000_000))) == got
    assert summary(dedupe.dedupe(dedupe.dedupe(rows))) == got
    assert summary(dedupe.dedupe(rows.repartition(7))) == got
    open_first = summary(dedupe.dedupe(rows, open_wins=True))
    assert ("same start", "P", "2024-01-05", "None", "10.00") in open_first


def test_exclusivity(contracts):
    rows = dedupe_rows(contracts).unionByName(
        dedupe_rows(contracts).filter("account_number = 'clean'").withColumn("revenue_category", F.lit("Churn"))
    )
    found = dedupe.exclusivity_conflicts(rows)
    assert {(r.account_number, r.n_categories) for r in found.collect()} == {("clean", 2)}
    assert found.count() == 6
    assert dedupe.exclusivity_conflicts(dedupe.dedupe(rows)).isEmpty()


def test_tiers(spark, contracts):
    bridge = as_dicts(tiers.tier_bridge(spark))
    assert len(bridge) == 9 + 22 + 22
    df = contracts(*[contract(f"A{c}", code=c) for c in range(1, 54)], contract("none", code=None))
    rows = tiers.add_tiers(df).collect()
    per_tier = {t: {r.cxn_code for r in rows if r.tier == t} for t in {r.tier for r in rows}}
    assert per_tier.pop("Full") == {*range(1, 54), None}
    assert per_tier == {t: set(codes) for t, codes in TIER_SEGMENTS.items()}
    for tier, codes in TIER_SEGMENTS.items():
        assert tiers.filter_on_tier(df, tier).count() == len(codes)
    assert tiers.filter_on_tier(df, "Full").count() == 54
    with pytest.raises(ValueError):
        tiers.filter_on_tier(df, "nobody")
    odd = tiers.add_tiers(df, {"it's": [5]}).filter(F.col("tier") == "it's")
    assert odd.count() == 1


def test_preparation_does_not_depend_on_partitions(contracts, cfg):
    df = contracts(*CHURN_ROWS, *[contract(f"B{i % 5}", start=f"2024-01-{i % 28 + 1:02d}") for i in range(60)])
    one = summary(prepare_contracts(df.coalesce(1), cfg))
    assert one == summary(prepare_contracts(df.repartition(9), cfg))
    assert tag_contracts(df, cfg).filter("revenue_category = 'Other'").isEmpty()


@pytest.mark.parametrize("open_wins", [False, True])
def test_preparation_agrees_with_its_steps_one_by_one(spark, contracts, cfg, open_wins):
    """Rows that leave first still count for their account's status, and never one that would have stayed."""
    rng = random.Random(7)
    ends = [None, "2999-12-31", "2023-06-30", "2024-02-29", "2024-05-31", "2025-01-01"]
    accounts = [None, "hot", "hot", *[f"A{n}" for n in range(30)], *[f"L{n}" for n in range(30)]]
    rows = [
        contract(
            account=(account := rng.choice(accounts)),
            package=rng.choice("PQR"),
            start=f"2023-{rng.choice(('01', '02'))}-0{rng.randrange(1, 5)}",
            end=rng.choice(ends),
            price=rng.choice(["1.00", "2.00"]),
            wo=rng.choice(["Disconnect", None] if (account or "").startswith("L") else ["Activate", "Change of Service", "Disconnect"]),
            reason=rng.choice(["Upgrade", "Downgrade", "Other", None]),
            code=rng.choice([None, 5, 6]),
            site=rng.choice([None, "1", "2"]),
        )
        for _ in range(1500)
    ]
    config = replace(cfg, open_wins=open_wins)
    frame = contracts(*rows, *rows[:200])
    got = prepare_contracts(frame, config)
    expected = dedupe.dedupe(tag_contracts(frame, config), open_wins)
    assert got.schema.names == expected.schema.names
    assert [f.dataType for f in got.schema] == [f.dataType for f in expected.schema]
    order = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(map(tuple, expected.collect()), key=order)
    assert got.filter("churn_flag = 1").count() and got.filter("churn_flag = 0").count()


def test_conflicts_are_the_same_staged(contracts):
    rows = contracts(contract(reason="a"), contract(reason="b"), contract(account="A2")).withColumn("revenue_category", F.col("reason_group"))
    want = sorted(map(str, dedupe.exclusivity_conflicts(rows).collect()))
    assert len(want) == 2
    assert sorted(map(str, dedupe.exclusivity_conflicts(rows, staged=True).collect())) == want


def test_tiers_as_bits(spark):
    # more tiers than a whole number has bits; one without segments, one that names a segment twice
    many = {f"t{n}": (n % 7, n % 7, n) for n in range(130)} | {"none": ()}
    rows = spark.createDataFrame([(g, c) for g in range(9) for c in (g, g * 17, None)] + [(99, None)], "g int, cxn_code int")
    bits = tiers.tier_bits(F.col("cxn_code"), many)
    assert len(bits) == 3
    names = [f"b{n}" for n in range(len(bits))]
    united = rows.groupBy("g").agg(F.count("*").alias("n"), *[F.bit_or(b).alias(n) for b, n in zip(bits, names, strict=True)])
    got = {r.g: set(r.t) for r in united.select("g", tiers.tiers_of_bits([F.col(n) for n in names], many).alias("t")).collect()}
    assert got == {
        g: {"Full"} | {t for t, codes in many.items() if {*codes} & {g, g * 17}} if g < 9 else {"Full"} for g in got
    } and len(got) == 10
