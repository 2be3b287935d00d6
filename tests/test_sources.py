import datetime as dt
from decimal import Decimal

import pytest
from conftest import contract
from pyspark.sql import functions as F

from waterline.operators.pricing import price_change_table, price_changes
from waterline.plans.monthly import monthly_run, run_from_files
from waterline.plans.prep import clean_and_prepare
from waterline.schema import MONTHLY_TITLES
from waterline.sources import contracts as source
from waterline.sources import monthly, sinks, staging
from waterline.sources.layout import Layout
from waterline.sources.price_changes import read_price_changes
from waterline.sources.runs import Run, read_current, remove_replaced
from waterline.sources.sites import read_sites_csv, read_sites_parquet

HEADER = (
    "Account Number,Package Name,Package Group,Package Group Condensed,Package Start Date,"
    "Package End Date, Price ,WO Type Group,Reason Group,Test Flag,CXN Code,Site,City,Zip"
)
LINES = [
    'A1,n,g,TV: Premier,2024-01-05,2999-12-31,"$1,234.50 ",Activate,Other,0,5,12.0,Oulu,1',
    "A2,n,g,TV: Premier,1/5/2024,2/6/2024,$10.00,Activate,,0,7,North,Malmö,2",
    "A3,n,g,TV: Premier,junk,,$10.00,Activate,Other,0,7,3,x,3",
    "A4,n,g,Internet: 1 Gbps,2024-01-05,NA,bad,Activate,Other,0,NaN,4,x,4",
    "A5,n,g,Something,2024-01-05,,$1,Activate,Other,0,7,4,x,4",
    "A6,n,g,TV: Premier,2024-01-05,,$1,Activate,Other,1,7,4,x,4",
]


@pytest.fixture
def csv(tmp_path):
    extra = ",".join(f"Extra {i}" for i in range(40))
    path = tmp_path / "contracts.csv"
    lines = [f"{HEADER},{extra}"] + [line + "," * 40 for line in LINES]
    path.write_bytes("\n".join(lines).encode("latin-1"))
    return str(path)


def test_contract_csv(spark, csv):
    assert len(source.read_contracts_csv(spark, csv).columns) > 42
    df = source.validate(source.read_contracts_csv(spark, csv, first=42))
    assert len(df.columns) == 42 and df.columns[-1] == "extra_27"
    rows = {r.account_number: r for r in df.collect()}
    assert rows["A1"].price == "$1,234.50 " and rows["A1"].cxn_code == 5
    assert rows["A2"].reason_group is None and rows["A2"].city == "Malmö"
    assert rows["A4"].cxn_code is None and rows["A4"].end_date is None
    with pytest.raises(ValueError):
        source.validate(df.drop("site"))


def test_raw_to_prepared(spark, csv, cfg):
    from waterline.config import RunConfig

    raw = source.read_contracts_csv(spark, csv)
    out = clean_and_prepare(raw, RunConfig(as_of=cfg.as_of)).collect()
    rows = {r.account_number: r for r in out}
    # A3 has no readable start, A5 no core package, A6 is a test account
    assert set(rows) == {"A1", "A4"} | {r for r in rows if r == "A2"}
    assert rows["A1"].price == Decimal("1234.50") and rows["A1"].end_date is None
    assert rows["A4"].price == 0 and rows["A4"].cxn_code is None
    assert rows["A2"].end_date == dt.date(2024, 2, 6) and rows["A2"].churn_flag == 1
    assert "city" not in out[0].asDict() and "extra_1" not in out[0].asDict()


def test_price_change_csv(spark, tmp_path):
    path = tmp_path / "changes.csv"
    path.write_text("seq,package,effective_date,old_price,new_price\n2,Q,2024-02-01,1,2\n1,P,2024-01-01,1.50,2\n")
    listed = price_changes([("P", "2024-01-01", "1.5", 2), ("Q", "2024-02-01", 1, 2)])
    read = read_price_changes(spark, str(path)).orderBy("seq").collect()
    assert read == price_change_table(spark, listed).collect()
    path.write_text("seq,package,effective_date,old_price,new_price\n1,P,01.02.2024,x,2\n")
    with pytest.raises(Exception):
        read_price_changes(spark, str(path)).collect()


def test_sites(spark, tmp_path):
    path = tmp_path / "sites.csv"
    path.write_text("Site,Date,1,2,Note\n12.0,2024-01-05,7,8,x\n,2024-01-05,1,1,x\nN,1/31/2024,1,,x\n")
    df = read_sites_csv(spark, str(path))
    got = sorted(map(tuple, df.collect()))
    assert got[0] == ("12", dt.date(2024, 1, 5), 1, 7) and len(got) == 4
    df.write.parquet(str(tmp_path / "long"))
    assert sorted(map(tuple, read_sites_parquet(spark, str(tmp_path / "long")).collect())) == got


def test_run_writes_everything(spark, contracts, cfg, tmp_path):
    df = contracts(
        contract("A1", start="2024-01-05", end="2024-04-02", price="50.00"),
        contract("A2", start="2024-02-05", end="2024-05-02", price="50.00", code=7),
    )
    sites = spark.createDataFrame(
        [("1", dt.date(2024, 1, 5), 5, 10)], "site string, release_date date, cxn_code int, base bigint"
    )
    layout = Layout(str(tmp_path / "out"))
    changes = price_changes([("P", "2024-03-01", 50, 60)])
    run = monthly_run(df, sites, cfg, layout=layout)
    again = monthly_run(df, sites, cfg, changes, layout=layout)
    assert again.contracts.count() == 4 and run.contracts.count() == 2
    baseline = monthly.read_monthly(
        spark, f"{layout.all_tiers('combined_results')}/baseline_combined_mrr_arpu_results"
    )
    key = ["tier", "month"]
    back = baseline.select(*run.combined.columns).orderBy(*key).collect()
    assert back == run.combined.orderBy(*key).collect()
    assert (tmp_path / "out/Full/filtered_data/price_filtered_data").is_dir()
    assert not (tmp_path / "out/Mutual_Exclusivity_Errors").exists()

    paths = sinks.export_csv(run.combined, layout, ["Full", "high_performers"])
    titles = spark.read.option("header", True).csv(paths[0]).columns
    assert titles == list(MONTHLY_TITLES)
    read = monthly.read_monthly_csv(spark, paths[0], "Full")
    full = run.combined.filter("tier = 'Full'").orderBy("month").collect()
    assert read.select(*run.combined.columns).orderBy("month").collect() == full
    [flow] = sinks.export_csv(run.waterfall, layout, ["Full"])
    assert "mrr_waterfall/baseline_mrr_waterfall_results" in flow
    rows = sinks.export_contracts_csv(run.contracts, layout, "high_performers", cfg.tiers)
    assert spark.read.option("header", True).csv(rows).filter(F.col("`CXN Code`") == 5).count() == 1
    tiered = sinks.write_contracts(run.contracts, layout, cfg.tiers)
    assert read_current(spark, tiered).groupBy("tier").count().count() == 3
    assert spark.read.parquet(sinks.write_cleaned(df, layout)).count() == 2
    conflict = df.withColumn("n_categories", F.lit(2))
    path, count = sinks.write_exclusivity_errors(conflict, layout)
    assert path.endswith("Mutual_Exclusivity_Errors") and count == 2 and (run.conflicting, run.rejected) == (0, 0)
    with pytest.raises(ValueError):
        layout.tier("Full", "nowhere")


def test_runs_replace_only_what_they_wrote(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    path = f"{layout.all_tiers('combined_results')}/table"

    def table(*rows):
        return spark.createDataFrame(rows, "month string, v int, tier string")

    def current(tiers=None):
        return sorted(map(tuple, read_current(spark, path, tiers).collect()))

    with pytest.raises(FileNotFoundError):
        current()
    sinks.write_by_tier(table(("2024-01", 1, "a"), ("2024-02", 2, "a")), layout, "combined_results", "table")
    sinks.write_by_tier(table(("2024-01", 3, "1/b")), layout, "combined_results", "table")
    assert current() == [("2024-01", 1, "a"), ("2024-01", 3, "1/b"), ("2024-02", 2, "a")]
    broken = Run(spark, layout)
    sinks.write_by_tier(table(("2024-01", 9, "a")), layout, "combined_results", "table", broken)
    assert current(["a"]) == [("2024-01", 1, "a"), ("2024-02", 2, "a")]
    sinks.write_by_tier(table(("2024-03", 5, "a")), layout, "combined_results", "table", tiers=["a", "1/b"])
    assert current() == [("2024-03", 5, "a")] and remove_replaced(spark, path) == 2
    sinks.write_by_tier(table(("2024-03", 5, "a")).limit(0), layout, "combined_results", "table", tiers=["a"])
    assert current() == [] and remove_replaced(spark, path) == 1
    # the run that is not finished keeps its files
    broken.finish()
    assert current() == []


def test_rejects_are_counted_while_they_are_written(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    rows = spark.range(7).withColumnRenamed("id", "n").mapInArrow(seen, "n long")
    path, count = sinks.write_rejects(rows, layout)
    assert count == 7 == evaluated.value and spark.read.option("header", True).csv(path).count() == 7
    assert sinks.write_rejects(rows.filter("n > 10"), layout) == (None, 0) and not (tmp_path / "out/Rejected_Rows").exists()


def test_run_from_files(spark, csv, cfg, tmp_path):
    from waterline.config import RunConfig

    sites = tmp_path / "sites.csv"
    sites.write_text("Site,Date,5,7\n12,2024-01-05,7,8\nNorth,2024-02-05,7,8\n")
    layout = Layout(str(tmp_path / "out"))
    run = run_from_files(spark, csv, str(sites), RunConfig(as_of=cfg.as_of), layout, keys=[0, 1])
    assert spark.read.parquet(f"{layout.tier('Full', 'raw_cleaned')}/cleaned_data").count() == 6
    rows = {(r.tier, r.month): r for r in run.combined.collect()}
    assert {t for t, _ in rows} == {"Full", "high_performers"}
    assert rows["high_performers", "2024-02"].starting_mrr == 1234.5
    assert rows["Full", "2024-02"].churn == 10.0 and rows["Full", "2024-02"].base == 15
    titled = spark.read.option("header", True).csv(
        f"{layout.tier('high_performers', 'combined_results')}/baseline_combined_mrr_arpu_results"
    )
    assert titled.count() == 6


def test_run_from_files_leaves_no_raw_rows(spark, csv, cfg, tmp_path, monkeypatch):
    from pathlib import Path

    from waterline.config import RunConfig
    from waterline.sources import staging

    sites = tmp_path / "sites.csv"
    sites.write_text("Site,Date,5\n12,2024-01-05,7\n")
    folder = tmp_path / "staged"
    monkeypatch.setattr(staging, "staging_folder", lambda spark: str(folder))
    run = run_from_files(spark, csv, str(sites), RunConfig(as_of=cfg.as_of), Layout(str(tmp_path / "out")), keys=[0])
    names = {p.name.rsplit("-", 1)[0] for p in Path(folder).iterdir() if any(p.iterdir())}
    assert "raw" not in names and {"waterfall", "combined"} <= names
    assert run.combined.count()


def test_complete_months_and_tier_series(spark):
    rows = [(t, f"2024-{m:02d}", float(m)) for t, n in (("Full", 5), ("high_performers", 4)) for m in range(1, n + 1)]
    df = spark.createDataFrame(rows, "tier string, month string, v double")
    assert monthly.complete_months(df).groupBy("tier").count().orderBy("tier").collect() == [
        ("Full", 4), ("high_performers", 3),
    ]
    series = monthly.tier_series(df, ["high_performers", "underperformers"], "v", "v").orderBy("month")
    assert [tuple(r) for r in series.collect()] == [
        ("2024-01", 1.0, 0.0), ("2024-02", 2.0, 0.0), ("2024-03", 3.0, 0.0),
    ]


def test_staging_uses_the_shared_folder(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, s string")
    back = staging.materialise(df, "x")
    assert back.count() == 3 and back.schema == df.schema
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: f"{tmp_path}/")
    assert staging.shared_folder(spark) == str(tmp_path)


def quoted_file(path, records, header=("a", "b", "c")):
    """A CSV as other programs write it: quotes only where they are needed."""
    import csv

    with open(path, "w", newline="", encoding="ISO-8859-1") as out:
        writer = csv.writer(out, lineterminator="\r\n")
        writer.writerow(header)
        writer.writerows(records)


@pytest.mark.parametrize("bytes_per_split", [70, 1000, 10**8])
def test_records_with_quotes_and_breaks_in_any_split(spark, tmp_path, bytes_per_split):
    import random

    draw = random.Random(3)
    pieces = ["x", "é", '"', ",", "\n", "\r\n", " ", "long " * 30, "\n\n", '""']
    records = [(str(i), "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 6))) or "-", f"end{i}") for i in range(300)]
    records += [("300", "\n" * 400, "e"), ("301", "y\n" * 200, "e")]
    for n, part in enumerate((records[:150], records[150:])):
        quoted_file(tmp_path / f"{n}.csv", part)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_per_split)
    try:
        got = [tuple(r) for r in source.read_text_csv(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(records)


def test_unreadable_records(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,"two\nlines",3\n4,5,6,7\n8,9\n10,"never closed,11\n12,13,14\n')
    rows = [tuple(r) for r in source.read_text_csv(spark, str(path)).collect()]
    assert sorted(rows) == [("1", "two\nlines", "3"), ("8", "9", None)]
    lost = [r.record for r in source.unreadable_records(spark, str(path)).collect()]
    assert sorted(lost) == ['10,"never closed,11', "12,13,14", "4,5,6,7"]
    out, count = sinks.write_unreadable(source.unreadable_records(spark, str(path)), Layout(str(tmp_path / "out")))
    assert out.endswith("Unreadable_Records") and count == 3
    path.write_text("a,b\n1,2\n")
    assert source.unreadable_records(spark, str(path)).count() == 0
