"""Whole runs and every sink: written, read back, and returned as they stand in the files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verification import oracle
from verification.entry_queries import ORACLE as ENTRY_ORACLE
from verification.entry_queries import date_text
from verification.fixtures import AS_OF, CHANGES, CONFIG, contracts, raw_contracts, sites, table
from verification.forecast_queries import rounded
from verification.forecast_queries import run as forecast_run
from verification.queries import deduped, flagged, tagged, wide_sites
from waterline.config import TIER_SEGMENTS
from waterline.forecast.models import TREND
from waterline.functions.calendar import month_key, open_as_date
from waterline.functions.money import finite, format_currency
from waterline.operators import churn, cleaning, filters
from waterline.operators.dedupe import exclusivity_conflicts
from waterline.plans import monthly
from waterline.schema import CONTRACT_TITLES
from waterline.sources import sinks
from waterline.sources.contracts import read_text_csv
from waterline.sources.layout import Layout
from waterline.sources.monthly import read_monthly, read_monthly_csv
from waterline.sources.runs import Run, read_current
from waterline.sources.sites import read_sites_csv
from waterline.sources.staging import materialise, scratch

# Full and high performers.
KEYS = (0, 1)
PICKED = ("Full", "high_performers")
LAST_DAY = dt.date(2099, 12, 31)


def _output(spark: SparkSession) -> Layout:
    return Layout(scratch(spark, "output"))


def _file_of(rows: DataFrame, name: str) -> str:
    """Contract rows as a CSV with titles and text prices, compressed: as plain text it is the largest table of all."""
    path = scratch(rows.sparkSession, name)
    options = {"header": True, "encoding": "ISO-8859-1", "compression": "gzip"}
    sinks.titled(rows, sinks.CONTRACT_FILE_TITLES).write.options(**options).csv(path)
    return path


# Notes with quotes, separators and both kinds of line breaks; Spark and DuckDB read the same text.
NOTE = """case cast(o_orderkey % 5 as int)
    when 0 then concat('say "', o_orderpriority, '", and go')
    when 1 then concat('first', chr(10), o_orderpriority, chr(10), chr(10), 'last')
    when 2 then concat('"', chr(13), chr(10), '"', chr(10), ',')
    when 3 then concat(chr(10), '""')
    else 'plain' end"""
SPLIT_BYTES = 32_768


def _csv_quoted_breaks(spark, sf):
    """One file read in several splits, records over two of them included."""
    path = scratch(spark, "notes")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.expr(NOTE).alias("note"), F.lit("end").alias("last"))
    sinks.write_csv(rows.coalesce(1), path)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, SPLIT_BYTES)
    try:
        # lines are read and numbered here
        return read_text_csv(spark, path)
    finally:
        spark.conf.set(name, before)


def _sites_file(spark, sf):
    path = scratch(spark, "sites")
    wide_sites(spark, sf).write.option("header", True).csv(path)
    return path


def _run_from_files(spark, sf):
    layout = _output(spark)
    # ids of the fixture, which decide ties, are whole numbers and would be text in a file
    raw = raw_contracts(spark, sf)
    padded = raw.withColumns({k: F.lpad(F.col(k).cast("string"), 12, "0") for k in ("order_key", "line_number", "part_key")})
    path = _file_of(padded, "contracts")
    monthly.run_from_files(spark, path, _sites_file(spark, sf), CONFIG, layout)
    return read_monthly(spark, f"{layout.all_tiers('combined_results')}/baseline_combined_mrr_arpu_results")


def _batch_run(spark, sf):
    """Two tiers, repriced; the combined table as written."""
    layout = _output(spark)
    monthly.batch_run(contracts(spark, sf), sites(spark, sf), CONFIG, KEYS, CHANGES, layout)
    return read_monthly(spark, f"{layout.all_tiers('combined_results')}/combined_mrr_arpu_results")


def _two_runs(spark, sf):
    """High performers, then underperformers, then high performers repriced, and a run that breaks."""
    layout = _output(spark)
    rows, places = contracts(spark, sf), sites(spark, sf)
    for keys, changes in (([1], ()), ([3], ()), ([1], CHANGES)):
        written = monthly.batch_run(rows, places, CONFIG, keys, changes, layout)
    # written, never finished
    sinks.write_combined(written.combined, layout, run=Run(spark, layout), tiers=["high_performers"])
    path = layout.all_tiers("combined_results")
    names = {"baseline": f"{path}/baseline_combined_mrr_arpu_results", "repriced": f"{path}/combined_mrr_arpu_results"}
    tables = [read_monthly(spark, p).withColumn("scenario", F.lit(name)) for name, p in names.items()]
    return tables[0].unionByName(tables[1])


def _waterfall_sink(spark, sf):
    layout = _output(spark)
    monthly.batch_run(contracts(spark, sf), sites(spark, sf), CONFIG, KEYS, layout=layout)
    return read_monthly(spark, f"{layout.all_tiers('mrr_waterfall')}/baseline_mrr_waterfall_results")


def _run_arr(spark, sf):
    return monthly.batch_run(contracts(spark, sf), sites(spark, sf), CONFIG, KEYS).arr


def _monthly_csv(spark, sf):
    """The combined table as one CSV per tier with the original titles, and back."""
    layout = _output(spark)
    run = monthly.batch_run(contracts(spark, sf), sites(spark, sf), CONFIG, KEYS)
    paths = sinks.export_csv(run.combined, layout, PICKED)
    parts = [read_monthly_csv(spark, path, tier) for path, tier in zip(paths, PICKED, strict=True)]
    return parts[0].unionByName(parts[1])


def _sites_csv(spark, sf):
    back = read_sites_csv(spark, _sites_file(spark, sf))
    return back.select("site", month_key(F.col("release_date")).alias("month"), "cxn_code", "base")


def _cleaned_sink(spark, sf):
    cleaned = cleaning.handle_missing_data(raw_contracts(spark, sf))
    path = sinks.write_cleaned(cleaned, _output(spark))
    return spark.read.parquet(path).na.fill(-1, subset=["test_flag", "cxn_code"])


def _filtered_sink(spark, sf):
    path = sinks.write_contracts(deduped(spark, sf), _output(spark), TIER_SEGMENTS)
    return read_current(spark, path)


def _back(spark: SparkSession, path: str | None, names: tuple[str, ...]) -> DataFrame:
    """Columns of a CSV with titles under their canonical names, as text."""
    if path is None:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    titles = {name: title for title, name in CONTRACT_TITLES.items()}
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return raw.select(*[F.col(f"`{titles.get(n, n)}`").alias(n) for n in names])


def _exclusivity_sink(spark, sf):
    # read twice: for the conflicting keys and for their rows
    rows = materialise(tagged(spark, sf), "tagged")
    path, _ = sinks.write_exclusivity_errors(exclusivity_conflicts(rows, staged=True), _output(spark))
    return _back(spark, path, ("account_number", "package_group", "start_date", "site", "order_key", "line_number"))


def _rejects_sink(spark, sf):
    path, _ = sinks.write_rejects(filters.rejected_starts(date_text(spark, sf)), _output(spark))
    back = _back(spark, path, ("order_key", "start_date"))
    return back.withColumn("order_key", F.col("order_key").cast("bigint"))


def _predictions_sink(spark, sf):
    path = sinks.write_predictions(forecast_run(spark, sf, TREND).trend, _output(spark), "Ending MRR")
    return rounded(read_monthly(spark, path))


def _finite_values(spark, sf):
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    odd = (
        F.when(line == 1, F.lit(float("nan")))
        .when(line == 2, F.lit(float("inf")))
        .when(line == 3, F.lit(float("-inf")))
        .when(line > 4, price)
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", finite(odd).alias("value"))


def _open_ends(spark, sf):
    """Contracts without a last day, dated as far ahead as a date column of a report goes."""
    rows = contracts(spark, sf).withColumn("end_date", open_as_date(F.col("end_date"), LAST_DAY))
    return rows.groupBy("end_date").agg(F.count("*").alias("n"))


def _undated_churn(spark, sf):
    """Churned rows of every seventh order have lost their date."""
    date = F.when(F.col("order_key") % 7 != 0, F.col("churn_date"))
    return churn.churned_without_date(flagged(spark, sf).withColumn("churn_date", date)).select("order_key", "line_number")


def _currency_file(spark, sf):
    """Repriced contract rows of one tier as CSV, prices as written."""
    rows = deduped(spark, sf).withColumn("price", format_currency(F.col("price")))
    path = sinks.export_contracts_csv(rows, _output(spark), "underperformers", TIER_SEGMENTS)
    return _back(spark, path, ("account_number", "package_group", "start_date", "price", "order_key", "line_number"))


QUERIES = {
    "run_from_files": _run_from_files,
    "batch_run": _batch_run,
    "two_runs": _two_runs,
    "run_arr": _run_arr,
    "waterfall_sink": _waterfall_sink,
    "monthly_csv": _monthly_csv,
    "sites_csv": _sites_csv,
    "csv_quoted_breaks": _csv_quoted_breaks,
    "cleaned_sink": _cleaned_sink,
    "filtered_sink": _filtered_sink,
    "tier_csv_sink": _currency_file,
    "exclusivity_sink": _exclusivity_sink,
    "rejects_sink": _rejects_sink,
    "predictions_sink": _predictions_sink,
    "finite_values": _finite_values,
    "open_ends": _open_ends,
    "undated_churn": _undated_churn,
}


def oracle_sql() -> dict[str, str]:
    """Most files hold what a query without a file returns; the SQL is that of the definitions."""
    core = oracle.oracle_sql()
    from verification.forecast_oracle import oracle_sql as forecast_sql

    picked = ", ".join(f"'{t}'" for t in PICKED)
    columns = oracle.MONTHLY_COLUMNS

    def text(*names: str) -> str:
        return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)

    return {
        "run_from_files": f"WITH {oracle.combined(rows=oracle.prep(head=oracle.cleaned_head()))} SELECT {columns} FROM combined",
        "batch_run": f"WITH {oracle.combined(rows=oracle.splits(), source='split')} SELECT {columns} FROM combined WHERE tier IN ({picked})",
        "two_runs": f"""SELECT {columns}, 'baseline' AS scenario FROM ({core['combined_metrics']})
            WHERE tier IN ('high_performers', 'underperformers') UNION ALL
            SELECT * FROM (WITH {oracle.combined(rows=oracle.splits(), source='split')}
              SELECT {columns}, 'repriced' AS scenario FROM combined WHERE tier = 'high_performers')""",
        "run_arr": f"SELECT * FROM ({core['arr']}) WHERE tier IN ({picked})",
        "waterfall_sink": f"SELECT * FROM ({core['mrr_waterfall_by_tier']}) WHERE tier IN ({picked})",
        "monthly_csv": f"SELECT * FROM ({core['combined_metrics']}) WHERE tier IN ({picked})",
        "sites_csv": core["wide_sites"],
        "csv_quoted_breaks": f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {NOTE} AS note, 'end' AS last FROM orders",
        "cleaned_sink": core["cleaned_contracts"],
        "filtered_sink": core["tier_rows"],
        "tier_csv_sink": f"""WITH {oracle.prep()},{oracle.BRIDGE}
            SELECT {text('account_number', 'package_group', 'start_date')},
              concat('$', price) AS price, {text('order_key', 'line_number')}
            FROM deduped SEMI JOIN (SELECT cxn_code FROM bridge WHERE tier = 'underperformers') USING (cxn_code)""",
        "exclusivity_sink": f"""SELECT {text('account_number', 'package_group', 'start_date', 'site', 'order_key', 'line_number')}
            FROM ({core['exclusivity_check']})""",
        "rejects_sink": ENTRY_ORACLE["rejected_rows"],
        "predictions_sink": forecast_sql()["trend_table"],
        "finite_values": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
            CASE WHEN l_linenumber > 4 THEN l_extendedprice ELSE 0 END AS value FROM lineitem""",
        "open_ends": f"""WITH {oracle.HEAD}
            SELECT coalesce(CAST(CASE WHEN year(end_date) >= 2999 THEN DATE '{LAST_DAY}' ELSE end_date END AS VARCHAR), '') AS end_date,
              count(*) AS n FROM contracts GROUP BY ALL""",
        "undated_churn": f"""WITH {oracle.prep(AS_OF)}
            SELECT order_key, CAST(line_number AS BIGINT) AS line_number FROM flagged WHERE churn_flag = 1 AND order_key % 7 = 0""",
    }
