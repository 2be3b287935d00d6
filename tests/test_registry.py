import pytest
from conftest import SMALL

import __spark_entry__ as driver
from verification.check import differences, duck, duck_rows, spark_rows

CHECKED = [
    "medians", "cleaned_contracts", "prepared_from_raw", "csv_round_trip", "csv_quoted_breaks", "wide_sites", "dedupe_category", "deduped_contracts", "exclusivity_check",
    "split_contracts", "split_contracts_long_list", "two_runs", "price_change_impact", "mrr_start_new_early", "combined_metrics_repriced",
    "cumulative_arpu_summary", "quality_ratios", "gram_stats", "trend_quality",
    "fit_gaps", "lasso_net_new", "coefficient_report", "net_new_projection", "model_dispatch", "scenario_table",
    "rejects_sink", "finite_values", "open_ends", "undated_churn",
]


def test_names():
    queries, sql = driver.queries(), driver.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(CHECKED) <= set(sql)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["tier", "month"] and len(df.columns) == 30
    assert df.count() == 4 * 121


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    got = spark_rows(driver.queries()[name](spark, SMALL))
    assert differences(got, duck_rows(duck(SMALL), driver.oracle_sql()[name])) == []
