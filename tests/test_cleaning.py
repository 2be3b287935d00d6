import random
import statistics
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from waterline.operators import cleaning
from waterline.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("A", None, "$10.00 ", 1, None, None, 1.0),
        ("B", "P", "bad", None, 5, None, None),
        (None, "P", None, 3, 7, "2024-01-01", 3.0),
        ("D", "Q", "$1,000", 4, None, None, 4.0),
    ]
    return spark.createDataFrame(
        rows,
        "account_number string, package_group string, price string, test_flag int, cxn_code int,"
        " end_date string, extra double",
    )


def test_profile(raw):
    rows = cleaning.missing_profile(raw).collect()
    got = {r.column_name: (r.missing_count, r.missing_percentage, r.data_type) for r in rows}
    assert got["end_date"] == (3, 75.0, "string")
    assert got["cxn_code"] == (2, 50.0, "int")
    assert rows[0].column_name == "end_date"
    empty = cleaning.missing_profile(raw.limit(0)).collect()
    assert all(r.missing_percentage == 0 for r in empty)


def test_sparse_columns_go_unless_protected(raw):
    wide = raw.withColumn("mostly", F.when(F.col("account_number") == "A", 1))
    assert set(wide.columns) - set(cleaning.drop_sparse_columns(wide).columns) == {"mostly"}
    # half missing is not more than half
    assert "cxn_code" in cleaning.drop_sparse_columns(wide, protected=()).columns
    assert "end_date" not in cleaning.drop_sparse_columns(wide, protected=()).columns


def test_handle_missing(raw):
    rows = cleaning.handle_missing_data(raw).collect()
    assert [r.price for r in rows] == [Decimal("10.00"), 0, 0, Decimal("1000.00")]
    assert [r.account_number for r in rows] == ["A", "B", "Unknown", "D"]
    assert rows[0].package_group == "Unknown"
    assert rows[0].cxn_code is None and rows[1].test_flag is None
    assert rows[0].end_date is None
    assert rows[1].extra == 3.0
    filled = cleaning.handle_missing_data(raw, fill_ids=True).collect()
    assert [r.cxn_code for r in filled] == [6, 5, 7, 6]
    assert filled[1].test_flag == 3


def test_fractional_median_of_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert sorted(r.n for r in cleaning.fill_medians(df).collect()) == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("accuracy", [2, 100, 100_000])
def test_exact_quantiles(spark, accuracy):
    """A third of the rows are copies of one value; the sketch may be useless."""
    rng = random.Random(accuracy)
    groups = {
        "skewed": [5.0] * 400 + [rng.uniform(-10, 10) for _ in range(800)],
        "one": [3.25],
        "two": [1.0, 2.0],
        "ties": [1.0, 1.0, 2.0, 2.0],
        "heavy tail": [rng.paretovariate(0.5) for _ in range(501)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probabilities = {"low": 0.0, "median": 0.5, "p90": 0.9, "high": 1.0}
    got = exact_quantiles(df, ["g"], "v", probabilities, accuracy).collect()
    assert len(got) == len(groups)
    for r in got:
        for name, p in probabilities.items():
            assert r[name] == pytest.approx(np.quantile(groups[r.g], p), rel=1e-12)
        assert r["median"] == pytest.approx(statistics.median(groups[r.g]), rel=1e-12)
