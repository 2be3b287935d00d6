"""The driver's tables as contracts, sites and price changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import SEGMENTS, RunConfig
from waterline.operators.pricing import PriceChange, price_changes

# All part types but SMALL stand for core packages.
PACKAGES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "STANDARD")
AS_OF = dt.date(2005, 1, 1)
# Before the last starts and ends: open contracts that start later than the analysis date.
EARLY_AS_OF = dt.date(1999, 1, 1)

CONFIG = RunConfig(as_of=AS_OF, core_packages=PACKAGES)
EARLY_CONFIG = RunConfig(as_of=EARLY_AS_OF, core_packages=PACKAGES)

CHANGES: list[PriceChange] = price_changes(
    [
        ("PROMO", "1997-03-15", "50.99", "55.99"),
        ("PROMO", "1998-07-01", "50.99", "59.99"),
        ("ECONOMY", "1998-07-01", "60.99", "64.99"),
        ("LARGE", "1999-01-01", "40.99", "45.99"),
    ]
)

CONTRACT_COLUMNS = """
  concat('A', cast(o_custkey as string)) as account_number,
  p_type as package_group,
  case when o_custkey % 3 = 0 and o_orderpriority = '4-NOT SPECIFIED' then 'Change of Service'
       when o_orderpriority = '5-LOW' then 'Disconnect' else 'Activate' end as wo_type_group,
  case l_returnflag when 'A' then 'Upgrade' when 'R' then 'Downgrade' else 'Other' end
    as reason_group,
  cast(l_shipdate as date) as start_date,
  case when o_custkey % 4 = 1 and l_linestatus = 'O' then cast(null as date)
       when o_custkey % 4 = 2 and l_linestatus = 'O' and l_returnflag = 'N'
         then date '2999-12-31'
       else cast(cast(l_shipdate as date) + cast(l_quantity as int) * 20 * interval '1' day
                 as date) end as end_date,
  cast(cast(40.99 as decimal(18,2)) + cast(l_quantity as int) % 8 * 5 as decimal(18,2)) as price,
  case when l_tax >= 0.08 then 1 else 0 end as test_flag,
  cast(o_custkey % 53 + 1 as int) as cxn_code,
  cast(l_suppkey as string) as site,
  l_orderkey as order_key,
  l_linenumber as line_number,
  l_partkey as part_key
"""
# Adding days as days spares Spark the general interval arithmetic.
_INTERVAL = "cast(cast(l_shipdate as date) + cast(l_quantity as int) * 20 * interval '1' day\n                 as date)"
SPARK_COLUMNS = CONTRACT_COLUMNS.replace(
    _INTERVAL, "date_add(cast(l_shipdate as date), cast(l_quantity as int) * 20)"
)
assert SPARK_COLUMNS != CONTRACT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    # the join below needs this partitioning anyway; asked for here, one small file is spread too
    lines = lines.repartition("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).selectExpr(*_split(SPARK_COLUMNS))


def _split(columns: str) -> list[str]:
    """The expressions of a select list, one per `` as name,``."""
    parts, depth, current = [], 0, ""
    for ch in columns.strip():
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return [*parts, current.strip()]


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts as a file would hold them: text price, gaps in the columns, a sparse column."""
    first = F.col("line_number") == 1
    gaps = {
        c: F.when(first, None).otherwise(F.col(c))
        for c in ("package_group", "reason_group", "test_flag", "cxn_code")
    }
    junk = (
        F.when(F.col("line_number") == 2, F.lit("(5)"))
        .when(F.col("line_number") == 3, F.lit("-"))
        .when(F.col("line_number") == 4, F.concat(F.lit("$1,"), F.col("price").cast("string")))
        .otherwise(F.concat(F.lit("$"), F.col("price").cast("string"), F.lit(" ")))
    )
    rows = _star(spark, sf_dir).selectExpr(
        *_split(SPARK_COLUMNS),
        "case when l_linenumber = 1 then null else l_discount end as discount",
        "case when l_quantity > 20 then null else l_tax end as tax",
    )
    return rows.withColumns(gaps).withColumn("price", junk)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form, one row per supplier and segment."""
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("segment", F.explode(F.sequence(F.lit(SEGMENTS[0]), F.lit(SEGMENTS[-1]))))
        .selectExpr(
            "cast(s_suppkey as string) as site",
            "cast(date '1994-06-01' + cast(s_suppkey % 90 as int) * interval '1' month as date)"
            " as release_date",
            "segment as cxn_code",
            "cast((s_suppkey * 7 + segment * 13) % 200 as bigint) as base",
        )
    )


# A change of one package per order, between 800 prices; Spark and DuckDB read the same text.
LONG_CHANGES = """
  select cast(o_orderkey as bigint) as seq, 'PROMO' as package, cast(o_orderdate as date) as effective_date,
    cast(40.99 + cast(o_custkey % 800 as decimal(18,2)) * 0.05 as decimal(18,2)) as old_price,
    cast(40.99 + cast(o_orderkey % 800 as decimal(18,2)) * 0.05 as decimal(18,2)) as new_price
  from orders
"""


def long_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many changes of one package as there are orders."""
    return spark.sql(LONG_CHANGES.replace("from orders", "from {orders}"), orders=table(spark, sf_dir, "orders"))
