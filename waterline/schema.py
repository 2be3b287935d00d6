"""Column names and types: file titles on one side, canonical names on the other."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 2)

# file title -> canonical name, in file order
CONTRACT_TITLES: dict[str, str] = {
    "Account Number": "account_number",
    "Package Name": "package_name",
    "Package Group": "package_group_raw",
    "Package Group Condensed": "package_group",
    "Package Start Date": "start_date",
    "Package End Date": "end_date",
    "Price": "price",
    "WO Type Group": "wo_type_group",
    "Reason Group": "reason_group",
    "Test Flag": "test_flag",
    "CXN Code": "cxn_code",
    "Site": "site",
}

# Derived contract columns and their file titles.
DERIVED_TITLES: dict[str, str] = {
    "Weeks_Key": "week_key",
    "Months_Key": "month_key",
    "Quarters_Key": "quarter_key",
    "Years_Key": "year_key",
    "Churn_Flag": "churn_flag",
    "Churn_Date": "churn_date",
    "Revenue_Category": "revenue_category",
}

# Monthly table, in file order.
MONTHLY_TITLES: dict[str, str] = {
    "Month": "month",
    "Month_Sequential": "month_sequential",
    "Month_Number": "month_number",
    "Starting MRR": "starting_mrr",
    "Starting PARPU": "starting_parpu",
    "Starting Count": "starting_count",
    "New MRR": "new_mrr",
    "New Count": "new_count",
    "New PARPU": "new_parpu",
    "Expansion": "expansion",
    "Expansion Count": "expansion_count",
    "Expansion PARPU": "expansion_parpu",
    "Contraction": "contraction",
    "Contraction Count": "contraction_count",
    "Contraction PARPU": "contraction_parpu",
    "Churn": "churn",
    "Churn Count": "churn_count",
    "Churn PARPU": "churn_parpu",
    "Net New MRR": "net_new_mrr",
    "Net Count": "net_count",
    "Net PARPU": "net_parpu",
    "Ending MRR": "ending_mrr",
    "Ending Count": "ending_count",
    "Ending PARPU": "ending_parpu",
    "ARPU": "arpu",
    "Site_Opens": "site_opens",
    "Base": "base",
    "Cumulative_Base": "cumulative_base",
    "Take_Rate": "take_rate",
}

# Waterfall file: the order differs from the monthly table.
WATERFALL_COLUMNS: tuple[str, ...] = (
    "month",
    "starting_mrr",
    "starting_count",
    "new_mrr",
    "new_count",
    "expansion",
    "expansion_count",
    "contraction",
    "contraction_count",
    "churn",
    "churn_count",
    "net_new_mrr",
    "net_count",
    "ending_mrr",
    "ending_count",
    "month_number",
    "month_sequential",
)

MONTHLY_COUNTS = frozenset(
    c for c in MONTHLY_TITLES.values() if c.endswith("_count")
) | {"month_sequential", "month_number", "site_opens", "base", "cumulative_base"}

MONTHLY_SCHEMA = T.StructType(
    [T.StructField("tier", T.StringType(), False)]
    + [
        T.StructField(
            name,
            T.StringType()
            if name == "month"
            else T.LongType()
            if name in MONTHLY_COUNTS
            else T.DoubleType(),
        )
        for name in MONTHLY_TITLES.values()
    ]
)

PRICE_CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("package", T.StringType(), False),
        T.StructField("effective_date", T.DateType(), False),
        T.StructField("old_price", PRICE, False),
        T.StructField("new_price", PRICE, False),
    ]
)

# Columns later steps need; never dropped for being sparse.
PROTECTED_COLUMNS: frozenset[str] = frozenset(
    {
        "account_number",
        "package_group",
        "start_date",
        "end_date",
        "price",
        "wo_type_group",
        "reason_group",
        "test_flag",
        "cxn_code",
        "site",
    }
)
PACKAGE_COLUMNS = ("package_name", "package_group_raw", "package_group")
ID_COLUMNS = ("cxn_code", "test_flag", "site")
DATE_COLUMNS = ("start_date", "end_date")

CONTRACT_TYPES: dict[str, T.DataType] = {
    "account_number": T.StringType(),
    "package_name": T.StringType(),
    "package_group_raw": T.StringType(),
    "package_group": T.StringType(),
    "start_date": T.DateType(),
    "end_date": T.DateType(),
    "price": PRICE,
    "wo_type_group": T.StringType(),
    "reason_group": T.StringType(),
    "test_flag": T.IntegerType(),
    "cxn_code": T.IntegerType(),
    "site": T.StringType(),
}
