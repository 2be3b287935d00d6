"""Missing-data profile, sparse-column drop and fills."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waterline.config import SPARSE_PERCENT, UNKNOWN
from waterline.functions.money import parse_currency
from waterline.operators.quantiles import exact_quantiles
from waterline.schema import DATE_COLUMNS, ID_COLUMNS, PACKAGE_COLUMNS, PROTECTED_COLUMNS


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL: both are missing values."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(df.schema[name].dataType, T.DecimalType):
        return F.when(~F.isnan(column), column)
    return column


def missing_profile(df: DataFrame) -> DataFrame:
    """``(column_name, missing_count, missing_percentage, data_type)``, sparsest first.

    One aggregation over all columns; the unpivot afterwards touches a single row.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(known(df, c).isNull()).alias(c) for c in df.columns]
    )
    type_of = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return (
        counts.unpivot("_rows", list(df.columns), "column_name", "missing_count")
        .select(
            "column_name",
            "missing_count",
            F.coalesce(
                F.try_divide(F.col("missing_count") * F.lit(100.0), F.col("_rows")), F.lit(0.0)
            ).alias("missing_percentage"),
            F.element_at(type_of, F.col("column_name")).alias("data_type"),
        )
        .orderBy(F.desc("missing_percentage"), "column_name")
    )


def sparse_columns(profile: DataFrame, protected: Collection[str] = PROTECTED_COLUMNS) -> list[str]:
    """Columns missing in more than half of the rows. Runs the profile: one row per column."""
    sparse = profile.filter(F.col("missing_percentage") > SPARSE_PERCENT)
    return [r.column_name for r in sparse.collect() if r.column_name not in protected]


def drop_sparse_columns(
    df: DataFrame,
    profile: DataFrame | None = None,
    protected: Collection[str] = PROTECTED_COLUMNS,
) -> DataFrame:
    """Drop columns more than half missing, by the given profile (default: of ``df`` itself)."""
    return df.drop(*sparse_columns(profile or missing_profile(df), protected))


def parse_price(df: DataFrame, column: str = "price") -> DataFrame:
    return df.withColumn(column, parse_currency(F.col(column).cast("string")))


def fill_packages(df: DataFrame) -> DataFrame:
    return df.na.fill(UNKNOWN, subset=[c for c in PACKAGE_COLUMNS if c in df.columns])


def fill_text(df: DataFrame, keep_null: Sequence[str] = ()) -> DataFrame:
    """Fill text columns with a placeholder; dates stay NULL even while they are text."""
    skip = {*DATE_COLUMNS, *keep_null}
    text = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    return df.na.fill(UNKNOWN, subset=text)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, median)``, exact; the mean of the middle two for an even count."""
    long = df.select(*[known(df, c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return exact_quantiles(long, ["column_name"], "value", {"median": 0.5})


def fill_medians(
    df: DataFrame, fill_ids: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    """Fill numeric columns with their median.

    Ids (segment, site, test flag) have no meaningful median and stay NULL unless ``fill_ids``.
    Whole-number columns take the median only where it is whole; otherwise they become DOUBLE.
    Medians are computed only for columns with gaps; a median per column comes back, and the fill
    itself is a plain projection.
    """
    wanted = [
        c
        for c in (columns if columns is not None else numeric_columns(df))
        if fill_ids or c not in ID_COLUMNS
    ]
    if not wanted:
        return df
    gaps = df.agg(*[F.count_if(known(df, c).isNull()).alias(c) for c in wanted]).first()
    wanted = [c for c in wanted if gaps[c]]
    if not wanted:
        return df
    found = {r.column_name: r.median for r in medians(df, wanted).collect()}
    filled = {}
    for field in df.schema.fields:
        value = found.get(field.name)
        if value is None:
            continue
        column = known(df, field.name)
        whole = isinstance(field.dataType, T.IntegralType)
        if whole and not float(value).is_integer():
            column, target = column.cast("double"), T.DoubleType()
        else:
            target = field.dataType
        filled[field.name] = F.coalesce(column, F.lit(value).cast(target))
    return df.withColumns(filled) if filled else df


def handle_missing_data(df: DataFrame, fill_ids: bool = False) -> DataFrame:
    """Profile, parse prices, drop sparse columns and fill, in this order.

    The profile describes the frame before prices are parsed.
    """
    profile = missing_profile(df)
    ids = () if fill_ids else ID_COLUMNS
    return (
        df.transform(parse_price)
        .transform(drop_sparse_columns, profile)
        .transform(fill_packages)
        .transform(fill_text, ids)
        .transform(fill_medians, fill_ids)
    )
