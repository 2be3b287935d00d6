"""Contract tables from CSV and Parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.schema import CONTRACT_TITLES, CONTRACT_TYPES, DATE_COLUMNS
from waterline.sources.records import CORRUPT, has_breaks, read_records

# Texts read as a missing value.
MISSING_TEXTS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def canonical_name(title: str) -> str:
    title = title.strip()
    plain = re.sub(r"\W+", "_", title).strip("_").lower()
    return CONTRACT_TITLES.get(title, plain)


def read_text_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", unreadable: bool = False) -> DataFrame:
    """A CSV with header, every column as text: no inference pass, and splittable.

    Records may hold line breaks within quotes. With ``unreadable`` a last column has the text of
    records that cannot be read; else they are left out.
    """
    plain = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )
    if not has_breaks(spark, path, encoding):
        return plain.withColumn(CORRUPT, F.lit(None).cast("string")) if unreadable else plain
    records = read_records(spark, path, plain.columns, encoding)
    return records if unreadable else records.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable_records(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """``(record)``: texts of the records that ``read_text_csv`` leaves out."""
    return read_text_csv(spark, path, encoding, unreadable=True).select(F.col(CORRUPT).alias("record")).filter("record is not null")


def read_contracts_csv(
    spark: SparkSession, path: str, numeric: Sequence[str] = (), first: int | None = None
) -> DataFrame:
    """The columns under canonical names; ``first`` keeps so many of the file's only.

    Dates and price stay text until they are cleaned; flag and segment are integers. ``numeric``
    names further columns (canonical names) to read as numbers.
    """
    raw = read_text_csv(spark, path)
    columns = []
    for position, title in enumerate(raw.columns[:first]):
        name = canonical_name(title)
        text = F.col(f"`{title}`")
        value = F.when(~text.isin(*MISSING_TEXTS), text)
        if name in ("test_flag", "cxn_code"):
            value = value.try_cast("double").try_cast("int")
        elif name in numeric:
            value = value.try_cast("double")
        columns.append(value.alias(name or f"column_{position}"))
    return raw.select(*columns)


def read_contracts_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet twin: titles or canonical names, in the types of contracts."""
    raw = spark.read.parquet(path)
    return typed(raw.select(*[F.col(f"`{c}`").alias(canonical_name(c)) for c in raw.columns]))


def typed(df: DataFrame) -> DataFrame:
    """Known columns in their types; a value that does not fit is an error. Text dates stay text."""
    wanted = {}
    for field in df.schema.fields:
        target = CONTRACT_TYPES.get(field.name)
        text_date = field.name in DATE_COLUMNS and field.dataType.simpleString() == "string"
        if target is not None and field.dataType != target and not text_date:
            wanted[field.name] = F.col(field.name).cast(target)
    return df.withColumns(wanted) if wanted else df


def missing_columns(df: DataFrame) -> list[str]:
    """Required input columns the frame lacks."""
    optional = {"package_name", "package_group_raw"}
    return [c for c in CONTRACT_TITLES.values() if c not in optional and c not in df.columns]


def validate(df: DataFrame) -> DataFrame:
    absent = missing_columns(df)
    if absent:
        raise ValueError(f"contract columns missing: {', '.join(absent)}")
    return df
