"""CSV records with line breaks inside quotes, without reading a file in one task.

A line ends a record if the quotes before its end, from the file's beginning on, are even in number.
Every file split counts its quotes; sums over the splits of a file tell each split whether it begins
inside quotes and how many records began before. Files are read split by split, lines of a record
meet in one group, and only records of several lines are shuffled together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waterline.sources.staging import materialise

CORRUPT = "_unreadable"


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``(file, split, at, text, quotes)`` of every line; line ends within quotes stay as they are."""
    raw = spark.read.option("lineSep", "\n").text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # grows with the place within a split
        F.monotonically_increasing_id().alias("at"),
        text.alias("text"),
    )
    return lines.withColumn("quotes", F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit(""))))


def has_breaks(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> bool:
    """Whether any line of the files has an odd number of quotes, so that a record goes on after it."""
    return not _lines(spark, path, encoding).filter(F.col("quotes") % 2 == 1).isEmpty()


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with ``record``, their record's number within the file from 1 on, ``lines`` of the record
    and ``whole``, whether the record's quotes are closed."""
    within = Window.partitionBy("file", "split").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = materialise(lines.withColumn("inside", before % 2), "csv-lines")
    splits = local.groupBy("file", "split").agg(
        F.sum("quotes").alias("sum"), F.count_if(F.col("inside") == 0).alias("even"), F.count_if(F.col("inside") == 1).alias("odd")
    )
    # a row per split
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy("file")
    splits = splits.withColumn("carried", F.coalesce(F.sum("sum").over(earlier), F.lit(0)) % 2)
    began = F.when(F.col("carried") == 0, F.col("even")).otherwise(F.col("odd"))
    splits = splits.withColumn("offset", F.coalesce(F.sum(began).over(earlier), F.lit(0)))
    splits = splits.withColumn("records", F.sum(began).over(everywhere)).withColumn("closed", F.sum("sum").over(everywhere) % 2 == 0)
    placed = local.join(splits.select("file", "split", "carried", "offset", "records", "closed"), ["file", "split"])
    begins = ((F.col("inside") + F.col("carried")) % 2 == 0).cast("int")
    record = F.col("offset") + F.sum("begins").over(within)
    numbered = placed.withColumn("begins", begins).withColumn("record", record)
    # quotes that never close leave the last record of a file open
    whole = F.col("closed") | (F.col("record") < F.col("records"))
    return numbered.select("file", "split", "at", "record", "text", whole.alias("whole"), ((F.col("begins") == 1) & (F.col("quotes") % 2 == 0)).alias("single"))


def read_records(spark: SparkSession, path: str, names: list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """The files' records as text columns, the header of each file left out.

    ``_unreadable`` holds the text of a record that has more fields than the header or, line by line,
    what follows a quote that is never closed; it is null for all others. Fields that are missing at
    the end are null.
    """
    numbered = _numbered(_lines(spark, path, encoding)).filter("record > 1")
    single = numbered.filter("single and whole").select("text", "whole")
    parts = F.array_sort(F.collect_list(F.struct("split", "at", "text")))
    several = numbered.filter("not single and whole").groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p.text), "\n").alias("text"))
    lost = numbered.filter("not whole").select("text", "whole")
    records = single.unionByName(several.select("text", F.lit(True).alias("whole"))).unionByName(lost)
    records = records.withColumn("text", F.regexp_replace("text", r"\r\z", "")).filter("length(text) > 0")
    # one column more shows records with too many fields
    fields = [f"f{i}" for i in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, "beyond"])
    options = {"escape": '"', "maxCharsPerColumn": "-1"}
    parsed = records.withColumn("r", F.when(F.col("whole"), F.from_csv("text", schema, options)))
    unreadable = F.when(~F.col("whole") | F.col("r.beyond").isNotNull(), F.col("text"))
    readable = unreadable.isNull()
    columns = [F.when(readable, F.col(f"r.{f}")).alias(name) for f, name in zip(fields, names, strict=True)]
    return parsed.select(*columns, unreadable.alias(CORRUPT))
