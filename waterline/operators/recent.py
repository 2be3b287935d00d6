"""The last rows of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def last_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` last rows of each group in ascending order of ``order``; nulls come first.

    Tasks pass on ``n`` rows of a group at most, so no group is shuffled whole. Rows that tie at the
    edge are told apart by their other columns where those can be sorted.
    """
    if n < 1:
        raise ValueError("at least one row")
    rest = [f.name for f in df.schema if f.name not in (*by, *order) and f.dataType.typeName() not in ("map", "variant")]
    ranked = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *rest)])
    return df.withColumn("_place", F.row_number().over(ranked)).filter(F.col("_place") <= n).drop("_place")
