"""Performance tiers: named groups of segments, many-to-many, plus the full set of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waterline.config import FULL, TIER_SEGMENTS


def tier_bridge(
    spark: SparkSession, tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS
) -> DataFrame:
    """``(tier, cxn_code)``, one row per segment of a tier."""
    rows = [(tier, int(code)) for tier, codes in tiers.items() for code in codes]
    return spark.createDataFrame(rows, "tier string, cxn_code int")


def tiers_of(cxn_code: Column, tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS) -> Column:
    """Array of the tiers a segment belongs to, ``Full`` first."""
    members: dict[int, list[str]] = {}
    for tier, codes in tiers.items():
        for code in codes:
            members.setdefault(int(code), []).append(tier)
    full = f"array({_text(FULL)})"
    if not members:
        return F.expr(full)
    # One constant map, parsed in one go: a call per entry would cost more than the query's plan.
    entries = ", ".join(
        f"{code}, array({', '.join(_text(n) for n in names)})"
        for code, names in sorted(members.items())
    )
    none = F.expr("cast(array() AS array<string>)")
    found = F.try_element_at(F.expr(f"map({entries})"), cxn_code)
    return F.concat(F.expr(full), F.coalesce(found, none))


# Tiers in one whole number of :func:`tier_bits`.
BITS = 62


def tier_bits(cxn_code: Column, tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS) -> list[Column]:
    """The tiers a segment belongs to, without ``Full``, as bits of whole numbers of ``BITS`` tiers each.

    Sets of tiers unite by ``bit_or``; :func:`tiers_of_bits` has their names.
    """
    out = []
    for low in range(0, len(tiers), BITS):
        bits: dict[int, int] = {}
        for place, codes in enumerate(list(tiers.values())[low : low + BITS]):
            for code in codes:
                bits[int(code)] = bits.get(int(code), 0) | 1 << place
        entries = ", ".join(f"{code}, {value}L" for code, value in sorted(bits.items()))
        found = F.try_element_at(F.expr(f"map({entries})"), cxn_code) if bits else F.lit(None)
        out.append(F.coalesce(found.cast("bigint"), F.lit(0).cast("bigint")))
    return out


def tiers_of_bits(bits: Sequence[Column], tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS) -> Column:
    """Array of the tiers of sets of :func:`tier_bits`, ``Full`` first."""
    names = [
        F.when(bits[n // BITS].bitwiseAND(F.lit(1 << n % BITS).cast("bigint")) != 0, F.lit(name)) for n, name in enumerate(tiers)
    ]
    return F.array_distinct(F.array_compact(F.array(F.lit(FULL), *names)))


def _text(name: str) -> str:
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def add_tiers(df: DataFrame, tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS) -> DataFrame:
    """One copy of a row per tier it belongs to. Narrow: no join and no shuffle."""
    return df.withColumn("tier", F.explode(tiers_of(F.col("cxn_code"), tiers)))


def filter_on_tier(
    df: DataFrame, tier: str, tiers: Mapping[str, Sequence[int]] = TIER_SEGMENTS
) -> DataFrame:
    if tier == FULL:
        return df
    if tier not in tiers:
        raise ValueError(f"unknown performance tier: {tier}")
    return df.filter(F.col("cxn_code").isin(*[int(c) for c in tiers[tier]]))
