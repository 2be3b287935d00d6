"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same number of expected copies, the source's target over
its size. Documents stand in order of their size; the running sum of expected copies plus one
random offset crosses integers, and a document is taken once for each integer it crosses. Size
order makes the words taken differ from the target by at most about one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import same

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"
# Hex digits of a hash of the id that split rows of equal source and size: 4,096 groups.
DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Targets of the sources in ``sizes(source, source_size)``, a row per source.

    ``share`` of all sizes is dealt by weight; no target exceeds ``cap`` times its source's size and
    the excess is dealt again by weight. That ends where every source below its cap has the same
    target per weight: with sources in order of cap per weight, the first that stays below its cap
    tells how much. Sources weigh ``weights`` in code-point order, repeating, null last.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    out = sizes.withColumn("weight", F.element_at(listed, place + 1)).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("per_weight", left / weight_left)
    out = out.withColumn("below", F.col("most") > F.col("per_weight") * F.col("weight"))
    level = F.max(F.when(F.col("below"), F.col("per_weight"))).over(everything)
    target = F.when(F.col("below"), level * F.col("weight")).otherwise(F.col("most"))
    return out.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """One offset in [0, 1) per source, the same in every run."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\x00"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def id_hash(doc_id: Column) -> Column:
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, DIGITS)


def with_copies(docs: DataFrame, size: Column, **settings) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to every row of ``docs``.

    ``docs`` has ``doc_id`` and ``source``; ``size`` counts a document's words. Rows are ranked
    within (source, size, hash of the id) and the counts of these groups are summed up in two
    steps, so a hot source or a hot size never stands in one task. Equal rows share the copies of
    their ranks. ``docs`` is read twice and must give the same rows both times.
    """
    rows = docs.withColumn("size", size.cast("long")).withColumn("__hash", id_hash(F.col("doc_id")))
    groups = rows.groupBy("source", "size", "__hash").agg(F.count("*").alias("n"))
    by_size = groups.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sources, **settings)

    before = Window.unboundedPreceding, -1
    sizes = by_size.select(
        "source",
        "size",
        F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("size").rowsBetween(*before)), F.lit(0)).alias("smaller"),
    )
    sizes = sizes.join(targets, same(sizes, targets, "source")).drop(targets["source"])
    within = Window.partitionBy("source", "size").orderBy("__hash").rowsBetween(*before)
    groups = groups.select("source", "size", "__hash", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("earlier"))
    groups = groups.join(sizes, same(groups, sizes, "source", "size")).drop(sizes["source"], sizes["size"])

    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy("source", "size", "__hash").orderBy("doc_id")))
    out = ranked.join(groups, same(ranked, groups, "source", "size", "__hash"))
    out = out.drop(groups["source"], groups["size"], groups["__hash"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place = F.col("smaller") + F.col("earlier") + F.col("__rank")
    u = offset(F.col("source"))
    copies = F.floor(place * rate + u) - F.floor((place - 1) * rate + u)
    return out.withColumn("copies", copies.cast("long")).drop("__hash", "__rank", "smaller", "earlier")


def mix(docs: DataFrame, size: Column, **settings) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its own columns only.

    Nulls: a null source is a source of its own, the last; null texts have size 0 and follow the
    rate of their source. An empty table gives no rows. Extra columns are carried along, whatever
    their names: the work is done on a struct of them.
    """
    names = docs.columns
    packed = docs.select("doc_id", "source", F.struct(*[docs[n] for n in names]).alias("row"), size.alias("words"))
    taken = with_copies(packed, F.col("words"), **settings).filter("copies > 0")
    copies = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copies.select("row.*")
