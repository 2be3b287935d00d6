"""Near-duplicate detection with bottom-k sketches.

A document is the set of its word shingles under one hash function; its sketch is the ``k`` smallest
hashes. Equal sets are one class from the start, so copies cost nothing more. Classes whose sketches
overlap meet in inverted lists of the retained hashes, rarest first: sets as similar as asked share
far more than ``OVERLAP`` of a sketch, so the commonest hashes of a sketch need no lists and a
passage that many documents share makes none.

Links are then found in two rounds. In the first, every list tests its most central member against
the others, which joins groups of near copies without all their pairs. In the second, lists with
members of different components are gone through exactly: the members' full sets stand in order of
rarity, two sets as similar as asked must share one of the rarest elements of both, at positions
that leave enough elements behind, and pairs across components that do are tested. A pair is
estimated on the sketch of the union before its full sets are compared, and only the exact
comparison makes a link.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import prepare, same
from waterline.sources.staging import materialise

WORDS, PERCENT, SKETCH = 5, 80, 64
# Share of a sketch that two linked sets have in common at least. For sets at 80 % the expected
# share is 80 %; fewer than 26 of 64 has a probability below 3e-11.
OVERLAP = 0.4


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct shingles in ascending order.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Fewer words than
    ``size`` are one shingle; no words are none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(size, len(words))
    joined = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        joined = _mixed(joined * np.uint64(0x9E3779B97F4A7C15) + hashed[i : len(words) - size + 1 + i])
    return np.unique(joined.view(np.int64))


def _digests(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    plain = values.view(np.uint64)
    return tuple(int(_mixed(plain + np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for salt in (1, 0x51ED270B0A1F39C1))


def _list_column(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _sketched(batches: Iterable[pa.RecordBatch], size: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, first, second, kept = [], [], [], []
        for text in batch.column(3):
            values = shingles(text.as_py() or "", size)
            digests = _digests(values)
            counts.append(len(values))
            first.append(digests[0])
            second.append(digests[1])
            kept.append(values[:k])
        columns = [*batch.columns[:3], pa.array(counts, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, _list_column(kept)], names=["row", "doc_id", "text_hash", "n", "d1", "d2", "sketch"])


def _full_sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(text.as_py() or "", size) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), _list_column(sets)], names=["node", "n", "shingles"])


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sketches(docs: DataFrame, size: int, k: int) -> DataFrame:
    """One row per row of ``docs``: its number, id, text hash, set size, set digest and sketch."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_hash(F.col("text")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    ddl = "row long, doc_id long, text_hash long, n long, d1 long, d2 long, sketch array<long>"
    return rows.mapInArrow(lambda batches: _sketched(batches, size, k), ddl)


def _needed(size: Column) -> Column:
    """How many of a sketch of this size a linked set shares at least."""
    return F.ceil(size * F.lit(OVERLAP))


def inverted_lists(classes: DataFrame, k: int) -> DataFrame:
    """``(value, node, n, central)``: for each retained hash the classes that must list it.

    ``central`` is how many sketches share a member's hashes, summed over its hashes.
    """
    postings = classes.select("node", "n", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    mine = Window.partitionBy("node")
    size = F.least(F.col("n"), F.lit(k))
    return (
        postings.join(shared, "value")
        .withColumn("place", F.row_number().over(mine.orderBy("df", "value")))
        .withColumn("seen", F.count("*").over(mine))
        .withColumn("central", F.sum("df").over(mine))
        # hashes of this class only come first and need no list
        .filter(size - F.col("seen") + F.col("place") <= size - _needed(size) + 1)
        .select("value", "node", "n", "central")
    )


def _alike_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's most central member with every other member."""
    centers = lists.groupBy("value").agg(F.max(F.struct("central", (-F.col("node")).alias("minus"), "n")).alias("c"))
    centers = centers.select("value", (-F.col("c.minus")).alias("a"), F.col("c.n").alias("na"))
    pairs = lists.join(centers, "value").filter((F.col("node") != F.col("a")) & _alike_sizes(F.col("n"), F.col("na"), percent))
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    # sets are in ascending order, so a sketch is a set's beginning
    first, second = F.slice("sa", 1, k), F.slice("sb", 1, k)
    union = F.slice(F.array_sort(F.array_union(first, second)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(union, first), second))
    likely = common >= _needed(F.size(union))
    shared = F.size(F.array_intersect("sa", "sb"))
    exact = (100 + percent) * shared >= percent * (F.col("na") + F.col("nb"))
    return both.filter(F.when(likely, exact).otherwise(False)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node in ``edges(a, b)`` but the roots: the least node reachable.

    Alternates two steps until nothing changes: all larger neighbours of a node, then all smaller
    ones, are linked to its least neighbour. Each turn is written, so no lineage builds up.
    """

    def step(links: DataFrame, both_ways: bool) -> DataFrame:
        ends = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else links
        least = ends.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        moved = ends.join(least, "u")
        if both_ways:
            out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        else:
            out = moved.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", F.col("least").alias("v")))
        return out.distinct()

    def state(links: DataFrame):
        return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    links = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before, now = None, state(links)
    while before != now:
        links = materialise(step(step(links, True), False), "links")
        before, now = now, state(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def remaining_pairs(lists: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may be linked, by rarest elements of the full sets."""
    members = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = members.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("value")
    live = members.join(mixed, "value", "left_semi").select("node", "root").distinct()

    elements = sets.join(live, "node").select("node", "root", "n", F.explode("shingles").alias("value"))
    shared = elements.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    mine = Window.partitionBy("node")
    placed = (
        elements.join(shared, "value")
        .withColumn("left", F.count("*").over(mine) - F.row_number().over(mine.orderBy("df", "value")) + 1)
        # so many elements, this one and those after it, can still be shared
        .filter(100 * F.col("left") >= percent * F.col("n"))
        .select("value", "node", "root", "n", "left")
    )
    placed = materialise(placed, "rarest")

    by_root = placed.groupBy("value", "root").agg(F.count("*").alias("members"))
    main = by_root.groupBy("value").agg(F.max(F.struct("members", "root")).alias("m"), F.count("*").alias("roots")).filter("roots > 1")
    main = main.select("value", F.col("m.root").alias("main"))
    placed = placed.join(main, "value")
    # two members of a list's main component need no test, so those outside it ask
    ask = placed.filter("root <> main").select("value", *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "n", "left")])
    pairs = ask.join(
        placed,
        (ask["value"] == placed["value"])
        & (F.col("root_a") != F.col("root"))
        & ((F.col("root") == F.col("main")) | (F.col("node_a") < F.col("node")))
        & _alike_sizes(F.col("n_a"), F.col("n"), percent)
        & ((100 + percent) * F.least("left_a", "left") >= percent * (F.col("n_a") + F.col("n"))),
    )
    return pairs.select(F.least("node_a", "node").alias("a"), F.greatest("node_a", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, k: int = SKETCH) -> DataFrame:
    """``(row, doc_id, text_hash, n_shingles, component_id, root)``, one row per row of ``docs``.

    ``component_id`` is the least id of the documents reachable over links, ``root`` tells
    components apart even where ids repeat. Documents are linked if ``100 * intersection >= percent *
    union`` of their shingle sets; ones without words have no links. Null ids count only where a
    component has no other. ``docs`` is read twice and must give the same rows both times.
    """
    rows = materialise(sketches(docs, words, k), "sketches")
    digest = ["d1", "d2", "n"]
    classes = rows.filter("n > 0").groupBy(*digest).agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    classes = materialise(classes, "classes")
    shown = rows.select("row", "doc_id", "text_hash", "sketch").join(classes.select("n", "node"), F.col("row") == F.col("node"))
    shown = shown.select("node", "n", "doc_id", "text_hash", "sketch")
    lists = materialise(inverted_lists(shown, k), "lists")

    wanted = lists.groupBy("value").agg(F.count("*").alias("members")).filter("members > 1")
    wanted = lists.join(wanted, "value", "left_semi").select("node").distinct()
    wanted = rows.select(F.col("row").alias("node"), "doc_id", "text_hash").join(wanted, "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    found = texts.join(wanted, same(texts, wanted, "doc_id", "text_hash")).select("node", "text")
    found = found.dropDuplicates(["node"])
    sets = materialise(found.mapInArrow(lambda batches: _full_sets(batches, words), "node long, n long, shingles array<long>"), "sets")

    links = materialise(linked(star_pairs(lists, percent), sets, percent, k), "star_links")
    roots = components(links)
    more = materialise(linked(remaining_pairs(lists, sets, roots, percent), sets, percent, k), "more_links")
    if more.take(1):
        # components of components: what is settled stays settled
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))

    settled = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = settled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    settled = settled.join(least, "root").select(*digest, "root", "component_id")
    out = rows.select("row", "doc_id", "text_hash", *digest).join(settled, digest, "left")
    return out.select(
        "row",
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("root", "row").alias("root"),
    )


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The component of every document; one row per row of ``docs``.

    Nulls: a null text is an empty one, linked with nothing; a null id is kept only where its
    component has no other. Rows that repeat an id and a text are copies; rows that repeat an id with
    another text are documents of their own. An empty table gives no rows. Other columns of ``docs``
    are not read.
    """
    found = near_duplicates(docs, words, percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one with the least id.

    All columns stay. Rows that agree in id and text are one document, so exactly one stays.
    """
    found = near_duplicates(docs, words, percent)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    stays = found.groupBy("root").agg(best.alias("s")).select("s.id", "s.hash").distinct()
    names = docs.columns
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_hash(docs["text"]).alias("hash"), F.struct(*[docs[n] for n in names]).alias("row"))
    rows = rows.join(stays, same(rows, stays, "id", "hash"), "left_semi")
    once = Window.partitionBy("id", "hash").orderBy("row")
    return rows.withColumn("copy", F.row_number().over(once)).filter("copy = 1").select("row.*")
