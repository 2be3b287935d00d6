"""Sharding by a hierarchical weighted hash tree of regions, racks and shards.

A row descends the tree: at each level every child draws a weighted hash of the row's key, and the
smallest draw wins. A shard draws by its own path and weight, a rack or region of a fixed weight by
its own too, and any other node by the smallest draw of its children, which is a draw by the sum of
their weights. So the draws of all nodes but the changed shard and those above it stay what they
were: a change of a shard's weight, or a new shard, moves rows into or out of that shard only, and
below a node of fixed weight only within that node.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.sources.staging import materialise

LAW = "key"


@dataclass(frozen=True)
class Leaf:
    """A shard and the place it has in the tree."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Shards with their weights. A rack or region weighs what its shards weigh unless ``fixed``.

    ``fixed`` maps ``region`` or ``region/rack`` to a weight; with it, a change below that node
    stays below it. Nodes without a shard of positive weight take no part.
    """

    leaves: tuple[Leaf, ...]
    fixed: dict[str, float] = field(default_factory=dict)

    def children(self) -> list[dict[str, dict[str, list[tuple[str, float]]]]]:
        """For each level, the parent's path with its children's paths, and what draws for each child.

        That is the nodes ``(path, weight)`` nearest to the child, it included, that have a weight of
        their own: the child if it is a shard or fixed, else those of its children.
        """
        levels: list[dict[str, dict[str, list[tuple[str, float]]]]] = [{}, {}, {}]
        for leaf in self.leaves:
            paths = [leaf.region, f"{leaf.region}/{leaf.rack}", f"{leaf.region}/{leaf.rack}/{leaf.shard}"]
            if leaf.weight <= 0 or any(self.fixed.get(p, 1.0) <= 0 for p in paths):
                continue
            drawing = (paths[2], leaf.weight)
            for level, parent, child in reversed(list(zip(levels, ["", *paths], paths, strict=False))):
                if child in self.fixed:
                    drawing = (child, self.fixed[child])
                drawn = level.setdefault(parent, {}).setdefault(child, [])
                if drawing not in drawn:
                    drawn.append(drawing)
        return levels


def even_tree(shards: Iterable[int], racks: int = 2, per_rack: int = 2) -> Tree:
    """Equal shards in order: ``per_rack`` to a rack and ``racks`` to a region.

    The tree of a few more shards has the same nodes and some new ones, and takes rows only into those.
    """
    leaves = []
    for shard in shards:
        rack = shard // per_rack
        leaves.append(Leaf(shard, f"region{rack // racks}", f"rack{rack % racks}"))
    return Tree(tuple(leaves))


def _draw(key: Column, parent: Column, level: dict[str, dict[str, list[tuple[str, float]]]]) -> Column:
    """The child of ``parent`` with the smallest weighted draw."""
    options = []
    for path, children in level.items():
        listed = [
            F.struct(F.lit(child).alias("child"), F.lit(p).alias("path"), F.lit(float(w)).alias("weight"))
            for child, drawing in children.items()
            for p, w in drawing
        ]
        options += [F.lit(path), F.array(*listed)]

    def cost(node: Column) -> Column:
        # uniform in (0, 1) from the upper 53 bits; -ln(u) / w is an exponential draw of rate w
        uniform = (F.shiftrightunsigned(F.xxhash64(key, node["path"]), 11) + F.lit(0.5)) / F.lit(2.0**53)
        return F.struct((-F.log(uniform) / node["weight"]).alias("cost"), node["path"].alias("path"), node["child"].alias("child"))

    drawn = F.transform(F.element_at(F.create_map(*options), parent), cost)
    return F.array_min(drawn)["child"]


def with_shard(df: DataFrame, key: Column, tree: Tree, name: str) -> DataFrame:
    """Add the shard of every row. Null keys draw like one key of their own."""
    paths = [f"__{name}_{i}" for i in range(3)]
    out, parent = df, F.lit("")
    for path, level in zip(paths, tree.children(), strict=True):
        out = out.withColumn(path, _draw(key, parent, level))
        parent = F.col(path)
    shard = F.element_at(F.split(parent, "/"), -1).cast("int")
    return out.withColumn(name, shard).drop(*paths)


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """Place every document; one row per row of ``docs``.

    ``doc_id`` is the key. ``slot`` numbers a shard's rows from 0 without gaps: rows are numbered
    within the part of the table one task wrote, and parts are laid end to end by their counts, so
    neither a large shard nor a repeated key meets in one task.

    Nulls: a null text has size 1 and the checksum of no bytes; null ids go to one shard like any
    repeated id. Repeated rows keep a row and slot each. An empty table gives no rows. Other columns
    of ``docs`` are not read.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("seq"),
    )
    rows = with_shard(rows, F.col("doc_id"), tree, "shard")
    rows = materialise(with_shard(rows, F.col("doc_id"), grown, "grown_shard"), "shards")

    in_order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("start"))
    )
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("seq"))
    return (
        rows.withColumn("rank", rank)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            "shard",
            (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )
