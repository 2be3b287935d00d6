"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings.

Each node has a few split points; a row goes down to the nearest. For every split point the node knows
the least and greatest distance to the rows of each sibling. A search wants the rows whose inner
product with the anchor lies in a window, which is an annulus of distances around the anchor: a sibling
whose ranges miss the annulus, seen from any split point, is left out with all below it. What is left
is computed exactly in the leaves.

The tree is fitted on a bounded sample; ranges, leaves and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.blocks import inner_products, matrix, pass_by
from waterline.llm.tables import prepare
from waterline.sources.staging import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
# Rows the split points are chosen from; children of a node; levels at most (4096 leaves).
SAMPLE_ROWS, ARITY, MOST_LEVELS = 4096, 8, 4
# Rows of a leaf that call for another level, and of a block of a leaf beyond the last level.
LEAF_ROWS, BLOCK_ROWS = 2048, 8192
# Candidates for a node's split points, of which the farthest from one another are taken.
CANDIDATES = 3 * ARITY
# Stands for a null id in the order of ties.
LAST_ID = 2**63 - 1
# What rounding may take from a distance, as a share of the greatest norm.
ROUNDING = 1e-6


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(squares, 0.0))


def _split_points(rows: np.ndarray) -> np.ndarray:
    """Rows far from one another, by turns the farthest from those taken."""
    candidates = rows[:CANDIDATES]
    taken = [0]
    nearest = _distances(candidates, candidates[:1])[:, 0]
    while len(taken) < min(ARITY, len(candidates)) and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(candidates, candidates[taken[-1:]])[:, 0])
    return candidates[taken]


class Tree:
    """Split points of a complete tree, children of node n from ``n * ARITY + 1`` on; later its ranges."""

    def __init__(self, sample: np.ndarray, levels: int) -> None:
        self.width, self.levels = sample.shape[1], levels
        self.first_leaf = sum(ARITY**n for n in range(levels))
        self.points: list[np.ndarray] = []
        held = {0: sample}
        for node in range(self.first_leaf):
            rows = held.pop(node)
            self.points.append(_split_points(rows) if len(rows) else np.zeros((1, self.width)))
            child = _distances(rows, self.points[node]).argmin(axis=1) if len(rows) else np.zeros(0, int)
            for i in range(ARITY):
                held[node * ARITY + 1 + i] = rows[child == i]
        shape = (self.first_leaf, ARITY, ARITY)
        self.near, self.far = np.full(shape, np.inf), np.full(shape, -np.inf)
        self.norms = np.full((self.first_leaf, ARITY, 2), [np.inf, -np.inf])

    def descend(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each node with rows: their positions, distances to its points and children."""
        at = np.zeros(len(rows), dtype=np.int64)
        for _ in range(self.levels):
            below = np.empty_like(at)
            for node in np.unique(at):
                here = np.flatnonzero(at == node)
                away = _distances(rows[here], self.points[node])
                child = away.argmin(axis=1)
                below[here] = node * ARITY + 1 + child
                yield int(node), here, away, child
            at = below

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        for node, here, _, child in self.descend(rows):
            at[here] = node * ARITY + 1 + child
        return at - self.first_leaf

    def widen(self, rows: np.ndarray) -> None:
        """Take rows into the ranges."""
        norms = np.sqrt((rows**2).sum(axis=1))
        for node, here, away, child in self.descend(rows):
            for j in np.unique(child):
                mine, norm, n = away[child == j], norms[here[child == j]], len(self.points[node])
                self.near[node, :n, j] = np.minimum(self.near[node, :n, j], mine.min(axis=0))
                self.far[node, :n, j] = np.maximum(self.far[node, :n, j], mine.max(axis=0))
                low, high = self.norms[node, j]
                self.norms[node, j] = min(low, norm.min()), max(high, norm.max())

    def meet(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
        """Positions of the queries that each leaf may answer; windows of products as (query, window)."""
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * ARITY**self.levels
        squares = (queries**2).sum(axis=1)
        greatest = max(np.sqrt(squares.max(initial=0.0)), self.norms[0, :, 1].max(), 0.0)
        slack = ROUNDING * greatest + 1e-6
        alive = {0: np.arange(len(queries))}
        for node in range(self.first_leaf):
            here = alive.pop(node, None)
            if here is None:
                continue
            points = self.points[node]
            away = _distances(queries[here], points)
            for j in np.flatnonzero(self.norms[node, :, 1] >= 0):
                near, far = self.near[node, : len(points), j], self.far[node, : len(points), j]
                least, most = self.norms[node, j] ** 2
                inner = np.sqrt(np.maximum(squares[here, None] + least - 2 * high[here], 0.0))
                outer = squares[here, None] + most - 2 * low[here]
                reach = np.sqrt(np.maximum(outer, 0.0))
                # an axis each for queries, windows and split points
                to, reach, inner = away[:, None, :], reach[:, :, None], inner[:, :, None]
                hit = (near <= to + reach + slack) & (far >= to - reach - slack) & (far >= inner - to - slack)
                # a product beyond what norms allow is in no window
                hit = (hit.all(axis=2) & (outer >= -slack * greatest) & (low[here] <= high[here])).any(axis=1)
                child = node * ARITY + 1 + j
                if child >= self.first_leaf:
                    out[child - self.first_leaf] = here[hit]
                elif hit.any():
                    alive[child] = here[hit]
        return out


def usable_rows(embeddings: DataFrame, change: int | None = None) -> DataFrame:
    """``(id, label, vector, width)`` of whole numbers; rows without label or usable vector leave.

    ``change``: the label of rows whose id it divides goes up by one, modulo ten.
    """
    number = F.transform("embedding", lambda x: x.cast("double"))

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    identity, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    if change:
        label = F.when(identity % change == 0, (label + 1) % 10).otherwise(label)
    return (
        embeddings.select(F.coalesce(identity, F.lit(LAST_ID)).alias("id"), label.alias("label"), number.alias("number"))
        .filter(F.col("label").isNotNull() & F.col("number").isNotNull() & ~F.exists("number", unusable))
        .select("id", "label", F.transform("number", lambda x: F.floor(x * SCALE).cast("long")).alias("vector"))
        .withColumn("width", F.size("vector"))
    )


def _fit(rows: DataFrame) -> tuple[Tree, pd.DataFrame]:
    """Tree on a sample of the commonest width, with the sample."""
    counts = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    width, count = (counts["width"], counts["count"]) if counts else (0, 0)
    sample = rows.filter(F.col("width") == width).orderBy(F.xxhash64("id", "vector"), "id", "rid").limit(SAMPLE_ROWS).toPandas()
    levels = 1
    while count > LEAF_ROWS * ARITY**levels and levels < MOST_LEVELS:
        levels += 1
    points = matrix(sample["vector"]).astype(np.float64) if len(sample) else np.zeros((0, max(width, 0)))
    return Tree(points, levels), sample


def _place(tree: Tree):
    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf = np.full(len(batch), ARITY**tree.levels, dtype=np.int64)
            fits = (batch["width"] == tree.width).to_numpy()
            if fits.any():
                leaf[fits] = tree.leaves(matrix(batch["vector"][fits]).astype(np.float64))
            yield batch.assign(leaf=leaf)

    return place


def _ranges(tree: Tree):
    def ranges(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Tree(np.zeros((0, tree.width)), tree.levels)
        found.points = tree.points
        for batch in batches:
            if len(batch):
                found.widen(matrix(batch["vector"]).astype(np.float64))
        node, i, j = np.nonzero(np.isfinite(found.near))
        low, high = found.norms[node, j].T
        yield pd.DataFrame({"node": node, "i": i, "j": j, "near": found.near[node, i, j], "far": found.far[node, i, j], "low": low, "high": high})

    return ranges


def _learn_ranges(tree: Tree, placed: DataFrame) -> None:
    """Ranges over all rows; as many numbers come to the driver as the tree has."""
    fitting = placed.filter(F.col("width") == tree.width).select("vector")
    parts = fitting.mapInPandas(_ranges(tree), "node int, i int, j int, near double, far double, low double, high double")
    merged = parts.groupBy("node", "i", "j").agg(F.min("near"), F.max("far"), F.min("low"), F.max("high")).toPandas()
    node, i, j, near, far, low, high = (merged[c].to_numpy() for c in merged.columns)
    tree.near[node, i, j], tree.far[node, i, j] = near, far
    tree.norms[node, j, 0], tree.norms[node, j, 1] = low, high


class _Search:
    """Anchors' way through the tree; rows of the sample narrow the windows before."""

    def __init__(self, tree: Tree, sample: pd.DataFrame, blocks: dict[int, int]) -> None:
        self.tree, self.blocks = tree, blocks
        self.rids, self.labels = sample["rid"].to_numpy(), sample["label"].to_numpy()
        self.vectors = matrix(sample["vector"]) if len(sample) else np.zeros((0, tree.width), dtype=np.int64)
        # where the blocks of a leaf start in one numbering
        self.start = np.cumsum([0, *[blocks.get(n, 0) for n in range(ARITY**tree.levels + 1)]])

    def numbers(self, leaf: int) -> range:
        return range(int(self.start[leaf]), int(self.start[leaf + 1]))

    def send(self, batch: pd.DataFrame, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
        """The batch's rows once per block that may answer them."""
        rows, numbers = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        fits = np.flatnonzero((batch["width"] == self.tree.width).to_numpy())
        where = [np.flatnonzero((batch["width"] != self.tree.width).to_numpy())]
        if len(fits):
            vectors = matrix(batch["vector"].iloc[fits]).astype(np.float64)
            where = [fits[found] for found in self.tree.meet(vectors, low[fits], high[fits])] + where
        else:
            where = [fits] * ARITY**self.tree.levels + where
        for leaf, found in enumerate(where):
            for number in self.numbers(leaf):
                rows.append(found)
                numbers.append(np.full(len(found), number))
        return batch.iloc[np.concatenate(rows)].assign(block=np.concatenate(numbers))

    def ask_same(self, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Anchors with the least score that their positives must reach."""
        for batch in batches:
            low = np.full((len(batch), 1), -np.inf)
            for q, scores in self._sampled(batch):
                mine = scores[(self.labels == batch["label"].iloc[q]) & (self.rids != batch["rid"].iloc[q])]
                if len(mine) >= POSITIVES:
                    low[q] = np.partition(mine, -POSITIVES)[-POSITIVES]
            yield self.send(batch, low, np.full_like(low, np.inf))

    def ask_other(self, batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Anchors with the windows of their positives, narrowed from below."""
        for batch in batches:
            low, high = np.full((len(batch), POSITIVES), np.inf), np.full((len(batch), POSITIVES), -np.inf)
            for q, windows in enumerate(zip(batch["low"], batch["high"], strict=True)):
                low[q, : len(windows[0])], high[q, : len(windows[1])] = windows
            for q, scores in self._sampled(batch):
                other = scores[self.labels != batch["label"].iloc[q]]
                for w in range(POSITIVES):
                    inside = other[(other >= low[q, w]) & (other <= high[q, w])]
                    if len(inside) >= NEGATIVES:
                        low[q, w] = np.partition(inside, -NEGATIVES)[-NEGATIVES]
            yield self.send(batch, low, high)

    def _sampled(self, batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        fits = np.flatnonzero((batch["width"] == self.tree.width).to_numpy())
        if len(fits) and len(self.vectors):
            yield from zip(fits, inner_products(matrix(batch["vector"].iloc[fits]), self.vectors), strict=True)


def _by_width(block: pd.DataFrame, state: dict, queries: pd.DataFrame):
    """Rows of the block and queries of the same width, with all their scores."""
    if not state:
        for width, rows in block.groupby("width"):
            state[width] = rows, matrix(rows["vector"]), rows["id"].to_numpy(), rows["label"].to_numpy(), rows["rid"].to_numpy()
    for width, asked in queries.groupby("width"):
        if width in state:
            yield asked, *state[width][2:], inner_products(matrix(asked["vector"]), state[width][1])


def _same(block: pd.DataFrame, state: dict, queries: pd.DataFrame) -> pd.DataFrame:
    """The best rows of the anchor's label, itself left out."""
    out = []
    for asked, ids, labels, rids, scores in _by_width(block, state, queries):
        for q, (rid, label) in enumerate(zip(asked["rid"], asked["label"], strict=True)):
            found = np.flatnonzero((labels == label) & (rids != rid))
            # the complement turns the order around without leaving the range
            for at in found[np.lexsort((ids[found], ~scores[q, found]))[:POSITIVES]]:
                out.append((rid, int(ids[at]), int(scores[q, at])))
    return pd.DataFrame(out, columns=["rid", "positive_id", "positive_score"])


def _other(block: pd.DataFrame, state: dict, queries: pd.DataFrame) -> pd.DataFrame:
    """For each window the best rows of other labels."""
    out = []
    for asked, ids, labels, _, scores in _by_width(block, state, queries):
        columns = [asked[c] for c in ("rid", "label", "slot", "low", "high")]
        for q, (rid, label, slots, lows, highs) in enumerate(zip(*columns, strict=True)):
            found = np.flatnonzero((labels != label) & (scores[q] >= min(lows)) & (scores[q] <= max(highs)))
            found = found[np.lexsort((ids[found], ~scores[q, found]))]
            for slot, low, high in zip(slots, lows, highs, strict=True):
                inside = found[(scores[q, found] >= low) & (scores[q, found] <= high)]
                out += [(rid, int(slot), int(ids[at]), int(scores[q, at])) for at in inside[:NEGATIVES]]
    return pd.DataFrame(out, columns=["rid", "slot", "negative_id", "negative_score"])


def _hundredths(share: int) -> Column:
    """So many hundredths of a positive's score, exactly."""
    return F.col("positive_score").cast("decimal(20,0)") * share / F.lit(100).cast("decimal(3,0)")


def _id(name: str) -> Column:
    return F.when(F.col(name) != LAST_ID, F.col(name)).alias(name)


def mine(embeddings: DataFrame, every: int = 50, change: int | None = 7) -> DataFrame:
    """Hard negatives of each anchor (a row whose id is divisible by ``every``) and positive.

    Positives are the best rows of the anchor's label, negatives the best rows of other labels whose
    score lies between 50 and 95 hundredths of the positive's; ties go to the smaller id.

    The split points (at most 4,680) and a sample of 4,096 rows are sent to the tasks; all rows are in
    the tree. A leaf of more than ``BLOCK_ROWS`` rows is cut into blocks by a hash of the row; anchors
    go to the blocks of the leaves that are left.

    Nulls: rows without label or usable vector take no part; a null id is no anchor, keeps its label
    and comes last among ties. Rows that repeat an id are rows of their own, as anchors too. Vectors are
    compared with those of as many components. Components and scores beyond a long are taken as its
    end. A positive without negatives gives no row, nor does an empty table. Other columns are not read.
    """
    spark = embeddings.sparkSession
    prepare(spark)
    rows = materialise(usable_rows(embeddings, change).withColumn("rid", F.monotonically_increasing_id()), "labelled-vectors")
    tree, sample = _fit(rows)
    schema = "id long, label long, vector array<long>, width int, rid long, leaf long"
    placed = materialise(rows.mapInPandas(_place(tree), schema), "tree-leaves")
    _learn_ranges(tree, placed)
    # one row per leaf
    counts = {r["leaf"]: -(-r["count"] // BLOCK_ROWS) for r in placed.groupBy("leaf").count().collect()}
    search = _Search(tree, sample, counts)
    leaves = [(leaf, int(search.start[leaf]), n) for leaf, n in counts.items()]
    blocks = F.broadcast(spark.createDataFrame(leaves, "leaf long, start long, n long"))
    number = F.col("start") + F.pmod(F.xxhash64("rid"), F.col("n"))
    dealt = placed.join(blocks, "leaf").select("id", "label", "vector", "width", "rid", number.alias("block"))

    anchors = rows.filter((F.col("id") % every == 0) & (F.col("id") != LAST_ID))
    asked = materialise(anchors.select("rid", "id", "label", "vector", "width"), "anchors")
    count = asked.count()
    plain = "rid long, id long, label long, vector array<long>, width int"
    sent = asked.mapInPandas(search.ask_same, f"{plain}, block long")
    near = pass_by(dealt, sent, count, _same, "rid long, positive_id long, positive_score long")
    best = Window.partitionBy("rid").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("slot", F.row_number().over(best)).filter(F.col("slot") <= POSITIVES)
    near = near.withColumn("low", F.ceil(_hundredths(LOW)).cast("long")).withColumn("high", F.floor(_hundredths(HIGH)).cast("long"))
    positives = materialise(near, "positives")

    windows = positives.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("w"))
    wanted = asked.join(windows, "rid").select(
        "rid", "id", "label", "vector", "width", F.col("w.slot").alias("slot"), F.col("w.low").alias("low"), F.col("w.high").alias("high")
    )
    more = "slot array<int>, low array<long>, high array<long>"
    sent = wanted.mapInPandas(search.ask_other, f"{plain}, {more}, block long")
    hard = pass_by(dealt, sent, count, _other, "rid long, slot int, negative_id long, negative_score long")
    order = Window.partitionBy("rid", "slot").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES)
    pairs = positives.join(asked.select("rid", F.col("id").alias("anchor_id")), "rid")
    return hard.join(pairs, ["rid", "slot"]).select(
        "anchor_id", _id("positive_id"), "rank", _id("negative_id"), "positive_score", "negative_score"
    )
