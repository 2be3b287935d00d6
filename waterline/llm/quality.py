"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text are binned by quantiles of a bounded training sample; trees are grown
level by level from histograms of gradients, and flattened into arrays of feature, threshold and
leaf value, which numpy walks for all rows of a batch at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waterline.llm.tables import prepare

# Labelled documents a fit reads at most; they are the first in an order by hash of the id.
TRAIN_ROWS = 8_000
FOLDS, HELD_OUT = 5, 0
CUT = 0.3
BINS, DEPTH, ROUNDS, RATE, RIDGE, LEAST_ROWS = 64, 4, 60, 0.15, 1.0, 10

STATISTICS = (
    "log_bytes log_words word_bytes letters upper digits spaces lines common_marks rare_marks non_ascii"
    " line_words repeated_lines distinct_words top_word repeated_pairs rare_mark_words upper_words sentence_words"
    " closed_lines"
).split()


def _classes() -> np.ndarray:
    """Of every byte: 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 common mark, 6 rare mark, 7 other."""
    table = np.full(256, 7, dtype=np.uint8)
    table[:32] = 3
    table[10] = 4
    table[127] = 3
    table[32] = 3
    table[33:127] = 6
    for marks, kind in ((b".,;:'\"!?()-", 5), (b"0123456789", 2)):
        table[list(marks)] = kind
    table[65:91], table[97:123] = 1, 0
    return table


_CLASS = _classes()


def statistics(text: str) -> list[float]:
    """The numbers a document is judged by; all zero for an empty one."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_CLASS[np.frombuffer(data, dtype=np.uint8)], minlength=8) / len(data)
    lines = [line for line in data.split(b"\n") if line.strip()]
    counts = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    n = len(words)
    rare = len(data.translate(None, _NOT_RARE))
    return [
        np.log1p(len(data)),
        np.log1p(n),
        len(data) / n,
        float(kinds[0] + kinds[1]),
        float(kinds[1]),
        float(kinds[2]),
        float(kinds[3]),
        float(kinds[4]),
        float(kinds[5]),
        float(kinds[6]),
        float(kinds[7]),
        min(n / len(lines), 1e4),
        1 - len(set(lines)) / len(lines),
        len(counts) / n,
        max(counts.values()) / n,
        1 - len(pairs) / max(1, n - 1),
        rare / n,
        sum(v for w, v in counts.items() if w.isupper()) / n,
        n / (1 + sum(v for w, v in counts.items() if w[-1] in b".!?")),
        sum(line.rstrip()[-1] in b".!?:" for line in lines) / len(lines),
    ]


_NOT_RARE = bytes(b for b in range(256) if _CLASS[b] != 6)


@dataclass(frozen=True)
class Forest:
    """Trees of one depth as arrays: inner nodes in breadth-first order, then leaf values."""

    start: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray
    values: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        at = np.arange(len(rows))
        depth = int(np.log2(self.values.shape[1])) if len(self.values) else 0
        for features, thresholds, values in zip(self.features, self.thresholds, self.values, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[at, features[node]] > thresholds[node])
            total += values[node - (len(values) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Forest:
    """Boost trees on the logistic loss. Without both labels the score is the share of ones, or 0.5."""
    mean = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    start = float(np.log(mean / (1 - mean)))
    empty = Forest(start, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(np.unique(labels)) < 2:
        return empty
    width = rows.shape[1]
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(rows), start)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = p - labels, p * (1 - p)
        features, thresholds = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            cut = np.full((count, 2), -1)
            for f in range(width):
                cell = (node - first) * BINS + bins[:, f]
                g, h, n = (
                    np.bincount(cell, weights=w, minlength=count * BINS).reshape(count, BINS).cumsum(axis=1)
                    for w in (gradient, curvature, np.ones(len(rows)))
                )
                left, right = (g, h, n), (g[:, -1:] - g, h[:, -1:] - h, n[:, -1:] - n)
                gain = sum(a * a / (b + RIDGE) for a, b, _ in (left, right)) - (g[:, -1:] ** 2 / (h[:, -1:] + RIDGE))
                gain = np.where((n >= LEAST_ROWS) & (right[2] >= LEAST_ROWS), gain, 0)[:, : len(edges[f])]
                if gain.shape[1]:
                    at = gain.argmax(axis=1)
                    better = gain[np.arange(count), at] > best + 1e-12
                    best[better] = gain[np.arange(count), at][better]
                    cut[better] = np.stack([np.full(count, f), at], axis=1)[better]
            for k in range(count):
                if cut[k, 0] >= 0:
                    features[first + k], thresholds[first + k] = cut[k, 0], edges[cut[k, 0]][cut[k, 1]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), features[node]] > thresholds[node])
        leaf = node - inner
        g, h = (np.bincount(leaf, weights=w, minlength=leaves) for w in (gradient, curvature))
        values = -RATE * g / (h + RIDGE)
        total += values[leaf]
        trees.append((features, thresholds, values))
    return Forest(start, *(np.array(part) for part in zip(*trees, strict=True)))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest:
    """Fit on at most ``rows`` labelled documents that are not held out.

    Labels of one id that differ are settled by their mean, ties for 1; rows without id or without
    a label of 0 or 1 do not count. The sample is bounded before texts are read, and again after, so
    that ids repeated in ``docs`` cannot enlarge it. Only its statistics reach the driver.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = usable.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    known = known.orderBy(*order).limit(rows)
    prepare(docs.sparkSession)
    # the sample has a bound of its own, so it may be sent to every task
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    measured = texts.select("doc_id", "label", _measured(F.col("text")).alias("x")).orderBy(*order, F.col("x")).limit(rows)
    sample = measured.select("label", "x").collect()
    return fit(np.array([r["x"] for r in sample]).reshape(-1, len(STATISTICS)), np.array([r["label"] for r in sample], dtype=float))


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts], dtype=float).reshape(-1, len(STATISTICS))


def _measured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(texts)))

    return measure(F.coalesce(text, F.lit("")))


def score(text: Column, forest: Forest) -> Column:
    """The score of a text, 0 to 1; a null text counts as an empty one."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(forest.score(_matrix(texts)))

    return scored(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; one row per row of ``docs``.

    Nulls: a null text is an empty one, whose statistics are all zero; a null id is never held out.
    Repeated rows get equal scores. Without usable labels every score is 0.5; with one label only it
    is that label's share. An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    forest = train(docs, labels)
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, score(F.col("text"), forest).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their own columns."""
    forest = train(docs, labels)
    names = docs.columns
    packed = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), score(docs["text"], forest).alias("score"))
    return packed.filter(F.col("score") >= CUT).select("row.*")
