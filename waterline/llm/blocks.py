"""Queries that pass by blocks of rows: each block stays in its task, its queries stream past it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Queries answered at once, and those one task gets for a block; further ones go to a copy of the block.
AT_ONCE = 512
QUERY_SHARE = 1 << 16
_ROW, _QUERY = 0, 1
_KEY = ("block", "share", "kind")

Answer = Callable[[pd.DataFrame, dict, pd.DataFrame], pd.DataFrame]


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one width as the rows of a matrix of whole numbers."""
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), -1)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, held within the range of a long.

    In floating point where no sum can leave its whole numbers.
    """
    if not rows.shape[1] or not len(rows) or not len(queries):
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    peak = [float(np.abs(m.astype(np.float64)).max()) for m in (queries, rows)]
    if peak[0] * peak[1] * rows.shape[1] < 2.0**53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    sums = queries.astype(object) @ rows.astype(object).T
    return np.clip(sums, -(2**63), 2**63 - 1).astype(np.int64)


def _runs(batch: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Stretches of a sorted batch with equal keys."""
    keys = batch[list(_KEY)].to_numpy()
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(batch)], strict=True):
        if high > low:
            yield tuple(keys[low]), batch.iloc[low:high]


def _stream(answer: Answer):
    def answers(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, parts, block, state = None, [], None, {}
        for batch in batches:
            for (number, share, kind), run in _runs(batch):
                if (number, share) != place:
                    place, parts, block, state = (number, share), [], None, {}
                if kind == _ROW:
                    parts.append(run)
                elif parts:
                    if block is None:
                        block, parts = pd.concat(parts, ignore_index=True), [True]
                    for low in range(0, len(run), AT_ONCE):
                        yield answer(block, state, run.iloc[low : low + AT_ONCE])

    return answers


def pass_by(rows: DataFrame, queries: DataFrame, query_count: int, answer: Answer, schema: str) -> DataFrame:
    """Answers of each block of ``rows`` to the ``queries`` sent to it; both have a column ``block``.

    ``answer(block, state, queries)`` gets all rows of one block, a dictionary of its own that lasts as
    long as the block, and some of its queries. A block has to fit a task; its queries need not. Rows and
    queries are shuffled once, rows once more per ``QUERY_SHARE`` queries there are.
    """
    shares = max(1, -(-query_count // QUERY_SHARE))

    def side(frame: DataFrame, other: DataFrame, kind: int, share: Column) -> DataFrame:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema if f.name not in frame.columns]
        return frame.select("*", *missing).withColumn("share", share).withColumn("kind", F.lit(kind))

    copies = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0)
    own = F.pmod(F.xxhash64("rid"), F.lit(shares)).cast("int")
    both = side(rows, queries, _ROW, copies).unionByName(side(queries, rows, _QUERY, own))
    sent = both.repartition("block", "share").sortWithinPartitions(*_KEY)
    return sent.mapInPandas(_stream(answer), schema)
