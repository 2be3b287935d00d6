"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into segments, each with its mean and deviation. With segments of n components the
inner product of q and v is at most the sum of ``n * (mean_q * mean_v + dev_q * dev_v)``, so the
distance ``|q|**2 + |v|**2 - 2 q.v`` has a lower bound that needs two numbers per segment. Bounds go
from coarse to fine: candidates that cannot reach the k-th best score known so far leave, and exact
scores are computed for the rest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waterline.llm.tables import prepare
from waterline.sources.staging import materialise

SCALE = 1024
TOP = 10
# Segments of the levels; the last level is the components themselves.
LEVELS = (4, 16)
# Rows of a block of candidates (a power of two) and about those of a block of queries.
CANDIDATE_BITS = 13
QUERY_BLOCK = 1024
# Stands for a null id in the order of ties.
LAST_ID = 2**63 - 1


def segment_stats(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Root of the length times mean, and times deviation, of each segment: a bound is one product."""
    width = vectors.shape[1]
    edges = np.unique(np.linspace(0, width, min(segments, width) + 1).astype(int))
    parts = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        piece = vectors[:, low:high]
        parts += [piece.mean(axis=1), piece.std(axis=1)]
    scale = np.repeat(np.sqrt(np.diff(edges)), 2)[:, None]
    return (np.array(parts) * scale).T.reshape(len(vectors), -1)


def _exact(query: np.ndarray, rows: np.ndarray, small: bool) -> np.ndarray:
    """Integer inner products; in floating point where no sum can leave its whole numbers."""
    if small:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    sums = (rows.astype(object) * query.astype(object)).sum(axis=1)
    return np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in sums], dtype=np.int64)


def top_block(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, rids: np.ndarray, ids: np.ndarray, k: int = TOP):
    """For each query the k best rows of one block as (query, position, score); ``own`` is left out."""
    if not rows.shape[1]:
        small = True
    else:
        peak = [float(np.abs(m.astype(np.float64)).max()) for m in (queries, rows)]
        small = peak[0] * peak[1] * rows.shape[1] < 2.0**53
    as_float, query_float = rows.astype(np.float64), queries.astype(np.float64)
    levels = [(segment_stats(query_float, s), segment_stats(as_float, s)) for s in LEVELS] if rows.shape[1] else []
    # what rounding may take from a bound
    slack = 1e-9 * np.linalg.norm(query_float, axis=1) * (np.linalg.norm(as_float, axis=1).max(initial=0.0)) + 1e-6
    found = []
    for q in range(len(queries)):
        alive = np.flatnonzero(rids != own[q])
        if levels and len(alive) > k:
            for query_stats, row_stats in levels:
                bound = row_stats[alive] @ query_stats[q]
                # the k most promising rows give a score that the answer must reach
                first = alive[np.argpartition(-bound, k - 1)[:k]]
                least = _exact(queries[q], rows[first], small).min()
                alive = alive[bound >= least - slack[q]]
                if len(alive) <= k:
                    break
        scores = _exact(queries[q], rows[alive], small)
        for i in np.lexsort((ids[alive], -scores.astype(np.float64) if small else [-int(s) for s in scores]))[:k]:
            found.append((q, int(alive[i]), int(scores[i])))
    return found


def _search_block(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(queries) and len(rows):
        matrix = lambda part: np.array(part["vector"].tolist(), dtype=np.int64).reshape(len(part), -1)
        ids = rows["id"].to_numpy()
        found = top_block(matrix(queries), queries["rid"].to_numpy(), matrix(rows), rows["rid"].to_numpy(), ids)
        names, rids = queries["id"].to_numpy(), queries["rid"].to_numpy()
        out = [(int(rids[q]), int(names[q]), int(ids[i]), score) for q, i, score in found]
    return pd.DataFrame(out, columns=["rid", "query_id", "vec_id", "score"])


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """``(id, vector)`` of whole numbers; rows with a null vector or a component that is no number leave."""
    number = F.transform("embedding", lambda x: x.cast("double"))

    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    return (
        embeddings.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST_ID)).alias("id"), number.alias("number"))
        .filter(F.col("number").isNotNull() & ~F.exists("number", unusable))
        .select("id", F.transform("number", lambda x: F.floor(x * SCALE).cast("long")).alias("vector"))
    )


def top_k(embeddings: DataFrame, every: int = 100, k: int = TOP) -> DataFrame:
    """The k highest inner products of each row whose id is divisible by ``every``, against all others.

    Rows are cut into blocks by where they stand in the staged table, so no id makes a block large;
    each pair of a query block and a candidate block is one group, and the k best of each are merged
    per query. Vectors are compared with those of as many components. A component beyond the range
    of a long is taken as its end, and so is a score.

    Nulls: rows without a usable vector take no part; a row with a null id is a candidate only and
    comes last among ties. Rows that repeat an id are rows of their own: each asks and is found. An
    empty table gives no rows. Other columns are not read.
    """
    if k != TOP:
        raise ValueError(f"blocks keep {TOP} rows")
    spark = embeddings.sparkSession
    prepare(spark)
    rows = materialise(usable_vectors(embeddings).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("width", F.size("vector")).withColumn("block", F.shiftright("rid", CANDIDATE_BITS))
    asked = rows.filter((F.col("id") % every == 0) & (F.col("id") != LAST_ID)).drop("block")
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    # one task's rows are one block
    asked = materialise(asked.repartition(parts).withColumn("part", F.spark_partition_id()), "queries")
    blocks = rows.select("block", F.col("width").alias("of")).distinct()
    questions = asked.join(blocks, F.col("width") == F.col("of"))
    parts_seen = asked.select("part", F.col("width").alias("of")).distinct()
    answers = rows.join(parts_seen, F.col("width") == F.col("of")).select("id", "rid", "vector", "part", "block", "width")
    questions = questions.select("id", "rid", "vector", F.col("part").alias("asked_part"), F.col("block").alias("asked_block"), F.col("width").alias("asked_width"))
    found = (
        questions.groupBy("asked_part", "asked_block", "asked_width")
        .cogroup(answers.groupBy("part", "block", "width"))
        .applyInPandas(_search_block, "rid long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.when(F.col("vec_id") != LAST_ID, F.col("vec_id")).alias("vec_id"), "score")
    )
