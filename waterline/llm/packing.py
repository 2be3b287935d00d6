"""Cost-balanced packing of token ids into sequences of a fixed length.

A piece of n tokens costs ``linear * n + quadratic * n**2``: projections grow with the tokens,
attention with their square. Pieces are taken in descending order and each goes to the sequence of
lowest cost that has room for all of it; where none has, it is cut at the room of the cheapest
sequence that is not full. A block of documents gets as many sequences as its tokens need and no
more, so only a block's last tokens can leave padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm.tokens import tokenizer
from waterline.llm.tables import prepare

CAPACITY = 2048
END = (1).to_bytes(4, "little")
# Tokens a task holds while it packs them; 8 MB.
BLOCK_TOKENS = 1 << 21
# A layer of width d does about 12 d**2 n + 2 d n**2 multiplications; d = 2,048.
LINEAR, QUADRATIC = 1.0, 1.0 / (6 * 2048)
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("sequence_cost", pa.float64()),
    ]
)


def piece_cost(length, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * length + quadratic * length * length


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pack documents of these lengths; pieces as (document, start, length, sequence, offset).

    Every token is in exactly one piece, and all sequences but the last few are full: their number
    is the least that holds the tokens.
    """
    pieces, rest, sequence = [], [], 0
    for doc, length in enumerate(lengths.tolist()):
        for start in range(0, length - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if length % capacity:
            rest.append((length % capacity, doc, length - length % capacity))
    count = -(-sum(r[0] for r in rest) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity)
    rest.sort(key=lambda r: (-r[0], r[1]))
    for length, doc, start in rest:
        while length:
            fits = room >= length
            if not fits.any():
                fits = room > 0
            best = int(np.argmin(np.where(fits, cost, np.inf)))
            size = min(length, int(room[best]))
            pieces.append((doc, start, size, sequence + best, capacity - int(room[best])))
            room[best] -= size
            cost[best] += piece_cost(size)
            start, length = start + size, length - size
    return pieces


def _pack_block(ids: list, tokens: list[bytes], first: int, capacity: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.array([len(t) // 4 for t in tokens])
    pieces = pack_lengths(lengths, capacity)
    doc, start, size, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*pieces, strict=True))
    costs = np.bincount(sequence, weights=piece_cost(size))
    crc = [zlib.crc32(memoryview(tokens[d])[4 * s : 4 * (s + n)]) for d, s, n, _, _ in pieces]
    columns = [
        pa.array([ids[d] for d in doc.tolist()], pa.int64()),
        pa.array(start),
        pa.array(size),
        pa.array(crc, pa.int64()),
        pa.array(lengths[doc]),
        pa.array(sequence + first),
        pa.array(offset),
        pa.array(costs[sequence]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA), first + len(costs)


def _pack_rows(batches: Iterable[pa.RecordBatch], path: str, capacity: int, block_tokens: int) -> Iterator[pa.RecordBatch]:
    encode = tokenizer(path).encode
    # each task numbers its sequences in a range of its own
    ids, tokens, held, first = [], [], 0, TaskContext.get().partitionId() << 33
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            packed = encode(text.as_py() or "") + END
            ids.append(doc_id)
            tokens.append(packed)
            held += len(packed) // 4
            if held >= block_tokens:
                out, first = _pack_block(ids, tokens, first, capacity)
                yield out
                ids, tokens, held = [], [], 0
    if ids:
        yield _pack_block(ids, tokens, first, capacity)[0]


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Tokenise and pack every document; one row per piece.

    Documents are packed where they are read, in blocks of about ``block_tokens`` tokens, so texts
    are not shuffled and a task's memory does not depend on the table. ``docs`` should be a table or
    another source that gives a task the same rows when it runs again; ``sequence_id`` depends on
    how that source is divided into tasks.

    Nulls: a null text is an empty one, whose only token is the end mark; a null id stays null.
    Repeated rows are packed as often as they occur. An empty table gives no rows. Other columns of
    ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _pack_rows(batches, tokenizer_path, capacity, block_tokens), ddl)
