"""Packing of documents into training windows by Karmarkar-Karp differencing.

Each task tokenizes its documents and gathers their ids into blocks of a bounded
number of tokens. From a document longer than a window, whole windows are cut off
first and stand alone. What is left is cut into pieces of at most ``max_piece``
tokens, and the pieces of a block are divided over windows by multiway
differencing (:mod:`differencing`): near-equal sums leave little padding, and the
number of windows rises until none exceeds the capacity. Texts are never
shuffled; windows are numbered through by a prefix sum over the tasks.

Blocks, not groups, bound the memory: a frequent source or a very long document
only makes more of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_base, store
from .differencing import into_windows
from .tokens import encoder

CAPACITY = 4096
BLOCK_TOKENS = 1 << 21

PIECE_SCHEMA = (
    "part int, window long, offset long, doc_id long, start long, length long, doc_tokens long, ids binary"
)


def cut(doc_tokens: int, capacity: int, max_piece: int) -> Iterator[tuple[int, int]]:
    """``(start, length)``: whole windows first, then pieces of at most ``max_piece``."""
    start = doc_tokens - doc_tokens % capacity
    yield from ((at, capacity) for at in range(0, start, capacity))
    while start < doc_tokens:
        yield start, min(max_piece, doc_tokens - start)
        start += max_piece


def _pack(path: str, end_id: int, capacity: int, max_piece: int, block_tokens: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, first = encoder(path).encode, TaskContext.get().partitionId(), 0
        pieces, waiting = [], 0  # (doc, start, length, doc_tokens, ids)

        def flush():
            nonlocal first
            length = np.array([p[2] for p in pieces], "int64")
            whole = length == capacity
            window = np.empty(length.size, "int64")
            window[whole] = np.arange(whole.sum())
            if not whole.all():
                window[~whole] = whole.sum() + into_windows(length[~whole], capacity)
            order = np.argsort(window, kind="stable")
            window, length = window[order], length[order]
            before = np.cumsum(length) - length
            opens = np.concatenate([[True], window[1:] != window[:-1]])
            offset = before - before[opens][np.cumsum(opens) - 1]
            rank = np.cumsum(opens) - 1  # windows that got nothing leave no number
            columns = list(zip(*[pieces[k] for k in order]))
            out = pa.RecordBatch.from_pydict({
                "part": pa.array(np.full(length.size, part), pa.int32()),
                "window": pa.array(rank + first, pa.int64()), "offset": pa.array(offset, pa.int64()),
                "doc_id": pa.array(columns[0], pa.int64()), "start": pa.array(columns[1], pa.int64()),
                "length": pa.array(length, pa.int64()), "doc_tokens": pa.array(columns[3], pa.int64()),
                "ids": pa.array(columns[4], pa.binary()),
            })
            first += int(rank[-1]) + 1
            return out

        for batch in batches:
            for doc, text in zip(batch["id"].to_pylist(), batch["text"]):  # one text at a time as a string
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                for start, length in cut(n, capacity, max_piece):
                    pieces.append((doc, start, length, n, ids[4 * start:4 * (start + length)]))
                    waiting += length
                    if waiting >= block_tokens:
                        yield flush()
                        pieces, waiting = [], 0
        if pieces:
            yield flush()

    return run


def pack_windows(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = CAPACITY,
    max_piece: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers;
    the pieces of a sequence by ``offset`` are the sequence. ``max_piece`` (a
    quarter of the capacity by default) trades cuts for padding.

    A null or empty text is its end id alone. Ids may be null or repeat: every
    row is packed on its own. Other columns are ignored. An empty table gives no
    rows. Sequences are numbered without gaps.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    run = _pack(tokenizer_path, end_id, capacity, max_piece or max(1, capacity // 4), block_tokens)
    pieces = store(rows.mapInArrow(run, PIECE_SCHEMA), "packed-pieces")
    parts = pieces.groupBy("part").agg((F.max("window") + 1).alias("n"))
    base = running_base(parts, "part", "n", "base").select("part", "base")
    # one row of two numbers per task of the pass above, far less than the driver keeps of each task anyway
    return pieces.join(F.broadcast(base), "part").select(
        F.col("doc_id").alias(id_col), "start", "length", "doc_tokens",
        (F.col("base") + F.col("window")).alias("sequence_id"), "offset", "ids",
    )
