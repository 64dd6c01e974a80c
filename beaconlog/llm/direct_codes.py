"""Token ids in files with directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level k holds the k-th
chunk of every id that has one, and a bitmap that tells which of its ids go on.
A directory holds, for every 512 bits of a bitmap, how many ones precede them.
The token at any position is read by following ranks from level to level: one
byte per level is touched, nothing before it is decoded.

Bytes of a segment (all numbers little-endian):

    magic ``DAC1``, documents u32, ids u64, levels u32
    document offsets: u64 per document and one for the end
    per level: chunks u64, then the chunks, the bitmap, and the directory (u32 per 512 bits)

Segments are rows of a Parquet table (``part, segment, docs, ids, inside, payload``;
``inside`` counts the ids before the segment in its part), so they are written by Spark's committer and can lie in any store it reaches. Parts
are ranges of document ids in ascending order, segments follow one another in a
part, and a directory of parts tells the position of a segment's first id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_base, store
from .tokens import encoder

MAGIC = b"DAC1"
BLOCK = 512
SEGMENT_IDS = 1 << 20
_HEAD = "<4sIQI"


# ── the code itself (numpy, no Spark) ───────────────────────────────────────

def pack(ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """A segment of ``ids`` (unsigned 32-bit) whose document k is ``offsets[k]:offsets[k + 1]``."""
    out, level, rest = [], 0, ids.astype("<u4")
    while level == 0 or rest.size:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, more.size, BLOCK), dtype="u4") if more.size else np.zeros(0, "u4")
        before = np.concatenate([np.zeros(1, "u4"), np.cumsum(blocks, dtype="u4")[:-1]]) if blocks.size else blocks
        out += [struct.pack("<Q", rest.size), (rest & 0xFF).astype("u1").tobytes(), bits.tobytes(), before.astype("<u4").tobytes()]
        rest = rest[more] >> 8
        level += 1
    head = struct.pack(_HEAD, MAGIC, len(offsets) - 1, ids.size, level)
    return b"".join([head, np.asarray(offsets, "<u8").tobytes(), *out])


class Segment:
    """Read access to a segment's bytes."""

    def __init__(self, payload: bytes):
        magic, docs, self.size, levels = struct.unpack_from(_HEAD, payload)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = struct.calcsize(_HEAD)
        self.offsets = np.frombuffer(payload, "<u8", docs + 1, at)
        at += 8 * (docs + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, "u1", n, at)
            bits = np.frombuffer(payload, "u1", -(-n // 8), at + n)
            before = np.frombuffer(payload, "<u4", -(-n // BLOCK), at + n + bits.size)
            at += n + bits.size + 4 * before.size
            self.levels.append((chunks, bits, before))

    def token(self, position: int) -> int:
        """The id at ``position``, by rank alone."""
        if not 0 <= position < self.size:
            raise IndexError(position)
        value, shift = 0, 0
        for chunks, bits, before in self.levels:
            value |= int(chunks[position]) << shift
            if not bits[position >> 3] >> (position & 7) & 1:
                return value
            first = position // BLOCK * BLOCK >> 3
            inside = int.from_bytes(bits[first:(position >> 3) + 1].tobytes(), "little")
            inside &= (1 << (position - (first << 3))) - 1
            position = int(before[position // BLOCK]) + inside.bit_count()
            shift += 8
        return value

    def tokens(self) -> np.ndarray:
        """All ids, level by level from the last."""
        above = np.zeros(0, "<u4")
        for chunks, bits, _ in reversed(self.levels):
            values = chunks.astype("<u4")
            more = np.unpackbits(bits, count=chunks.size, bitorder="little").view(bool)
            values[more] |= above << np.uint32(8)
            above = values
        return above


# ── writing and reading with Spark ──────────────────────────────────────────

def _segments(path: str, end_id: int, limit: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, docs, size, part, number, written = encoder(path).encode, [], [], 0, 0, 0, 0

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in held])])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([number], pa.int32()),
                "docs": pa.array([docs], pa.list_(pa.int64())), "ids": pa.array([ids.size], pa.int64()),
                "inside": pa.array([written], pa.int64()),
                "payload": pa.array([pack(ids, offsets)], pa.binary()),
            })

        for batch in batches:
            for doc, text, part in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), batch["part"].to_pylist()):
                held.append(encode(text) + end)
                docs.append(doc)
                size += len(held[-1]) // 4
                if size >= limit:
                    yield flush()
                    written += size
                    held, docs, size, number = [], [], 0, number + 1
        if held:
            yield flush()

    return run


SEGMENT_SCHEMA = "part int, segment int, docs array<bigint>, ids long, inside long, payload binary"


def write_codes(
    docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write segments in ascending document order.

    Returns the stored segments with ``start``, the position of their first id.
    A null or empty text is its end id alone. Null document ids come first;
    rows with equal ids follow one another in the order of their text's hash.
    Other columns are ignored. An empty table writes no segment. A segment ends
    with the document that fills it, so a document is never cut.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", "tie"]
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("id", "text", F.spark_partition_id().alias("part"))
    )
    segments = store(ordered.mapInArrow(_segments(tokenizer_path, end_id, segment_ids), SEGMENT_SCHEMA), "token-codes")
    parts = segments.groupBy("part").agg(F.sum("ids").alias("n"))
    # one row of two numbers per task of the pass above, far less than the driver keeps of each task anyway
    base = F.broadcast(running_base(parts, "part", "n", "base").select("part", "base"))
    return segments.join(base, "part").withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, start, payload in zip(batch["docs"].to_pylist(), batch["start"].to_pylist(), batch["payload"].to_pylist()):
            segment = Segment(payload)
            raw, offsets = memoryview(segment.tokens().astype("<u4", copy=False)).cast("B"), segment.offsets.astype("int64")
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(docs, pa.int64()),
                "start": pa.array(offsets[:-1] + start, pa.int64()),
                "n_tokens": pa.array(np.diff(offsets), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in pairwise(offsets.tolist())], pa.int64()),
            })


def read_documents(segments: DataFrame) -> DataFrame:
    """Per document, decoded from the stored segments: ``doc_id, start, n_tokens, ids_crc32``."""
    return segments.select("docs", "start", "payload").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _tokens(positions: list[int]):
    wanted = np.array(sorted(positions), "int64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n, payload in zip(batch["start"].to_pylist(), batch["ids"].to_pylist(), batch["payload"].to_pylist()):
                here = wanted[np.searchsorted(wanted, start):np.searchsorted(wanted, start + n)]
                segment = Segment(payload)
                yield pa.RecordBatch.from_pydict({
                    "position": pa.array(here, pa.int64()),
                    "token": pa.array([segment.token(int(p - start)) for p in here], pa.int64()),
                })

    return run


def read_tokens(segments: DataFrame, positions: list[int]) -> DataFrame:
    """``position, token`` for a given list of positions; segments without any are not read further."""
    in_segment = F.exists(F.lit(sorted(positions)), lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("ids")))
    return segments.where(in_segment).select("start", "ids", "payload").mapInArrow(
        _tokens(positions), "position long, token long"
    )
