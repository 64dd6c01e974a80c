"""Token counts of whole texts by a compiled finite-state transducer (:mod:`transducer`)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_memo
from .transducer import Transducer

CHUNK_CHARS = 1 << 16
# piece types of the model file that text can be made of: normal and user defined
_NORMAL, _USER_DEFINED, _BYTE = 1, 4, 6


def compile_model(path: str) -> Transducer:
    """The transducer of a sentencepiece BPE model; raises if the model is of another kind."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    norm = model.normalizer_spec
    ours = (
        model.trainer_spec.model_type == 2 and model.trainer_spec.byte_fallback
        and not norm.precompiled_charsmap and norm.add_dummy_prefix
        and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        and not any(p.type == _USER_DEFINED for p in model.pieces)
    )
    pieces = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
    if not ours or any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("needs a BPE model with byte fallback, without normalisation, whose pieces stay inside words")
    return Transducer(pieces)


def _count(path: str, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo("token_counts")
        if ("transducer", path) not in memo:
            memo["transducer", path] = compile_model(path)
        count = memo["transducer", path].count
        for batch in batches:
            tokens = [count(text, chunk_chars) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n_bytes"], pa.array(tokens, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    return run


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit``.

    A null text counts as empty: no bytes, no tokens. Ids may be null or repeat.
    Other columns are ignored. Long texts are read in chunks of ``chunk_chars``
    characters whose maps are combined, so the result does not depend on it. An
    empty table gives no rows. There is no shuffle: rows are counted where they lie.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(_count(model_path, chunk_chars), "id long, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
