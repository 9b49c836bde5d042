"""Sequences without padding: documents cut into pieces of power-of-two lengths, equal lengths bucketed.

A document of n ids (end id included) becomes as many pieces of `limit` as fit, then one piece for each
set bit of the rest, longest first. Each piece is a sequence of its own: none crosses documents and none
is padded. Pieces of one length share a bucket, a folder of the written table.

Defined results: a null text is an empty one (one piece that holds the end id); repeated rows are packed
as often as they occur; an empty table gives an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text, stored
from clipwarden.llm.tokens import encoded_rows

LIMIT = 1024
#: Bytes of ids after which a batch of pieces is handed to Spark.
BATCH_BYTES = 8 << 20


def piece_lengths(n: int, limit: int = LIMIT) -> list[int]:
    """Lengths of the pieces of `n` ids; `limit` is a power of two."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << k for k in range(limit.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Pieces with their ids: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    The pieces are written once, bucketed by length; a sequence's number is its place in that table.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            cols = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "doc_tokens", "length", "ids"])

        for key, ids in encoded_rows(batches, tokenizer):
            n, at = len(ids) // 4, 0
            for length in piece_lengths(n, limit):
                out.append((key, at, n, length, ids[4 * at : 4 * (at + length)]))
                at += length
            held += len(ids)
            if held >= BATCH_BYTES:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()

    pieces = id_and_text(df, id_col, text_col).mapInArrow(
        cut, "doc_id bigint, start bigint, doc_tokens bigint, length bigint, ids binary"
    )
    table = stored(pieces.withColumn("bucket", F.col("length")), "pieces", "bucket")
    return table.select(
        "doc_id", "start", "length", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), "ids",
    )
