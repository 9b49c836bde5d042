"""Token ids as wavelet matrices: one succinct blob per shard, stored as rows of Parquet files.

A wavelet matrix keeps one bit plane per bit of the ids. On each level the ids are split stably by
that bit; rank counts per block of 512 bits turn positions of one level into positions of the next, so
single ids, counts and occurrences are answered from the planes without decoding the shard.

Defined results: a null text is an empty one and holds the end id alone; equal doc_ids are ordered by
text; a null doc_id sorts first; an empty table gives an empty result. Columns besides id and text are
ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text
from clipwarden.llm.tokens import encoded_rows

MAGIC = b"WVM1"
BLOCK_BITS = 512
#: Ids per shard at which a new one begins, so that a level stays in the processor's cache; a longer document makes
#: a longer shard.
SHARD_TOKENS = 1 << 19


class WaveletMatrix:
    """Access, rank, select and count over a sequence of ids."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]) -> None:
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ranks = [self._blocks(p) for p in planes]

    @staticmethod
    def _blocks(plane: np.ndarray) -> np.ndarray:
        per_block = np.bitwise_count(plane.reshape(-1, BLOCK_BITS // 8)).sum(1, dtype=np.int64)
        return np.concatenate(([0], np.cumsum(per_block)))

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        n = len(ids)
        bits = bits or max(1, int(ids.max()).bit_length() if n else 1)
        row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        size = (n // BLOCK_BITS + 1) * (BLOCK_BITS // 8)
        for level in range(bits - 1, -1, -1):
            ones = (row >> level) & 1 == 1
            plane = np.zeros(size, np.uint8)
            packed = np.packbits(ones)
            plane[: len(packed)] = packed
            # by places, as a mask of mixed bits is slow to index with
            low = row[np.flatnonzero(~ones)]
            planes.append(plane)
            zeros.append(len(low))
            row = np.concatenate((low, row[np.flatnonzero(ones)]))
        return cls(n, planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids in order: the stable splits are undone from the lowest plane up."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        row = np.zeros(self.n, kind)
        for level in range(bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            up = np.empty(self.n, kind)
            z = self.zeros[level]
            up[np.flatnonzero(~ones)] = row[:z]
            up[np.flatnonzero(ones)] = row[z:] | kind(1 << (bits - 1 - level))
            row = up
        return row

    def _rank1(self, level: int, i: int) -> int:
        block, rest = divmod(i, BLOCK_BITS)
        found = int(self.ranks[level][block])
        if rest:
            head = self.planes[level][block * BLOCK_BITS // 8 : block * BLOCK_BITS // 8 + (rest + 7) // 8]
            found += int(np.unpackbits(head, count=rest).sum())
        return found

    def _select1(self, level: int, k: int) -> int:
        """Position of the k-th (from 0) set bit."""
        block = int(np.searchsorted(self.ranks[level], k, side="right")) - 1
        part = self.planes[level][block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8]
        return block * BLOCK_BITS + int(np.flatnonzero(np.unpackbits(part))[k - int(self.ranks[level][block])])

    def _select0(self, level: int, k: int) -> int:
        counts = np.arange(len(self.ranks[level])) * BLOCK_BITS - self.ranks[level]
        block = int(np.searchsorted(counts, k, side="right")) - 1
        part = self.planes[level][block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8]
        return block * BLOCK_BITS + int(np.flatnonzero(np.unpackbits(part) == 0)[k - int(counts[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            one = self._rank1(level, i + 1) - self._rank1(level, i)
            value = value << 1 | one
            i = self.zeros[level] + self._rank1(level, i) if one else i - self._rank1(level, i)
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where occurrences of `symbol` before `end` lie below the last plane."""
        low, high = 0, end
        for level in range(len(self.planes)):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if symbol >> (len(self.planes) - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, symbol: int, end: int | None = None) -> int:
        """Occurrences of `symbol` before position `end`."""
        if symbol >> len(self.planes):
            return 0
        low, high = self._range(symbol, self.n if end is None else end)
        return high - low

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of `symbol`."""
        if k < 0 or k >= self.rank(symbol):
            raise IndexError(k)
        i = self._range(symbol, self.n)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = symbol >> (len(self.planes) - 1 - level) & 1
            i = self._select1(level, i - self.zeros[level]) if one else self._select0(level, i)
        return i

    def to_bytes(self) -> bytes:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        parts = [press.compress(p.tobytes()) for p in self.planes]
        head = struct.pack("<4sQB", MAGIC, self.n, len(parts))
        return head + b"".join(struct.pack("<QQ", z, len(p)) + p for z, p in zip(self.zeros, parts))

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        import zstandard

        magic, n, levels = struct.unpack_from("<4sQB", blob)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at, planes, zeros = 13, [], []
        size = (n // BLOCK_BITS + 1) * (BLOCK_BITS // 8)
        for _ in range(levels):
            zero, length = struct.unpack_from("<QQ", blob, at)
            raw = zstandard.ZstdDecompressor().decompress(blob[at + 16 : at + 16 + length], max_output_size=size)
            planes.append(np.frombuffer(raw, np.uint8))
            zeros.append(zero)
            at += 16 + length
        return cls(n, planes, zeros)


SHARD_SCHEMA = "part int, seq int, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, matrix binary"


def write_shards(
    df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    partitions: int | None = None, shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode whole texts and write shards in ascending id order to Parquet files at `path`.

    Rows are range partitioned by id, so `(part, seq)` orders the shards as the ids are ordered.
    """
    rows = id_and_text(df, id_col, text_col)
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        keys: list[Any] = []
        sizes: list[int] = []
        parts: list[bytes] = []

        def shard() -> pa.RecordBatch:
            blob = WaveletMatrix.build(np.frombuffer(b"".join(parts), "<u4")).to_bytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([sum(sizes)], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([blob], pa.binary()),
                ],
                ["part", "seq", "n_tokens", "doc_ids", "doc_tokens", "matrix"],
            )

        held = 0
        for key, ids in encoded_rows(batches, tokenizer):
            keys.append(key)
            sizes.append(len(ids) // 4)
            parts.append(ids)
            held += sizes[-1]
            if held >= shard_tokens:
                yield shard()
                keys, sizes, parts, held, seq = [], [], [], 0, seq + 1
        if keys:
            yield shard()

    laid = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    laid.mapInArrow(build, SHARD_SCHEMA).write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents back from the shards with their ids (little-endian 32-bit), and each shard's first position."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["matrix"]).decode().astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                step = 2000
                for k in range(0, len(ends), step):
                    span = range(k, min(k + step, len(ends)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["doc_ids"][i] for i in span], pa.int64()),
                            pa.array([row["part"]] * len(span), pa.int32()),
                            pa.array([row["seq"]] * len(span), pa.int32()),
                            pa.array(list(span), pa.int32()),
                            pa.array(starts[span.start : span.stop], pa.int64()),
                            pa.array([row["doc_tokens"][i] for i in span], pa.int64()),
                            pa.array([ids[starts[i] : ends[i]].tobytes() for i in span], pa.binary()),
                        ],
                        ["doc_id", "part", "seq", "at", "in_shard", "n_tokens", "ids"],
                    )

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    # one row per partition, then one per shard of a partition: neither grows with the documents of a shard
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    bases = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_inside")).join(
        before, "part"
    ).select("part", "seq", (F.col("_before") + F.col("_inside")).alias("_base"))
    docs = shards.mapInArrow(decode, "doc_id bigint, part int, seq int, at int, in_shard bigint, n_tokens bigint, ids binary")
    return docs, bases


def shard_documents(spark: SparkSession, path: str, **derived: Column) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, part, seq and what `derived` makes of `ids`.

    Only these columns are joined with the shards' starts, so ids travel no further unless asked for.
    """
    docs, bases = read_documents(spark, path)
    narrow = docs.select(
        "doc_id", "part", "seq", "in_shard", "n_tokens", *[col.alias(name) for name, col in derived.items()]
    )
    start = (F.col("_base") + F.col("in_shard")).alias("start")
    return narrow.join(bases, ["part", "seq"]).select("doc_id", start, "n_tokens", *derived, "part", "seq")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of `token` per shard, counted on the planes: part, seq, n."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = WaveletMatrix.from_bytes(row["matrix"]).rank(token)
                yield pa.RecordBatch.from_pylist(
                    [{"part": row["part"], "seq": row["seq"], "n": n}],
                    pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64())]),
                )

    return spark.read.schema(SHARD_SCHEMA).parquet(path).mapInArrow(count, "part int, seq int, n bigint")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every occurrence of `token` by select: doc_id, position in the document."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.from_bytes(row["matrix"])
                at = np.array([matrix.select(token, k) for k in range(matrix.rank(token))], np.int64)
                ends = np.cumsum(row["doc_tokens"])
                doc = np.searchsorted(ends, at, side="right")
                first = ends - row["doc_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][i] for i in doc], pa.int64()), pa.array(at - first[doc], pa.int64())],
                    ["doc_id", "position"],
                )

    return spark.read.schema(SHARD_SCHEMA).parquet(path).mapInArrow(find, "doc_id bigint, position bigint")
