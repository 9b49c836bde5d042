"""Document fingerprints of closed syncmers.

A k-mer of code points is an anchor if the least of its inner s-mers is its first or its last one. That
depends on the k-mer alone, so an edit moves no anchor it does not touch. A fingerprint holds all
anchors with all their positions, as base64 text, so it grows with the text. Two fingerprints are alike by the
share of the anchors of both that they have in common, the n-th of a hash with the n-th, on any diagonal that a
neighbouring common anchor is on too.

Defined results: a null text is an empty one; a text too short for an anchor has one anchor, itself; an empty
text has none; two fingerprints without anchors are alike (1.0), one without and one with are not (0.0);
the next document of the last is the first; a single document is its own next; null ids sort first, equal
ids by text; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text
from clipwarden.llm.words import coefficients, mix

K, S = 12, 4
#: Neighbouring common anchors are on one diagonal if their shifts differ by at most this many code points.
SHIFT_STEP = 16
OUT_BYTES = 8 << 20
NULL_ID = -(1 << 63)


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the closed syncmers of `text`."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < k:
        if not len(codes):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        whole = (codes.astype(np.uint64) * coefficients(len(codes), 21)).sum(keepdims=True)
        return mix(whole), np.zeros(1, np.int64)
    inner = np.zeros(len(codes) - s + 1, np.uint32)
    for j, c in enumerate(coefficients(s, 22)):
        inner += codes[j : j + len(inner)] * np.uint32(c & np.uint64(0xFFFFFFFF))
    inner ^= inner >> np.uint32(15)
    inner *= np.uint32(0x2C1B3C6D)
    inner ^= inner >> np.uint32(13)
    low, reach, need = inner, 1, k - s + 1
    while reach < need:
        step = min(reach, need - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    at = np.flatnonzero((inner[: len(low)] == low) | (inner[need - 1 :] == low))
    hashes = np.zeros(len(at), np.uint64)
    for j, c in enumerate(coefficients(k, 23)):
        hashes += codes[at + j].astype(np.uint64) * c
    return mix(hashes), at


class Sketch:
    """The anchors of a text: 32-bit hashes in ascending order and their positions, ascending for each hash."""

    def __init__(self, hashes: np.ndarray, positions: np.ndarray) -> None:
        self.hashes, self.positions = hashes, positions

    @classmethod
    def of(cls, text: str) -> Sketch:
        hashes, at = anchors(text)
        hashes = (hashes >> np.uint64(32)).astype(np.uint32)
        order = np.argsort(hashes, kind="stable")
        return cls(hashes[order], at[order].astype(np.uint32))

    def keys(self) -> np.ndarray:
        """Hash and number of the occurrence in one number."""
        place = np.arange(len(self.hashes))
        first = np.maximum.accumulate(np.where(np.diff(self.hashes, prepend=self.hashes[:1]) != 0, place, 0))
        return self.hashes.astype(np.uint64) << np.uint64(32) | (place - first).astype(np.uint64)

    def text(self) -> str:
        return base64.b64encode(self.hashes.astype("<u4").tobytes() + self.positions.astype("<u4").tobytes()).decode()

    @classmethod
    def parse(cls, text: str) -> Sketch:
        both = np.frombuffer(base64.b64decode(text), "<u4")
        return cls(both[: len(both) // 2], both[len(both) // 2 :])

    def likeness(self, other: Sketch) -> float:
        if not len(self.hashes) or not len(other.hashes):
            return float(len(self.hashes) == len(other.hashes))
        common, mine, theirs = np.intersect1d(self.keys(), other.keys(), assume_unique=True, return_indices=True)
        at = self.positions[mine].astype(np.int64)
        shift = (other.positions[theirs].astype(np.int64) - at)[np.argsort(at)]
        near = np.abs(np.diff(shift)) <= SHIFT_STEP
        agree = int((np.append(near, False) | np.append(False, near)).sum()) if len(shift) > 1 else len(shift)
        return agree / (len(self.hashes) + len(other.hashes) - agree)


def in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows as (bucket, guest, doc_id, text): buckets are ranges of ids, and each also gets the next one's first row.

    Only that one row per bucket is sent twice. The borders come from quantiles of the ids, so they are
    known before any text is moved.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")
    shares = [i / buckets for i in range(1, buckets)]
    borders = sorted({int(x) for x in keyed.approxQuantile("doc_id", shares, 1 / (4 * buckets))})
    width = max(1, round(len(borders) ** 0.5))
    groups = [borders[i : i + width] for i in range(0, len(borders), width)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda x: x <= F.col("doc_id")))

    if borders:
        heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
        every = F.array(*[F.lit(b).cast("bigint") for b in borders])
        group = below(heads) - 1
        inside = below(F.slice(every, F.greatest(group, F.lit(0)) * width + 1, F.lit(width)))
        bucket = F.when(group < 0, F.lit(0)).otherwise(group * width + inside).cast("int")
    else:
        bucket = F.lit(0)
    placed = keyed.withColumn("bucket", bucket)
    firsts = placed.groupBy("bucket").agg(F.min("doc_id").alias("first_id")).collect()  # one row per bucket
    firsts.sort(key=lambda r: r.bucket)
    before = [(firsts[i].first_id, firsts[i - 1].bucket) for i in range(len(firsts))]
    guests = spark.createDataFrame(before, "doc_id bigint, before int")
    own = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest"))
    return (
        placed.join(F.broadcast(guests), "doc_id", "left")
        .withColumn("place", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))))
        .select("place.bucket", "place.guest", "doc_id", "text")
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of a document's code points replaced by the first ones of the next.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None  # bucket, id, text and sketch of the row that waits for its next one
        out: list[tuple] = []
        held = 0
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        for batch in batches:
            for bucket, guest, key, text in zip(*[c.to_pylist() for c in batch.columns]):
                if guest and (here is None or here[0] != bucket):
                    continue  # a further row of the id that begins the next bucket
                text = text or ""
                sketch = here[3] if here is not None and here[2] == text else Sketch.of(text)
                if here is not None:
                    _, old, own, mine = here
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    changed = mine if edited == own else Sketch.of(edited)
                    out.append(
                        (
                            None if old == NULL_ID else old, len(own), hashlib.sha256(edited.encode()).hexdigest(),
                            mine.text(), changed.text(), mine.likeness(changed), mine.likeness(sketch),
                        )
                    )
                    held += len(out[-1][3]) + len(out[-1][4])
                here = None if guest else (bucket, key, text, sketch)
                if len(out) >= 1000 or held >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return (
        in_order(id_and_text(df, id_col, text_col), buckets)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "guest", "doc_id", "text")
        .mapInArrow(
            run,
            "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )
