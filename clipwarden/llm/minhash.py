"""Near duplicates by b-bit MinHash: bands find candidates, packed low bits estimate, full sets confirm.

Texts of equal shingle sets are one class, represented by its smallest id. Each class has `HASHES` minima;
groups of `BAND_ROWS` of them are its band keys, and the lowest `BITS` bits of all are packed into bit planes.
The share of minima whose low bits agree, corrected for chance agreement, estimates the similarity.

1. In each bucket (classes with one band key) the class that lies in the largest buckets overall is the
   centre; members are compared with the centre only. Candidates whose estimate is at most `SPREAD` standard
   deviations below the threshold are confirmed on full shingle sets, and components are formed.
2. Buckets whose members already share one component need no more. In the others, members outside the
   bucket's main component are compared with the members of other components: by an estimate from `FINE_HASHES`
   minima, which these few classes get in addition and whose deviation is a third, and, without loss, by a bound: of
   n shingles u may occur in no other candidate, so no more than n - u can be shared. Both stand in the join's
   condition; only pairs near the threshold leave it.

So no pair inside a group of copies that hang together is formed, and pairs of different components are
all considered. At the threshold a pair shares no band with a probability below 1e-7 (1e-6 at 0.8).

Defined results: A-Z are lowered; texts without words, null texts included, have empty sets and are linked
with nothing; texts of fewer words than a shingle are one shingle; repeated rows fall into one class; rows
with null ids stay; rows that repeat an id with another text share its links; an empty table gives an empty
result. The threshold counts in whole hundredths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text, stored, text_rows
from clipwarden.llm.words import WordHasher, Words, blocks, coefficients, mix

SHINGLE = 5
THRESHOLD = 0.8
HASHES, BAND_ROWS, BITS = 128, 4, 4
#: Standard deviations of the estimate that a pair may lie below the threshold and still be confirmed.
SPREAD = 5.5
#: Minima of the longer signatures that the classes left open by the first round get.
FINE_HASHES = 1024


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of the block."""
    hashes = words.windows(size, 1)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(hashes[a : b - size + 1])
        elif b > a:
            yield mix((words.hashes[a:b] * coefficients(b - a, 2)).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


class Minima:
    """Minima of `hashes` permutations of a set, their band keys and packed low bits."""

    def __init__(self, hashes: int, rows: int, bits: int) -> None:
        self.hashes, self.rows, self.bits = hashes, rows, bits
        self.factor = (coefficients(hashes, 3) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
        self.shift = (coefficients(hashes, 4) >> np.uint64(32)).astype(np.uint32)[:, None]
        self.band = coefficients(rows, 5)
        self.number = coefficients(hashes // rows, 6)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        values = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(self.hashes, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(values), 1024):
            np.minimum(low, (values[None, at : at + 1024] * self.factor + self.shift).min(1), out=low)
        return low

    def bands(self, low: np.ndarray) -> np.ndarray:
        """One signed 64-bit key per band, different for different bands."""
        keys = (low.astype(np.uint64).reshape(-1, self.rows) * self.band).sum(1, dtype=np.uint64)
        return mix(keys + self.number).view(np.int64)

    def packed(self, low: np.ndarray) -> np.ndarray:
        """`bits` planes of the minima's lowest bits, as 64-bit words, plane by plane."""
        spread = low * np.uint32(BITS_SPREAD)
        planes = [np.packbits((spread >> np.uint32(31 - b)) & np.uint32(1)) for b in range(self.bits)]
        return np.concatenate(planes).view(np.int64)


# Fixed value: an odd constant that moves the minima's entropy into the bits that are kept.
BITS_SPREAD = 0x85EBCA6B


def estimate(a: str, b: str, hashes: int, bits: int) -> Column:
    """Similarity of two packed signatures by bit counts, corrected for chance agreement of low bits."""
    width = hashes // 64
    differing = " + ".join(
        "bit_count(" + " | ".join(f"({a}[{p * width + w}] ^ {b}[{p * width + w}])" for p in range(bits)) + ")"
        for w in range(width)
    )
    agree, chance = f"(1 - ({differing}) / {hashes}.0D)", 2.0**-bits
    return F.expr(f"({agree} - {chance}D) / {1 - chance}D")


def deviation(similarity: float, hashes: int, bits: int) -> float:
    """Standard deviation of `estimate` at a similarity: low bits agree by a common minimum or by chance."""
    chance = 2.0**-bits
    agree = chance + (1 - chance) * similarity
    return (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)


def signatures(df: DataFrame, shingle: int, hashes: int, rows: int, bits: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bands, packed; of a frame of doc_id and text."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, minima = WordHasher(), Minima(hashes, rows, bits)
        for keys, texts in blocks(text_rows(batches), lower=True):
            counts, digests, bands, packed = [], [], [], []
            for found in shingle_sets(hasher(texts), shingle):
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                low = minima.minima(found)
                bands.append(minima.bands(low))
                packed.append(minima.packed(low))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "bands", "packed"],
            )

    return df.mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, packed array<bigint>"
    )


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of ids whose full shingle sets are similar enough."""

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            ids = [batch.column(c).to_pylist() for c in (0, 1)]
            texts = [batch.column(c).to_pylist() for c in (2, 3)]
            good = []
            for x, y in zip(*texts):
                one, two = shingle_sets(hasher([x.encode().lower(), y.encode().lower()]), shingle)
                shared = len(one) + len(two) - len(np.union1d(one, two))
                good.append(100 * shared >= percent * (len(one) + len(two) - shared))
            keep = [i for i, ok in enumerate(good) if ok]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[c][i] for i in keep], pa.int64()) for c in (0, 1)], ["a", "b"]
            )

    left = docs.withColumnsRenamed({"doc_id": "a", "text": "text_a"})
    right = docs.withColumnsRenamed({"doc_id": "b", "text": "text_b"})
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(check, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): label is the smallest id reachable over the edges (a, b); ids without edges are left out."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        # the smallest label among the neighbours, then the label of the label
        seen = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(seen, "a").select("a", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("a").alias("low"), F.col("label").alias("far"))
        moved = step.join(jump, "low").select("a", F.col("label").alias("old"), F.least("low", "far").alias("label"))
        moved = stored(moved, "labels")
        if moved.filter("old <> label").isEmpty():
            return moved.select("a", "label")
        labels = moved.select("a", "label")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    shingle: int = SHINGLE, hashes: int = HASHES, rows: int = BAND_ROWS, bits: int = BITS,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept; one row per row of `df`."""
    docs = id_and_text(df, id_col, text_col)
    percent = round(threshold * 100)
    least = threshold - SPREAD * deviation(threshold, hashes, bits)
    signed = stored(signatures(docs, shingle, hashes, rows, bits), "signatures")
    filled = signed.filter("n_shingles > 0")
    classes = stored(filled.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    # one row per class, even if rows repeat its id
    heads = filled.select(F.col("doc_id").alias("id"), "digest", "n_shingles", "bands", "packed").join(
        classes, ["digest", "id"], "left_semi"
    ).dropDuplicates(["digest"])
    heads = stored(heads.select("id", "n_shingles", "bands", "packed"), "heads")

    banded = heads.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(banded.join(sizes, "key"), "members")
    # texts travel once: only those of classes that share a bucket are looked at again
    texts = stored(
        docs.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidates"
    )
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    centres = (
        members.join(weight, "id")
        .groupBy("key")
        .agg(F.max(F.struct(F.col("weight"), (-F.col("id")).alias("minus"))).alias("top"))
        .select("key", (-F.col("top.minus")).alias("centre"))
    )
    packed = heads.select("id", "packed")
    stars = (
        members.join(centres, "key")
        .filter("id <> centre")
        .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
        .distinct()
        .join(packed.toDF("a", "pa"), "a")
        .join(packed.toDF("b", "pb"), "b")
        .filter(estimate("pa", "pb", hashes, bits) >= least)
        .select("a", "b")
    )
    first = stored(confirmed(stars, texts, shingle, percent), "first_links")
    labels = components(first)

    labelled = stored(
        members.join(labels.withColumnRenamed("a", "id"), "id", "left").select(
            "key", "band", "id", F.coalesce("label", "id").alias("label")
        ),
        "labelled",
    )
    per_label = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    main = (
        per_label.groupBy("key")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1")
        .select("key", F.col("top.label").alias("main"))
    )
    unsettled = stored(labelled.join(main, "key"), "unsettled")
    open_ids = unsettled.select("id").distinct()
    alone = unshared(texts, open_ids, shingle)
    fine = fine_signatures(texts, open_ids, shingle, rows, bits)
    sharp = threshold - SPREAD * deviation(threshold, FINE_HASHES, bits)
    facts = stored(
        heads.join(open_ids, "id", "left_semi")
        .join(alone, "id", "left")
        .join(fine, "id")
        .select(
            "id", "fine", "bands", F.col("n_shingles").alias("n"),
            (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("sharable"),
        ),
        "facts",
    )
    full = unsettled.join(facts, "id")
    outer = full.filter("label <> main").select(*[F.col(c).alias(f"x_{c}") for c in full.columns])
    ratio = percent / (100 + percent)
    # unequal labels; two members outside the main component meet once, and only in the first bucket they share
    earlier = F.arrays_overlap(F.slice("x_bands", F.lit(1), F.col("band")), F.slice("bands", F.lit(1), F.col("band")))
    met = (
        outer.join(full, F.col("x_key") == F.col("key"))
        .filter("x_label <> label AND (label = main OR x_id < id)")
        .filter(F.least("x_sharable", "sharable") + 1e-6 >= ratio * (F.col("x_n") + F.col("n")))
        .filter(estimate("x_fine", "fine", FINE_HASHES, bits) >= sharp)
        .filter(~earlier)
    )
    rest = met.select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b"))
    second = stored(confirmed(rest, texts, shingle, percent), "second_links")
    if not second.isEmpty():
        labels = components(first.union(second))
    found = classes.join(labels.withColumnRenamed("a", "id"), "id", "left").select(
        "digest", F.coalesce("label", "id").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def fine_signatures(texts: DataFrame, ids: DataFrame, shingle: int, rows: int, bits: int) -> DataFrame:
    """For texts of the given ids: (id, fine), the packed low bits of `FINE_HASHES` minima."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, minima = WordHasher(), Minima(FINE_HASHES, rows, bits)
        for keys, block in blocks(text_rows(batches), lower=True):
            packed = [minima.packed(minima.minima(found)) for found in shingle_sets(hasher(block), shingle)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(packed, pa.list_(pa.int64()))], ["id", "fine"]
            )

    rows_of_ids = texts.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    # rows may repeat an id with another text, but equal rows count once
    return rows_of_ids.mapInArrow(sign, "id bigint, fine array<bigint>").dropDuplicates(["id", "fine"])


def unshared(texts: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """For texts of the given ids: (id, alone), how many of a text's shingles occur in no other of them."""

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for keys, block in blocks(text_rows(batches), lower=True):
            sets = list(shingle_sets(hasher(block), shingle))
            owner = np.repeat(np.array(keys, np.int64), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(np.concatenate(sets).view(np.int64))], ["id", "shingle"]
            )

    rows = texts.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return (
        rows.mapInArrow(explode, "id bigint, shingle bigint")
        .groupBy("shingle")
        .agg(F.min("id").alias("id"), F.max("id").alias("most"))
        .filter("id = most")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
