"""Repeated passages by compaction of a de Bruijn graph of words.

Every window of `WIDTH` consecutive words is an edge of the graph; its source is its first occurrence, the
smallest (doc_id, word position) where the same words stand. An edge is repeated in a document if its
source lies in a document with a smaller id. Repeated edges that follow each other in the document and
whose sources follow each other too are one nonbranching path; it is kept as one row of coordinates. The
words at both ends of these coordinates are compared by digest, and only verified paths count.

Edges reach their sources by exchanges keyed on ranges of the hash space. A task (chunk) sends each
distinct key once, so a passage that occurs in a third of all documents is one entry per chunk:

1. Anchors thin out the edges: the least hash of the nine-word grams inside a window is shared by equal
   windows, and neighbouring windows mostly share theirs. Edges whose anchor occurs once cannot repeat.
2. The edges that are left look up their source by 64-bit keys.

Defined results: null and empty texts have no words; a text shorter than a window has no edge and keeps all
its words; equal passages inside one document only are kept; rows that repeat an id and text get the same
result; a null id counts as the largest; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text, stored
from clipwarden.llm.words import BLOCK_BYTES, WordHasher, Words

WIDTH, GRAM = 13, 9
NO_ID = (1 << 63) - 1
MESSAGE = "bucket int, chunk int, directory boolean, payload binary"


def pack(value: Any) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unpack(data: bytes) -> Any:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def thin(values: np.ndarray) -> tuple[str, bytes]:
    """The values byte plane by byte plane, so that equal high bytes compress to nothing."""
    return values.dtype.str, values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def thick(kind: str, data: bytes) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def rises(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours, modulo the type's range; `np.cumsum` of the same type undoes them."""
    return np.diff(values, prepend=values.dtype.type(0))


def message(rows: list[tuple[int, int, bool, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), (), ()]
    kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)], ["bucket", "chunk", "directory", "payload"]
    )


def anchors(grams: np.ndarray, windows: int, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least gram hash of each window of one text, run by run: the values and where the runs begin."""
    low, reach, need = grams, 1, width - gram + 1
    while reach < need:
        step = min(reach, need - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    low = low[:windows]
    begins = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    return low[begins], begins


class Chunk:
    """The keys of a task's documents in the order of their ids, and the messages made of them."""

    def __init__(self, docs: list[tuple], buckets: int) -> None:
        docs.sort(key=lambda d: d[:2])
        self.docs, self.buckets = docs, buckets
        keys = np.concatenate([d[2] for d in docs])
        self.counts = np.array([len(d[2]) for d in docs], np.int64)
        self.keys, self.first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        self.inverse = inverse.astype(np.uint32)
        self.step = (1 << 64) // buckets + 1
        borders = np.array([b * self.step for b in range(1, buckets)], np.uint64)
        self.cuts = np.concatenate(([0], np.searchsorted(self.keys, borders), [len(self.keys)]))

    def messages(self, chunk: int, columns: Callable[[slice, int], Any], directory: Any) -> Iterator[pa.RecordBatch]:
        rows = [(chunk % self.buckets, chunk, True, pack((self.docs_part(), directory)))]
        for b in range(self.buckets):
            a, z = int(self.cuts[b]), int(self.cuts[b + 1])
            if z > a:
                rows.append((b, chunk, False, pack(columns(slice(a, z), b))))
        for at in range(0, len(rows), 64):
            yield message(rows[at : at + 64])

    def docs_part(self) -> tuple:
        ids = np.array([d[0] for d in self.docs], np.int64)
        return ids, np.array([d[1] for d in self.docs], np.int64), self.counts, self.inverse


def keyed_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows gathered to blocks of text; each is a tuple of the batch's columns with its text as bytes last."""
    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            data = (row[-1] or "").encode()
            rows.append((*row[:-1], data))
            held += len(data)
            if held >= BLOCK_BYTES:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def each_text(found: Words, width: int) -> Iterator[tuple[int, int, int]]:
    """(index of the text, its first word, its number of windows) for texts that have windows."""
    begins = found.first.tolist()
    for i, (a, b) in enumerate(zip(begins[:-1], begins[1:])):
        if b - a >= width:
            yield i, a, b - a - width + 1


def send_anchors(docs: DataFrame, buckets: int, width: int, gram: int) -> DataFrame:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hasher, kept = WordHasher(), []
        for rows in keyed_blocks(batches):
            found = hasher([r[-1] for r in rows])
            grams = found.windows(gram, 7)
            for i, a, n in each_text(found, width):
                values, _ = anchors(grams[a : a + n + width - gram], n, width, gram)
                kept.append((rows[i][0], rows[i][1], values))
        if kept:
            chunk = Chunk(kept, buckets)
            drop = np.uint64(max(0, chunk.step.bit_length() - 32))
            cols = lambda s, b: ((chunk.keys[s] - np.uint64(b * chunk.step)) >> drop).astype(np.uint32)
            yield from chunk.messages(TaskContext.get().partitionId(), cols, None)

    return docs.mapInArrow(send, MESSAGE)


def find_common(table: pa.Table) -> pa.Table:
    """Answer each chunk which of its anchors other chunks have too."""
    rows = table.to_pylist()
    asked = [(r, unpack(r["payload"])) for r in rows if not r["directory"]]
    out = [(r["bucket"], r["chunk"], True, r["payload"]) for r in rows if r["directory"]]
    if asked:
        # a chunk sends no key twice, but two keys of it may share their 32 bits: that only adds candidates
        _, inverse, counts = np.unique(np.concatenate([v for _, v in asked]), return_inverse=True, return_counts=True)
        common, at = counts[inverse] > 1, 0
        for r, values in asked:
            out.append((r["bucket"], r["chunk"], False, pack((np.packbits(common[at : at + len(values)]), len(values)))))
            at += len(values)
    return pa.Table.from_batches([message(out)])


def answers(table: pa.Table) -> tuple[tuple, Any, list[Any]]:
    """A chunk's directory and the answers to its keys in the order of the keys."""
    rows = sorted(table.to_pylist(), key=lambda r: (not r["directory"], r["bucket"]))
    docs, directory = unpack(rows[0]["payload"])
    return docs, directory, [unpack(r["payload"]) for r in rows[1:]]


def candidate_runs(table: pa.Table) -> pa.Table:
    """Per document the bits of its anchor runs that may be repeated."""
    (ids, marks, counts, inverse), _, replies = answers(table)
    common = np.concatenate([np.unpackbits(bits)[:n].astype(bool) for bits, n in replies])
    common |= np.bincount(inverse, minlength=len(common)) > 1
    runs = common[inverse]
    out: list[tuple] = []
    at = 0
    for key, mark, n in zip(ids.tolist(), marks.tolist(), counts.tolist()):
        own = runs[at : at + n]
        if own.any():
            out.append((key, mark, np.packbits(own).tobytes()))
        at += n
    cols = list(zip(*out)) or [(), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.table({c: pa.array(v, k) for c, v, k in zip(("key", "mark", "runs"), cols, kinds)})


def send_edges(candidates: DataFrame, buckets: int, width: int, gram: int) -> DataFrame:
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hasher, kept = WordHasher(), []
        for rows in keyed_blocks(batches):
            found = hasher([r[-1] for r in rows])
            grams, edges = found.windows(gram, 7), found.windows(width, 8)
            for i, a, n in each_text(found, width):
                _, begins = anchors(grams[a : a + n + width - gram], n, width, gram)
                runs = np.unpackbits(np.frombuffer(rows[i][2], np.uint8))[: len(begins)].view(bool)
                mask = np.repeat(runs, np.diff(np.concatenate((begins, [n]))))
                kept.append((rows[i][0], rows[i][1], edges[a : a + n][mask], np.flatnonzero(mask).astype(np.uint32)))
        if kept:
            chunk = Chunk(kept, buckets)
            places = np.concatenate([d[3] for d in kept])
            owner = np.repeat(np.array([d[0] for d in kept], np.int64), chunk.counts)
            cols = lambda s, b: (
                thin(rises(chunk.keys[s])), thin(owner[chunk.first[s]]), thin(places[chunk.first[s]])
            )
            yield from chunk.messages(TaskContext.get().partitionId(), cols, thin(rises(places)))

    return candidates.mapInArrow(send, MESSAGE)


def find_sources(table: pa.Table) -> pa.Table:
    """Answer each chunk the source of those of its edges whose source lies in another chunk."""
    rows = table.to_pylist()
    asked = [(r, unpack(r["payload"])) for r in rows if not r["directory"]]
    out = [(r["bucket"], r["chunk"], True, r["payload"]) for r in rows if r["directory"]]
    if asked:
        columns = [[thick(*c) for c in v] for _, v in asked]
        keys = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns])
        docs, places = (np.concatenate([c[i] for c in columns]) for i in (1, 2))
        order = np.lexsort((places, docs, keys))
        ranked = keys[order]
        head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        best = np.empty(len(keys), np.int64)
        best[order] = order[np.maximum.accumulate(np.where(head, np.arange(len(keys)), 0))]
        other, at = best != np.arange(len(keys)), 0
        for (r, _), values in zip(asked, columns):
            part = slice(at, at + len(values[0]))
            moved = best[part][other[part]]
            found = (np.packbits(other[part]), len(values[0]), thin(docs[moved]), thin(places[moved]))
            out.append((r["bucket"], r["chunk"], False, pack(found)))
            at = part.stop
    return pa.Table.from_batches([message(out)])


def compact(table: pa.Table) -> pa.Table:
    """Join consecutive edges whose sources follow each other: key, mark, start, edges, src, src_start."""
    (ids, marks, counts, inverse), moves, replies = answers(table)
    places = np.cumsum(thick(*moves), dtype=np.uint32)
    owner = np.repeat(np.arange(len(ids)), counts)
    first = np.unique(inverse, return_index=True)[1]
    src, src_at = ids[owner[first]], places[first].astype(np.int64)
    other = np.concatenate([np.unpackbits(m)[:n].astype(bool) for m, n, _, _ in replies])
    src[other] = np.concatenate([thick(*d) for _, _, d, _ in replies])
    src_at[other] = np.concatenate([thick(*p) for _, _, _, p in replies])
    src, src_at, own, at = src[inverse], src_at[inverse], owner, places.astype(np.int64)
    hit = src < ids[own]
    own, at, src, src_at = own[hit], at[hit], src[hit], src_at[hit]
    if not len(own):
        begins = np.zeros(0, np.int64)
    else:
        follows = (own[1:] == own[:-1]) & (at[1:] == at[:-1] + 1) & (src[1:] == src[:-1]) & (src_at[1:] == src_at[:-1] + 1)
        begins = np.concatenate(([0], np.flatnonzero(~follows) + 1))
    lengths = np.diff(np.concatenate((begins, [len(own)])))
    cols = (ids[own[begins]], marks[own[begins]], at[begins], lengths, src[begins], src_at[begins])
    names = ("key", "mark", "start", "edges", "src", "src_start")
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, cols)})


def span_digests(df: DataFrame, width: int) -> DataFrame:
    """Digests of the words of spans, of (key, mark, spans, text); a span is of one mark or, if null, of any."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, mark, spans, text in zip(*[c.to_pylist() for c in batch.columns]):
                words = text.encode().split()
                for span in spans:
                    if span["of"] is None or span["of"] == mark:
                        part = b" ".join(words[span["start"] : span["start"] + span["edges"] + width - 1])
                        found = hashlib.sha256(part).digest()
                        out.append((key, mark, span["of"], span["start"], span["edges"], found))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], ["key", "mark", "of", "start", "edges", "digest"]
            )

    return df.mapInArrow(digest, "key bigint, mark bigint, of bigint, start bigint, edges bigint, digest binary")


def removed_words(n: int, spans: list[Any], width: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int32)
    for span in spans:
        steps[span["start"]] += 1
        steps[span["start"] + span["edges"] + width - 1] -= 1
    return np.cumsum(steps[:n]) > 0


def without_spans(df: DataFrame, width: int) -> DataFrame:
    """key, mark, n_removed, kept_text (removed words cut out, all else unchanged), kept_sha256."""

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            out = []
            for key, mark, spans, text in zip(*[c.to_pylist() for c in batch.columns]):
                data = text.encode()
                found = hasher([data])
                gone = removed_words(len(found.starts), spans, width)
                words = [data[a:b] for a, b in zip(found.starts[~gone].tolist(), found.ends[~gone].tolist())]
                # a run of removed words goes with the white space after it
                flips = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                kept, at = [], 0
                for a, b in zip(flips[::2], flips[1::2]):
                    kept.append(data[at : found.starts[a]])
                    at = int(found.starts[b]) if b < len(found.starts) else len(data)
                kept.append(data[at:])
                sha = hashlib.sha256(b" ".join(words)).hexdigest()
                out.append((key, mark, int(gone.sum()), b"".join(kept).decode(), sha))
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], ["key", "mark", "n_removed", "kept_text", "kept_sha256"]
            )

    return df.mapInArrow(
        strip, "key bigint, mark bigint, n_removed bigint, kept_text string, kept_sha256 string"
    )


def word_facts(docs: DataFrame) -> DataFrame:
    """key, mark, n_words, sha256 of all words joined by one space."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks, texts = batch.columns
            words = [(t or "").encode().split() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    keys, marks, pa.array([len(w) for w in words], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
                ],
                ["key", "mark", "n_words", "words_sha256"],
            )

    return docs.mapInArrow(count, "key bigint, mark bigint, n_words bigint, words_sha256 string")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key (the id, the largest long for null), mark (a hash of the text) and text: together they name a row."""
    return id_and_text(df, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("mark"), "text"
    )


def stripped(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM
) -> DataFrame:
    """Documents from which something is removed: key, mark, n_removed, kept_text, kept_sha256."""
    docs = keyed(df, id_col, text_col)
    buckets = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flagged = (
        send_anchors(docs, buckets, width, gram)
        .groupBy("bucket").applyInArrow(find_common, MESSAGE)
        .groupBy("chunk").applyInArrow(candidate_runs, "key bigint, mark bigint, runs binary")
        .dropDuplicates(["key", "mark"])
    )
    # rows that repeat id and text are looked at once
    candidates = stored(
        docs.join(flagged, ["key", "mark"]).select("key", "mark", "runs", "text").dropDuplicates(["key", "mark"]),
        "candidates",
    )
    paths = stored(
        send_edges(candidates, buckets, width, gram)
        .groupBy("bucket").applyInArrow(find_sources, MESSAGE)
        .groupBy("chunk").applyInArrow(
            compact, "key bigint, mark bigint, start bigint, edges bigint, src bigint, src_start bigint"
        )
        .distinct(),
        "paths",
    )
    texts = candidates.select("key", "mark", "text")
    # both ends of all paths in one pass over the texts; a source is named by its id alone
    ends = paths.select("key", "mark", "start", "edges").union(
        paths.select(F.col("src").alias("key"), F.lit(None).cast("bigint"), F.col("src_start"), "edges").distinct()
    )
    listed = ends.groupBy("key").agg(F.collect_list(F.struct(F.col("mark").alias("of"), "start", "edges")).alias("spans"))
    digests = stored(
        span_digests(texts.join(listed, "key").select("key", "mark", "spans", "text"), width), "span_digests"
    )
    own = digests.filter("of IS NOT NULL").select("key", "mark", "start", "edges", "digest")
    theirs = digests.filter("of IS NULL").select(
        F.col("key").alias("src"), F.col("start").alias("src_start"), "edges", "digest"
    )
    verified = paths.join(own, ["key", "mark", "start", "edges"]).join(
        theirs, ["src", "src_start", "edges", "digest"], "left_semi"
    )
    spans = verified.groupBy("key", "mark").agg(F.collect_list(F.struct("start", "edges")).alias("spans"))
    return without_spans(texts.join(spans, ["key", "mark"]).select("key", "mark", "spans", "text"), width)


def deduplicated(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM
) -> DataFrame:
    """Per row of `df`: doc_id, n_words, n_removed, kept_sha256 of the kept words, kept_text (null: all is kept)."""
    facts = word_facts(keyed(df, id_col, text_col))
    found = facts.join(stripped(df, id_col, text_col, width, gram), ["key", "mark"], "left")
    return found.select(
        F.when(F.col("key") < NO_ID, F.col("key")).alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "words_sha256").alias("kept_sha256"),
        "kept_text",
    )
