"""Exact duplicates with a split for heavy hitters.

Each task keeps a Misra-Gries summary of the digests it sees. Summed over tasks, the counters that exceed
1/`counters` of all rows number fewer than `counters` and include every digest above 2/`counters` of the
rows. Their true counts and first ids are aggregated (partial sums before the shuffle) and broadcast:
their rows are decided in the map task. All other digests are shuffled; no such group holds more than
2/`counters` of the rows.

Defined results: a null text counts as empty, and empty texts equal each other; runs of ASCII white space
count as one space; the smallest id of equal texts stays, a null id sorts last; rows that repeat id and
text stay or go together; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text, stored

COUNTERS = 1000


def misra_gries(items: Iterable[bytes], counters: int) -> dict[bytes, int]:
    """Lower bounds of the items' counts, short of the truth by at most len(items) / (counters + 1)."""
    held: dict[bytes, int] = {}
    for item in items:
        if item in held:
            held[item] += 1
        elif len(held) < counters:
            held[item] = 1
        else:
            held = {k: v - 1 for k, v in held.items() if v > 1}
    return held


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """doc_id, digest (SHA-256 of the normalised text), keep_id, group_size, kept; one row per row of `df`."""
    digests = stored(
        id_and_text(df, id_col, text_col).select(
            "doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")
        ),
        "digests",
    )

    def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries((d for b in batches for d in b.column(0).to_pylist()), counters)
        cols = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, ["digest", "n"])

    rows = digests.agg(F.count(F.lit(1)).alias("_rows"))
    frequent = (
        digests.select("digest")
        .mapInArrow(summaries, "digest binary, n bigint")
        .groupBy("digest")
        .agg(F.sum("n").alias("_at_least"))
        .join(F.broadcast(rows), F.col("_at_least") * counters > F.col("_rows"))
        .select("digest")
    )
    # fewer than `counters` rows of 32 bytes each, by the threshold above
    winners = stored(
        digests.join(F.broadcast(frequent), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )
    decided = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.min("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    return decided.unionByName(rest).select(
        "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    )
