"""Duplicate removal: perceptual, one per source, last wins, overlap thinning, altered copies."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import comparable_text, fixed_text
from clipwarden.operators.latest import edge_rows
from clipwarden.operators.ordered import carry_fold, join_null_safe
from clipwarden.spec import OVERLAP_WINDOW_SEC

HASHES = ["first_hash", "middle_hash", "last_hash"]


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def mean_hamming(pairs: list[tuple[Column, Column]]) -> Column:
    total = F.lit(0)
    for a, b in pairs:
        total = total + hamming(a, b)
    return total / F.lit(float(len(pairs)))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values).view(np.uint8), axis=-1).sum(axis=-1)


def perceptual_dedup(
    clips: DataFrame,
    threshold: float = 8.0,
    source: str = "source_video_id",
    start: str = "clip_start_sec",
    tiebreak: list[str] = ["clip_id"],  # noqa: B006
    partitions: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Compare each clip with the last kept clip of its source; drop it at distance <= threshold.

    Clips with a missing hash are kept and make the next clip a fresh reference. Adds `decision`
    (`kept` or `removed`), `distance` and `reference_clip`.
    """
    def step(state, rows: pd.DataFrame):
        known = rows[HASHES].notna().all(axis=1).to_numpy()
        packed = rows[HASHES].fillna(0).astype("int64").to_numpy()
        ids = rows["clip_id"].to_numpy()
        n = len(rows)
        decision = np.full(n, "kept", dtype=object)
        distance = np.full(n, None, dtype=object)
        reference = np.full(n, None, dtype=object)
        i = 0
        while i < n:
            if not known[i]:
                state = None
                i += 1
                continue
            if state is None:
                state = (packed[i].tolist(), ids[i])
                i += 1
                continue
            # distances to the reference, in growing strides, up to the next kept clip
            width = 64
            while i < n and state is not None:
                stop = min(n, i + width)
                gap = np.flatnonzero(~known[i:stop])
                if len(gap):
                    stop = i + int(gap[0])
                if stop == i:
                    break
                dist = _bits(packed[i:stop] ^ np.array(state[0], dtype="int64")) / float(len(HASHES))
                far = np.flatnonzero(dist > threshold)
                end = i + int(far[0]) + 1 if len(far) else stop
                distance[i:end] = dist[: end - i]
                reference[i:end] = state[1]
                if len(far):
                    decision[i : end - 1] = "removed"
                    state = (packed[end - 1].tolist(), ids[end - 1])
                    i = end
                    break
                decision[i:end] = "removed"
                i, width = end, min(width * 4, 65536)
        return state, {"decision": decision, "distance": distance, "reference_clip": reference}

    outputs = {"decision": "string", "distance": "double", "reference_clip": "string"}
    return carry_fold(
        clips, [source], [start, *tiebreak], ["clip_id", *HASHES], step, outputs, partitions=partitions,
        block_rows=block_rows,
    )


def blank_removed_captions(decided: DataFrame, keep: bool = False) -> DataFrame:
    """Empty the caption of removed rows unless `keep`."""
    if keep:
        return decided
    return decided.withColumn(
        "caption", F.when(F.col("decision") == "removed", F.lit("")).otherwise(F.col("caption"))
    )


def one_per_source(
    clips: DataFrame,
    min_frames: int = 121,
    max_dup_ratio: float = 0.03,
    source: str = "source_video_id",
    start: str = "clip_start_sec",
    tiebreak: list[str] = ["clip_id"],  # noqa: B006
    compat: bool = False,
) -> DataFrame:
    """Keep the earliest valid clip per source; every row gets one decision and a reason.

    Needs `source_frames` and `dup_ratio`; null in either means unusable metrics. The choice is one
    small row per source joined back, so a hot source is never gathered. With `compat=True`
    a source without candidates reports its earliest clip as kept *and* as removed, and rows with
    unusable metrics vanish there and count as later rows elsewhere.
    """
    c = F.col
    usable = c("source_frames").isNotNull() & c("dup_ratio").isNotNull()
    short = usable & (c("source_frames") < min_frames)
    repeated = usable & ~short & (c("dup_ratio") > max_dup_ratio)
    valid = usable & ~short & ~repeated
    rank = F.struct(start, *tiebreak)
    rows = clips.withColumns({"_rank": rank, "_valid": valid, "_short": short, "_rep": repeated})
    ranks = rows.select(source, start, *tiebreak, "_rank", "_valid")
    first = edge_rows(ranks, [source], [start, *tiebreak], last=False)
    best = edge_rows(ranks.filter("_valid"), [source], [start, *tiebreak], last=False)
    picks = join_null_safe(
        first.select(source, c("_rank").alias("_first")), best.select(source, c("_rank").alias("_best")), [source], "left"
    )
    joined = join_null_safe(rows, picks, [source])
    fallback = c("_best").isNull()
    chosen = F.coalesce(c("_rank") == c("_best"), F.lit(False))
    first = fallback & (c("_rank") == c("_first"))
    frames_msg = F.concat(
        F.lit("frames="), c("source_frames").cast("string"), F.lit(f"<{min_frames}")
    )
    dup_msg = F.concat(F.lit("dup_ratio="), fixed_text(c("dup_ratio"), 3), F.lit(f">{max_dup_ratio}"))
    removed_reason = (
        F.when(c("_short"), frames_msg)
        .when(c("_rep"), dup_msg)
        .when(~fallback, F.lit("later_from_same_source"))
        .otherwise(F.lit("bad_metrics"))
    )
    kept = chosen | first
    reason = (
        F.when(chosen, "kept").when(first, "no_valid_candidate_kept_earliest").otherwise(removed_reason)
    )
    if compat:
        entry = F.struct(
            F.when(kept, "kept").otherwise("removed").alias("decision"), reason.alias("reason")
        )
        again = F.struct(F.lit("removed").alias("decision"), removed_reason.alias("reason"))
        entries = (
            F.when(first & (c("_short") | c("_rep")), F.array(entry, again))
            .when(fallback & ~first & (removed_reason == "bad_metrics"), F.array().cast(
                "array<struct<decision:string,reason:string>>"))
            .otherwise(F.array(entry))
        )
        joined = joined.withColumn("_e", F.explode(entries))
        return joined.select(*clips.columns, "_e.decision", "_e.reason")
    return joined.select(
        *clips.columns, F.when(kept, "kept").otherwise("removed").alias("decision"), reason.alias("reason")
    )


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key in `order`."""
    return edge_rows(df, keys, order)


def thin_overlaps(
    df: DataFrame,
    key: str,
    start: str,
    window: float = OVERLAP_WINDOW_SEC,
    tiebreak: list[str] = [],  # noqa: B006
    partitions: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Greedy thinning: keep the first start of a key, then each start `window` after the last kept."""
    def step(state, rows: pd.DataFrame):
        at = rows[start].to_numpy(dtype="float64")
        kept = np.zeros(len(at), dtype=bool)
        i = 0 if state is None else int(np.searchsorted(at - state, window, side="left"))
        while i < len(at):
            kept[i] = True
            state = float(at[i])
            i = max(i + 1, int(np.searchsorted(at - state, window, side="left")))
        return state, {"kept": kept}

    return carry_fold(
        df, [key], [start, *tiebreak], [start], step, {"kept": "boolean"}, partitions=partitions, block_rows=block_rows
    )


def altered_copies(
    a: DataFrame,
    b: DataFrame,
    match: list[str] = ["caption", "width", "height", "num_frames"],  # noqa: B006
    differ: list[str] = ["clip_sha256", "source_video_id", "clip_start_sec"],  # noqa: B006
) -> DataFrame:
    """Suspected re-uploads: versions in `a` with rows in `b` alike in `match` but with another hash, source or start.

    One row per different version of `a`: match, differ, `rows` of that version, and `altered`, how many rows of
    `b` are alike and differ. It is the size of the group in `b` less its rows of the same version, so no pairs
    are formed; all counts are summed up before they are shuffled.
    """
    same = {f"_c{i}": comparable_text(F.col(c)) for i, c in enumerate(differ)}

    def named(df: DataFrame) -> DataFrame:
        return df.select(*match, *differ).filter(F.col(match[0]).isNotNull() & (F.col(match[0]) != "")).withColumns(same)

    alike = [F.col(m) for m in match]
    shown = [F.min(c).alias(c) for c in differ]
    versions = named(a).groupBy(*match, *same).agg(*shown, F.count(F.lit(1)).alias("rows"))
    there = named(b).groupBy(*match, *same).agg(F.count(F.lit(1)).alias("_same"))
    groups = named(b).groupBy(*alike).agg(F.count(F.lit(1)).alias("_all"))
    found = versions.join(groups, match).join(there, [*match, *same], "left")
    return found.withColumn("altered", F.col("_all") - F.coalesce("_same", F.lit(0))).filter("altered > 0").select(
        *match, *differ, "rows", "altered"
    )
