"""Joins of the clip tables: quality lookups, overlap range joins, version pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.operators.ordered import global_index, neighbours, running_sums
from clipwarden.session import cut_lineage
from clipwarden.spec import OVERLAP_WINDOW_SEC


def attach_measures(clips: DataFrame, quality: DataFrame) -> DataFrame:
    """Left join of clips to quality rows by clip id, strict defaults (no frames, all duplicate)."""
    right = quality.select(
        F.col("name").alias("clip_id"),
        F.col("source_frames").alias("_frames"),
        F.col("duplicate_frame_ratio").alias("_dup"),
        F.lit(True).alias("_hit"),
    )
    return (
        clips.join(right, "clip_id", "left")
        .withColumns(
            {
                "source_frames": F.when(F.col("_hit"), F.col("_frames")).otherwise(F.lit(0)),
                "dup_ratio": F.when(F.col("_hit"), F.col("_dup")).otherwise(F.lit(1.0)),
            }
        )
        .drop("_frames", "_dup", "_hit")
    )


def keep_passed(clips: DataFrame, quality: DataFrame) -> DataFrame:
    """Clips whose id is graded PASS."""
    passed = quality.filter(F.col("grade") == "PASS").select(F.col("name").alias("clip_id"))
    return clips.join(passed, "clip_id", "left_semi")


def skip_seen(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    return df.join(history.select(key), key, "left_anti")


#: Bits of one bitmap of `bitmap_construct_agg`.
BITMAP_BITS = 32768


def maybe_in(rows: DataFrame, probe: DataFrame, key: str, blocks: int = 256, hashes: int = 4) -> DataFrame:
    """Rows whose key may stand in `probe`: all that do, and a few that do not.

    A blocked Bloom filter of the keys of `probe`: a hash picks one of `blocks` bitmaps, `hashes` others pick
    its bits. It is broadcast and takes 4 KB a block however many keys there are; more keys only let more
    rows through. Nothing of `rows` is shuffled.
    """
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block")
    bits = [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BITMAP_BITS)).cast("int") for i in range(hashes)]
    maps = probe.select(block, F.explode(F.array(*bits)).alias("_bit")).groupBy("_block").agg(
        F.bitmap_construct_agg("_bit").alias("_map")
    )

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_map"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("getbit", byte, bit % 8) == 1

    held = rows.withColumn("_block", block).join(F.broadcast(maps), "_block")
    for bit in bits:
        held = held.filter(is_set(bit))
    return held.select(*rows.columns)


def _starts(df: DataFrame, key: str, start: str) -> DataFrame:
    """Distinct starts per key with their copies counted: copies never meet as pairs."""
    return (
        df.select(F.col(key).alias("key"), F.col(start).cast("double").alias("start"))
        .filter(F.col("key").isNotNull() & F.col("start").isNotNull())
        .groupBy("key", "start")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _window_end(start: Column, window: float, up: bool) -> Column:
    """The last place whose difference to `start` is below `window`, as floating-point subtraction sees it.

    It lies a few steps of the number format around `start` plus or minus `window`.
    """
    s, w = start, F.lit(float(window))
    at = s + w if up else s - w
    half_step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.abs(at), F.abs(s), w))) - 53)
    tried = F.array(*[at + half_step * k for k in range(-4, 5)])
    inside = F.filter(tried, lambda x: ((x - s) if up else (s - x)) < w)
    return F.array_max(inside) if up else F.array_min(inside)


def _near_counts(points: DataFrame, probes: DataFrame, window: float) -> DataFrame:
    """For each start of `probes`, how many of `points` (key, start, copies) are closer than `window`.

    Both ends of a start's window are sorted among the points; the difference of the running counts at the
    two ends is the answer. No pairs are formed, and a hot key spans many blocks.
    """
    # at equal places: the lower end, then the points, then the upper end, as both ends lie inside the window
    ends = F.array(
        F.struct(_window_end(F.col("start"), window, True).alias("at"), F.lit(2).alias("turn"), F.lit(1).alias("sign")),
        F.struct(_window_end(F.col("start"), window, False).alias("at"), F.lit(0).alias("turn"), F.lit(-1).alias("sign")),
    )
    asked = probes.select("key", "start", F.col("copies").alias("own"), F.explode(ends).alias("e")).select(
        "key", "start", "own", "e.at", "e.turn", "e.sign", F.lit(0).cast("bigint").alias("n")
    )
    there = points.select(
        "key", "start", F.lit(None).cast("bigint").alias("own"), F.col("start").alias("at"), F.lit(1).alias("turn"),
        F.lit(0).alias("sign"), F.col("copies").alias("n"),
    )
    counted = running_sums(asked.unionByName(there), ["key"], ["at", "turn"], {"upto": F.col("n")})
    return (
        counted.filter("sign <> 0")
        .groupBy("key", "start")
        .agg(F.max("own").alias("copies"), F.sum(F.col("upto") * F.col("sign")).alias("near"))
    )


def overlap_counts(df: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC) -> DataFrame:
    """Per different start: key, start, copies, and `overlaps`, the other clips of the key closer than `window`.

    Half the sum of copies * overlaps is the number of overlapping pairs.
    """
    starts = _starts(df, key, start)
    return _near_counts(starts, starts, window).select("key", "start", "copies", (F.col("near") - 1).alias("overlaps"))


def cross_overlap_counts(
    a: DataFrame, b: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC
) -> DataFrame:
    """Per different start of `a`: key, start, copies, and `overlaps`, the clips of `b` closer than `window`."""
    return _near_counts(_starts(b, key, start), _starts(a, key, start), window).withColumnRenamed("near", "overlaps")


def overlap_details(df: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC) -> DataFrame:
    """Per different start that overlaps another clip: key, start, copies, `nearest` other start and its `distance`.

    A start that stands more than once is its own nearest, at distance 0; of two equally near ones the earlier is named.
    """
    starts = _starts(df, key, start)
    flagged = starts.select("key", "start", F.lit(True).alias("asked"), F.lit(True).alias("there"))
    near = neighbours(flagged, ["key"], "start", "asked", "there").join(starts.filter("copies > 1"), ["key", "start"], "left")
    return _nearest(near.withColumn("same", F.col("copies").isNotNull()), window).withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))


def cross_overlap_details(
    a: DataFrame, b: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC
) -> DataFrame:
    """Per different start of `a` that overlaps a clip of `b`: key, start, copies, the `nearest` start of `b`, `distance`."""
    sides = _starts(a, key, start).withColumn("side", F.lit("a")).unionByName(_starts(b, key, start).withColumn("side", F.lit("b")))
    copies = {k: F.sum(F.when(F.col("side") == k, F.col("copies"))) for k in "ab"}
    both = sides.groupBy("key", "start").agg(copies["a"].alias("copies"), copies["b"].isNotNull().alias("there"))
    both = cut_lineage(both.withColumn("asked", F.col("copies").isNotNull()))
    own = both.filter("asked").select("key", "start", "copies", F.col("there").alias("same"))
    near = neighbours(both, ["key"], "start", "asked", "there").join(own, ["key", "start"])
    return _nearest(near, window)


def _nearest(near: DataFrame, window: float) -> DataFrame:
    """Name the nearest place of rows with `same` (one lies at the row's own start), `before` and `after`."""
    s = F.col("start")
    back, ahead = s - F.col("before"), F.col("after") - s
    nearest = (
        F.when(F.col("same"), s)
        .when(F.col("after").isNull() | (back <= ahead), F.col("before"))
        .otherwise(F.col("after"))
    )
    named = near.withColumn("nearest", nearest).withColumn("distance", F.abs(F.col("nearest") - s))
    return named.filter(F.col("distance") < window).select("key", "start", "copies", "nearest", "distance")


def touching(
    a: DataFrame, b: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC
) -> DataFrame:
    """Rows of `a` closer than `window` to any row of `b` with the same key (range semi join).

    Only the smallest and largest start of each bin of `b` matter, so `b` shrinks to one row per
    key and bin before it is shuffled and no pairs are formed.
    """
    floor = F.floor(F.col("_s") / F.lit(window))
    edges = (
        b.select(F.col(key).alias("_k"), F.col(start).cast("double").alias("_s"))
        .filter(F.col("_k").isNotNull() & F.col("_s").isNotNull())
        .groupBy("_k", floor.alias("_bin"))
        .agg(F.min("_s").alias("_min"), F.max("_s").alias("_max"))
    )
    # what a row in bin t has to look at: its own bin, the end of t-1, the start of t+1
    near = (
        edges.select("_k", "_min", "_max", F.explode(F.array(*[F.lit(o) for o in (-1, 0, 1)])).alias("_o"), "_bin")
        .groupBy("_k", (F.col("_bin") + F.col("_o")).alias("_bin"))
        .agg(
            F.max(F.when(F.col("_o") == 1, F.col("_max"))).alias("_before"),
            F.min(F.when(F.col("_o") == 0, F.col("_min"))).alias("_low"),
            F.max(F.when(F.col("_o") == 0, F.col("_max"))).alias("_high"),
            F.min(F.when(F.col("_o") == -1, F.col("_min"))).alias("_after"),
        )
    )
    probe = a.withColumn("_s", F.col(start).cast("double"))
    probe = probe.withColumns({"_k": F.col(key), "_bin": F.floor(F.col("_s") / F.lit(window))})
    close = F.lit(False)
    for edge in ("_before", "_low", "_high", "_after"):
        close = close | F.coalesce(F.abs(F.col("_s") - F.col(edge)) < window, F.lit(False))
    return (
        probe.join(near, ["_k", "_bin"])
        .filter(close)
        .select(*a.columns)
    )


def overlap_count(
    a: DataFrame, b: DataFrame, key: str, start: str, window: float = OVERLAP_WINDOW_SEC
) -> DataFrame:
    """Positions of the smaller dataset that touch the other one; `a` wins a tie.

    The side depends on both row counts, so they are taken first.
    """
    rows_a, rows_b = a.count(), b.count()
    small, large = (b, a) if rows_a > rows_b else (a, b)
    side = "b" if rows_a > rows_b else "a"
    return touching(small, large, key, start, window).agg(
        F.lit(side).alias("counted_side"), F.count(F.lit(1)).alias("overlaps")
    )


def overlap_index(df: DataFrame, key: str, start: str) -> DataFrame:
    return df.agg(
        F.count_distinct(key).alias("keys"), F.count(F.col(start)).alias("positions")
    )


def positional_join(
    a: DataFrame, b: DataFrame, order: list[str], cols: list[str], partitions: int | None = None
) -> DataFrame:
    """Zip two datasets by their sorted position; `cols` come back as `<col>_a` and `<col>_b`."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        slim = df.select(*dict.fromkeys([*order, *cols]))
        return global_index(slim, order, "position", partitions).select(
            "position", *[F.col(c).alias(f"{c}_{tag}") for c in cols]
        )

    return side(a, "a").join(side(b, "b"), "position", "full_outer")


def map_ids(df: DataFrame, id_map: DataFrame, column: str = "clip_id") -> DataFrame:
    """Replace ids by their new ones; ids without an entry become null."""
    pairs = id_map.select(F.col("old_id").alias(column), F.col("new_id"))
    return (
        df.join(pairs, column, "left").withColumn(column, F.col("new_id")).drop("new_id")
        .select(*df.columns)
    )


def with_files(df: DataFrame, files: DataFrame, uri: str, how: str = "left", base: str = "/") -> DataFrame:
    """Join rows to a file listing (`path`, `size_mb`) by the resolved path of `uri`; each path counts once."""
    from clipwarden.functions.paths import resolve_path

    there = files.groupBy(resolve_path(F.col("path"), base).alias("_path")).agg(F.max("size_mb").alias("size_mb"))
    keyed = df.withColumn("_path", resolve_path(F.col(uri), base))
    if how in ("left_anti", "left_semi"):
        there = there.select("_path")
    return keyed.join(there, "_path", how).drop("_path")
