"""Per-clip metrics from a table of decoded frames.

`frames` has one row per frame: `clip_id, frame_idx, height, width, channels, pixels` with uint8
pixels in row-major HWC order. Frames are cut into blocks of consecutive indices per clip; the last
frame of a block is also sent to the next block, so each pair of neighbours meets exactly once and
a long clip is spread over many tasks. Kernels return sums, which Spark adds up per clip.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwarden.functions import scores
from clipwarden.operators.joins import maybe_in
from clipwarden.operators.ordered import exact_quantiles, rank_columns, ranked_quantiles
from clipwarden.session import cut_lineage, scratch_path
from clipwarden.spec import TargetSpec

BLOCK_FRAMES = 64
HIST_BINS = 64
# luma as an integer: 2126 r + 7152 g + 722 b, at most 255 * 10000
LUMA_UNIT = 2_550_000.0

PARTIAL_FIELDS = [
    "n_values", "n_pixels", "has_prev", "abs_sum", "abs_sq",
    "luma_sum", "luma_sq", "luma_min", "luma_max", "black", "white", "sat_sum",
    "dx_sum", "dx_n", "dy_sum", "dy_n",
    "r_sum", "g_sum", "b_sum", "r_sq", "g_sq", "b_sq",
]
PARTIAL_SCHEMA = (
    "clip_id string, frame_idx int, height int, width int, "
    + ", ".join(f"{f} double" for f in PARTIAL_FIELDS)
    + ", hist array<bigint>"
)


def with_neighbours(frames: DataFrame, block: int = BLOCK_FRAMES) -> DataFrame:
    """Blocks of consecutive frames, sorted, each led by the last frame of the block before."""
    own = F.floor(F.col("frame_idx") / F.lit(block))
    last = F.col("frame_idx") % block == block - 1
    return (
        frames.withColumn("_own", own)
        .withColumn(
            "_at", F.explode(F.when(last, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
        )
        .repartition("clip_id", "_at")
        .sortWithinPartitions("clip_id", "_at", "frame_idx")
    )


def _image(row: Any) -> np.ndarray:
    return np.frombuffer(row.pixels, dtype=np.uint8).reshape(row.height, row.width, row.channels)


def luma_units(image: np.ndarray) -> np.ndarray:
    """Exact integer luma per pixel; gray frames count their value as r, g and b."""
    x = image.astype(np.int64)
    if x.shape[2] == 1:
        return x[:, :, 0] * 10000
    return 2126 * x[:, :, 0] + 7152 * x[:, :, 1] + 722 * x[:, :, 2]


def frame_kernel(image: np.ndarray, prev: np.ndarray | None) -> dict[str, Any]:
    """Sums of one frame and of its difference to the frame before."""
    x = image.astype(np.int64)
    rgb = x if x.shape[2] >= 3 else np.repeat(x[:, :, :1], 3, axis=2)
    luma = luma_units(image)
    dx, dy = np.abs(np.diff(x, axis=1)), np.abs(np.diff(x, axis=0))
    top, low = rgb.max(axis=2) / 255.0, rgb.min(axis=2) / 255.0
    bins = np.minimum(luma * HIST_BINS // int(LUMA_UNIT), HIST_BINS - 1)
    out = {
        "n_values": x.size,
        "n_pixels": luma.size,
        "has_prev": 0.0,
        "abs_sum": 0.0,
        "abs_sq": 0.0,
        "luma_sum": luma.sum(),
        "luma_sq": (luma.astype(np.float64) ** 2).sum(),
        "luma_min": luma.min(),
        "luma_max": luma.max(),
        # value / 255 < .01 and value / 255 > .99
        "black": (x <= 2).sum(),
        "white": (x >= 253).sum(),
        "sat_sum": ((top - low) / np.maximum(top, 1e-6)).sum(),
        "dx_sum": dx.sum(),
        "dx_n": dx.size,
        "dy_sum": dy.sum(),
        "dy_n": dy.size,
        "hist": np.bincount(bins.ravel(), minlength=HIST_BINS).tolist(),
    }
    for i, c in enumerate("rgb"):
        out[f"{c}_sum"] = rgb[:, :, i].sum()
        out[f"{c}_sq"] = (rgb[:, :, i] ** 2).sum()
    if prev is not None:
        diff = np.abs(x - prev.astype(np.int64))
        out.update(has_prev=1.0, abs_sum=diff.sum(), abs_sq=(diff**2).sum())
    return out


def frame_partials(
    frames: DataFrame,
    kernel: Callable[[np.ndarray, np.ndarray | None], dict[str, Any]] = frame_kernel,
    schema: str = PARTIAL_SCHEMA,
    block: int = BLOCK_FRAMES,
) -> DataFrame:
    """One row per frame from a pluggable per-frame function.

    `kernel(image, previous_image)` returns the fields that `schema` lists after the key columns;
    the previous image is `None` for the first frame of a clip.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (clip, frame index, image) of the row before; one frame crosses batches
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                image = _image(r)
                follows = held is not None and held[0] == r.clip_id and held[1] == r.frame_idx - 1
                lead = r.own_block != r.at_block
                if not lead:
                    fields = kernel(image, held[2] if follows else None)
                    rows.append(
                        {"clip_id": r.clip_id, "frame_idx": r.frame_idx, "height": r.height, "width": r.width, **fields}
                    )
                held = (r.clip_id, r.frame_idx, image)
            if rows:
                yield pd.DataFrame(rows)

    laid = with_neighbours(
        frames.select("clip_id", "frame_idx", "height", "width", "channels", "pixels"), block
    ).withColumnsRenamed({"_own": "own_block", "_at": "at_block"})
    return laid.mapInPandas(run, schema)


def _std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from sums."""
    return F.when(n > 1, F.sqrt(F.greatest((squares - total * total / n) / (n - 1), F.lit(0.0))))


def pair_deltas(partials: DataFrame) -> DataFrame:
    """Mean absolute change per pair of neighbouring frames, on [0, 1]."""
    return partials.filter("has_prev = 1").select(
        "clip_id", "frame_idx", (F.col("abs_sum") / (F.col("n_values") * F.lit(255.0))).alias("delta")
    )


def clip_metrics(
    partials: DataFrame,
    clips: DataFrame,
    spec: TargetSpec = TargetSpec(),
    single_frame: str = "drop",
    duplicate_below: float = 0.002,
    high_motion_above: float = 0.12,
    scene_cut_above: float = 0.20,
    partitions: int | None = None,
) -> DataFrame:
    """The clip quality row (all but grade and reason), from frame partials and `clips(clip_id, fps)`.

    `single_frame` says what a clip without pairs becomes: `drop` leaves it out, `zero` counts one
    pair without change, `dup` reports it as all duplicate.
    """
    # read twice below: one small row per frame instead of a second pass over the pixels
    partials = cut_lineage(partials)
    sums = _sums(partials, duplicate_below, high_motion_above, scene_cut_above)
    p95 = exact_quantiles(pair_deltas(partials), ["clip_id"], "delta", {"motion_p95": 0.95}, partitions=partitions)
    m = _derive(sums).join(p95, "clip_id", "left").join(clips.select("clip_id", "fps"), "clip_id", "left")
    if single_frame == "drop":
        m = m.filter("pairs > 0")
    fill = {"zero": 1.0 if duplicate_below > 0 else 0.0, "dup": 1.0}.get(single_frame, 0.0)
    m = m.withColumns(
        {
            "duplicate_frame_ratio": F.coalesce("duplicate_frame_ratio", F.lit(fill)),
            "temporal_diff_mean": F.coalesce("temporal_diff_mean", F.lit(0.0)),
            "temporal_diff_std": F.coalesce("temporal_diff_std", F.lit(0.0)),
            "motion_p95": F.coalesce("motion_p95", F.lit(0.0)),
            "high_motion_ratio": F.coalesce("high_motion_ratio", F.lit(0.0)),
            "source_fps": F.coalesce("fps", F.lit(0.0)),
        }
    )
    c = F.col
    errors = scores.spec_errors(
        c("source_width"), c("source_height"), c("source_frames"), c("source_fps"), spec
    )
    return m.withColumns(errors).withColumns(
        {
            "conformance_score": scores.conformance(
                c("source_width"), c("source_height"), c("source_frames"), c("source_fps"),
                c("duplicate_frame_ratio"), spec,
            ),
            "timelapse_score": scores.timelapse(
                c("duplicate_frame_ratio"), c("high_motion_ratio"), c("temporal_diff_mean"), c("temporal_diff_std")
            ),
        }
    )


def _sums(partials: DataFrame, dup: float, high: float, cut: float) -> DataFrame:
    delta = F.when(
        F.col("has_prev") == 1, F.col("abs_sum") / (F.col("n_values") * F.lit(255.0))
    )
    luma_mean = F.col("luma_sum") / (F.col("n_pixels") * F.lit(LUMA_UNIT))
    n, s, ss = F.col("n_pixels"), F.col("luma_sum"), F.col("luma_sq")
    frame_std = _std(n, s, ss) / F.lit(LUMA_UNIT)
    blank = (F.coalesce(frame_std, F.lit(0.0)) < 0.01) | (luma_mean < 0.02)
    rows = partials.withColumns({"_delta": delta, "_luma": luma_mean, "_blank": blank})
    paired = F.when(F.col("has_prev") == 1, F.col("n_values")).otherwise(F.lit(0.0))
    plain = [f for f in PARTIAL_FIELDS if f not in ("has_prev", "luma_min", "luma_max")]
    return rows.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("source_frames"),
        F.max("width").alias("source_width"),
        F.max("height").alias("source_height"),
        F.sum("has_prev").alias("pairs"),
        F.sum(paired).alias("_paired"),
        *[F.sum(f).alias(f) for f in plain],
        F.min("luma_min").alias("luma_min"),
        F.max("luma_max").alias("luma_max"),
        F.avg(F.when(F.col("_delta") < dup, 1.0).when(F.col("_delta").isNotNull(), 0.0)).alias("duplicate_frame_ratio"),
        F.avg(F.when(F.col("_delta") > high, 1.0).when(F.col("_delta").isNotNull(), 0.0)).alias("high_motion_ratio"),
        F.count_if(F.col("_delta") > cut).alias("scene_cut_count"),
        F.stddev_samp("_luma").alias("flicker_luma_std"),
        F.avg(F.when(F.col("_blank"), 1.0).otherwise(0.0)).alias("blank_frame_ratio"),
        F.array(*[F.sum(F.col("hist")[i]) for i in range(HIST_BINS)]).alias("hist"),
    )


def entropy(hist: Column) -> Column:
    """Normalised entropy of a histogram column."""
    total = F.greatest(F.aggregate(hist, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(1))

    def term(x: Column) -> Column:
        p = x / total
        return p * F.log2(p + F.lit(1e-12))

    return -F.aggregate(hist, F.lit(0.0), lambda a, x: a + term(x)) / F.lit(float(np.log2(HIST_BINS)))


def _derive(sums: DataFrame) -> DataFrame:
    c = F.col
    unit = F.lit(LUMA_UNIT)
    cols = {
        "temporal_diff_mean": F.when(c("_paired") > 0, c("abs_sum") / (c("_paired") * 255.0)),
        "temporal_diff_std": _std(c("_paired"), c("abs_sum"), c("abs_sq")) / F.lit(255.0),
        "sharpness_grad_mean": c("dx_sum") / (c("dx_n") * 255.0) + c("dy_sum") / (c("dy_n") * 255.0),
        "entropy_mean": entropy(c("hist")),
        "black_pixel_ratio": c("black") / c("n_values"),
        "white_pixel_ratio": c("white") / c("n_values"),
        "luma_mean": c("luma_sum") / (c("n_pixels") * unit),
        "luma_std": _std(c("n_pixels"), c("luma_sum"), c("luma_sq")) / unit,
        "saturation_mean": c("sat_sum") / c("n_pixels"),
        "luma_low": c("luma_min") / unit,
        "luma_high": c("luma_max") / unit,
    }
    for ch in "rgb":
        cols[f"rgb_mean_{ch}"] = c(f"{ch}_sum") / (c("n_pixels") * 255.0)
        cols[f"rgb_std_{ch}"] = _std(c("n_pixels"), c(f"{ch}_sum"), c(f"{ch}_sq")) / F.lit(255.0)
    out = sums.withColumns(cols).withColumn("contrast_rms", c("luma_std"))
    return out.drop(*[f for f in PARTIAL_FIELDS if f not in ("n_values", "n_pixels")], "hist", "_paired")


def video_stats(partials: DataFrame, clips: DataFrame, spec: TargetSpec = TargetSpec(), partitions: int | None = None) -> DataFrame:
    """Metrics of resampled clips as logged before training; single frames count as unchanged."""
    return clip_metrics(partials, clips, spec, "zero", partitions=partitions)


def sample_metrics(partials: DataFrame, scale: float = 1.0) -> DataFrame:
    """Duplicate, static and timelapse scores of a sampled window, from pair deltas.

    `scale=1.0` keeps deltas on 0-255 against thresholds meant for [0, 1]; `scale=1/255` applies
    the thresholds as documented.
    """
    d = F.when(F.col("has_prev") == 1, F.col("abs_sum") / F.col("n_values") * F.lit(scale))
    share = lambda cond: F.avg(F.when(cond, 1.0).when(F.col("_d").isNotNull(), 0.0))
    agg = partials.withColumn("_d", d).groupBy("clip_id").agg(
        share(F.col("_d") < 0.002).alias("duplicate_ratio"),
        share(F.col("_d") < 0.02).alias("static_ratio"),
        share(F.col("_d") > 0.12).alias("_high"),
        F.avg("_d").alias("mean_delta"),
        F.stddev_samp("_d").alias("std_delta"),
    )
    lapse = scores.timelapse(F.col("duplicate_ratio"), F.col("_high"), F.col("mean_delta"), F.coalesce("std_delta", F.lit(float("nan"))))
    return agg.filter("mean_delta is not null").withColumn("timelapse_score", lapse).drop("_high")


def delta_quantiles(partials: DataFrame, partitions: int | None = None) -> DataFrame:
    """Quantiles of the pair deltas per clip."""
    probs = {"delta_p01": 0.01, "delta_p50": 0.50, "delta_p95": 0.95, "delta_p99": 0.99}
    return exact_quantiles(pair_deltas(partials), ["clip_id"], "delta", probs, partitions=partitions)


def jerk(partials: DataFrame) -> DataFrame:
    """Absolute change between consecutive pair deltas, by an equi join on the next index."""
    d = pair_deltas(partials)
    nxt = d.select("clip_id", (F.col("frame_idx") + 1).alias("frame_idx"), F.col("delta").alias("_before"))
    return d.join(nxt, ["clip_id", "frame_idx"]).select(
        "clip_id", "frame_idx", F.abs(F.col("delta") - F.col("_before")).alias("jerk")
    )


def jerk_metrics(partials: DataFrame, partitions: int | None = None) -> DataFrame:
    j = jerk(cut_lineage(partials))
    means = j.groupBy("clip_id").agg(F.avg("jerk").alias("jerk_mean"))
    return means.join(exact_quantiles(j, ["clip_id"], "jerk", {"jerk_p95": 0.95}, partitions=partitions), "clip_id")


def luma_quantiles(frames: DataFrame, bins: int = 1024) -> DataFrame:
    """Exact luma p01 and p99 per clip, selected in two steps.

    Pixels are read once: each batch of frames leaves one stored row per clip and bin, with the bin's different lumas
    and their counts. Bin totals, at most `bins` a clip, tell which bins hold the ranks; only lumas of those are shuffled.
    """
    spark, probs = frames.sparkSession, {"luma_p01": 0.01, "luma_p99": 0.99}
    width = int(LUMA_UNIT) // bins + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for clip, part in pdf.groupby("clip_id", sort=False):
                values = np.concatenate([luma_units(_image(r)).ravel() for r in part.itertuples(index=False)])
                if not len(values):
                    continue
                uniq, n = np.unique(values, return_counts=True)
                cuts = np.flatnonzero(np.diff(uniq // width)) + 1
                starts = np.concatenate(([0], cuts))
                yield pd.DataFrame(
                    {
                        "clip_id": clip, "bin": uniq[starts] // width, "n": np.add.reduceat(n, starts),
                        "units": np.split(uniq, cuts), "counts": np.split(n, cuts),
                    }
                )

    path = scratch_path(spark, "luma_bins")
    frames.select("clip_id", "height", "width", "channels", "pixels").mapInPandas(
        run, "clip_id string, bin bigint, n bigint, units array<bigint>, counts array<bigint>"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    clip = Window.partitionBy("clip_id")
    totals = stored.groupBy("clip_id", "bin").agg(F.sum("n").alias("_c")).select(
        "clip_id", "bin", "_c", F.sum("_c").over(clip.orderBy("bin")).alias("_upto"), F.sum("_c").over(clip).alias("_n")
    )
    first, upto = F.col("_upto") - F.col("_c"), F.col("_upto")
    held = [(first <= rank) & (rank < upto) for pair in rank_columns(probs, F.col("_n")) for rank in pair]
    wanted = totals.filter(reduce(Column.__or__, held)).select("clip_id", "bin", first.alias("_before"), "_n")
    wanted = cut_lineage(wanted.withColumn("_at", F.xxhash64("clip_id", "bin")))
    near = maybe_in(stored.withColumn("_at", F.xxhash64("clip_id", "bin")), wanted, "_at").drop("_at", "n")
    lumas = near.join(wanted.drop("_at"), ["clip_id", "bin"]).select(
        "clip_id", "bin", "_before", "_n", F.explode(F.arrays_zip("units", "counts")).alias("_e")
    )
    counted = lumas.groupBy("clip_id", "bin", "_before", "_n", "_e.units").agg(F.sum("_e.counts").alias("_c"))
    running = F.sum("_c").over(Window.partitionBy("clip_id", "bin").orderBy("units"))
    q = ranked_quantiles(counted.withColumn("_upto", F.col("_before") + running), ["clip_id"], "units", probs)
    return q.withColumns({c: F.col(c) / F.lit(LUMA_UNIT) for c in probs})


def frame_pair_errors(a: DataFrame, b: DataFrame, frame_idx: int = 0) -> DataFrame:
    """Mse, mae and psnr between equally indexed frames of two frame tables."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.filter(F.col("frame_idx") == frame_idx).select("clip_id", F.col("pixels").alias(f"pixels_{tag}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                x = np.frombuffer(r.pixels_a, dtype=np.uint8).astype(np.int64)
                y = np.frombuffer(r.pixels_b, dtype=np.uint8).astype(np.int64)
                rows.append((r.clip_id, float(((x - y) ** 2).sum()) / (x.size * 65025.0), float(np.abs(x - y).sum()) / (x.size * 255.0)))
            yield pd.DataFrame(rows, columns=["clip_id", "mse", "mae"])

    joined = side(a, "a").join(side(b, "b"), "clip_id")
    return joined.mapInPandas(run, "clip_id string, mse double, mae double").withColumn(
        "psnr", scores.psnr(F.col("mse"))
    )


def sample_frames(frames: DataFrame, totals: DataFrame, wanted: int) -> DataFrame:
    """Pick evenly spread frames per clip (`totals`: clip_id, total); short clips repeat frames."""
    plan = totals.select("clip_id", F.posexplode(scores.uniform_frames(F.col("total"), wanted)).alias("slot", "frame_idx"))
    return plan.join(frames, ["clip_id", "frame_idx"])


def _resize_weights(source: int, target: int) -> np.ndarray:
    """Area-averaging weights from `source` to `target` cells."""
    edges = np.linspace(0, source, target + 1)
    cells = np.arange(source)
    over = np.minimum(edges[1:, None], cells[None, :] + 1) - np.maximum(edges[:-1, None], cells[None, :])
    over = np.clip(over, 0, None)
    return over / over.sum(axis=1, keepdims=True)


def image_hash(image: np.ndarray, cols: int = 8, rows: int = 8) -> int:
    """Difference hash: gray, resize to (cols + 1) x rows, bit = left > right, row by row, MSB first."""
    x = image.astype(np.float64)
    gray = x[:, :, 0] if x.shape[2] == 1 else x[:, :, :3] @ np.array([0.299, 0.587, 0.114])
    small = _resize_weights(gray.shape[0], rows) @ gray @ _resize_weights(gray.shape[1], cols + 1).T
    bits = (small[:, :-1] > small[:, 1:]).ravel()
    value = 0
    for b in bits.tolist():
        value = value << 1 | int(b)
    return value - (1 << 64) if value >= 1 << 63 else value


def frame_hashes(frames: DataFrame, cols: int = 8, rows: int = 8) -> DataFrame:
    """Difference hash per frame as a signed 64-bit integer (`cols * rows <= 64`).

    Resizing averages areas, so hashes of large frames are not bit-equal to a Lanczos resize.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(
                {
                    "clip_id": pdf["clip_id"],
                    "frame_idx": pdf["frame_idx"],
                    "dhash": [image_hash(_image(r), cols, rows) for r in pdf.itertuples(index=False)],
                }
            )

    return frames.select("clip_id", "frame_idx", "height", "width", "channels", "pixels").mapInPandas(
        run, "clip_id string, frame_idx int, dhash bigint"
    )


def clip_hashes(hashes: DataFrame, indices: tuple[int, int, int] = (0, 60, 120)) -> DataFrame:
    """First, middle and last hash per clip from a frame-hash table."""
    names = ["first_hash", "middle_hash", "last_hash"]
    picks = hashes.filter(F.col("frame_idx").isin(list(indices)))
    return picks.groupBy("clip_id").agg(
        *[F.max(F.when(F.col("frame_idx") == i, F.col("dhash"))).alias(n) for i, n in zip(indices, names)]
    )


def hash_triples(
    frames: DataFrame, cols: int = 8, rows: int = 8, indices: tuple[int, int, int] = (0, 60, 120)
) -> DataFrame:
    """First, middle and last hash per clip from decoded frames; no other frame is sent to Python."""
    return clip_hashes(frame_hashes(frames.filter(F.col("frame_idx").isin(list(indices))), cols, rows), indices)


def array_dhash(gray: Column, cols: int, rows: int) -> Column:
    """Difference hash of an already sized gray array of `(cols + 1) * rows` values, JVM only.

    `gray` should be a plain column: an expression would be evaluated again for every bit.
    """
    at = [r * (cols + 1) + i for r in range(rows) for i in range(cols)]

    def fold(acc: Column, i: Column) -> Column:
        bit = F.when(F.get(gray, i) > F.get(gray, i + 1), 1).otherwise(0)
        return F.shiftleft(acc, 1).bitwiseOR(bit.cast("bigint"))

    return F.aggregate(F.lit(at).cast("array<int>"), F.lit(0).cast("bigint"), fold)


def gray_pixels(values: Column) -> Column:
    """Pack an array of 0..255 integers as pixel bytes, JVM only."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("bigint")), 2, "0")), ""))
