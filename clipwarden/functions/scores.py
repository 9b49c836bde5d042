"""Conformance, timelapse and dashboard scores; sampling plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwarden.functions.numbers import round_even
from clipwarden.spec import TargetSpec

DEFAULT = TargetSpec()


def _unit(col: Column) -> Column:
    return F.least(col, F.lit(1.0))


def aspect_error(width: Column, height: Column, spec: TargetSpec = DEFAULT) -> Column:
    ratio = width.cast("double") / F.greatest(height, F.lit(1)).cast("double")
    return F.abs(ratio - F.lit(spec.width / spec.height))


def fps_error(fps: Column, spec: TargetSpec = DEFAULT) -> Column:
    return F.when(fps > 0, fps - F.lit(spec.fps)).otherwise(F.lit(0.0))


def duration_seconds(frames: Column, fps: Column) -> Column:
    return F.when(fps > 0, frames.cast("double") / fps).otherwise(F.lit(0.0))


def spec_errors(
    width: Column, height: Column, frames: Column, fps: Column, spec: TargetSpec = DEFAULT
) -> dict[str, Column]:
    """The error columns against the target profile, by name."""
    return {
        "width_error_px": width - F.lit(spec.width),
        "height_error_px": height - F.lit(spec.height),
        "frame_error": frames - F.lit(spec.frames),
        "fps_error": fps_error(fps, spec),
        "aspect_error": aspect_error(width, height, spec),
        "duration_seconds": duration_seconds(frames, fps),
    }


def conformance(
    width: Column,
    height: Column,
    frames: Column,
    fps: Column,
    duplicate_ratio: Column,
    spec: TargetSpec = DEFAULT,
) -> Column:
    """One minus the mean of six penalties, each at most 1."""

    def off(value: Column, target: float) -> Column:
        return _unit(F.abs(value.cast("double") - F.lit(float(target))) / F.lit(float(target)))

    fps_part = F.when(fps > 0, off(fps, spec.fps)).otherwise(F.lit(0.25))
    total = (
        off(width, spec.width)
        + off(height, spec.height)
        + off(frames, spec.frames)
        + fps_part
        + _unit(aspect_error(width, height, spec))
        + duplicate_ratio
    )
    return F.lit(1.0) - total / F.lit(6.0)


def timelapse(duplicate_ratio: Column, high_motion: Column, mean: Column, std: Column) -> Column:
    """Timelapse likelihood; `std` is over all elements for clips, over pair deltas for samples."""
    steady = F.lit(1.0) - _unit(std / F.greatest(mean, F.lit(1e-6)))
    score = _unit(high_motion * F.lit(0.7) + steady * F.lit(0.3))
    gate = (duplicate_ratio < 0.05) & (high_motion > 0.30) & (mean > 0.0025)
    return F.when(gate, score).otherwise(F.lit(0.0))


def dataset_bars(
    conformance_mean: Column, motion: Column, sharpness: Column, entropy: Column, duplicates: Column
) -> dict[str, Column]:
    return {
        "conformance": conformance_mean,
        "motion": _unit(motion * F.lit(8.0)),
        "sharpness": _unit(sharpness * F.lit(12.0)),
        "entropy": entropy,
        "low_duplicates": F.greatest(F.lit(0.0), F.lit(1.0) - duplicates),
    }


def inference_bars(psnr: Column, motion: Column, blank: Column, speed: Column) -> dict[str, Column]:
    return {
        "first_frame_psnr_40": _unit(psnr / F.lit(40.0)),
        "motion": _unit(motion * F.lit(10.0)),
        "low_blank": F.greatest(F.lit(0.0), F.lit(1.0) - blank),
        "speed": _unit(speed / F.lit(8.0)),
    }


def psnr(mse: Column) -> Column:
    return F.when(mse <= 1e-12, F.lit(99.0)).otherwise(F.lit(-10.0) * F.log10(mse))


def per_second(amount: Column, seconds: Column) -> Column:
    return amount.cast("double") / F.greatest(seconds, F.lit(1e-6))


# --- sampling plans --------------------------------------------------------


def plan_total_frames(duration: Column, fps: Column, minimum: int = DEFAULT.frames) -> Column:
    """Frame total assumed for a clip of known duration."""
    n = F.when(duration > 0, round_even(duration * fps)).otherwise(F.lit(minimum))
    return F.greatest(n, F.lit(minimum)).cast("bigint")


def keyframe_plan(total: Column, count: int) -> Column:
    """Evenly spread frame indices, rounded half to even."""
    if count < 1:
        return F.array().cast("array<bigint>")
    if count == 1:
        return F.array(F.lit(0).cast("bigint"))
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: round_even(i.cast("double") * (total - 1) / F.lit(float(count - 1))),
    )


def uniform_frames(total: Column, wanted: int) -> Column:
    """`wanted` indices over a clip of `total` frames; identity when equal, error when empty."""
    step = (total - 1).cast("double") / F.lit(float(max(wanted - 1, 1)))
    picks = F.transform(
        F.sequence(F.lit(0), F.lit(wanted - 1)),
        lambda i: F.least(round_even(i.cast("double") * step), total - 1).cast("bigint"),
    )
    same = F.sequence(F.lit(0).cast("bigint"), (total - 1).cast("bigint"))
    return (
        F.when(total <= 0, F.raise_error(F.lit("video has no frames")).cast("array<bigint>"))
        .when(total == wanted, same)
        .otherwise(picks)
    )


def sample_window(duration: Column, length: float = 20.0) -> dict[str, Column]:
    """Start and length of the sample cut from a source; null without a known duration."""
    known = duration > 0
    size = F.least(F.lit(float(length)), duration * F.lit(0.25))
    start = F.least(
        duration * F.lit(0.4),
        F.greatest(duration * F.lit(0.1), duration / F.lit(2.0) - size / F.lit(2.0)),
    )
    return {"sample_start": F.when(known, start), "sample_duration": F.when(known, size)}
