"""Analytics over append-only training logs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import finite
from clipwarden.functions.scores import per_second
from clipwarden.operators.ordered import carry_fold, join_null_safe, rank_within


def ema_values(values: np.ndarray, decay: float, before: float | None) -> np.ndarray:
    """Exponential moving average of `values`, going on from `before` or seeded by the first value."""
    out = np.empty(len(values))
    ema = before
    for i, v in enumerate(values.tolist()):
        ema = v if ema is None else decay * ema + (1 - decay) * v
        out[i] = ema
    return out


def ema_many(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, decay: float) -> np.ndarray:
    """`ema_values` of many runs at a time, each seeded by its first value: all second values, all third ones, and so on."""
    out = np.asarray(values, dtype="float64").copy()
    live = np.arange(len(starts))
    for nth in range(1, int(sizes.max(initial=0))):
        live = live[sizes[live] > nth]
        here = starts[live] + nth
        out[here] = decay * out[here - 1] + (1 - decay) * out[here]
    return out


def ema(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    decay: float = 0.98,
    name: str = "ema",
    partitions: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Moving average per key in order, seeded by the first value.

    The state of a block is an affine map of the state before it, so blocks of one long run are
    composed instead of replayed.
    """
    def step(state, rows: pd.DataFrame):
        values = rows[value].to_numpy(dtype="float64")
        # state: (ema so far, decay^n, ema of the rows when started from zero)
        last, scale, offset = state if state is not None else (None, 1.0, 0.0)
        out = ema_values(values, decay, last)
        tail = ema_values(values, decay, offset)
        return (float(out[-1]), scale * decay ** len(values), float(tail[-1])), {name: out}

    def merge(before, tail):
        joined = tail[1] * before[0] + tail[2]
        return (joined, before[1] * tail[1], tail[1] * before[2] + tail[2])

    def bulk(rows: pd.DataFrame, starts, sizes):
        return {name: ema_many(rows[value].to_numpy(dtype="float64"), starts, sizes, decay)}

    return carry_fold(
        df, keys, order, [value], step, {name: "double"}, merge=merge, partitions=partitions, block_rows=block_rows, bulk=bulk
    )


def early_stop_scan(state, steps, losses, warmup: int, min_delta: float, patience: int):
    """Advance (best, best_step, misses, stopped_at) over validation rows; also flags per row."""
    best, best_step, misses, stopped = state or (math.inf, None, 0, None)
    flags = []
    for s, v in zip(steps, losses):
        flag = "after_stop" if stopped is not None else "ignored"
        if stopped is None and s >= warmup and v is not None and not math.isnan(v):
            if v < best - min_delta:
                best, best_step, misses, flag = v, s, 0, "improved"
            else:
                misses += 1
                flag = "no_improvement"
                if misses >= patience > 0:
                    stopped, flag = s, "stopped"
        flags.append((flag, None if math.isinf(best) else best, best_step, misses))
    return (best, best_step, misses, stopped), flags


def early_stop_many(
    steps: np.ndarray, losses: np.ndarray, starts: np.ndarray, sizes: np.ndarray, warmup: int, min_delta: float, patience: int,
    seeds: tuple | None = None,
) -> dict[str, np.ndarray]:
    """`early_stop_scan` of many runs at a time: all first rows, all second ones, and so on.

    `seeds` are (is a state, best, best step, misses, stopped step) per row; a state is the first row of its run. Returns per
    row: status, best, best_step, misses, and the step of the stop once there was one; absent values are masked.
    """
    n, runs = len(steps), len(starts)
    best, misses = np.full(runs, np.inf), np.zeros(runs, "int64")
    best_step, stopped = (np.ma.masked_all(runs, "int64") for _ in range(2))
    out = {
        "status": np.full(n, "ignored", object), "best": np.ma.masked_all(n, "float64"), "best_step": np.ma.masked_all(n, "int64"),
        "misses": np.zeros(n, "int64"), "stopped": np.ma.masked_all(n, "int64"),
    }
    live = np.arange(runs)
    for nth in range(int(sizes.max(initial=0))):
        live = live[sizes[live] > nth]
        here = starts[live] + nth
        real = np.ones(len(live), bool)
        if nth == 0 and seeds is not None:
            real = ~seeds[0][here]
            r, h = live[~real], here[~real]
            best[r] = np.where(np.isnan(seeds[1][h]), np.inf, seeds[1][h])
            best_step[r], misses[r], stopped[r] = seeds[2][h], seeds[3][h], seeds[4][h]
            out["status"][h] = "state"
        gone = ~np.ma.getmaskarray(stopped)[live]
        judged = real & ~gone & (steps[here] >= warmup) & ~np.isnan(losses[here])
        better = judged & (losses[here] < best[live] - min_delta)
        worse = judged & ~better
        best[live[better]] = losses[here[better]]
        best_step[live[better]] = steps[here[better]]
        misses[live[better]] = 0
        misses[live[worse]] += 1
        ends = worse & (patience > 0) & (misses[live] >= patience)
        stopped[live[ends]] = steps[here[ends]]
        for flag, hit in (("after_stop", real & gone), ("improved", better), ("no_improvement", worse), ("stopped", ends)):
            out["status"][here[hit]] = flag
        out["best"][here] = np.ma.masked_invalid(best[live])
        out["best_step"][here], out["misses"][here], out["stopped"][here] = best_step[live], misses[live], stopped[live]
    return out


def early_stop(
    df: DataFrame,
    keys: list[str],
    step_col: str,
    loss: str,
    warmup: int = 0,
    min_delta: float = 0.005,
    patience: int = 2,
    partitions: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """Early-stop trace per run: `status`, best loss, best step and misses after each row."""
    outputs = {"status": "string", "best_loss": "double", "best_step": "bigint", "misses": "int"}

    def advance(state, rows: pd.DataFrame):
        state, flags = early_stop_scan(
            state, rows[step_col].tolist(), rows[loss].tolist(), warmup, min_delta, patience
        )
        return state, dict(zip(outputs, zip(*flags)))

    def bulk(rows: pd.DataFrame, starts, sizes):
        steps, losses = rows[step_col].to_numpy("int64"), rows[loss].to_numpy("float64")
        told = early_stop_many(steps, losses, starts, sizes, warmup, min_delta, patience)
        return dict(zip(outputs, (told[k] for k in ("status", "best", "best_step", "misses"))))

    return carry_fold(
        df, keys, [step_col], [step_col, loss], advance, outputs, partitions=partitions, block_rows=block_rows, bulk=bulk
    )


def early_stop_result(trace: DataFrame, keys: list[str], step_col: str) -> DataFrame:
    """One row per run: stop step (null when it ran on), best step and best loss."""
    live = F.col("status") != "after_stop"
    at = F.when(live, F.col(step_col))
    return trace.groupBy(*keys).agg(
        F.min(F.when(F.col("status") == "stopped", F.col(step_col))).alias("stop_step"),
        F.max_by("best_step", at).alias("best_step"),
        F.max_by("best_loss", at).alias("best_loss"),
    )


def latest_finite(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Last finite value per key."""
    good = finite(F.col(value))
    return df.groupBy(*keys).agg(
        F.max_by(value, F.when(good, F.col(order))).alias("latest"),
    )


def temporal_thirds(
    df: DataFrame, keys: list[str], order: list[str], value: str, partitions: int | None = None
) -> DataFrame:
    """Means of the first, middle and last third of each series; fewer than 3 rows give one mean.

    The thirds are `[0,a) [a,2a) [2a,n)` with `a = n div 3`.
    """
    ranked = rank_within(df, keys, order, "_rank", partitions)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    third = F.greatest(F.expr("_n div 3"), F.lit(1))
    pos = F.col("_rank") - 1
    many = F.col("_n") >= 3
    v = F.col(value)
    return (
        join_null_safe(ranked, sizes, keys)
        .groupBy(*keys)
        .agg(
            F.avg(F.when(many & (pos < third), v)).alias("first"),
            F.avg(F.when(many & (pos >= third) & (pos < 2 * third), v)).alias("middle"),
            F.avg(F.when(many & (pos >= 2 * third), v)).alias("last"),
            F.avg(F.when(~many, v)).alias("all"),
        )
    )


def timing_columns(parts: list[str], total: str, samples: Column, frames_per_sample: int) -> dict[str, Column]:
    """Share of each timing part in the step and the throughput columns."""
    out = {f"{p}_share": F.col(p) / F.greatest(F.col(total), F.lit(1e-6)) for p in parts}
    out["samples_per_second"] = per_second(samples, F.col(total))
    out["frames_per_second"] = per_second(samples * F.lit(frames_per_sample), F.col(total))
    return out
