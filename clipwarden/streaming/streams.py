"""The rule and log operators on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from clipwarden.operators import grade, lint
from clipwarden.operators.joins import maybe_in
from clipwarden.operators.logs import early_stop_many, early_stop_scan, ema_many, ema_values
from clipwarden.operators.ordered import carry_fold, join_null_safe
from clipwarden.session import cut_lineage
from clipwarden.sources.manifests import classify_lines, parsed_rows, path_exists, read_issues
from clipwarden.spec import OVERLAP_WINDOW_SEC, GradeThresholds


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def to_batches(df: DataFrame, path: str, partition_by: list[str] = []):  # noqa: B006
    """Writer into one folder per micro batch; a replayed batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(write)


def graded_stream(quality: DataFrame, limits: GradeThresholds = GradeThresholds()) -> DataFrame:
    """Grades arriving quality rows and names their route."""
    return grade.grade_clips(quality, limits).withColumn(
        "route", F.when(F.col("grade") == "FAIL", "quarantine").otherwise(F.lower("grade"))
    )


def rolling_summary(
    log: DataFrame, ts: str, keys: list[str], value: str, window: str = "10 minutes", slide: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """Count, mean, min and max per (sliding) event-time window and key."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        log.withWatermark(ts, watermark)
        .groupBy(span.alias("w"), *keys)
        .agg(
            F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
        )
        .select(F.col("w.start").alias("window_start"), *keys, "n", "mean", "min", "max")
    )


def new_rows(
    stream: DataFrame, key: str, history: DataFrame | None = None, ts: str | None = None, watermark: str = "1 hour"
) -> DataFrame:
    """Rows whose key was seen neither in `history` nor earlier in the stream.

    With `ts` the memory of seen keys is bounded by the watermark; without it the state store holds every key:
    `new_rows_writer` keeps them in a table.
    """
    rows = stream if history is None else stream.join(history.select(key), key, "left_anti")
    if ts:
        return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])


def unseen(rows: DataFrame, key: str, seen: DataFrame, blocks: int = 256) -> DataFrame:
    """One row of each key of `rows` that is not in `seen`; a null is a key like any other.

    Of the stored keys only those that pass the Bloom filter of `rows` are shuffled; the anti join is exact.
    """
    stored = maybe_in(seen.select(key), rows.select(key), key, blocks)
    return join_null_safe(rows.dropDuplicates([key]), stored, [key], "left_anti")


def new_rows_writer(stream: DataFrame, key: str, path: str, history: DataFrame | None = None, blocks: int = 256):
    """Writer of the rows whose key is neither in `history` nor in an earlier micro batch.

    The rows found so far, one folder per batch, are themselves the memory, so the state store stays empty.
    A replayed batch looks at earlier batches only and overwrites its own folder.
    """
    spark, schema = stream.sparkSession, stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = batch.select(key).limit(0) if history is None else history.select(key)
        if path_exists(spark, path):
            found = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(path)
            seen = seen.unionByName(found.filter(F.col("batch_id") < batch_id).select(key))
        unseen(batch, key, seen, blocks).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write)


def watched(
    rows: DataFrame, states: DataFrame, decay: float = 0.98, warmup: int = 0, min_delta: float = 0.005, patience: int = 2,
    block_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Moving average and early stop of new rows (run, step, loss), continuing from `states`: (rows, new states).

    A run's state is a first row of its own in an ordered fold over blocks of (run, step), so a run may span many tasks.
    States have one row per run: run, ema, best, best_step, misses, stopped.
    """
    known = states.join(rows.select("run").distinct(), "run", "left_semi")
    lined = rows.select("run", "step", "loss", F.lit(1).alias("kind")).unionByName(
        known.select("*", F.lit(0).alias("kind")), allowMissingColumns=True
    )

    def average(state, part: pd.DataFrame):
        # (average so far, decay^n, average of the rows when started from zero); a state row forgets what was before
        values, seeds = part["loss"].to_numpy(dtype="float64"), part["ema"].to_numpy(dtype="float64")
        seeded = int(part["kind"].iloc[0] == 0)
        last, scale, offset = state if state is not None else (None, 1.0, 0.0)
        if seeded:
            last, scale, offset = float(seeds[0]), 0.0, float(seeds[0])
        out, tail = ema_values(values[seeded:], decay, last), ema_values(values[seeded:], decay, offset)
        n = len(out)
        ends = (float(out[-1]), scale * decay**n, float(tail[-1])) if n else (last, scale, offset)
        return ends, {"loss_ema": [seeds[0]] * seeded + out.tolist()}

    def joined(before, tail):
        now = tail[1] * before[0] + tail[2]
        return (now, before[1] * tail[1], tail[1] * before[2] + tail[2])

    def averages(part: pd.DataFrame, starts, sizes):
        values = np.where(part["kind"] == 0, part["ema"].to_numpy(dtype="float64"), part["loss"].to_numpy(dtype="float64"))
        return {"loss_ema": ema_many(values, starts, sizes, decay)}

    smooth = carry_fold(
        lined, ["run"], ["kind", "step"], ["loss", "ema", "kind"], average, {"loss_ema": "double"}, merge=joined,
        block_rows=block_rows, bulk=averages,
    )
    outputs = {"status": "string", "now_best": "double", "now_best_step": "bigint", "now_misses": "bigint", "now_stopped": "bigint"}

    def judge(state, part: pd.DataFrame):
        made: list[tuple] = []
        if part["kind"].iloc[0] == 0:
            best, at, misses, stopped = (None if pd.isna(v) else v for v in part.iloc[0][["best", "best_step", "misses", "stopped"]])
            state = (float("inf") if best is None else best, at, int(misses or 0), stopped)
            made.append(("state", best, at, state[2], stopped))
            part = part.iloc[1:]
        steps = part["step"].tolist()
        state, flags = early_stop_scan(state, steps, part["loss"].tolist(), warmup, min_delta, patience)
        stopped = state[3]
        for s, (flag, best, at, misses) in zip(steps, flags):
            gone = stopped if flag in ("stopped", "after_stop") else None
            made.append((flag, best, at, misses, gone))
        return state, dict(zip(outputs, zip(*made)))

    def judge_many(part: pd.DataFrame, starts, sizes):
        def whole(name):
            return np.ma.masked_array(part[name].fillna(0).to_numpy("int64"), part[name].isna().to_numpy())

        state = (part["kind"] == 0).to_numpy()
        seeds = (state, part["best"].to_numpy("float64"), whole("best_step"), whole("misses").data, whole("stopped"))
        found = early_stop_many(
            whole("step").data, part["loss"].to_numpy("float64"), starts, sizes, warmup, min_delta, patience, seeds
        )
        return dict(zip(outputs, (found[k] for k in ("status", "best", "best_step", "misses", "stopped"))))

    kept = ["step", "loss", "kind", "best", "best_step", "misses", "stopped"]
    fold = carry_fold(smooth, ["run"], ["kind", "step"], kept, judge, outputs, block_rows=block_rows, bulk=judge_many)
    told = cut_lineage(fold)
    last = F.struct("kind", "step")
    ends = told.groupBy("run").agg(
        *[F.max_by(v, last).alias(n) for n, v in {
            "ema": "loss_ema", "best": "now_best", "best_step": "now_best_step", "misses": "now_misses", "stopped": "now_stopped",
        }.items()]
    )
    after = states.join(ends.select("run"), "run", "left_anti").unionByName(ends)
    return told.filter("kind = 1").select("run", "step", "loss", "loss_ema", "status"), after


def run_monitor(
    log: DataFrame, run: str, step: str, loss: str, path: str, decay: float = 0.98, warmup: int = 0,
    min_delta: float = 0.005, patience: int = 2, block_rows: int | None = None,
):
    """Writer of the watched rows of each micro batch to `path`/rows; each continues from the states of the one before.

    States are a table per batch, `path`/states. A replayed batch starts from the same states and overwrites its own
    folders, so it changes nothing. No task holds a run: see `watched`.
    """
    spark = log.sparkSession
    kind = dict(log.dtypes)[run]
    schema = f"run {kind}, ema double, best double, best_step bigint, misses bigint, stopped bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = f"{path}/states/batch_id={batch_id - 1}"
        states = spark.read.schema(schema).parquet(earlier) if path_exists(spark, earlier) else spark.createDataFrame([], schema)
        rows = batch.select(F.col(run).alias("run"), F.col(step).cast("bigint").alias("step"), F.col(loss).cast("double").alias("loss"))
        found, after = watched(rows, states, decay, warmup, min_delta, patience, block_rows)
        found.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        after.write.mode("overwrite").parquet(f"{path}/states/batch_id={batch_id}")

    return log.writeStream.foreachBatch(write)


def overlap_monitor(
    clips: DataFrame, key: str, start: str, arrival: str, window: float = OVERLAP_WINDOW_SEC, ts: str | None = None,
    retention_seconds: float | None = None, watermark: str = "1 hour", windows_per_bin: int = 64,
) -> DataFrame:
    """Marks arriving clips that start closer than `window` to an earlier arrival of the same key.

    State is kept per key and time bin, so a hot key spreads over tasks: rows near the edge of a bin are also shown
    to the neighbouring bin, and each row is judged in its own. A bin is cut into cells as wide as the window and
    keeps the least and the greatest start of each, as these decide for every later row: the state of a bin has at
    most `windows_per_bin` + 2 cells however many clips arrive.

    With `ts` and `retention_seconds` a bin forgets its starts once the watermark has passed its latest row by that
    much, so the answer does not depend on how fast rows arrive; rows behind the watermark are late and left out.
    Without them nothing is forgotten. An arrival that is null comes first of its batch, and of
    equal ones the smaller start; clips whose start is null or not a number are left out.
    """
    if (ts is None) != (retention_seconds is None):
        raise ValueError("ts and retention_seconds go together")
    forget = ts is not None
    if forget:
        clips = clips.withWatermark(ts, watermark)
    clips = clips.filter(F.col(start).isNotNull() & ~F.isnan(F.col(start).cast("double")))
    width = F.lit(float(window * windows_per_bin))
    bins = F.floor(F.col(start) / width)
    into = F.col(start) - bins * width
    reach = F.array(
        bins, F.when(into <= window, bins - 1), F.when(into >= width - F.lit(float(window)), bins + 1)
    )
    shown = clips.select(
        F.col(key).alias("key"),
        F.col(start).cast("double").alias("start"),
        F.col(arrival).cast("bigint").alias("arrival"),
        bins.alias("own"),
        *([F.col(ts).alias("ts")] if forget else []),
        F.explode(F.array_compact(reach)).alias("bin"),
    )

    def judge(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        cells, low, high, latest = state.get if state.exists else ([], [], [], None)
        ends = dict(zip(cells, zip(low, high)))
        parts = []
        for pdf in batches:
            parts.append(pdf[["arrival", "start", "own"]].astype({"arrival": "Int64"}))
            if forget and pdf["ts"].notna().any():
                newest = int(pdf["ts"].max().timestamp() * 1000)
                latest = newest if latest is None else max(latest, newest)
        rows = pd.concat(parts).sort_values(["arrival", "start"], na_position="first")
        marks = []
        for arrived, s, own in rows.itertuples(index=False):
            cell = int(s // window)
            # a start closer than the window lies at most one cell away, two where the division rounds
            near = any(abs(s - q) < window for k in range(cell - 2, cell + 3) for q in ends.get(k, ()))
            if own == group[1]:
                marks.append((group[0], s, arrived, near))
            least, most = ends.get(cell, (s, s))
            ends[cell] = (min(least, s), max(most, s))
        state.update((list(ends), [e[0] for e in ends.values()], [e[1] for e in ends.values()], latest))
        if forget and latest is not None:
            due = latest + int(retention_seconds * 1000)
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if marks:
            yield pd.DataFrame(marks, columns=["key", "start", "arrival", "overlaps"]).astype({"arrival": "Int64"})

    kind = dict(shown.dtypes)["key"]
    return shown.groupBy("key", "bin").applyInPandasWithState(
        judge,
        f"key {kind}, start double, arrival bigint, overlaps boolean",
        "cells array<bigint>, low array<double>, high array<double>, latest bigint",
        "append",
        GroupStateTimeout.EventTimeTimeout if forget else GroupStateTimeout.NoTimeout,
    )


def judge_starts(rows: DataFrame, cells: DataFrame, window: float = OVERLAP_WINDOW_SEC) -> DataFrame:
    """Rows (key, start, arrival) with `overlaps`: closer than `window` to an earlier row of the key or to a start in `cells`.

    A cell is as wide as the window; `cells` (key, cell, low, high) hold its least and greatest start of earlier batches.
    Each row is shown to the cells its window reaches, three as a rule, and compared with the least and the greatest
    start that came there before it: a window over (key, cell), so a hot key spreads over its cells. Equal rows are
    told apart by their number alone: the first may be free, the others overlap it.
    """
    width = F.lit(float(window))
    place = F.col("start") / width
    # quotients round: a start just below a border may be counted above it
    slack = F.lit(1e-9) + F.abs(place) * F.lit(1e-15)
    reach = F.sequence(F.floor(place - 1 - slack), F.floor(place + 1 + slack))
    shown = rows.select("key", "start", "arrival", F.floor(place).alias("home"), F.explode(reach).alias("cell"))
    own = F.col("cell") == F.col("home")
    shown = shown.select(
        "key", "cell", F.lit(1).alias("kind"), "arrival", "start", own.alias("own"),
        F.when(own, F.col("start")).alias("low"), F.when(own, F.col("start")).alias("high"),
    )
    lined = shown.unionByName(cells.select("key", "cell", "low", "high", F.lit(0).alias("kind")), allowMissingColumns=True)
    before = Window.partitionBy("key", "cell").orderBy("kind", "arrival", "start").rowsBetween(Window.unboundedPreceding, -1)
    near = [F.abs(F.col("start") - end.over(before)) < width for end in (F.min("low"), F.max("high"))]
    met = lined.withColumn("near", F.coalesce(near[0] | near[1], F.lit(False))).filter("kind = 1 AND (own OR near)")
    told = met.groupBy("key", "start", "arrival").agg(
        F.count_if("own").alias("copies"), F.min(F.when(F.col("own"), F.col("near"))).alias("first"),
        F.max(F.when(~F.col("own"), F.col("near"))).alias("beside"),
    )
    free = F.col("first") | F.coalesce("beside", F.lit(False))
    return told.select(
        "key", "start", "arrival", F.explode(F.concat(F.array(free), F.array_repeat(F.lit(True), F.col("copies").cast("int") - 1))).alias("overlaps")
    )


def overlap_monitor_writer(clips: DataFrame, key: str, start: str, arrival: str, path: str, window: float = OVERLAP_WINDOW_SEC):
    """Writer of the verdicts of `overlap_monitor` to `path`/rows, for streams that forget nothing.

    The memory is a table: the least and the greatest start per key and cell of each batch, in `path`/cells. All of a micro
    batch is judged by `judge_starts`, so no group of clips costs a call of its own and the state store stays empty.
    A replayed batch looks at earlier batches only and overwrites its own folders.
    """
    spark = clips.sparkSession
    kind = dict(clips.dtypes)[key]
    schema = f"key {kind}, cell bigint, low double, high double, batch_id bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(F.col(key).alias("key"), F.col(start).cast("double").alias("start"), F.col(arrival).cast("bigint").alias("arrival"))
        rows = rows.filter(F.col("start").isNotNull() & ~F.isnan("start"))
        known = spark.createDataFrame([], schema)
        if path_exists(spark, f"{path}/cells"):
            known = spark.read.schema(schema).parquet(f"{path}/cells").filter(F.col("batch_id") < batch_id)
        judge_starts(rows, known, window).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        cells = rows.groupBy("key", F.floor(F.col("start") / F.lit(float(window))).alias("cell")).agg(
            F.min("start").alias("low"), F.max("start").alias("high")
        )
        cells.write.mode("overwrite").parquet(f"{path}/cells/batch_id={batch_id}")

    return clips.writeStream.foreachBatch(write)


def activity_sessions(
    events: DataFrame, key: str, ts: str, gap: str = "1 hour", watermark: str = "1 hour"
) -> DataFrame:
    """Gap-based sessions per key: start, end (of the last event plus the gap) and event count."""
    return (
        events.withWatermark(ts, watermark)
        .groupBy(F.session_window(ts, gap).alias("s"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
    )


def linted_stream(lines: DataFrame, base: str, line: Column) -> DataFrame:
    """Row-local manifest issues on a stream of text lines."""
    classified = classify_lines(lines.select(line.alias("line"), F.col("value").alias("raw")))
    return read_issues(classified).unionByName(lint.lint_text(parsed_rows(classified), base))
