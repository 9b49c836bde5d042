"""Queries of the streaming operators (G): table data arrives as files and is processed to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwarden.operators.grade import score_clips
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.plans.rule_queries import _LINES, manifest_lines
from clipwarden.session import scratch_path
from clipwarden.streaming import streams

c = F.col
ROW = ", ".join(b.ROW_ORDER)


def _streamed(spark, name, parts, build, partition_by=()):
    """Land `parts` one after the other and run the stream after each: state is carried from run to run.

    The files keep the natural partitions of the data. Results go into batch folders, which are read back.
    """
    path, out, state = (scratch_path(spark, f"{name}_{k}") for k in ("in", "out", "checkpoint"))
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = build(streams.file_stream(spark, path, parts[0].schema))
        streams.run_available(streams.to_batches(stream, out, list(partition_by)), state)
    return spark.read.parquet(out).drop("batch_id")


def _halves(df, key):
    """`df` in two parts by a hash of `key`."""
    odd = F.pmod(F.xxhash64(key), F.lit(2)) == 1
    return [df.filter(odd), df.filter(~odd)]


@query(
    "G01_graded_stream",
    f"WITH {b.GRADED_SQL} SELECT {ROW}, reason, CASE WHEN grade = 'FAIL' THEN 'quarantine' ELSE lower(grade) END AS route FROM graded",
)
def g01(spark, d):
    def build(arriving):
        return streams.graded_stream(arriving).select(*b.ROW_ORDER, "reason", "route")

    return _streamed(spark, "graded", _halves(score_clips(b.clips(spark, d)), "l_orderkey"), build, ["route"])


def _events_with_end(spark, d):
    """Events, and after them one late marker that moves the watermark past all of them."""
    # watermarks need an instant; built from the epoch, it does not depend on the session's zone
    ts = F.timestamp_micros(b.epoch_micros("ts")).alias("ts")
    ev = b.table(spark, d, "events").select("event_id", ts, c("event_type"), "user_id", "value")
    end = ev.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit("end").alias("event_type"),
        F.lit(-1).cast("bigint").alias("user_id"), F.lit(0.0).alias("value"),
    )
    return [ev, end]


@query(
    "G02_rolling_summary",
    """SELECT epoch_us(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')) AS window_us, event_type, count(value) AS n, round(avg(value), 6) AS mean,
    min(value) AS min, max(value) AS max FROM events GROUP BY ALL""",
)
def g02(spark, d):
    def build(arriving):
        return streams.rolling_summary(arriving, "ts", ["event_type"], "value", "6 hours")

    t = _streamed(spark, "summary", _events_with_end(spark, d), build).filter("event_type <> 'end'")
    return t.select(
        F.unix_micros("window_start").alias("window_us"), "event_type", "n", F.round("mean", 6).alias("mean"), "min", "max"
    )


@query(
    "G03_new_rows",
    "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0)",
)
def g03(spark, d):
    ids = b.table(spark, d, "lineitem").select(c("l_orderkey").alias("id"), "l_linenumber")
    history = b.table(spark, d, "orders").filter(c("o_custkey") % 3 == 0).select(c("o_orderkey").alias("id"))
    # most ids arrive in both runs: the second one meets the memory of the first
    parts = [ids.filter("l_linenumber % 2 = 1").select("id"), ids.filter("l_linenumber % 2 = 0").select("id")]
    path, out, state = (scratch_path(spark, f"new_{k}") for k in ("in", "out", "checkpoint"))
    for part in parts:
        part.write.mode("append").parquet(path)
        arriving = streams.file_stream(spark, path, part.schema)
        streams.run_available(streams.new_rows_writer(arriving, "id", out, history), state)
    return spark.read.parquet(out).select("id")


@query(
    "G04_run_monitor",
    f"""WITH RECURSIVE {b.RUNLOG_SQL}, n AS (SELECT run, step, loss, row_number() OVER (PARTITION BY run ORDER BY step) AS rn FROM runlog),
    e AS (SELECT run, step, rn, loss, loss AS ema, CASE WHEN step >= 1 THEN loss ELSE 1e300 END AS best, 0 AS miss, NULL::BIGINT AS stopped,
        CASE WHEN step >= 1 THEN 'improved' ELSE 'ignored' END AS status FROM n WHERE rn = 1
      UNION ALL SELECT n.run, n.step, n.rn, n.loss, 0.9e0 * e.ema + (1e0 - 0.9e0) * n.loss,
        CASE WHEN e.stopped IS NULL AND n.step >= 1 AND n.loss < e.best - 0.05e0 THEN n.loss ELSE e.best END,
        CASE WHEN e.stopped IS NOT NULL OR n.step < 1 THEN e.miss WHEN n.loss < e.best - 0.05e0 THEN 0 ELSE e.miss + 1 END,
        CASE WHEN e.stopped IS NOT NULL THEN e.stopped WHEN n.step >= 1 AND NOT n.loss < e.best - 0.05e0 AND e.miss + 1 >= 2 THEN n.step END,
        CASE WHEN e.stopped IS NOT NULL THEN 'after_stop' WHEN n.step < 1 THEN 'ignored' WHEN n.loss < e.best - 0.05e0 THEN 'improved'
          WHEN e.miss + 1 >= 2 THEN 'stopped' ELSE 'no_improvement' END
      FROM e JOIN n ON n.run = e.run AND n.rn = e.rn + 1) SELECT run, step, round(ema, 9) AS loss_ema, status FROM e""",
)
def g04(spark, d):
    # steps of a run arrive in order: early steps of all runs first, then the later ones
    rows = b.runlog(spark, d).select("run", "step", "loss")
    parts = [rows.filter("step < 2"), rows.filter("step >= 2 AND step < 4"), rows.filter("step >= 4")]

    path, out, state = (scratch_path(spark, f"watched_{k}") for k in ("in", "out", "checkpoint"))
    for part in parts:
        part.write.mode("append").parquet(path)
        arriving = streams.file_stream(spark, path, parts[0].schema)
        streams.run_available(streams.run_monitor(arriving, "run", "step", "loss", out, 0.9, 1, 0.05, 2), state)
    t = spark.read.parquet(f"{out}/rows").drop("batch_id")
    return t.select("run", "step", F.round("loss_ema", 9).alias("loss_ema"), "status")


@query(
    "G05_overlap_monitor",
    f"""WITH {b.STARTS_SQL} SELECT x.key, x.start, x.event_id AS arrival, EXISTS (SELECT 1 FROM starts y WHERE y.key = x.key AND y.event_id < x.event_id
      AND abs(y.start - x.start) < 3600e0) AS overlaps FROM starts x""",
)
def g05(spark, d):
    # arrival is the event id, so a third of the range of ids comes at a time
    rows = b.starts(spark, d).select("event_id", "key", "start")
    ends = rows.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    step = ((ends.high or 0) - (ends.low or 0)) // 3 + 1
    third = F.floor((c("event_id") - (ends.low or 0)) / step)
    parts = [rows.filter(third == i) for i in range(3)]

    path, out, state = (scratch_path(spark, f"judged_{k}") for k in ("in", "out", "checkpoint"))
    for part in parts:
        part.write.mode("append").parquet(path)
        arriving = streams.file_stream(spark, path, parts[0].schema)
        streams.run_available(streams.overlap_monitor_writer(arriving, "key", "start", "event_id", out, 3600.0), state)
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


@query(
    "G06_activity_sessions",
    """WITH n AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sess FROM n)
    SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 7200000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, sess""",
)
def g06(spark, d):
    def build(arriving):
        return streams.activity_sessions(arriving, "user_id", "ts", "2 hours")

    t = _streamed(spark, "sessions", _events_with_end(spark, d), build).filter("user_id >= 0")
    return t.select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n")


@query(
    "G07_linted_stream",
    f"""WITH {_LINES}, k AS (SELECT *, coalesce(trim(video), '') <> '' AS hv FROM rowz)
    SELECT 'MANIFEST_BAD_JSON' AS code, line, NULL AS sample_id FROM raw WHERE kind = 'bad'
    UNION ALL SELECT 'MANIFEST_ROW_NOT_OBJECT', line, NULL FROM raw WHERE kind = 'list'
    UNION ALL SELECT 'MISSING_ID', line, sample_id FROM k WHERE id IS NULL OR trim(id) = ''
    UNION ALL SELECT 'MISSING_VIDEO_FIELD', line, sample_id FROM k WHERE NOT hv
    UNION ALL SELECT 'MISSING_PROMPT_FIELD', line, sample_id FROM k WHERE hv AND trim(prompt) = ''
    UNION ALL SELECT 'PROMPT_TOO_SHORT', line, sample_id FROM k WHERE hv AND trim(prompt) <> '' AND len(regexp_extract_all(prompt, '\\S+')) < 6
    UNION ALL SELECT 'UNUSUAL_VIDEO_EXTENSION', line, sample_id FROM k WHERE hv AND path LIKE '%.gif'""",
)
def g07(spark, d):
    lines = manifest_lines(spark, d).select((c("doc_id") + 1).alias("no"), "value")
    def build(arriving):
        return streams.linted_stream(arriving, "/data", c("no")).select("code", "line", "sample_id")

    return _streamed(spark, "issues", _halves(lines, "no"), build)
