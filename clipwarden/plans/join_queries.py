"""Queries of joins (J), windows and folds (W), duplicates (D), selection (T) and set operations (U)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from clipwarden.functions import paths
from clipwarden.operators import compare, dedup, grade, joins, logs, merge, ordered, profile, select
from clipwarden.operators import frames as fr
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.plans.rule_queries import LATEST_SQL, clip_manifest, latest_quality, all_files
from clipwarden.plans.scalar_queries import HASH_SQL

c = F.col
ROW = ", ".join(b.ROW_ORDER)
WINDOW = 3600.0


@query(
    "J01_attach_quality",
    f"""WITH {LATEST_SQL} SELECT {', '.join('m.' + k for k in b.ROW_ORDER)}, coalesce(q.grade, 'PASS') AS grade,
    coalesce(q.duplicate_frame_ratio, 0e0) AS duplicate_frame_ratio FROM clips m LEFT JOIN latest q ON q.clip_id = m.clip_id""",
)
def j01(spark, d):
    return grade.attach_quality(clip_manifest(spark, d), latest_quality(spark, d)).select(
        *b.ROW_ORDER, "grade", "duplicate_frame_ratio"
    )


def _by_stem(spark, d):
    # names are never null here; saying so spares joins a null check of the whole expression on every measured row, which
    # as one large filter is too long for the JVM to compile
    return latest_quality(spark, d).withColumn("name", F.coalesce(paths.stem(c("name")), F.lit("")))


@query(
    "J02_attach_measures",
    f"""WITH {LATEST_SQL} SELECT {', '.join('m.' + k for k in b.ROW_ORDER)}, coalesce(q.source_frames, 0) AS source_frames,
    coalesce(q.duplicate_frame_ratio, 1e0) AS dup_ratio FROM clips m LEFT JOIN latest q ON q.clip_id = m.clip_id""",
)
def j02(spark, d):
    rows = b.clips(spark, d).select("clip_id", *b.ROW_ORDER)
    return joins.attach_measures(rows, _by_stem(spark, d)).select(*b.ROW_ORDER, "source_frames", "dup_ratio")


@query(
    "J03_keep_passed",
    f"WITH {LATEST_SQL} SELECT {ROW} FROM clips WHERE clip_id IN (SELECT clip_id FROM latest WHERE grade = 'PASS')",
)
def j03(spark, d):
    rows = b.clips(spark, d).select("clip_id", *b.ROW_ORDER)
    return joins.keep_passed(rows, _by_stem(spark, d)).select(*b.ROW_ORDER)


@query("J04_skip_seen", "SELECT l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0) GROUP BY 1")
def j04(spark, d):
    history = b.table(spark, d, "orders").filter(c("o_custkey") % 3 == 0).select(c("o_orderkey").alias("id"))
    rows = b.table(spark, d, "lineitem").select(c("l_orderkey").alias("id"))
    return joins.skip_seen(rows, history, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "J05_full_outer_versions",
    f"""WITH {b.RECORDS2_SQL} SELECT clip_id, CASE WHEN t.o_orderkey IS NULL THEN 'original_only' WHEN o.o_orderkey IS NULL THEN 'processed_only' ELSE 'both' END AS present,
    coalesce(o.clip_sha256 = t.clip_sha256, false) AS clip_sha256_same, coalesce(o.source_video_id = t.source_video_id, false) AS source_video_id_same,
    coalesce(o.clip_start_sec = t.clip_start_sec, false) AS clip_start_sec_same, o.caption IS NOT DISTINCT FROM t.caption AS caption_same
    FROM records o FULL JOIN records2 t USING (clip_id)""",
)
def j05(spark, d):
    t = compare.compare_versions(b.records(spark, d), b.records_v2(spark, d))
    return t.select(
        "clip_id", "present", "clip_sha256_same", "source_video_id_same", "clip_start_sec_same", "caption_same"
    )


#: Rows of a block of the ordered folds: small enough for keys to cross blocks, large enough to be worth a task.
FOLD_ROWS = 5_000


def _near_sql(x, y, window, own):
    """Counts of the rows of `y` near each different start of `x`; `own`: they are the same rows."""
    return f"""SELECT x.key, x.start, x.copies, (SELECT count(*) FROM {y} y WHERE y.key = x.key AND abs(y.start - x.start) < {window}) - {own} AS overlaps FROM (SELECT key, start, count(*) AS copies FROM {x} GROUP BY ALL) x"""


@query("J06_overlap_pairs", f"WITH {b.STARTS_SQL} {_near_sql('starts', 'starts', WINDOW, 1)}")
def j06(spark, d):
    return joins.overlap_counts(b.starts(spark, d), "key", "start", WINDOW)


def _copied_starts(spark, d):
    """Starts on a coarse grid, which makes many copies."""
    return b.starts(spark, d).withColumn("start", F.floor(c("start") / 7200) * 7200.0)


@query(
    "J06_overlap_pairs_of_copies",
    f"WITH {b.STARTS_SQL}, g AS (SELECT key, floor(start / 7200e0) * 7200e0 AS start FROM starts) {_near_sql('g', 'g', '7200.5e0', 1)}",
)
def j06b(spark, d):
    return joins.overlap_counts(_copied_starts(spark, d), "key", "start", 7200.5)


def _halves(spark, d):
    s = b.starts(spark, d)
    return s.filter(c("event_id") % 2 == 0), s.filter(c("event_id") % 2 == 1)


@query(
    "J07_cross_overlap_pairs",
    f"""WITH {b.STARTS_SQL}, even AS (SELECT * FROM starts WHERE event_id % 2 = 0), odd AS (SELECT * FROM starts WHERE event_id % 2 = 1)
    {_near_sql('even', 'odd', WINDOW, 0)}""",
)
def j07(spark, d):
    return joins.cross_overlap_counts(*_halves(spark, d), "key", "start", WINDOW)


def _detail_sql(a: str, b_side: str, window: str, own: int) -> str:
    """The nearest start within the window, found among all pairs of a key."""
    other = "(x.start <> y.start OR x.copies > 1)" if own else "true"
    return f""", x AS (SELECT key, start, count(*) AS copies FROM {a} GROUP BY ALL), y AS (SELECT DISTINCT key, start FROM {b_side}),
    p AS (SELECT x.key, x.start, x.copies, y.start AS nearest, abs(x.start - y.start) AS distance,
        row_number() OVER (PARTITION BY x.key, x.start ORDER BY abs(x.start - y.start), y.start) AS rn
      FROM x JOIN y ON x.key = y.key AND abs(x.start - y.start) < {window} AND {other})
    SELECT key, start, copies, nearest, distance FROM p WHERE rn = 1"""


@query("J06_overlap_details", f"WITH {b.STARTS_SQL} {_detail_sql('starts', 'starts', WINDOW, 1)}")
def j06c(spark, d):
    return joins.overlap_details(b.starts(spark, d), "key", "start", WINDOW)


@query(
    "J06_overlap_details_of_copies",
    f"WITH {b.STARTS_SQL}, g AS (SELECT key, floor(start / 7200e0) * 7200e0 AS start FROM starts) {_detail_sql('g', 'g', '7200.5e0', 1)}",
)
def j06d(spark, d):
    return joins.overlap_details(_copied_starts(spark, d), "key", "start", 7200.5)


@query(
    "J07_cross_overlap_details",
    f"""WITH {b.STARTS_SQL}, even AS (SELECT * FROM starts WHERE event_id % 2 = 0), odd AS (SELECT * FROM starts WHERE event_id % 2 = 1)
    {_detail_sql('even', 'odd', WINDOW, 0)}""",
)
def j07b(spark, d):
    return joins.cross_overlap_details(*_halves(spark, d), "key", "start", WINDOW)


@query(
    "J08_touching_rows",
    f"""WITH {b.STARTS_SQL} SELECT event_id, key, start FROM starts x WHERE event_id % 2 = 0 AND EXISTS (SELECT 1 FROM starts y
      WHERE y.event_id % 2 = 1 AND x.key = y.key AND abs(x.start - y.start) < {WINDOW})""",
)
def j08(spark, d):
    return joins.touching(*_halves(spark, d), "key", "start", WINDOW).select("event_id", "key", "start")


@query(
    "J08_overlap_count",
    f"""WITH {b.STARTS_SQL} SELECT 'b' AS counted_side, count(*) AS overlaps FROM starts x WHERE event_id % 3 = 0 AND EXISTS (SELECT 1 FROM starts y
      WHERE y.event_id % 3 <> 0 AND x.key = y.key AND abs(x.start - y.start) < {WINDOW})""",
)
def j08b(spark, d):
    s = b.starts(spark, d)
    return joins.overlap_count(s.filter("event_id % 3 <> 0"), s.filter("event_id % 3 = 0"), "key", "start", WINDOW)


@query(
    "J09_map_ids",
    f"""SELECT {ROW}, CASE WHEN o_custkey % 2 = 0 THEN 'new_' || o_orderkey END AS clip_id
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def j09(spark, d):
    rows = b.table(spark, d, "lineitem").select(*b.ROW_ORDER, c("l_orderkey").cast("string").alias("clip_id"))
    key = c("o_orderkey").cast("string")
    id_map = b.table(spark, d, "orders").filter("o_custkey % 2 = 0").select(
        key.alias("old_id"), F.concat(F.lit("new_"), key).alias("new_id")
    )
    return joins.map_ids(rows, id_map)


@query(
    "J10_positional_join",
    f"""WITH {b.RECORDS2_SQL}, x AS (SELECT row_number() OVER (ORDER BY clip_id) - 1 AS position, caption, clip_sha256 FROM records),
    y AS (SELECT row_number() OVER (ORDER BY clip_id) - 1 AS position, caption, clip_sha256 FROM records2)
    SELECT position, x.caption AS caption_a, y.caption AS caption_b, coalesce(x.clip_sha256 = y.clip_sha256, false) AS same_hash FROM x FULL JOIN y USING (position)""",
)
def j10(spark, d):
    t = joins.positional_join(b.records(spark, d), b.records_v2(spark, d), ["clip_id"], ["caption", "clip_sha256"])
    same = F.coalesce(c("clip_sha256_a") == c("clip_sha256_b"), F.lit(False))
    return t.select("position", "caption_a", "caption_b", same.alias("same_hash"))


@query(
    "J11_rows_with_files",
    f"WITH {b.RECORDS_SQL} SELECT clip_id, CASE WHEN o_orderkey % 21 <> 0 THEN (o_orderkey % 100) / 8e0 END AS size_mb FROM records",
)
def j11(spark, d):
    return joins.with_files(b.records(spark, d), all_files(spark, d), "clip_uri", base="/data").select("clip_id", "size_mb")


@query("J11_rows_without_files", f"WITH {b.RECORDS_SQL} SELECT clip_id FROM records WHERE o_orderkey % 21 = 0")
def j11b(spark, d):
    return joins.with_files(b.records(spark, d), all_files(spark, d), "clip_uri", "left_anti", "/data").select("clip_id")


# --- windows and folds over logs -------------------------------------------


@query(
    "W01_rank_sources",
    f"""WITH {b.GRADED_SQL}, t AS (SELECT source, count(*) AS total, count(*) FILTER (grade = 'FAIL') AS fail, count(*) FILTER (grade = 'REVIEW') AS review FROM graded GROUP BY source)
    SELECT source, fail, review, row_number() OVER (ORDER BY fail DESC, review DESC, source) AS rank FROM t""",
)
def w01(spark, d):
    return select.ranked_sources(grade.source_table(b.graded(spark, d))).select("source", "fail", "review", "rank")


@query(
    "W02_loss_ema",
    f"""WITH RECURSIVE {b.RUNLOG_SQL}, n AS (SELECT run, step, loss, row_number() OVER (PARTITION BY run ORDER BY step) AS rn FROM runlog),
    e AS (SELECT run, step, rn, loss AS ema FROM n WHERE rn = 1 UNION ALL
      SELECT n.run, n.step, n.rn, 0.98e0 * e.ema + 0.02e0 * n.loss FROM e JOIN n ON n.run = e.run AND n.rn = e.rn + 1)
    SELECT run, step, round(ema, 9) AS loss_ema FROM e""",
)
def w02(spark, d):
    t = logs.ema(b.runlog(spark, d).select("run", "step", "loss"), ["run"], ["step"], "loss", 0.98, "loss_ema", block_rows=FOLD_ROWS)
    return t.select("run", "step", F.round("loss_ema", 9).alias("loss_ema"))


@query(
    "W03_rolling_mean",
    f"""WITH {b.STARTS_SQL} SELECT event_id, key, round(avg(value) OVER (PARTITION BY key ORDER BY event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 9) AS rolling_mean FROM starts""",
)
def w03(spark, d):
    s = b.starts(spark, d).select("event_id", "key", "value")
    t = ordered.rolling_mean(s, ["key"], ["event_id"], "value", 100)
    return t.select("event_id", "key", F.round("rolling_mean", 9).alias("rolling_mean"))


_STOP = f"""WITH RECURSIVE {b.RUNLOG_SQL}, n AS (SELECT run, step, loss, row_number() OVER (PARTITION BY run ORDER BY step) AS rn FROM runlog),
    e AS (SELECT run, step, rn, CASE WHEN step >= 1 THEN loss ELSE 1e300 END AS best, CASE WHEN step >= 1 THEN step END AS best_step, 0 AS miss,
        NULL::BIGINT AS stopped FROM n WHERE rn = 1
      UNION ALL SELECT n.run, n.step, n.rn,
        CASE WHEN e.stopped IS NULL AND n.step >= 1 AND n.loss < e.best - 0.05e0 THEN n.loss ELSE e.best END,
        CASE WHEN e.stopped IS NULL AND n.step >= 1 AND n.loss < e.best - 0.05e0 THEN n.step ELSE e.best_step END,
        CASE WHEN e.stopped IS NOT NULL OR n.step < 1 THEN e.miss WHEN n.loss < e.best - 0.05e0 THEN 0 ELSE e.miss + 1 END,
        CASE WHEN e.stopped IS NOT NULL THEN e.stopped WHEN n.step >= 1 AND NOT n.loss < e.best - 0.05e0 AND e.miss + 1 >= 2 THEN n.step END
      FROM e JOIN n ON n.run = e.run AND n.rn = e.rn + 1)"""


@query(
    "W04_early_stop",
    _STOP
    + """ SELECT run, max(stopped) AS stop_step, max_by(best_step, rn) AS best_step,
    CASE WHEN max_by(best, rn) < 1e300 THEN round(max_by(best, rn), 9) END AS best_loss FROM e GROUP BY run""",
)
def w04(spark, d):
    rows = b.runlog(spark, d).select("run", "step", "loss")
    trace = logs.early_stop(rows, ["run"], "step", "loss", warmup=1, min_delta=0.05, patience=2, block_rows=FOLD_ROWS)
    return logs.early_stop_result(trace, ["run"], "step").withColumn("best_loss", F.round("best_loss", 9))


@query(
    "W05_latest_value",
    f"""WITH {b.RUNLOG_SQL} SELECT run, max_by(loss, step) FILTER (step % 3 <> 2) AS latest FROM runlog GROUP BY run""",
)
def w05(spark, d):
    broken = F.when(c("step") % 3 == 2, F.lit(float("nan"))).otherwise(c("loss"))
    return logs.latest_finite(b.runlog(spark, d).withColumn("loss", broken), ["run"], "step", "loss")


@query(
    "W07_unique_ids",
    f"""WITH {b.CLIPS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY {ROW}) - 1 AS k FROM clips)
    SELECT {ROW}, CASE WHEN k = 0 THEN clip_id ELSE clip_id || '_' || k END AS new_id FROM n""",
)
def w07(spark, d):
    rows = b.clips(spark, d).select("clip_id", *b.ROW_ORDER)
    return merge.unique_ids(rows, "clip_id", b.ROW_ORDER).select(*b.ROW_ORDER, "new_id")


# each customer's orders carry ids that repeats of shorter ids would get: c, c, c_1, c_2, c_1_1, ...
_CONTESTED_SQL = """o AS (SELECT o_orderkey, o_custkey, 'c' || o_custkey || CASE o_orderkey % 7 WHEN 3 THEN '_1' WHEN 4 THEN '_2'
    WHEN 5 THEN '_1_1' WHEN 6 THEN '_4' ELSE '' END AS id FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM o)"""


@query(
    "W07_contested_ids",
    f"""WITH RECURSIVE {_CONTESTED_SQL},
    s AS (SELECT o_custkey, o_orderkey, rn, id AS new_id, [id] AS taken FROM n WHERE rn = 1
      UNION ALL SELECT o_custkey, o_orderkey, rn, new_id, list_append(taken, new_id) FROM (
        SELECT n.o_custkey, n.o_orderkey, n.rn, s.taken, CASE WHEN NOT list_contains(s.taken, n.id) THEN n.id
          ELSE n.id || '_' || list_min(list_filter(range(1, len(s.taken) + 2), lambda k: NOT list_contains(s.taken, n.id || '_' || k))) END AS new_id
        FROM s JOIN n ON n.o_custkey = s.o_custkey AND n.rn = s.rn + 1))
    SELECT o_orderkey, new_id FROM s""",
)
def w07_contested(spark, d):
    end = (
        F.when(c("o_orderkey") % 7 == 3, "_1").when(c("o_orderkey") % 7 == 4, "_2")
        .when(c("o_orderkey") % 7 == 5, "_1_1").when(c("o_orderkey") % 7 == 6, "_4").otherwise("")
    )
    rows = b.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), c("o_custkey").cast("string"), end).alias("id"))
    return merge.unique_ids(rows, "id", ["o_orderkey"]).select("o_orderkey", "new_id")


@query(
    "W10_temporal_thirds",
    f"""WITH {b.RUNLOG_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step) - 1 AS p, count(*) OVER (PARTITION BY run) AS n FROM runlog),
    t AS (SELECT *, greatest(n // 3, 1) AS a FROM n)
    SELECT run, round(avg(loss) FILTER (n >= 3 AND p < a), 9) AS first, round(avg(loss) FILTER (n >= 3 AND p >= a AND p < 2 * a), 9) AS middle,
    round(avg(loss) FILTER (n >= 3 AND p >= 2 * a), 9) AS last, round(avg(loss) FILTER (n < 3), 9) AS "all" FROM t GROUP BY run""",
)
def w10(spark, d):
    t = logs.temporal_thirds(b.runlog(spark, d), ["run"], ["step"], "loss")
    return t.select("run", *[F.round(k, 9).alias(k) for k in ("first", "middle", "last", "all")])


@query(
    "W11_step_timing",
    f"""WITH {b.RUNLOG_SQL}, s AS (SELECT run, step, chars / 1e3 AS encode_seconds, loss AS forward_seconds, chars / 1e3 + loss AS step_seconds FROM runlog)
    SELECT run, step, round(encode_seconds / greatest(step_seconds, 1e-6), 9) AS encode_seconds_share,
    round(forward_seconds / greatest(step_seconds, 1e-6), 9) AS forward_seconds_share, round(2e0 / greatest(step_seconds, 1e-6), 6) AS samples_per_second,
    round(242e0 / greatest(step_seconds, 1e-6), 6) AS frames_per_second FROM s""",
)
def w11(spark, d):
    t = b.runlog(spark, d).withColumns({"encode_seconds": c("chars") / F.lit(1000.0), "forward_seconds": c("loss")})
    t = t.withColumn("step_seconds", c("encode_seconds") + c("forward_seconds"))
    cols = logs.timing_columns(["encode_seconds", "forward_seconds"], "step_seconds", F.lit(2), 121)
    return t.select("run", "step", *[F.round(v, 9 if k.endswith("share") else 6).alias(k) for k, v in cols.items()])


# --- duplicates ------------------------------------------------------------


def hashed_clips(spark, d):
    """Each embedding as a clip of its label, hashed three ways."""
    pixels = b.table(spark, d, "embeddings").withColumn("v", b.frame_values())
    turned = pixels.withColumns({"rv": F.reverse("v"), "nv": F.transform("v", lambda x: 255 - x)})
    return turned.select(
        F.concat(F.lit("c"), F.lpad(c("vec_id").cast("string"), 12, "0")).alias("clip_id"),
        c("label").cast("string").alias("source_video_id"),
        c("vec_id").cast("double").alias("clip_start_sec"),
        F.when(c("vec_id") % 41 != 0, fr.array_dhash(c("v"), 7, 8)).alias("first_hash"),
        fr.array_dhash(c("rv"), 7, 8).alias("middle_hash"),
        fr.array_dhash(c("nv"), 7, 8).alias("last_hash"),
        F.lit("some caption").alias("caption"),
    )


def _dh(v: str) -> str:
    return (
        f"list_reduce(list_transform(range(0, 56), lambda i: CASE WHEN {v}[(i // 7) * 8 + i % 7 + 1] > {v}[(i // 7) * 8 + i % 7 + 2] "
        "THEN 1::BIGINT ELSE 0::BIGINT END), lambda a, x: a * 2 + x)"
    )


_FOLD = f"""WITH RECURSIVE {b.FRAMES_SQL}, hc AS (SELECT e.vec_id, e.label, 'c' || lpad(e.vec_id::VARCHAR, 12, '0') AS clip_id,
      CASE WHEN e.vec_id % 41 <> 0 THEN {_dh("p.v")} END AS h1, {_dh("p.rv")} AS h2, {_dh("p.nv")} AS h3,
      row_number() OVER (PARTITION BY e.label ORDER BY e.vec_id) AS rn
      FROM embeddings e JOIN (SELECT clip_no * 25 + frame_idx AS vec_id, v, list_reverse(v) AS rv, list_transform(v, lambda x: 255 - x) AS nv FROM px) p USING (vec_id)),
    f AS (SELECT label, clip_id, rn, h1 AS r1, CASE WHEN h1 IS NOT NULL THEN h2 END AS r2, CASE WHEN h1 IS NOT NULL THEN h3 END AS r3,
        CASE WHEN h1 IS NOT NULL THEN clip_id END AS rid, 'kept' AS decision, NULL::DOUBLE AS distance, NULL::VARCHAR AS reference_clip FROM hc WHERE rn = 1
      UNION ALL SELECT label, clip_id, rn, CASE WHEN keep THEN h1 ELSE r1 END, CASE WHEN keep THEN CASE WHEN h1 IS NOT NULL THEN h2 END ELSE r2 END,
        CASE WHEN keep THEN CASE WHEN h1 IS NOT NULL THEN h3 END ELSE r3 END, CASE WHEN keep THEN CASE WHEN h1 IS NOT NULL THEN clip_id END ELSE rid END,
        CASE WHEN keep THEN 'kept' ELSE 'removed' END, dist, CASE WHEN dist IS NOT NULL THEN rid END FROM (
        SELECT hc.label, hc.clip_id, hc.rn, hc.h1, hc.h2, hc.h3, f.r1, f.r2, f.r3, f.rid,
          (bit_count(xor(hc.h1, f.r1)) + bit_count(xor(hc.h2, f.r2)) + bit_count(xor(hc.h3, f.r3))) / 3e0 AS dist,
          coalesce((bit_count(xor(hc.h1, f.r1)) + bit_count(xor(hc.h2, f.r2)) + bit_count(xor(hc.h3, f.r3))) / 3e0 > 24e0, true) AS keep
        FROM f JOIN hc ON hc.label = f.label AND hc.rn = f.rn + 1))"""


@query("D01_perceptual_dedup", _FOLD + " SELECT clip_id, decision, round(distance, 9) AS distance, reference_clip FROM f")
def d01(spark, d):
    t = dedup.perceptual_dedup(hashed_clips(spark, d), threshold=24.0, block_rows=FOLD_ROWS)
    return t.select("clip_id", "decision", F.round("distance", 9).alias("distance"), "reference_clip")


@query(
    "D02_blank_captions",
    _FOLD + " SELECT clip_id, CASE WHEN decision = 'removed' THEN '' ELSE 'some caption' END AS caption FROM f",
)
def d02(spark, d):
    t = dedup.perceptual_dedup(hashed_clips(spark, d), threshold=24.0, block_rows=FOLD_ROWS)
    return dedup.blank_removed_captions(t).select("clip_id", "caption")


_ONE = f"""WITH {b.CLIPS_SQL}, m AS (SELECT {ROW}, source, clip_start_sec, CASE WHEN l_partkey % 17 <> 0 THEN source_frames END AS fr, duplicate_frame_ratio AS du FROM clips),
    s AS (SELECT *, fr IS NOT NULL AND fr >= 124 AND du <= 0.005e0 AS valid FROM m),
    r AS (SELECT *, min(CASE WHEN valid THEN (clip_start_sec, {ROW}) END) OVER (PARTITION BY source) AS best, min((clip_start_sec, {ROW})) OVER (PARTITION BY source) AS fst FROM s)
    SELECT {ROW}, CASE WHEN (clip_start_sec, {ROW}) = coalesce(best, fst) THEN 'kept' ELSE 'removed' END AS decision,
    CASE WHEN (clip_start_sec, {ROW}) = best THEN 'kept' WHEN best IS NULL AND (clip_start_sec, {ROW}) = fst THEN 'no_valid_candidate_kept_earliest'
      WHEN fr < 124 THEN 'frames=' || fr || '<124' WHEN fr IS NOT NULL AND du > 0.005e0 THEN printf('dup_ratio=%.3f>0.005', du)
      WHEN best IS NOT NULL THEN 'later_from_same_source' ELSE 'bad_metrics' END AS reason FROM r"""


@query("D03_one_per_source", _ONE)
def d03(spark, d):
    rows = b.clips(spark, d).select(
        *b.ROW_ORDER, "source", "clip_start_sec",
        F.when(c("l_partkey") % 17 != 0, c("source_frames")).alias("source_frames"),
        c("duplicate_frame_ratio").alias("dup_ratio"),
    )
    return dedup.one_per_source(rows, 124, 0.005, "source", "clip_start_sec", b.ROW_ORDER).select(
        *b.ROW_ORDER, "decision", "reason"
    )


@query(
    "D04_last_wins",
    """SELECT user_id, event_type, max_by(event_id, (ts, event_id)) AS event_id, max_by(value, (ts, event_id)) AS value FROM events GROUP BY ALL""",
)
def d04(spark, d):
    t = b.table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return dedup.last_wins(t, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "D06_thin_overlaps",
    f"""WITH RECURSIVE {b.STARTS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY start, event_id) AS rn FROM starts),
    f AS (SELECT key, event_id, rn, start AS last, true AS kept FROM n WHERE rn = 1 UNION ALL
      SELECT n.key, n.event_id, n.rn, CASE WHEN n.start - f.last >= 86400e0 THEN n.start ELSE f.last END, n.start - f.last >= 86400e0
      FROM f JOIN n ON n.key = f.key AND n.rn = f.rn + 1) SELECT event_id, key, kept FROM f""",
)
def d06(spark, d):
    s = b.starts(spark, d).select("event_id", "key", "start")
    return dedup.thin_overlaps(s, "key", "start", 86400.0, ["event_id"], block_rows=FOLD_ROWS).select("event_id", "key", "kept")


@query(
    "D07_altered_copies",
    f"""WITH {b.RECORDS2_SQL}, v AS (SELECT caption, width, clip_sha256, clip_start_sec, count(*) AS rows FROM records WHERE caption <> '' GROUP BY ALL)
    SELECT caption, clip_sha256, clip_start_sec, rows, (SELECT count(*) FROM records2 t WHERE t.caption = v.caption AND t.width = v.width
      AND (t.clip_sha256 <> v.clip_sha256 OR t.clip_start_sec <> v.clip_start_sec)) AS altered FROM v WHERE altered > 0""",
)
def d07(spark, d):
    t = dedup.altered_copies(
        b.records(spark, d), b.records_v2(spark, d), ["caption", "width"], ["clip_sha256", "clip_start_sec"]
    )
    return t.drop("width")


# --- selection and set operations ------------------------------------------


@query(
    "T02_order_sources_by_fails",
    f"""WITH {b.GRADED_SQL}, t AS (SELECT source, count(*) FILTER (grade = 'FAIL') AS fail, count(*) FILTER (grade = 'REVIEW') AS review FROM graded GROUP BY source)
    SELECT source, fail, review FROM t ORDER BY fail DESC, review DESC, source""",
)
def t02(spark, d):
    t = grade.source_table(b.graded(spark, d)).select("source", "fail", "review")
    return t.orderBy(F.desc("fail"), F.desc("review"), "source")


@query("T04_first_n", "SELECT doc_id, source, n_chars FROM documents ORDER BY source, doc_id LIMIT 50")
def t04(spark, d):
    return select.first_n(b.table(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source", "doc_id"], 50)


@query("T05_head_urls", "SELECT page_id, url FROM pages ORDER BY page_id LIMIT 5")
def t05(spark, d):
    return select.first_n(b.table(spark, d, "pages").select("page_id", "url"), ["page_id"], 5)


@query("T06_seeded_sample", "SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 5")
def t06(spark, d):
    return select.seeded_sample(b.table(spark, d, "documents").select("doc_id", "source"), ["doc_id"], 5)


@query(
    "T07_train_validation_split",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS i, count(*) OVER () AS n FROM documents)
    SELECT doc_id, CASE WHEN i <= least(greatest(CAST(round_even(n * 0.05e0, 0) AS BIGINT), 1), n - 1) THEN 'val' ELSE 'train' END AS split FROM n""",
)
def t07(spark, d):
    return select.split_rows(b.table(spark, d, "documents").select("doc_id"), ["doc_id"], 0.05)


@query("T08_sorted_rows", f"WITH {b.RECORDS_SQL} SELECT source_video_url, clip_start_sec, clip_id FROM records ORDER BY 1, 2, 3")
def t08(spark, d):
    t = b.records(spark, d).select("source_video_url", "clip_start_sec", "clip_id")
    return t.orderBy("source_video_url", "clip_start_sec", "clip_id")


@query(
    "U01_merge_datasets",
    f"""WITH {b.RECORDS2_SQL}, s AS (SELECT 0 AS dataset_no, * FROM records UNION ALL SELECT 2, * FROM records2),
    n AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY dataset_no, o_orderkey) - 1 AS k FROM s),
    m AS (SELECT *, CASE WHEN k = 0 THEN clip_id ELSE clip_id || '_' || k END AS nid FROM n)
    SELECT dataset_no, o_orderkey, clip_id AS original_id, nid AS clip_id, 'clips/' || nid || '.mp4' AS clip_uri, 'frames/' || nid || '.jpg' AS first_frame_uri FROM m""",
)
def u01(spark, d):
    # numbering stores what it is given, so only the columns of the result go in
    old, new = (t.select("o_orderkey", "clip_id") for t in (b.records(spark, d), b.records_v2(spark, d)))
    t = merge.merge_datasets([old, None, new], ["o_orderkey"])
    return t.select("dataset_no", "o_orderkey", "original_id", "clip_id", "clip_uri", "first_frame_uri")


@query("U03_union_history", "SELECT l_suppkey AS id FROM lineitem UNION SELECT o_custkey FROM orders")
def u03(spark, d):
    a = b.table(spark, d, "lineitem").select(c("l_suppkey").alias("id"))
    return merge.union_history(a, b.table(spark, d, "orders").select(c("o_custkey").alias("id")), "id")
