"""Queries of frame metrics (M), frame joins (J12, J13) and the extension surface (X)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clipwarden.functions import paths, scores, sqlfuncs, urls
from clipwarden.operators import frames as fr
from clipwarden.operators import profile
from clipwarden.operators.rowmap import map_rows_with_retry
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.plans.scalar_queries import HASH_SQL, page_links, _URLS

c = F.col
# embeddings change a lot between neighbours, so wider limits than for video
LIMITS = {"duplicate_below": 0.14, "high_motion_above": 0.15, "scene_cut_above": 0.16}


def gray(spark, d):
    return fr.frame_partials(b.gray_frames(spark, d))


def rgb(spark, d):
    return fr.frame_partials(b.rgb_frames(spark, d))


def _metrics(spark, d, cols, frames=b.gray_frames, digits=6):
    p = fr.frame_partials(frames(spark, d))
    t = fr.clip_metrics(p, b.frame_clips(spark, d), **LIMITS)
    out = [c(k) if dict(t.dtypes)[k] in ("string", "bigint") else F.round(k, digits).alias(k) for k in cols]
    return t.select("clip_id", *out)


@query("M01_pair_deltas", f"WITH {b.FRAMES_SQL} SELECT clip_id, frame_idx, round(delta, 9) AS delta FROM deltas")
def m01(spark, d):
    return fr.pair_deltas(gray(spark, d)).select("clip_id", "frame_idx", F.round("delta", 9).alias("delta"))


@query(
    "J13_previous_frame",
    f"WITH {b.FRAMES_SQL} SELECT clip_id, frame_idx, CAST(s AS BIGINT) AS abs_sum, CAST(ss AS BIGINT) AS abs_sq FROM deltas",
)
def j13(spark, d):
    return gray(spark, d).filter("has_prev = 1").select(
        "clip_id", "frame_idx", c("abs_sum").cast("bigint").alias("abs_sum"), c("abs_sq").cast("bigint").alias("abs_sq")
    )


@query(
    "M02_duplicate_ratio",
    f"WITH {b.FRAMES_SQL} SELECT clip_id, round(avg((delta < 0.14e0)::INT::DOUBLE), 6) AS duplicate_frame_ratio FROM deltas GROUP BY clip_id",
)
def m02(spark, d):
    return _metrics(spark, d, ["duplicate_frame_ratio"])


@query(
    "M03_temporal_diff",
    f"""WITH {b.FRAMES_SQL} SELECT clip_id, round(sum(s) / (sum(n) * 255e0), 6) AS temporal_diff_mean,
    round(sqrt((sum(ss) - sum(s) * sum(s) / sum(n)) / (sum(n) - 1)) / 255e0, 6) AS temporal_diff_std FROM deltas GROUP BY clip_id""",
)
def m03(spark, d):
    return _metrics(spark, d, ["temporal_diff_mean", "temporal_diff_std"])


@query(
    "M04_motion_p95",
    f"WITH {b.FRAMES_SQL} SELECT clip_id, round(quantile_cont(delta, 0.95), 6) AS motion_p95 FROM deltas GROUP BY clip_id",
)
def m04(spark, d):
    return _metrics(spark, d, ["motion_p95"])


@query(
    "M05_flicker",
    f"""WITH {b.FRAMES_SQL}, f AS (SELECT clip_id, frame_idx, avg(g) / 255e0 AS m FROM cells GROUP BY ALL)
    SELECT clip_id, round(stddev_samp(m), 6) AS flicker_luma_std FROM f GROUP BY clip_id""",
)
def m05(spark, d):
    return _metrics(spark, d, ["flicker_luma_std"])


@query(
    "M06_sharpness",
    f"""WITH {b.FRAMES_SQL}, dx AS (SELECT a.clip_id, avg(abs(a.g - b.g)) / 255e0 AS m FROM cells a JOIN cells b ON a.clip_id = b.clip_id AND a.frame_idx = b.frame_idx
      AND b.pos = a.pos + 1 AND a.pos % 8 < 7 GROUP BY 1),
    dy AS (SELECT a.clip_id, avg(abs(a.g - b.g)) / 255e0 AS m FROM cells a JOIN cells b ON a.clip_id = b.clip_id AND a.frame_idx = b.frame_idx AND b.pos = a.pos + 8 GROUP BY 1)
    SELECT clip_id, round(dx.m + dy.m, 6) AS sharpness_grad_mean FROM dx JOIN dy USING (clip_id)""",
)
def m06(spark, d):
    return _metrics(spark, d, ["sharpness_grad_mean"])


@query(
    "M07_entropy",
    f"""WITH {b.FRAMES_SQL}, h AS (SELECT clip_id, least(g * 10000 * 64 // 2550000, 63) AS bin, count(*)::DOUBLE AS n FROM cells GROUP BY ALL),
    p AS (SELECT clip_id, n / sum(n) OVER (PARTITION BY clip_id) AS p FROM h)
    SELECT clip_id, round(-sum(p * log2(p + 1e-12)) / 6e0, 6) AS entropy_mean FROM p GROUP BY clip_id""",
)
def m07(spark, d):
    return _metrics(spark, d, ["entropy_mean"])


@query(
    "M08_clipped_pixels",
    f"""WITH {b.RGB_SQL}, v AS (SELECT clip_id, unnest([r, gg, b]) / 255e0 AS x FROM rgb)
    SELECT clip_id, round(avg((x < 0.01e0)::INT::DOUBLE), 9) AS black_pixel_ratio, round(avg((x > 0.99e0)::INT::DOUBLE), 9) AS white_pixel_ratio FROM v GROUP BY clip_id""",
)
def m08(spark, d):
    return _metrics(spark, d, ["black_pixel_ratio", "white_pixel_ratio"], b.rgb_frames, 9)


@query(
    "M09_motion_and_cuts",
    f"""WITH {b.FRAMES_SQL} SELECT clip_id, round(avg((delta > 0.15e0)::INT::DOUBLE), 6) AS high_motion_ratio, count(*) FILTER (delta > 0.16e0) AS scene_cut_count FROM deltas GROUP BY clip_id""",
)
def m09(spark, d):
    return _metrics(spark, d, ["high_motion_ratio", "scene_cut_count"])


@query(
    "M10_luma",
    f"""WITH {b.RGB_SQL} SELECT clip_id, round(avg(luma) / 2550000e0, 6) AS luma_mean, round(stddev_samp(luma) / 2550000e0, 6) AS luma_std,
    round(stddev_samp(luma) / 2550000e0, 6) AS contrast_rms FROM rgb GROUP BY clip_id""",
)
def m10(spark, d):
    return _metrics(spark, d, ["luma_mean", "luma_std", "contrast_rms"], b.rgb_frames)


@query(
    "M11_saturation",
    f"""WITH {b.RGB_SQL} SELECT clip_id, round(avg((greatest(r, gg, b) / 255e0 - least(r, gg, b) / 255e0) / greatest(greatest(r, gg, b) / 255e0, 1e-6)), 6) AS saturation_mean FROM rgb GROUP BY clip_id""",
)
def m11(spark, d):
    return _metrics(spark, d, ["saturation_mean"], b.rgb_frames)


@query(
    "M12_sample_metrics",
    f"""WITH {b.FRAMES_SQL}, k AS (SELECT clip_id, delta * 0.02e0 AS x FROM deltas), s AS (SELECT clip_id, avg((x < 0.002e0)::INT::DOUBLE) AS du, avg((x < 0.02e0)::INT::DOUBLE) AS st,
      avg(x) AS m, stddev_samp(x) AS sd FROM k GROUP BY clip_id)
    SELECT clip_id, round(du, 6) AS duplicate_ratio, round(st, 6) AS static_ratio, round(m, 9) AS mean_delta, round(sd, 9) AS std_delta, 0e0 AS timelapse_score FROM s""",
)
def m12(spark, d):
    t = fr.sample_metrics(gray(spark, d), scale=0.02 / 255.0)
    digits = {"duplicate_ratio": 6, "static_ratio": 6, "mean_delta": 9, "std_delta": 9, "timelapse_score": 6}
    return t.select("clip_id", *[F.round(k, n).alias(k) for k, n in digits.items()])


@query(
    "M12_sample_metrics_raw_scale",
    f"""WITH {b.FRAMES_SQL}, s AS (SELECT clip_id, avg(delta * 255e0) AS m, stddev_samp(delta * 255e0) AS sd FROM deltas GROUP BY clip_id)
    SELECT clip_id, 0e0 AS duplicate_ratio, 0e0 AS static_ratio, round(m, 6) AS mean_delta, round(sd, 6) AS std_delta,
    round(least(1e0 * 0.7e0 + (1e0 - least(sd / greatest(m, 1e-6), 1e0)) * 0.3e0, 1e0), 6) AS timelapse_score FROM s""",
)
def m12b(spark, d):
    t = fr.sample_metrics(gray(spark, d), scale=1.0)
    return t.select("clip_id", *[F.round(k, 6).alias(k) for k in t.columns[1:]])


@query(
    "M13_color_and_luma_range",
    f"""WITH {b.RGB_SQL} SELECT clip_id, round(avg(r) / 255e0, 6) AS rgb_mean_r, round(avg(gg) / 255e0, 6) AS rgb_mean_g, round(avg(b) / 255e0, 6) AS rgb_mean_b,
    round(stddev_samp(r) / 255e0, 6) AS rgb_std_r, round(stddev_samp(gg) / 255e0, 6) AS rgb_std_g, round(stddev_samp(b) / 255e0, 6) AS rgb_std_b,
    round(min(luma) / 2550000e0, 9) AS luma_low, round(max(luma) / 2550000e0, 9) AS luma_high FROM rgb GROUP BY clip_id""",
)
def m13(spark, d):
    cols = [f"rgb_{k}_{ch}" for k in ("mean", "std") for ch in "rgb"]
    p = rgb(spark, d)
    t = fr.clip_metrics(p, b.frame_clips(spark, d), **LIMITS)
    return t.select(
        "clip_id", *[F.round(k, 6).alias(k) for k in cols], F.round("luma_low", 9).alias("luma_low"), F.round("luma_high", 9).alias("luma_high")
    )


@query(
    "M13_luma_quantiles",
    f"""WITH {b.RGB_SQL} SELECT clip_id, round(quantile_cont(luma::DOUBLE, 0.01) / 2550000e0, 9) AS luma_p01, round(quantile_cont(luma::DOUBLE, 0.99) / 2550000e0, 9) AS luma_p99 FROM rgb GROUP BY clip_id""",
)
def m13b(spark, d):
    t = fr.luma_quantiles(b.rgb_frames(spark, d))
    return t.select("clip_id", F.round("luma_p01", 9).alias("luma_p01"), F.round("luma_p99", 9).alias("luma_p99"))


@query(
    "M14_delta_quantiles",
    f"WITH {b.FRAMES_SQL} SELECT clip_id, "
    + ", ".join(f"round(quantile_cont(delta, {p}), 6) AS delta_{k}" for k, p in (("p01", 0.01), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
    + " FROM deltas GROUP BY clip_id",
)
def m14(spark, d):
    t = fr.delta_quantiles(gray(spark, d))
    return t.select("clip_id", *[F.round(k, 6).alias(k) for k in t.columns[1:]])


@query(
    "M15_jerk",
    f"""WITH {b.FRAMES_SQL}, j AS (SELECT a.clip_id, abs(a.delta - p.delta) AS j FROM deltas a JOIN deltas p ON a.clip_id = p.clip_id AND a.frame_idx = p.frame_idx + 1)
    SELECT clip_id, round(avg(j), 6) AS jerk_mean, round(quantile_cont(j, 0.95), 6) AS jerk_p95 FROM j GROUP BY clip_id""",
)
def m15(spark, d):
    t = fr.jerk_metrics(gray(spark, d))
    return t.select("clip_id", F.round("jerk_mean", 6).alias("jerk_mean"), F.round("jerk_p95", 6).alias("jerk_p95"))


@query(
    "M16_blank_frames",
    f"""WITH {b.RGB_SQL}, f AS (SELECT clip_id, frame_idx, stddev_samp(luma) / 2550000e0 AS sd, avg(luma) / 2550000e0 AS m FROM rgb GROUP BY ALL)
    SELECT clip_id, round(avg((sd < 0.01e0 OR m < 0.02e0)::INT::DOUBLE), 6) AS blank_frame_ratio FROM f GROUP BY clip_id""",
)
def m16(spark, d):
    return _metrics(spark, d, ["blank_frame_ratio"], b.rgb_frames)


_PAIR = """, e AS (SELECT a.clip_id, avg(((a.g - n.g) / 255e0) * ((a.g - n.g) / 255e0)) AS mse, avg(abs(a.g - n.g)) / 255e0 AS mae
    FROM cells a JOIN cells n ON a.clip_id = n.clip_id AND a.pos = n.pos AND a.frame_idx = 0 AND n.frame_idx = 1 GROUP BY 1)
    SELECT clip_id, round(mse, 9) AS mse, round(mae, 9) AS mae, round(CASE WHEN mse <= 1e-12 THEN 99e0 ELSE -10e0 * log10(mse) END, 6) AS psnr FROM e"""


def _next_frame(spark, d):
    return b.gray_frames(spark, d).withColumn("frame_idx", c("frame_idx") - 1)


@query("J12_first_frame_pairs", f"WITH {b.FRAMES_SQL}{_PAIR}")
def j12(spark, d):
    t = fr.frame_pair_errors(b.gray_frames(spark, d), _next_frame(spark, d), 0)
    return t.select("clip_id", F.round("mse", 9).alias("mse"), F.round("mae", 9).alias("mae"), F.round("psnr", 6).alias("psnr"))


@query(
    "M17_frame_errors_identical",
    f"WITH {b.FRAMES_SQL} SELECT DISTINCT clip_id, 0e0 AS mse, 0e0 AS mae, 99e0 AS psnr FROM px",
)
def m17(spark, d):
    return fr.frame_pair_errors(b.gray_frames(spark, d), b.gray_frames(spark, d), 0)


@query(
    "M18_throughput",
    """SELECT o_orderkey, round(121e0 / greatest(o_totalprice / 1e5, 1e-6), 6) AS frames_per_second, o_custkey * 1024 / 1048576e0 AS size_mb FROM orders""",
)
def m18(spark, d):
    return b.table(spark, d, "orders").select(
        "o_orderkey",
        F.round(scores.per_second(F.lit(121), c("o_totalprice") / F.lit(100000.0)), 6).alias("frames_per_second"),
        (c("o_custkey") * 1024 / F.lit(1048576.0)).alias("size_mb"),
    )


@query(
    "M_clip_quality_rows",
    f"""WITH {b.FRAMES_SQL}, q AS (SELECT clip_id, avg((delta < 0.14e0)::INT::DOUBLE) AS du FROM deltas GROUP BY clip_id),
    k AS (SELECT clip_id, any_value(clip_no) AS clip_no, max(frame_idx) + 1 AS n FROM px GROUP BY clip_id)
    SELECT clip_id, n::BIGINT AS source_frames, 8 AS source_width, 23e0 + clip_no % 3 AS source_fps, (n - 121)::BIGINT AS frame_error,
    round(1e0 - ((1280 - 8) / 1280e0 + (704 - 8) / 704e0 + least(abs(n - 121) / 121e0, 1e0) + abs(23e0 + clip_no % 3 - 24e0) / 24e0 + abs(1e0 - 1280e0 / 704e0) + du) / 6e0, 9) AS conformance_score
    FROM k JOIN q USING (clip_id)""",
)
def m_rows(spark, d):
    t = fr.clip_metrics(gray(spark, d), b.frame_clips(spark, d), **LIMITS)
    return t.select(
        "clip_id", "source_frames", "source_width", "source_fps", "frame_error", F.round("conformance_score", 9).alias("conformance_score")
    )


@query(
    "P19_sampled_frames",
    f"""WITH {b.FRAMES_SQL}, k AS (SELECT clip_id, max(frame_idx) + 1 AS n FROM px GROUP BY clip_id),
    s AS (SELECT clip_id, unnest(range(0, 40)) AS slot, n FROM k), t AS (SELECT clip_id, slot, least(CAST(round_even(slot::DOUBLE * ((n - 1)::DOUBLE / 39e0), 0) AS BIGINT), n - 1) AS frame_idx FROM s)
    SELECT t.clip_id, t.slot::INTEGER AS slot, t.frame_idx::INTEGER AS frame_idx, v[1]::INTEGER AS first_value FROM t JOIN px ON t.clip_id = px.clip_id AND t.frame_idx = px.frame_idx""",
)
def p19b(spark, d):
    frames = b.gray_frames(spark, d)
    totals = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("total"))
    t = fr.sample_frames(frames, totals, 40)
    first = F.conv(F.substring(F.hex("pixels"), 1, 2), 16, 10).cast("int")
    return t.select("clip_id", "slot", c("frame_idx").cast("int").alias("frame_idx"), first.alias("first_value"))


@query(
    "D01_hash_triples",
    f"""WITH {b.FRAMES_SQL}, {HASH_SQL} SELECT clip_id, max(dhash) FILTER (frame_idx = 0) AS first_hash, max(dhash) FILTER (frame_idx = 12) AS middle_hash,
    max(dhash) FILTER (frame_idx = 24) AS last_hash FROM hashes WHERE frame_idx IN (0, 12, 24) GROUP BY clip_id""",
)
def d01b(spark, d):
    return fr.hash_triples(b.gray_frames(spark, d), 7, 8, (0, 12, 24))


# --- extension surface -----------------------------------------------------


@query(
    "X01_custom_frame_function",
    f"WITH {b.FRAMES_SQL} SELECT clip_id, frame_idx, max(g) AS brightest, min(g) AS darkest FROM cells GROUP BY ALL",
)
def x01(spark, d):
    def extremes(image: np.ndarray, prev):
        return {"brightest": int(image.max()), "darkest": int(image.min())}

    t = fr.frame_partials(
        b.gray_frames(spark, d), extremes, "clip_id string, frame_idx int, height int, width int, brightest bigint, darkest bigint"
    )
    return t.select("clip_id", "frame_idx", "brightest", "darkest")


@query(
    "X02_map_rows_with_retry",
    """SELECT doc_id, doc_id % 10 <> 3 AS ok, CASE WHEN doc_id % 10 <> 3 THEN upper(source) || ':' || doc_id END AS value,
    CASE WHEN doc_id % 10 = 3 THEN 'ValueError: bad row ' || doc_id END AS error, CASE WHEN doc_id % 10 = 3 THEN 2 ELSE 1 END AS attempts FROM documents""",
)
def x02(spark, d):
    def label(row):
        if row["doc_id"] % 10 == 3:
            raise ValueError(f"bad row {row['doc_id']}")
        return f"{row['source'].upper()}:{row['doc_id']}"

    rows = b.table(spark, d, "documents").select("doc_id", "source")
    return map_rows_with_retry(rows, label, max_retries=2).drop("source")


@query(
    "X03_sql_functions",
    f"""WITH {_URLS} SELECT page_id, coalesce('https://www.youtube.com/watch?v=' || CASE
      WHEN host = 'youtu.be' THEN nullif(trim(path, '/'), '')
      WHEN host = 'youtube.com' OR host LIKE '%.youtube.com' THEN coalesce(nullif(trim(v), ''),
        nullif(regexp_extract(path, '^/+(shorts|embed|v)/+([^/]+)', 2), '')) END, trim(url)) AS source_key,
    lower(trim(regexp_replace(url, '[^A-Za-z0-9_.\\-]+', '_', 'g'), '_')) AS slug,
    trim(regexp_replace(url, '[^\\p{{L}}\\p{{N}}_.\\-]', '_', 'g'), '_') AS clean_id, bit_count(xor(page_id, 255::BIGINT))::INTEGER AS hamming FROM h""",
)
def x03(spark, d):
    sqlfuncs.register(spark)
    page_links(spark, d).createOrReplaceTempView("clipwarden_links")
    return spark.sql(
        """SELECT page_id, canonical_source_key(url) AS source_key, slug(url) AS slug, clean_id(url, 'none') AS clean_id,
        hamming(page_id, 255L) AS hamming FROM clipwarden_links"""
    )


@query(
    "X03_sql_grade",
    f"WITH {b.GRADED_SQL} SELECT {', '.join(b.ROW_ORDER)}, round(conformance_score, 9) AS conformance_score, round(timelapse_score, 9) AS timelapse_score, grade FROM graded",
)
def x03b(spark, d):
    sqlfuncs.register(spark)
    b.clips(spark, d).createOrReplaceTempView("clipwarden_clips")
    row = ", ".join(b.ROW_ORDER)
    return spark.sql(
        f"""WITH s AS (SELECT *, conformance(source_width, source_height, source_frames, source_fps, duplicate_frame_ratio) AS conf,
          timelapse_score(duplicate_frame_ratio, high_motion_ratio, temporal_diff_mean, temporal_diff_std) AS lapse FROM clipwarden_clips)
        SELECT {row}, round(conf, 9) AS conformance_score, round(lapse, 9) AS timelapse_score,
          grade_clip(conf, duplicate_frame_ratio, lapse, temporal_diff_mean, scene_cut_count, black_pixel_ratio + white_pixel_ratio) AS grade FROM s"""
    )


@query("X03_sql_dhash", f"WITH {b.FRAMES_SQL}, {HASH_SQL} SELECT * FROM hashes")
def x03c(spark, d):
    sqlfuncs.register(spark)
    t = b.table(spark, d, "embeddings").select(*b.frame_keys(), b.frame_values().cast("array<double>").alias("v"))
    t.createOrReplaceTempView("clipwarden_pixels")
    return spark.sql("SELECT clip_id, frame_idx, dhash(v, 7, 8) AS dhash FROM clipwarden_pixels")


@query(
    "X04_key_stats",
    """SELECT event_type AS key, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min,
    round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.9), 6) AS p90, max(value) AS max FROM events GROUP BY event_type""",
)
def x04(spark, d):
    values = b.table(spark, d, "events").select(c("event_type").alias("key"), "value")
    t = profile.key_stats(values, {"p10": 0.1, "p90": 0.9})
    return t.select(*[c(k) if k in ("key", "n", "min", "max") else F.round(k, 6).alias(k) for k in t.columns])


@query(
    "X05_clip_plan",
    """SELECT o_orderkey, k AS clip_no, (k - 1) * 5e0 AS clip_start FROM (SELECT o_orderkey, unnest(range(1, CAST(floor(o_totalprice / 1e4 / 5e0) AS BIGINT) + 1)) AS k FROM orders)""",
)
def x05(spark, d):
    from clipwarden.functions.plans import register_clip_plan

    register_clip_plan(spark)
    b.table(spark, d, "orders").createOrReplaceTempView("clipwarden_orders")
    return spark.sql(
        """SELECT o_orderkey, p.clip_no, p.clip_start FROM clipwarden_orders, LATERAL clip_plan(o_totalprice / 1e4D, 5D) p"""
    )
