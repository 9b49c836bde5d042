"""Clip, prompt, frame, log and file tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.operators import frames as fr
from clipwarden.operators.grade import grade_clips, score_clips

ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    gap = F.col(ts) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return (gap.cast("interval second").cast("decimal(20,6)") * 1000000).cast("bigint")


def clips(spark: SparkSession, d: str, items: DataFrame | None = None) -> DataFrame:
    """Line items seen as measured clips: all of them, or `items`."""
    c = F.col
    cid = F.concat(F.lit("clip_"), c("l_orderkey").cast("string"), F.lit("_node"), c("l_linenumber").cast("string"))
    return (table(spark, d, "lineitem") if items is None else items).select(
        cid.alias("clip_id"),
        F.concat(F.lit("clips/"), cid, F.lit(".mp4")).alias("path"),
        F.concat(F.lit("src"), c("l_suppkey").cast("string")).alias("source"),
        *ROW_ORDER,
        (1280 - 64 * (c("l_partkey") % 5)).cast("int").alias("source_width"),
        (704 - 32 * (c("l_suppkey") % 3)).cast("int").alias("source_height"),
        (118 + c("l_linenumber")).cast("int").alias("source_frames"),
        F.when(c("l_partkey") % 11 == 0, F.lit(0.0))
        .otherwise(F.lit(24.0) + (c("l_linenumber") % 3 - 1) * F.lit(0.5))
        .alias("source_fps"),
        F.abs("l_discount").alias("duplicate_frame_ratio"),
        (c("l_quantity") / F.lit(500.0)).alias("temporal_diff_mean"),
        F.abs("l_tax").alias("temporal_diff_std"),
        (c("l_quantity") / F.lit(50.0)).alias("high_motion_ratio"),
        F.when(c("l_linenumber") == 7, 1).otherwise(0).alias("scene_cut_count"),
        F.abs("l_tax").alias("black_pixel_ratio"),
        F.abs("l_tax").alias("white_pixel_ratio"),
        (c("l_linenumber") * F.lit(3.0)).alias("clip_start_sec"),
    )


CLIPS_SQL = """clips AS (
  SELECT 'clip_' || l_orderkey || '_node' || l_linenumber AS clip_id,
    'clips/clip_' || l_orderkey || '_node' || l_linenumber || '.mp4' AS path,
    'src' || l_suppkey AS source, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    CAST(1280 - 64 * (l_partkey % 5) AS INTEGER) AS source_width,
    CAST(704 - 32 * (l_suppkey % 3) AS INTEGER) AS source_height,
    CAST(118 + l_linenumber AS INTEGER) AS source_frames,
    CASE WHEN l_partkey % 11 = 0 THEN 0e0 ELSE 24e0 + (l_linenumber % 3 - 1) * 0.5e0 END AS source_fps,
    abs(l_discount) AS duplicate_frame_ratio, l_quantity / 500e0 AS temporal_diff_mean,
    abs(l_tax) AS temporal_diff_std, l_quantity / 50e0 AS high_motion_ratio,
    CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS scene_cut_count,
    abs(l_tax) AS black_pixel_ratio, abs(l_tax) AS white_pixel_ratio,
    l_linenumber * 3e0 AS clip_start_sec
  FROM lineitem)"""

SCORED_SQL = (
    CLIPS_SQL
    + """, scored AS (
  SELECT *, 1e0 - (least(abs(source_width - 1280e0) / 1280e0, 1e0) + least(abs(source_height - 704e0) / 704e0, 1e0)
      + least(abs(source_frames - 121e0) / 121e0, 1e0)
      + CASE WHEN source_fps > 0 THEN least(abs(source_fps - 24e0) / 24e0, 1e0) ELSE 0.25e0 END
      + least(abs(source_width::DOUBLE / greatest(source_height, 1)::DOUBLE - 1280e0 / 704e0), 1e0)
      + duplicate_frame_ratio) / 6e0 AS conformance_score,
    CASE WHEN duplicate_frame_ratio < 0.05e0 AND high_motion_ratio > 0.30e0 AND temporal_diff_mean > 0.0025e0
      THEN least(high_motion_ratio * 0.7e0
        + (1e0 - least(temporal_diff_std / greatest(temporal_diff_mean, 1e-6), 1e0)) * 0.3e0, 1e0)
      ELSE 0e0 END AS timelapse_score
  FROM clips)"""
)

GRADED_SQL = (
    SCORED_SQL
    + """, flagged AS (
  SELECT *, concat_ws('; ',
      CASE WHEN scene_cut_count > 0 THEN 'scene_cuts=' || scene_cut_count END,
      CASE WHEN duplicate_frame_ratio > 0.05e0 THEN printf('duplicates=%.2f%%', duplicate_frame_ratio * 100e0) END,
      CASE WHEN timelapse_score > 0.5e0 THEN printf('timelapse=%.2f', timelapse_score) END,
      CASE WHEN temporal_diff_mean < 0.005e0 THEN printf('static_mean_delta=%.4f', temporal_diff_mean) END,
      CASE WHEN black_pixel_ratio + white_pixel_ratio > 0.15e0
        THEN printf('clipping=%.2f%%', (black_pixel_ratio + white_pixel_ratio) * 100e0) END,
      CASE WHEN conformance_score < 0.5e0 THEN printf('conformance=%.3f', conformance_score) END) AS flags
  FROM scored), graded AS (
  SELECT * EXCLUDE (flags),
    CASE WHEN flags <> '' THEN 'FAIL'
      WHEN conformance_score >= 0.9e0 AND duplicate_frame_ratio < 0.03e0 AND timelapse_score < 0.3e0
        AND black_pixel_ratio + white_pixel_ratio < 0.08e0 THEN 'PASS' ELSE 'REVIEW' END AS grade,
    CASE WHEN flags <> '' THEN flags
      WHEN conformance_score >= 0.9e0 AND duplicate_frame_ratio < 0.03e0 AND timelapse_score < 0.3e0
        AND black_pixel_ratio + white_pixel_ratio < 0.08e0 THEN 'passed all checks' ELSE 'minor flags' END AS reason
  FROM flagged)"""
)


def graded(spark: SparkSession, d: str, items: DataFrame | None = None) -> DataFrame:
    return grade_clips(score_clips(clips(spark, d, items)))


def starts(spark: SparkSession, d: str) -> DataFrame:
    """Events seen as clip starts (in seconds) per user."""
    return table(spark, d, "events").select(
        "event_id", F.col("user_id").alias("key"), (epoch_micros("ts") / F.lit(1000000.0)).alias("start"),
        "ts", "value",
    )


STARTS_SQL = """starts AS (SELECT event_id, user_id AS key, epoch_us(ts) / 1e6 AS start, ts, value FROM events)"""


def frame_values() -> Column:
    """Vector components as pixel values 0..255."""
    return F.transform(
        "embedding",
        lambda x: F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.floor((x.cast("double") + 1.0) * F.lit(127.5)))).cast("int"),
    )


FRAMES_PER_CLIP = 25


def frame_keys() -> list[Column]:
    clip = F.floor(F.col("vec_id") / F.lit(FRAMES_PER_CLIP)).cast("string")
    return [
        F.concat(F.lit("clip_"), clip).alias("clip_id"),
        (F.col("vec_id") % FRAMES_PER_CLIP).cast("int").alias("frame_idx"),
    ]


def gray_frames(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings seen as 8 x 8 gray frames, 25 frames per clip."""
    return table(spark, d, "embeddings").select(
        *frame_keys(),
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("channels"),
        fr.gray_pixels(frame_values()).alias("pixels"),
    )


def rgb_frames(spark: SparkSession, d: str) -> DataFrame:
    """The same frames with three channels: the value, its inverse and a third mix."""
    triple = F.flatten(F.transform(frame_values(), lambda v: F.array(v, 255 - v, (v * 7) % 256)))
    return table(spark, d, "embeddings").select(
        *frame_keys(),
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("channels"),
        fr.gray_pixels(triple).alias("pixels"),
    )


def frame_clips(spark: SparkSession, d: str) -> DataFrame:
    """Frame rate per clip of the frame tables."""
    n = F.floor(F.col("vec_id") / F.lit(FRAMES_PER_CLIP))
    return (
        table(spark, d, "embeddings")
        .select(frame_keys()[0], (F.lit(23.0) + n % 3).alias("fps"))
        .distinct()
    )


FRAMES_SQL = """px AS (
  SELECT 'clip_' || (vec_id // 25) AS clip_id, CAST(vec_id % 25 AS INTEGER) AS frame_idx, vec_id // 25 AS clip_no,
    list_transform(embedding, lambda x: CAST(greatest(0e0, least(255e0, floor((x::DOUBLE + 1e0) * 127.5e0))) AS BIGINT)) AS v
  FROM embeddings), cells AS (
  SELECT clip_id, frame_idx, clip_no, unnest(v) AS g, unnest(range(0, len(v))) AS pos FROM px), deltas AS (
  SELECT a.clip_id, a.frame_idx, sum(abs(a.g - b.g))::DOUBLE AS s, sum((a.g - b.g) * (a.g - b.g))::DOUBLE AS ss,
    count(*) AS n, sum(abs(a.g - b.g))::DOUBLE / (count(*) * 255e0) AS delta
  FROM cells a JOIN cells b ON a.clip_id = b.clip_id AND a.frame_idx = b.frame_idx + 1 AND a.pos = b.pos
  GROUP BY 1, 2)"""

RGB_SQL = (
    FRAMES_SQL
    + """, rgb AS (
  SELECT clip_id, frame_idx, pos, g AS r, 255 - g AS gg, (g * 7) % 256 AS b,
    2126 * g + 7152 * (255 - g) + 722 * ((g * 7) % 256) AS luma FROM cells)"""
)


def runlog(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns seen as log rows: run, step and a loss-like value."""
    loss = F.length("text") % 97 / F.lit(10.0) + F.col("turn") / F.lit(7.0)
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("run"), F.col("turn").alias("step"), loss.alias("loss"), F.length("text").alias("chars")
    )


RUNLOG_SQL = """runlog AS (SELECT conv_id AS run, turn AS step,
    (length(text) % 97) / 10e0 + turn / 7e0 AS loss, length(text) AS chars FROM conversations)"""


def prompts(spark: SparkSession, d: str) -> DataFrame:
    """Documents seen as manifest rows."""
    return table(spark, d, "documents").select(
        F.col("doc_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("video"),
        F.col("text").alias("prompt"),
        "source", "lang", "n_chars",
    )


PROMPTS_SQL = """prompts AS (SELECT doc_id, 'doc_' || doc_id AS id, source || '/' || doc_id || '.mp4' AS video,
    text AS prompt, source, lang, n_chars FROM documents)"""


def records(spark: SparkSession, d: str) -> DataFrame:
    """Orders seen as clip records."""
    c = F.col
    key = c("o_orderkey").cast("string")
    cid = F.concat(F.lit("clip_"), key, F.lit("_node"), (c("o_orderkey") % 60).cast("string"), F.lit(".5"))
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey",
        cid.alias("clip_id"),
        F.concat(F.lit("clips/"), cid, F.lit(".mp4")).alias("clip_uri"),
        F.sha2(F.concat(F.lit("c"), key), 256).alias("clip_sha256"),
        F.concat(F.lit("frames/"), cid, F.lit(".jpg")).alias("first_frame_uri"),
        F.sha2(F.concat(F.lit("f"), key), 256).alias("first_frame_sha256"),
        F.concat(F.lit("vid_"), c("o_custkey").cast("string")).alias("source_video_id"),
        (c("o_orderkey") % 60 + F.lit(0.5)).alias("clip_start_sec"),
        F.when(c("o_orderkey") % 50 == 0, F.lit(6.0)).otherwise(F.lit(5.041666666666667)).alias("duration_sec"),
        F.when(c("o_orderkey") % 40 == 0, 640).otherwise(1280).cast("bigint").alias("width"),
        F.when(c("o_orderkey") % 30 == 0, 700).otherwise(704).cast("bigint").alias("height"),
        F.when(c("o_orderkey") % 20 == 0, F.lit(25.0)).otherwise(F.lit(24.0)).alias("fps"),
        F.when(c("o_orderkey") % 25 == 0, 100).otherwise(121).cast("bigint").alias("num_frames"),
        F.concat(F.lit("https://youtu.be/V"), c("o_custkey").cast("string")).alias("source_video_url"),
        F.when(c("o_orderkey") % 9 == 0, F.lit(None)).otherwise(
            F.concat(c("o_orderpriority"), F.lit(" shot "), c("o_orderstatus"), F.lit(" "), F.floor(c("o_orderkey") / 4).cast("string"))
        ).alias("caption"),
    )


RECORDS_SQL = """records AS (SELECT o_orderkey, o_custkey,
    'clip_' || o_orderkey || '_node' || (o_orderkey % 60) || '.5' AS clip_id,
    'clips/clip_' || o_orderkey || '_node' || (o_orderkey % 60) || '.5.mp4' AS clip_uri,
    sha256('c' || o_orderkey) AS clip_sha256,
    'frames/clip_' || o_orderkey || '_node' || (o_orderkey % 60) || '.5.jpg' AS first_frame_uri,
    sha256('f' || o_orderkey) AS first_frame_sha256,
    'vid_' || o_custkey AS source_video_id, o_orderkey % 60 + 0.5e0 AS clip_start_sec,
    CASE WHEN o_orderkey % 50 = 0 THEN 6e0 ELSE 5.041666666666667e0 END AS duration_sec,
    CAST(CASE WHEN o_orderkey % 40 = 0 THEN 640 ELSE 1280 END AS BIGINT) AS width,
    CAST(CASE WHEN o_orderkey % 30 = 0 THEN 700 ELSE 704 END AS BIGINT) AS height,
    CASE WHEN o_orderkey % 20 = 0 THEN 25e0 ELSE 24e0 END AS fps,
    CAST(CASE WHEN o_orderkey % 25 = 0 THEN 100 ELSE 121 END AS BIGINT) AS num_frames,
    'https://youtu.be/V' || o_custkey AS source_video_url,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority || ' shot ' || o_orderstatus || ' ' || (o_orderkey // 4) END AS caption
  FROM orders)"""


def records_v2(spark: SparkSession, d: str) -> DataFrame:
    """A later version of the records: some rows gone, some new, some fields changed."""
    c = F.col
    base = records(spark, d).filter(c("o_orderkey") % 13 != 0)
    new = F.col("o_orderkey") % 17 == 0
    key = c("o_orderkey").cast("string")
    return base.withColumns(
        {
            "clip_id": F.when(new, F.concat(c("clip_id"), F.lit("b"))).otherwise(c("clip_id")),
            "clip_sha256": F.when(c("o_orderkey") % 3 == 0, F.sha2(F.concat(F.lit("x"), key), 256)).otherwise(c("clip_sha256")),
            "source_video_id": F.when(c("o_orderkey") % 5 == 0, F.lit("other")).otherwise(c("source_video_id")),
            "clip_start_sec": F.when(c("o_orderkey") % 7 == 0, c("clip_start_sec") + 0.4).otherwise(c("clip_start_sec")),
        }
    )


RECORDS2_SQL = (
    RECORDS_SQL
    + """, records2 AS (SELECT * REPLACE (
    CASE WHEN o_orderkey % 17 = 0 THEN clip_id || 'b' ELSE clip_id END AS clip_id,
    CASE WHEN o_orderkey % 3 = 0 THEN sha256('x' || o_orderkey) ELSE clip_sha256 END AS clip_sha256,
    CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE source_video_id END AS source_video_id,
    CASE WHEN o_orderkey % 7 = 0 THEN clip_start_sec + 0.4e0 ELSE clip_start_sec END AS clip_start_sec)
  FROM records WHERE o_orderkey % 13 <> 0)"""
)
