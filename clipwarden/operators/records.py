"""Clip records from manifest rows, and repair of manifest paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwarden.functions import paths, text, urls
from clipwarden.spec import CLIP_COLUMNS, TargetSpec


def build_records(rows: DataFrame, spec: TargetSpec = TargetSpec(), strict: bool = True) -> DataFrame:
    """Clip records of rows `id, prompt, clip_sha256, first_frame_sha256`.

    Ids that do not parse fail the query, or are left out with `strict=False`.
    """
    cid = F.col("id")
    video, start = paths.clip_video_id(cid), paths.clip_start(cid)
    if strict:
        video, start = paths.strict(video, cid, "clip_id"), paths.strict(start, cid, "clip_id")
    else:
        rows = rows.filter(video.isNotNull() & start.isNotNull())
    return rows.select(
        cid.alias("clip_id"),
        paths.clip_uri(cid).alias("clip_uri"),
        "clip_sha256",
        paths.frame_uri(cid).alias("first_frame_uri"),
        "first_frame_sha256",
        urls.provider_source_id(video).alias("source_video_id"),
        start.alias("clip_start_sec"),
        F.lit(spec.duration).alias("duration_sec"),
        F.lit(spec.width).cast("bigint").alias("width"),
        F.lit(spec.height).cast("bigint").alias("height"),
        F.lit(spec.fps).alias("fps"),
        F.lit(spec.frames).cast("bigint").alias("num_frames"),
        urls.provider_source_url(video).alias("source_video_url"),
        F.coalesce("prompt", F.lit("")).alias("caption"),
    ).select(*CLIP_COLUMNS)


def usable_rows(rows: DataFrame, files: DataFrame, base: str = "/") -> DataFrame:
    """Rows with an id whose video, resolved against `base`, is among the listed files (`path`)."""
    named = rows.filter(F.coalesce("id", F.lit("")) != "").withColumn("_path", paths.resolve_path(F.col("video"), base))
    there = files.select(paths.resolve_path(F.col("path"), base).alias("_path"))
    return named.join(there, "_path", "left_semi").drop("_path")


def rewrite_paths(rows: DataFrame, dataset_dir: str) -> DataFrame:
    """Point videos into `<dir>/clips/`; adds `path_state` (`fixed`, `correct` or `empty`)."""
    name = paths.basename(F.coalesce("video", F.lit("")))
    want = F.concat(F.lit(dataset_dir.rstrip("/") + "/clips/"), name)
    state = F.when(name == "", "empty").when(F.col("video") == want, "correct").otherwise("fixed")
    return rows.withColumns(
        {"path_state": state, "video": F.when(state == "fixed", want).otherwise(F.col("video"))}
    )


def rewrite_counts(rewritten: DataFrame) -> DataFrame:
    return rewritten.agg(
        F.count_if(F.col("path_state") == "fixed").alias("fixed"),
        F.count_if(F.col("path_state") == "correct").alias("already_correct"),
        F.count(F.lit(1)).alias("rows"),
    )


def apply_captions(rows: DataFrame, captions: DataFrame, limit: int | None = None) -> DataFrame:
    """Take over landed captions (`id, caption`); an empty or missing one leaves the prompt alone."""
    joined = rows.join(captions.select("id", F.col("caption").alias("_c")), "id", "left")
    return joined.withColumn("prompt", text.caption_or(F.col("_c"), F.col("prompt"), limit)).select(*rows.columns)
