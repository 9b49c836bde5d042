"""Writers for reports, datasets, manifests and logs.

All outputs are folders of part files, so a writer never passes the data through one task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions import paths
from clipwarden.operators import grade, lint, prescreen, profile
from clipwarden.spec import CLIP_COLUMNS, ISSUE_COLUMNS, QUALITY_COLUMNS, GradeThresholds

INVENTORY_COLUMNS = [
    "line", "id", "video", "width", "height", "frames", "fps", "file_size_mb",
    "duplicate_frame_ratio", "aspect_error",
]

# --- Fixed values: interval manifest head ----------------------------------
INTERVAL_HEAD = {
    "protocol_version": "2.0.0",
    "schema_version": "2.0.0",
    "spec_id": "video_v1",
}
NO_HASH = "0" * 64


def write_quality_csv(graded: DataFrame, path: str, made_of: DataFrame | None = None) -> bool:
    """Quality report with header and fixed column order, as gzip; an empty report writes nothing.

    A report that has been put in order is shuffled to see whether it is empty: `made_of` has a row for each of its rows
    and is looked at instead.
    """
    if (graded if made_of is None else made_of).isEmpty():
        return False
    shown = graded.select(*[c for c in QUALITY_COLUMNS if c in graded.columns])
    shown.write.mode("overwrite").csv(path, header=True, compression="gzip")
    return True


def summary_document(graded: DataFrame, limits: GradeThresholds = GradeThresholds()) -> DataFrame:
    """The one-row summary with nested aggregate, issue map and thresholds."""
    totals = grade.quality_summary(graded)
    kinds = grade.issues_by_category(graded)
    issues = kinds.agg(
        # one entry per category text before `=`, a small fixed set
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("issues_by_category")
    )
    means = [c for c in totals.columns if c.startswith("mean_")]
    return totals.crossJoin(F.broadcast(issues)).select(  # one row on either side
        "total", "pass", "review", "fail", "pass_rate", "review_rate", "fail_rate",
        F.struct(*means).alias("aggregate"),
        "issues_by_category",
        F.struct(*[F.lit(v).alias(k) for k, v in vars(limits).items()]).alias("thresholds"),
    )


def write_summary(graded: DataFrame, path: str, limits: GradeThresholds = GradeThresholds()) -> None:
    summary_document(graded, limits).write.mode("overwrite").json(path)


def write_clips(clips: DataFrame, path: str) -> None:
    """Clip records as parquet; missing record columns become empty text."""
    cols = [F.col(c) if c in clips.columns else F.lit("").alias(c) for c in CLIP_COLUMNS]
    clips.select(*cols).write.mode("overwrite").parquet(path)


def manifest_lines(clips: DataFrame, captioned: bool = False) -> DataFrame:
    """`{id, video}` or `{id, video, prompt}` as JSON text."""
    fields = [F.col("clip_id").alias("id"), F.col("clip_uri").alias("video")]
    if captioned:
        fields.append(F.coalesce("caption", F.lit("")).alias("prompt"))
    return clips.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def write_manifest(clips: DataFrame, path: str, captioned: bool = False) -> None:
    manifest_lines(clips, captioned).write.mode("overwrite").text(path)


def interval_document(
    clips: DataFrame, netuid: int, miner_hotkey: str, interval_id: int, created_at: str, with_digest: bool = True
) -> DataFrame:
    """One-row dataset manifest; the hash is the content digest of the table, or 64 zeros."""
    counted = profile.dataset_digest(clips)
    digest = F.col("dataset_sha256") if with_digest else F.lit(NO_HASH)
    head: list[Column] = [F.lit(v).alias(k) for k, v in INTERVAL_HEAD.items()]
    return counted.select(
        *head,
        F.lit(netuid).alias("netuid"),
        F.lit(miner_hotkey).alias("miner_hotkey"),
        F.lit(interval_id).alias("interval_id"),
        F.lit(created_at).alias("created_at"),
        "record_count",
        digest.alias("dataset_sha256"),
    )


def write_training_manifest(
    graded: DataFrame, path: str, template: str, query: str, allow_review: bool = True
) -> None:
    grade.training_manifest(graded, template, query, allow_review).write.mode("overwrite").json(path)


def write_diagnostics(issues: DataFrame, inventory: DataFrame, path: str) -> None:
    """Issues as JSON lines and CSV, the video inventory as CSV and the counts as JSON; issues are found once."""
    issues = issues.persist(StorageLevel.DISK_ONLY)
    shown = issues.select(*ISSUE_COLUMNS)
    shown.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/diagnostics_jsonl")
    shown.write.mode("overwrite").csv(f"{path}/diagnostics_csv", header=True)
    inventory.select(*INVENTORY_COLUMNS).write.mode("overwrite").csv(f"{path}/video_inventory", header=True)
    lint.issue_counts(issues).write.mode("overwrite").json(f"{path}/diagnostics_summary")
    issues.unpersist()


def write_prescreen(screened: DataFrame, path: str) -> None:
    """Report CSV, one url list per recommendation and the counts; sources are screened once."""
    screened = screened.persist(StorageLevel.DISK_ONLY)
    prescreen.report_columns(screened).write.mode("overwrite").csv(f"{path}/report", header=True)
    screened.select("recommendation", "url").write.mode("overwrite").partitionBy("recommendation").text(
        f"{path}/urls"
    )
    prescreen.recommendation_counts(screened).write.mode("overwrite").json(f"{path}/summary")
    screened.unpersist()


def write_quarantine(graded: DataFrame, path: str) -> None:
    """Route rows by grade: FAIL to quarantine, the rest to kept.

    Each task keeps a file of either route open, so the rows are not sorted by route, which would spill them. The limit is
    one more than the routes: once it is reached, Spark begins to sort.
    """
    routed = graded.withColumn("route", F.when(F.col("grade") == "FAIL", "quarantine").otherwise("kept"))
    conf, key = graded.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, "3")
    try:
        routed.write.mode("overwrite").partitionBy("route").parquet(path)
    finally:
        conf.set(key, before)


def name_collisions(graded: DataFrame) -> DataFrame:
    """Base names that more than one failed path would claim in a flat quarantine folder."""
    return (
        graded.filter(F.col("grade") == "FAIL")
        .groupBy(paths.basename(F.col("path")).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def write_decisions(decided: DataFrame, path: str) -> None:
    """Kept and removed rows as two partitions of one dataset, in one pass."""
    decided.write.mode("overwrite").partitionBy("decision").parquet(path)


def write_cue_lists(lists: DataFrame, path: str, url: str) -> None:
    """`url | ts` lines, by url and position."""
    ordered = lists.repartitionByRange(url, "position").sortWithinPartitions(url, "position")
    ordered.select(F.concat(F.col(url), F.lit(" | "), F.col("cue")).alias("value")).write.mode("overwrite").text(path)


def append_log(rows: DataFrame, path: str, fmt: str = "json", fields: list[str] | None = None) -> None:
    """Append log rows; CSV logs are cut to fixed fields, absent ones stay empty."""
    if fields:
        rows = rows.select(
            *[F.col(f) if f in rows.columns else F.lit(None).cast("string").alias(f) for f in fields]
        )
    writer = rows.write.mode("append")
    writer.csv(path, header=True) if fmt == "csv" else writer.json(path)


def event_rows(rows: DataFrame, time: Column, event: Column, payload: list[str]) -> DataFrame:
    """`{time, event, **payload}` as JSON text."""
    body = F.struct(time.alias("time"), event.alias("event"), *payload)
    return rows.select(F.to_json(body).alias("value"))


def history_document(ids: DataFrame, key: str, updated: str) -> DataFrame:
    """Distinct ids, sorted, with the save time on every row; written as a table."""
    return ids.select(F.col(key).cast("bigint").alias("id")).distinct().sort("id").withColumn(
        "last_updated", F.lit(updated)
    )


def write_snapshot(rows: DataFrame, run_path: str) -> None:
    """The exact manifest rows a run used."""
    rows.write.mode("overwrite").json(f"{run_path}/manifest_snapshot")
