"""Clip grading, dataset grading, report filters and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions import paths, scores, text
from clipwarden.functions.numbers import with_fixed_text
from clipwarden.operators.latest import edge_rows
from clipwarden.spec import GradeThresholds, TargetSpec


def score_clips(df: DataFrame, spec: TargetSpec = TargetSpec()) -> DataFrame:
    """Add conformance and timelapse scores to measured clips."""
    c = F.col
    return df.withColumns(
        {
            "conformance_score": scores.conformance(
                c("source_width"), c("source_height"), c("source_frames"), c("source_fps"),
                c("duplicate_frame_ratio"), spec,
            ),
            "timelapse_score": scores.timelapse(
                c("duplicate_frame_ratio"), c("high_motion_ratio"), c("temporal_diff_mean"),
                c("temporal_diff_std"),
            ),
        }
    )


def grade_column(limits: GradeThresholds = GradeThresholds()) -> Column:
    """The grade over a scored clip row."""
    c = F.col
    clipping = c("black_pixel_ratio") + c("white_pixel_ratio")
    failed = F.lit(False)
    for hit in _fail_rules(limits).values():
        failed = failed | F.coalesce(hit, F.lit(False))
    strong = (
        _above(c("conformance_score") >= 0.90, c("conformance_score"))
        & (c("duplicate_frame_ratio") < 0.03)
        & (c("timelapse_score") < 0.3)
        & (clipping < 0.08)
    )
    return F.when(failed, "FAIL").when(strong, "PASS").otherwise("REVIEW")


def _above(hit: Column, value: Column) -> Column:
    """A comparison that NaN fails, though it sorts above all numbers."""
    return hit & ~F.isnan(value.cast("double"))


def _fail_rules(limits: GradeThresholds) -> dict[str, Column]:
    """Conditions that fail a clip, in reporting order."""
    c = F.col
    clipping = c("black_pixel_ratio") + c("white_pixel_ratio")
    return {
        "scene_cuts": c("scene_cut_count") > limits.scene_cut_max,
        "duplicates": _above(c("duplicate_frame_ratio") > limits.dup_ratio, c("duplicate_frame_ratio")),
        "timelapse": _above(c("timelapse_score") > limits.timelapse_score, c("timelapse_score")),
        "static_mean_delta": c("temporal_diff_mean") < 0.005,
        "clipping": _above(clipping > limits.clipping_ratio, clipping),
        "conformance": c("conformance_score") < limits.min_conformance,
    }


def grade_clips(df: DataFrame, limits: GradeThresholds = GradeThresholds()) -> DataFrame:
    """Add `grade` and `reason`; a fail reason lists all broken rules with their values."""
    c = F.col
    percent = F.lit(100.0)
    graded = df.withColumn("grade", grade_column(limits))
    texts = with_fixed_text(
        graded,
        {
            "_duplicates": (c("duplicate_frame_ratio") * percent, 2),
            "_timelapse": (c("timelapse_score"), 2),
            "_static_mean_delta": (c("temporal_diff_mean"), 4),
            "_clipping": ((c("black_pixel_ratio") + c("white_pixel_ratio")) * percent, 2),
            "_conformance": (c("conformance_score"), 3),
        },
    )
    shown = {
        "scene_cuts": c("scene_cut_count").cast("string"),
        "duplicates": F.concat(c("_duplicates"), F.lit("%")),
        "timelapse": c("_timelapse"),
        "static_mean_delta": c("_static_mean_delta"),
        "clipping": F.concat(c("_clipping"), F.lit("%")),
        "conformance": c("_conformance"),
    }
    flags = [F.when(hit, F.concat(F.lit(f"{k}="), shown[k])) for k, hit in _fail_rules(limits).items()]
    reason = (
        F.when(c("grade") == "FAIL", F.concat_ws("; ", *flags))
        .when(c("grade") == "PASS", "passed all checks")
        .otherwise("minor flags")
    )
    return texts.withColumn("reason", reason).select(*df.columns, "grade", "reason")


def grade_dataset(summary: DataFrame) -> DataFrame:
    """Dataset-level grade of one row of metric means; absent metrics take their worst default."""

    def metric(name: str, default: float) -> Column:
        col = F.col(name) if name in summary.columns else F.lit(None).cast("double")
        return F.coalesce(col, F.lit(default))

    conf, dup = metric("conformance_score", 0.0), metric("duplicate_frame_ratio", 1.0)
    clipping = metric("black_pixel_ratio", 0.0) + metric("white_pixel_ratio", 0.0)
    good = (conf >= 0.90) & (dup < 0.03) & (clipping < 0.08)
    fair = (conf >= 0.75) & (dup < 0.10) & (clipping < 0.15)
    return summary.withColumns(
        {
            "dataset_grade": F.when(good, "PASS").when(fair, "REVIEW").otherwise("FAIL"),
            "dataset_text": F.when(good, "Dataset format and visual health look strong.")
            .when(fair, "Dataset is usable, but review flagged metrics before ranking it highly.")
            .otherwise("Dataset has significant format or visual-quality issues for this benchmark."),
        }
    )


def dataset_means(df: DataFrame, metrics: list[str]) -> DataFrame:
    return df.agg(*[F.avg(m).alias(m) for m in metrics])


def filter_clips(
    manifest: DataFrame,
    quality: DataFrame,
    allowed: list[str] = ["PASS", "REVIEW"],  # noqa: B006
    max_dup_ratio: float = 0.03,
) -> DataFrame:
    """Keep manifest rows with an allowed grade and few duplicates.

    `quality` has one row per base name (see `latest_by_name`). A clip without a quality row counts
    as PASS with no duplicates.
    """
    want = [g.strip().upper() for g in allowed]
    joined = attach_quality(manifest, quality)
    return joined.filter(F.col("grade").isin(want) & ~(F.col("duplicate_frame_ratio") > max_dup_ratio))


def attach_quality(manifest: DataFrame, quality: DataFrame) -> DataFrame:
    """Left join of manifest rows to their quality row by base name, lenient defaults on a miss."""
    by_id = F.concat(F.col("id"), F.lit(".mp4"))
    name = F.when(F.coalesce(F.col("_base"), F.lit("")) == "", by_id).otherwise(F.col("_base"))
    right = quality.select(
        F.col("name"),
        F.col("grade").alias("_grade"),
        F.col("duplicate_frame_ratio").alias("_dup"),
        F.lit(True).alias("_hit"),
    )
    return (
        manifest.withColumn("_base", paths.basename(F.col("video")))
        .withColumn("name", name)
        .join(right, "name", "left")
        .withColumns(
            {
                "grade": F.when(F.col("_hit"), F.col("_grade")).otherwise("PASS"),
                "duplicate_frame_ratio": F.when(F.col("_hit"), F.col("_dup")).otherwise(F.lit(0.0)),
            }
        )
        .drop("_base", "_grade", "_dup", "_hit")
    )


def latest_by_name(quality: DataFrame, name: Column, order: list[str]) -> DataFrame:
    """Last row per name in `order`, without rows that have no name."""
    cols = [c for c in quality.columns if c != "name"]
    named = quality.withColumn("name", name).filter(F.col("name") != "")
    return edge_rows(named, ["name"], order, narrow_first=False).select("name", *cols)


def quality_summary(graded: DataFrame) -> DataFrame:
    """Grade counts, rates and the four headline means in one row."""
    total = F.greatest(F.count(F.lit(1)), F.lit(1))
    counts = {
        "pass": F.count_if(F.col("grade") == "PASS"),
        "review": F.count_if(F.col("grade") == "REVIEW"),
        "fail": F.count_if(~F.col("grade").isin("PASS", "REVIEW")),
    }
    means = {
        "mean_conformance_score": "conformance_score",
        "mean_duplicate_frame_ratio": "duplicate_frame_ratio",
        "mean_timelapse_score": "timelapse_score",
        "mean_temporal_diff_mean": "temporal_diff_mean",
    }
    return graded.agg(
        F.count(F.lit(1)).alias("total"),
        *[v.alias(k) for k, v in counts.items()],
        *[(v / total).alias(f"{k}_rate") for k, v in counts.items()],
        *[F.coalesce(F.avg(v), F.lit(0.0)).alias(k) for k, v in means.items()],
    )


def issues_by_category(graded: DataFrame) -> DataFrame:
    """Rows per primary category; PASS and REVIEW texts count as categories too."""
    return (
        graded.filter(F.coalesce(F.col("reason"), F.lit("")) != "")
        .groupBy(text.primary_category(F.col("reason")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def grade_totals(graded: DataFrame) -> DataFrame:
    return graded.groupBy("grade").agg(F.count(F.lit(1)).alias("n"))


def issue_totals(graded: DataFrame) -> DataFrame:
    """Issue categories over failed rows."""
    return (
        graded.filter(F.col("grade") == "FAIL")
        .select(F.explode(text.issue_categories(F.col("reason"), F.col("grade"))).alias("category"))
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def source_table(graded: DataFrame, source: str = "source") -> DataFrame:
    """Per source: grade counts, fail rate and issues as `K:n, ...` by falling count.

    Issues of equal count are listed by name.
    """
    kinds = [*text.ISSUE_WORDS.values(), "OTHER"]
    found = text.issue_categories(F.col("reason"), F.col("grade"))
    counted = graded.withColumn("_kinds", found).groupBy(source).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("grade") == "PASS").alias("pass"),
        F.count_if(F.col("grade") == "REVIEW").alias("review"),
        F.count_if(F.col("grade") == "FAIL").alias("fail"),
        *[F.count_if(F.array_contains("_kinds", k)).alias(f"_n_{k}") for k in kinds],
    )
    pairs = F.array(*[F.struct((-F.col(f"_n_{k}")).alias("m"), F.lit(k).alias("k")) for k in kinds])
    listed = F.transform(
        F.array_sort(F.filter(pairs, lambda p: p["m"] < 0)),
        lambda p: F.concat(p["k"], F.lit(":"), (-p["m"]).cast("string")),
    )
    return counted.select(
        source, "total", "pass", "review", "fail",
        (F.col("fail") / F.col("total")).alias("fail_rate"),
        F.when(F.size(listed) > 0, F.array_join(listed, ", ")).otherwise("-").alias("issues"),
    )


def problem_sources(table: DataFrame) -> DataFrame:
    return table.filter((F.col("fail_rate") > 0.5) | (F.col("fail") >= 5))


def training_manifest(
    graded: DataFrame, template: str, query: str, allow_review: bool = True
) -> DataFrame:
    """Manifest rows of usable clips with a templated prompt."""
    keep = ["PASS", "REVIEW"] if allow_review else ["PASS"]
    return graded.filter(F.col("grade").isin(keep)).select(
        paths.stem(F.col("path")).alias("id"),
        F.concat(F.lit("clips/"), paths.basename(F.col("path"))).alias("video"),
        text.build_prompt(template, F.lit(query), F.col("source_height")).alias("prompt"),
    )
