"""Scoring and screening of candidate sources from their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import fixed_text, percent_text
from clipwarden.functions.text import at_most
from clipwarden.spec import KEEP_KEYWORDS, REJECT_KEYWORDS, SampleThresholds


def score_metadata(df: DataFrame) -> DataFrame:
    """Add `metadata_score` and `metadata_reason` to source metadata rows.

    A reject keyword anywhere in title or description decides; the first one in list order is
    reported. Matching is by substring. Scores have a ceiling of 1 and no floor.
    """
    c = F.col
    low = df.withColumns(
        {
            "_title": F.lower(F.coalesce(c("title"), F.lit(""))),
            "_desc": F.lower(F.coalesce(c("description"), F.lit(""))),
        }
    )
    reject = F.coalesce(
        *[
            F.when(c("_title").contains(k), F.lit(f"reject_title:{k}")).when(
                c("_desc").contains(k), F.lit(f"reject_desc:{k}")
            )
            for k in REJECT_KEYWORDS
        ]
    )
    keep_hits = [c("_title").contains(k) for k in KEEP_KEYWORDS]
    duration = F.coalesce(c("duration"), F.lit(0.0))
    sized = (c("width") > 0) & (c("height") > 0)
    large = sized & (c("height") >= 1080) & (c("width") >= 1920)
    small = sized & ~large & ((c("height") < 704) | (c("width") < 1280))
    timed = F.coalesce(c("fps"), F.lit(0.0)) != 0
    native = timed & (F.abs(c("fps") - 24.0) < 0.1)
    slow = timed & ~native & (c("fps") < 20)
    steps = [
        *[(h, 0.15, f"keep:{k}") for h, k in zip(keep_hits, KEEP_KEYWORDS)],
        (duration < 30, -0.3, "too_short"),
        (duration > 120, 0.1, "good_duration"),
        (large, 0.1, "high_resolution"),
        (small, -0.3, "low_resolution"),
        (native, 0.1, "native_24fps"),
        (slow, -0.2, "low_fps"),
    ]
    yes = [F.coalesce(cond, F.lit(False)) for cond, _, _ in steps]
    score = F.lit(0.5)
    for cond, (_, delta, _) in zip(yes, steps):
        score = score + F.when(cond, F.lit(delta)).otherwise(F.lit(0.0))
    reasons = F.concat_ws("; ", *[F.when(cond, F.lit(name)) for cond, (_, _, name) in zip(yes, steps)])
    return (
        low.withColumn("_reject", reject)
        .withColumns(
            {
                "metadata_score": F.when(c("error").isNotNull() | c("_reject").isNotNull(), F.lit(0.0))
                .otherwise(F.least(score, F.lit(1.0))),
                "metadata_reason": F.when(
                    c("error").isNotNull(), F.concat(F.lit("metadata_error:"), c("error"))
                )
                .when(c("_reject").isNotNull(), c("_reject"))
                .when(reasons == "", "no_signals")
                .otherwise(reasons),
            }
        )
        .drop("_title", "_desc", "_reject")
    )


def recommend_by_metadata(scored: DataFrame) -> DataFrame:
    s = F.col("metadata_score")
    return scored.withColumns(
        {
            "recommendation": F.when(s <= 0, "REJECT").when(s < 0.5, "REVIEW").otherwise("KEEP"),
            "reason": F.when((s > 0) & (s < 0.5), F.lit("weak_metadata")).otherwise(
                F.col("metadata_reason")
            ),
        }
    )


def recommend_by_sample(
    scored: DataFrame, samples: DataFrame, limits: SampleThresholds = SampleThresholds()
) -> DataFrame:
    """Recommendation from metadata plus the metrics of a sampled window.

    `samples` has one row per url with `downloaded` and the three sample metrics, null metrics
    meaning that the sample did not decode. No row means that the download failed.
    """
    s = F.col("metadata_score")
    dup, still, lapse = (
        F.col("sample_duplicate_ratio"), F.col("sample_static_ratio"), F.col("sample_timelapse_score"),
    )
    rules = [
        (dup > limits.dup_ratio, F.concat(F.lit("sample_dup="), percent_text(dup))),
        (still > limits.static_ratio, F.concat(F.lit("sample_static="), percent_text(still))),
        (lapse > limits.timelapse_score, F.concat(F.lit("sample_timelapse="), fixed_text(lapse, 2))),
    ]
    flags = F.concat_ws("; ", *[F.when(cond, msg) for cond, msg in rules])
    # only sources that pass the cheap test are looked up among the samples
    probed = (s > 0) & (F.coalesce(F.col("duration"), F.lit(0.0)) > 0)
    base = scored.withColumn("_key", F.when(probed, F.col("url")))
    right = samples.withColumnRenamed("url", "_key")
    joined = base.join(right, "_key", "left")
    undecoded = dup.isNull()
    return joined.withColumns(
        {
            "recommendation": F.when(s <= 0, "REJECT")
            .when(~probed, "REVIEW")
            .when(~F.coalesce(F.col("downloaded"), F.lit(False)) | undecoded, "REVIEW")
            .when(flags != "", "REJECT")
            .when(s < 0.5, "REVIEW")
            .otherwise("KEEP"),
            "reason": F.when(s <= 0, F.col("metadata_reason"))
            .when(~probed, "no_duration")
            .when(~F.coalesce(F.col("downloaded"), F.lit(False)), "sample_download_failed")
            .when(undecoded, "sample_decode_failed")
            .when(flags != "", flags)
            .when(s < 0.5, "weak_metadata")
            .otherwise("sample_ok"),
        }
    ).drop("_key", "downloaded")


def recommendation_rank(col: Column) -> Column:
    return F.when(col == "KEEP", 0).when(col == "REVIEW", 1).otherwise(2)


def order_sources(df: DataFrame) -> DataFrame:
    """KEEP, REVIEW, REJECT, each by url."""
    return df.orderBy(recommendation_rank(F.col("recommendation")), "url")


def recommendation_counts(df: DataFrame) -> DataFrame:
    """One row of counts; levels without a source show 0."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("recommendation") == k).alias(k) for k in ("KEEP", "REVIEW", "REJECT")],
    )


def report_columns(df: DataFrame, title_limit: int | None = None) -> DataFrame:
    """The report's text form: two decimals for scores, four for ratios, empty for missing; titles are whole by default."""

    def text(name: str, digits: int) -> Column:
        return F.coalesce(fixed_text(F.col(name), digits), F.lit("")).alias(name)

    return df.select(
        "url",
        at_most(F.coalesce(F.col("title"), F.lit("")), title_limit).alias("title"),
        "duration", "fps", "width", "height",
        text("metadata_score", 2),
        "metadata_reason",
        text("sample_duplicate_ratio", 4),
        text("sample_static_ratio", 4),
        text("sample_timelapse_score", 4),
        "recommendation",
        "reason",
    )
