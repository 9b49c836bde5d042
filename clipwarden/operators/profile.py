"""Table profiles: numeric summaries, uniqueness, modes, schema, ordered lists, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import finite
from clipwarden.functions.text import cue_text
from clipwarden.operators.ordered import exact_quantiles, join_null_safe, rank_within

LOG_QUANTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95, "p99": 0.99}
SHORT_QUANTILES = {"p05": 0.05, "p50": 0.50, "p95": 0.95}
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")


def long_form(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(key, value) rows of all numeric and boolean columns; booleans count as 0 and 1."""
    cols = columns or [n for n, t in df.dtypes if t in NUMERIC_TYPES]
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.key", "_p.value").filter(
        "value is not null"
    )


def key_stats(
    values: DataFrame,
    quantiles: dict[str, float] = LOG_QUANTILES,
    finite_only: bool = True,
    sample_std: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Mean, std, min, quantiles, max and count of `value` per `key`.

    With `finite_only=False` one NaN makes every statistic of its key NaN.
    """
    v = F.col("value")
    rows = values.filter(finite(v)) if finite_only else values.filter(v.isNotNull())
    std = F.stddev_samp("value") if sample_std else F.stddev_pop("value")
    base = rows.groupBy("key").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        std.alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max(F.isnan("value")).alias("_nan"),
    )
    ranked = exact_quantiles(rows, ["key"], "value", quantiles, partitions=partitions)
    both = join_null_safe(base, ranked, ["key"])
    stats = ["mean", "std", "min", *quantiles, "max"]
    nan = F.lit(float("nan"))
    return both.select("key", "n", *[F.when(F.col("_nan"), nan).otherwise(F.col(s)).alias(s) for s in stats])


def log_summary(df: DataFrame, finite_only: bool = True, partitions: int | None = None) -> DataFrame:
    """Statistics per numeric key of a log, beside the count of all its rows."""
    stats = key_stats(
        long_form(df), LOG_QUANTILES if finite_only else SHORT_QUANTILES, finite_only, partitions=partitions
    )
    return stats.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("rows"))))  # a single row


def describe(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max per column."""
    return key_stats(
        long_form(df, columns),
        {"q25": 0.25, "q50": 0.50, "q75": 0.75},
        sample_std=True,
        partitions=partitions,
    )


def mean_min_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, min and max per column over finite values, in long form."""
    return (
        long_form(df, columns)
        .filter(finite(F.col("value")))
        .groupBy("key")
        .agg(F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    )


def uniqueness(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column and the row count, in one row."""
    fn = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(F.count(F.lit(1)).alias("rows"), *[fn(c).alias(f"{c}_unique") for c in columns])


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct count and most frequent value per column; the smallest value wins a tie."""
    counted = long_form(df, columns).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("key").agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode_value"),
        F.max("n").alias("mode_rows"),
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, type and non-null count; one pass over the table."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(n).alias("column"), F.lit(t).alias("type"),
            F.col(f"`{n}`").alias("non_null"),
        )
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def cue_lists(df: DataFrame, url: str, start: str, partitions: int | None = None) -> DataFrame:
    """One row per timestamp: url, its position in the url's ascending list, and its text."""
    ranked = rank_within(df.select(url, start), [url], [start], "position", partitions)
    return ranked.select(url, "position", cue_text(F.col(start)).alias("cue"))


def storage_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        (F.sum("size_mb") / F.lit(1024.0)).alias("total_gb"), F.max("size_mb").alias("largest_mb")
    )


def validation_losses(df: DataFrame, keys: list[str], loss: str) -> DataFrame:
    """Mean, population std and count of losses per step; no loss gives NaN."""
    nan = F.lit(float("nan"))
    return df.groupBy(*keys).agg(
        F.coalesce(F.avg(loss), nan).alias("val_loss"),
        F.coalesce(F.stddev_pop(loss), nan).alias("val_loss_std"),
        F.count(loss).alias("val_batches"),
    )


def dataset_digest(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a table's content.

    It hashes rows, not file bytes, since a folder of part files has no single checksum.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in sorted(df.columns)])
    row = F.sha2(text, 256)

    def part(at: int) -> Column:
        piece = F.conv(F.substring(row, at, 15), 16, 10).cast("decimal(20,0)")
        return F.sum(piece).cast("string")

    return df.agg(F.count(F.lit(1)).alias("record_count"), part(1).alias("_a"), part(16).alias("_b")).select(
        "record_count",
        F.sha2(
            F.concat_ws(
                ":", F.col("record_count").cast("string"),
                F.coalesce("_a", F.lit("0")), F.coalesce("_b", F.lit("0")),
            ),
            256,
        ).alias("dataset_sha256"),
    )


def outcome_counts(df: DataFrame, ok: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(ok)).alias("rows_written"), F.count_if(~F.col(ok)).alias("failures")
    )
