"""Top-k, sampling, splits and orderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import fixed_text
from clipwarden.operators.ordered import global_index


def seeded_hash(seed: int, *key: str) -> Column:
    """Reproducible hash text of a key; orders rows at random and the same way everywhere."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def seeded_unit(seed: int, *key: str) -> Column:
    """Reproducible number in [0, 1) of a key."""
    return F.conv(F.substring(seeded_hash(seed, *key), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def eligible_files(files: Column, min_height: int, min_fps: float) -> Column:
    """Files tall enough, with a link, and with an fps that is unknown or high enough."""
    zero = F.lit(0)

    def fits(f: Column) -> Column:
        fps = F.coalesce(f["fps"], F.lit(0.0))
        return (
            (F.coalesce(f["height"], zero) >= min_height)
            & ~((fps > 0) & (fps < min_fps))
            & (F.coalesce(f["link"], F.lit("")) != "")
        )

    return F.filter(files, fits)


def best_file(files: Column, min_height: int, min_fps: float) -> Column:
    """The eligible file with the largest (height, width, fps); the first one wins a tie."""
    ranked = F.transform(
        eligible_files(files, min_height, min_fps),
        lambda f, i: F.struct(
            F.coalesce(f["height"], F.lit(0)).alias("h"),
            F.coalesce(f["width"], F.lit(0)).alias("w"),
            F.coalesce(f["fps"], F.lit(0.0)).alias("r"),
            (-i).alias("i"),
            f.alias("file"),
        ),
    )
    return F.array_max(ranked)["file"]


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first `n` rows in `order`."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: list[str], n: int = 5, seed: int = 42) -> DataFrame:
    """Reproducible sample of `n` rows; small `n` only keeps a bounded heap per task."""
    return df.orderBy(seeded_hash(seed, *key), *key).limit(n)


def validation_count(n: int, fraction: float) -> int:
    """Rows in the validation side: rounded half to even, at least one if any, never all."""
    low = 1 if n > 1 and fraction > 0 else 0
    high = n - 1 if n > 1 else 0
    return min(max(int(round(n * fraction)), low), high)


def split_rows(
    df: DataFrame, key: list[str], fraction: float, seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """Add `split` (`train` or `val`) by seeded hash order; needs the row count first."""
    count = validation_count(df.count(), fraction)
    hashed = df.withColumn("_h", seeded_hash(seed, *key))
    placed = global_index(hashed, ["_h", *key], "_i", partitions)
    return placed.withColumn("split", F.when(F.col("_i") < count, "val").otherwise("train")).drop(
        "_h", "_i"
    )


def ranked_sources(table: DataFrame, source: str = "source", partitions: int | None = None) -> DataFrame:
    """Sources by falling fail, then review count, with a 1-based rank."""
    keyed = table.withColumns({"_f": -F.col("fail"), "_r": -F.col("review")})
    placed = global_index(keyed, ["_f", "_r", source], "rank", partitions)
    return placed.withColumn("rank", F.col("rank") + 1).drop("_f", "_r")


def clip_sampling_plan(
    df: DataFrame, video_id: str, duration: str, per_video: int, clip_seconds: float, seed: int = 42
) -> DataFrame:
    """Random clip starts per source, reproducible by hash; equal ids collapse into one.

    Sources with less than 0.01 s of room are skipped.
    """
    room = F.greatest(F.lit(0.0), F.col(duration) - F.lit(clip_seconds))
    start = F.round(seeded_unit(seed, video_id, "k") * F.col("_room"), 2)
    return (
        df.select(F.col(video_id), room.alias("_room"))
        .filter(F.col("_room") >= 0.01)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(per_video))))
        .withColumn("clip_start_sec", start)
        .withColumn(
            "clip_id",
            F.concat(F.lit("clip_"), F.col(video_id).cast("string"), F.lit("_node"), fixed_text(F.col("clip_start_sec"), 2)),
        )
        .select(video_id, "clip_id", "clip_start_sec")
        .dropDuplicates(["clip_id"])
    )
