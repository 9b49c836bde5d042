"""Parquet and CSV tables, run histories and upstream tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.functions import paths, text, urls
from clipwarden.functions.numbers import number_of
from clipwarden.operators.grade import latest_by_name
from clipwarden.operators.merge import stack_datasets
from clipwarden.sources.manifests import path_exists
from clipwarden.spec import CLIP_COLUMNS, CLIP_SCHEMA, NUMERIC_COLUMNS, QUALITY_SCHEMA


def read_clips(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """Clip records, only the record columns; `typed=False` takes the types found in the files."""
    reader = spark.read.schema(CLIP_SCHEMA) if typed else spark.read
    return reader.parquet(path).select(*CLIP_COLUMNS)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _quality_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUALITY_SCHEMA).csv(path, header=True).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_row"),
    )


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """Quality report keyed by base name; the last row of a name wins, a missing file is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], QUALITY_SCHEMA).withColumn("name", F.lit(""))
    rows = _quality_rows(spark, path)
    keyed = latest_by_name(rows, paths.basename(F.col("path")), ["_file", "_at", "_row"])
    return keyed.drop("_file", "_at", "_row")


def read_quality_batches(spark: SparkSession, batch_paths: list[str]) -> DataFrame:
    """Quality reports of several batches keyed by stem; later batches and rows win."""
    frames = [_quality_rows(spark, p) if path_exists(spark, p) else None for p in batch_paths]
    if all(f is None for f in frames):
        return spark.createDataFrame([], QUALITY_SCHEMA).withColumn("name", F.lit(""))
    rows = stack_datasets(frames, "_batch")
    keyed = latest_by_name(rows, paths.stem(F.col("path")), ["_batch", "_file", "_at", "_row"])
    return keyed.drop("_batch", "_file", "_at", "_row")


def coerce_numeric(df: DataFrame, strict: bool = False) -> DataFrame:
    """Turn text in columns that must be numeric into numbers; unparsable text becomes null.

    With `strict` a fraction in a whole-number column fails the query.
    """
    fixed = {}
    for name, kind in NUMERIC_COLUMNS.items():
        if name not in df.columns or dict(df.dtypes)[name] != "string":
            continue
        number = number_of(F.col(name))
        if kind == "bigint":
            whole = F.when(number == F.floor(number), number.cast("bigint"))
            if strict:
                bad = number.isNotNull() & whole.isNull()
                whole = F.when(
                    bad, F.raise_error(F.concat(F.lit(f"{name} is not whole: "), F.col(name))).cast("bigint")
                ).otherwise(whole)
            number = whole
        fixed[name] = number
    return df.withColumns(fixed) if fixed else df


def strip_to_clip_schema(df: DataFrame) -> DataFrame:
    """Drop columns that are no clip record columns; the rest stays in its order."""
    return df.select(*[c for c in df.columns if c in CLIP_COLUMNS])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Ids of earlier runs; unreadable or missing documents count as empty."""
    schema = "downloaded_ids array<bigint>, last_updated string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id bigint")
    docs = spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE")
    return docs.select(F.explode("downloaded_ids").alias("id")).filter("id is not null").distinct()


def prepare_upstream(
    df: DataFrame, index: str, video: str = "video", prompt: str = "prompt", id_column: str = "id",
    max_items: int | None = None, videos_dir: str = "videos",
) -> tuple[DataFrame, DataFrame]:
    """(manifest rows, failures) of an upstream table with configurable columns.

    `index` is the 0-based position; rows beyond `max_items` are left out when it is set. A video
    given as a struct counts by its path, else by its bytes; bytes are stored as mp4.
    """
    rows = df if max_items is None else df.filter(F.col(index) < max_items)
    sample_id = paths.clean_id(F.col(id_column), paths.sample_fallback(F.col(index)))
    kind = dict(df.dtypes)[video]
    if kind.startswith("struct"):
        link = F.nullif(F.col(f"{video}.path"), F.lit(""))
        usable = link.isNotNull() | F.col(f"{video}.bytes").isNotNull()
        ext = F.when(link.isNotNull(), urls.extension_of(link)).otherwise(".mp4")
    elif kind == "binary":
        usable, ext = F.col(video).isNotNull(), F.lit(".mp4")
    else:
        usable = F.col(video).isNotNull()
        ext = urls.extension_of(F.col(video))
    error = (
        F.when(F.col(prompt).isNull(), f"missing {prompt}").when(~usable, f"missing {video}")
    )
    marked = rows.withColumns({"_error": error, "_id": sample_id})
    good = marked.filter("_error is null").select(
        F.col("_id").alias("id"),
        paths.forward_slashes(F.concat(F.lit(videos_dir.rstrip("/") + "/"), F.col("_id"), ext)).alias("video"),
        text.prompt_or_default(F.col(prompt), F.col("_id")).alias("prompt"),
    )
    bad = marked.filter("_error is not null").select(F.col(index).alias("index"), F.col("_error").alias("error"))
    return good, bad
