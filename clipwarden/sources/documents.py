"""JSON documents: metric logs, summaries, search results and source metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.functions import text
from clipwarden.sources.manifests import MARK, numbered_lines, path_exists, quote_bare_numbers
from clipwarden.spec import SEARCH_SCHEMA, SOURCE_INFO_SCHEMA


def read_log_values(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, key, value) for every numeric or boolean value of a log with an open schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "file string, line bigint, key string, value double")
    lines = numbered_lines(spark, path).filter(text.strip(F.col("raw")) != "")
    return log_values(lines)


def log_values(lines: DataFrame) -> DataFrame:
    """Numeric values of JSON lines in long form; `NaN` and infinities are numbers, quoted ones not."""
    parsed = lines.withColumn("_v", F.parse_json(quote_bare_numbers(F.col("raw"))))
    exploded = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    kind = F.schema_of_variant("value")
    as_text = F.when(kind == "STRING", F.col("value").cast("string"))
    bare = F.when(as_text.startswith(MARK), F.replace(as_text, F.lit(MARK), F.lit("")).cast("double"))
    number = F.when(
        kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.col("value").try_cast("double")
    ).when(kind == "BOOLEAN", F.col("value").try_cast("boolean").cast("double"))
    rest = [c for c in lines.columns if c != "raw"]
    return exploded.select(*rest, "key", F.coalesce(bare, number).alias("value")).filter("value is not null")


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Summary documents as (count, metric, stat, value); a missing file gives count 0 and no metric."""
    empty = "count bigint, metrics map<string,map<string,double>>"
    if not path_exists(spark, path):
        docs = spark.range(1).select(F.lit(0).cast("bigint").alias("count"), F.lit(None).cast("map<string,map<string,double>>").alias("metrics"))
    else:
        docs = spark.read.schema(empty).option("allowNonNumericNumbers", "true").json(path, multiLine=True)
    metrics = docs.select("count", F.explode_outer("metrics").alias("metric", "_s"))
    return metrics.select("count", "metric", F.explode_outer("_s").alias("stat", "value"))


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per video of landed search pages: id, url, video_files."""
    pages = spark.read.schema(SEARCH_SCHEMA).json(path)
    return pages.select(F.explode("videos").alias("v")).select("v.id", "v.url", "v.video_files")


def read_source_dumps(spark: SparkSession, path: str, title_limit: int | None = None) -> DataFrame:
    """Source metadata from dump files: the last non-blank line of each file is the document.

    An unparsable document yields `error = json_parse_failed`. Titles are whole unless `title_limit` is given.
    """
    # the order of lines is enough, their numbers are not needed: each split passes on one line of a file
    lines = spark.read.text(path).select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"),
    )
    last = lines.filter(text.strip(F.col("raw")) != "").groupBy("file").agg(F.max_by("raw", "_at").alias("raw"))
    doc = F.from_json("raw", SOURCE_INFO_SCHEMA)
    bad = F.try_parse_json("raw").isNull()
    return last.withColumns({"_d": doc, "_bad": bad}).select(
        "file",
        "_d.url",
        text.at_most(F.coalesce("_d.title", F.lit("")), title_limit).alias("title"),
        "_d.description",
        F.coalesce("_d.duration", F.lit(0.0)).alias("duration"),
        "_d.width",
        "_d.height",
        F.when(F.col("_d.fps") != 0, F.col("_d.fps")).alias("fps"),
        F.when(F.col("_bad"), "json_parse_failed").otherwise(F.col("_d.error")).alias("error"),
    )
