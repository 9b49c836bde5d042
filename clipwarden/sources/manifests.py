"""JSONL manifests: lenient, strict, failing and skipping readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipwarden.functions import paths, text
from clipwarden.operators.lint import SHORT_PROMPT_WORDS, issue, missing_manifest
from clipwarden.session import cut_lineage
from clipwarden.spec import ISSUE_STRUCT

_BARE = r"(?<=[:\[,])(\s*)(-?Infinity|NaN)(?=\s*[,}\]])"
MARK = "#bare-number:"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def quote_bare_numbers(raw: Column) -> Column:
    """`NaN` and `Infinity`, which JSON writers of some languages emit, as marked strings."""
    quoted = F.regexp_replace(raw, _BARE, f'$1"{MARK}$2"')
    return F.when(raw.contains("NaN") | raw.contains("Infinity"), quoted).otherwise(raw)


def numbered_lines(spark: SparkSession, path: str, continuous: bool = False) -> DataFrame:
    """(file, line, raw) with true 1-based line numbers, however large the files are.

    With `continuous` the count goes on from one file of a folder to the next, by file name.

    Files are read in splits. Lines are counted per split first; a split's lines then go on from
    the count of the splits before it.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"),
    )
    # windows over splits only: one row per split, whatever their size
    files = Window.orderBy("file", "_at") if continuous else Window.partitionBy("file").orderBy("_at")
    before = files.rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        raw.groupBy("file", "_at")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .select("file", "_at", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    return raw.join(splits, ["file", "_at"]).select(
        "file", (F.col("_base") + F.col("_id") - F.col("_first") + 1).alias("line"), "raw"
    )


def classify_lines(lines: DataFrame) -> DataFrame:
    """Add `kind` (`row`, `bad_json`, `not_object`) and the parsed fields; blank lines are dropped."""
    parsed = lines.withColumn("_body", text.strip(F.col("raw"))).filter("_body <> ''")
    valid = F.try_parse_json(quote_bare_numbers(F.col("_body"))).isNotNull()
    kind = F.when(~valid, "bad_json").when(F.col("_body").startswith("{"), "row").otherwise("not_object")
    return parsed.withColumn("kind", kind)


def parsed_rows(classified: DataFrame, keys: tuple[str, ...] = ("id", "video", "prompt")) -> DataFrame:
    """Usable rows: line, `has_<key>` and the value per key, and all fields as a map."""
    cols = []
    for k in keys:
        cols += [F.map_contains_key("fields", F.lit(k)).alias(f"has_{k}"), F.col("fields")[k].alias(k)]
    parsed = classified.filter("kind = 'row'").select("line", _fields().alias("fields"))
    return parsed.select("line", *cols, "fields")


def scan_manifest(lines: DataFrame, keys: tuple[str, ...] = ("id", "video")) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of manifest lines, parsed once.

    What is kept of a line is narrow: its keys, the number of words of its prompt, the prompt if it is short, and
    the text of a broken line. It is stored, since the linter looks at it several times.
    """
    parsed = classify_lines(lines).select(
        "line", "kind", F.when(F.col("kind") == "bad_json", F.col("_body")).alias("_body"),
        F.when(F.col("kind") == "row", _fields()).alias("fields"),
    )
    cols = []
    for k in keys:
        cols += [F.map_contains_key("fields", F.lit(k)).alias(f"has_{k}"), F.col("fields")[k].alias(k)]
    words = text.word_count(F.col("prompt"))
    counted = parsed.select("line", "kind", "_body", *cols, F.col("fields")["prompt"].alias("prompt")).withColumn("words", words)
    kept = cut_lineage(counted.withColumn("prompt", F.when(F.col("words") < SHORT_PROMPT_WORDS, F.col("prompt"))))
    return kept.filter("kind = 'row'").drop("kind", "_body"), read_issues(kept)


def _fields() -> Column:
    return F.from_json("_body", "map<string,string>")


def read_issues(classified: DataFrame) -> DataFrame:
    line = F.col("line")
    found = F.when(
        F.col("kind") == "bad_json", issue("MANIFEST_BAD_JSON", line, value=F.col("_body"))
    ).when(F.col("kind") == "not_object", issue("MANIFEST_ROW_NOT_OBJECT", line))
    return classified.filter("kind <> 'row'").select(found.cast(ISSUE_STRUCT).alias("_i")).select("_i.*")


def read_lenient(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame]:
    """(rows, issues); a missing file gives no rows and one issue."""
    if not path_exists(spark, path):
        return None, missing_manifest(spark, path)
    classified = classify_lines(numbered_lines(spark, path, continuous=True))
    return parsed_rows(classified), read_issues(classified)


def read_strict(
    spark: SparkSession, path: str, required: tuple[str, ...] = ("video", "prompt"), check_rows: bool = True
) -> DataFrame:
    """Rows that all have the required keys; any broken line fails the query.

    A row without an `id` key gets the stem of its first required field.
    """
    classified = classify_lines(numbered_lines(spark, path, continuous=True)).withColumn("_f", _fields())
    if check_rows and classified.isEmpty():
        raise ValueError(f"no rows found in {path}")
    lacks = F.lit(False)
    for k in required:
        lacks = lacks | ~F.coalesce(F.map_contains_key("_f", F.lit(k)), F.lit(False))
    where = F.concat(F.lit(f"{path}:"), F.col("line").cast("string"))
    broken = F.when(F.col("kind") == "bad_json", F.raise_error(F.concat(where, F.lit(" is not valid JSON")))).when(
        (F.col("kind") == "not_object") | lacks,
        F.raise_error(F.concat(where, F.lit(f" must contain {list(required)}"))),
    )
    own_id = F.when(F.map_contains_key("_f", F.lit("id")), F.col("_f")["id"]).otherwise(
        paths.stem(F.col("_f")[required[0]])
    )
    checked = classified.withColumn("_ok", F.coalesce(broken.cast("string"), F.lit("ok")))
    return checked.filter("_ok = 'ok'").select(
        "line", own_id.alias("id"), *[F.col("_f")[k].alias(k) for k in required]
    )


def read_rows(spark: SparkSession, path: str, schema: str, on_bad: str = "fail", on_missing: str = "fail") -> DataFrame:
    """Plain typed read; bad lines `fail` the query or are `skip`ped, a missing file may be `empty`."""
    if on_missing == "empty" and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    mode = {"fail": "FAILFAST", "skip": "DROPMALFORMED"}[on_bad]
    return spark.read.schema(schema).option("allowNonNumericNumbers", "true").json(path, mode=mode)
