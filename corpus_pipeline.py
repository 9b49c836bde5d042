"""A training corpus from `documents`: toxic texts and duplicates go, repeated passages are cut, the rest is packed.

Each row is a document of its own to the stages that drop or cut documents, also where ids are null or stand more
than once: such tables are numbered first, by id (nulls last) and text, and the number decides instead of the id.
Further columns pass through unchanged; n_chars follows the text where it was cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.llm import debruijn, exact, minhash, packing, toxicity
from clipwarden.llm.queries import tokenizer_path
from clipwarden.operators.ordered import global_index
from clipwarden.session import cut_lineage, scratch_path

#: Score from which a document is rejected as toxic.
TOXIC_AT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic score; labels of held-out rows are not learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, labels, carry=True)
    return scored.filter(F.col("score") < TOXIC_AT).select("row.*")


#: The column that names a row.
ROW = "_pipeline_row"


def named_rows(docs: DataFrame) -> DataFrame:
    """`docs` with a number of its own for each row, in the order of ids; the id itself where ids are whole and unique."""
    clashing = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if clashing.isEmpty():
        return docs.withColumn(ROW, F.col("doc_id").cast("bigint"))
    numbered = global_index(docs.withColumn("_no_id", F.col("doc_id").isNull()), ["_no_id", "doc_id", "text"], ROW)
    # equal rows have no order of their own: the numbers must not change when a task runs again
    return cut_lineage(numbered.drop("_no_id"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    rows = named_rows(docs)
    gone = exact.exact_duplicates(rows, ROW).filter(~F.col("kept")).select(F.col("doc_id").alias(ROW))
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    rows = named_rows(docs)
    gone = minhash.near_duplicates(rows, ROW).filter(~F.col("kept")).select(F.col("doc_id").alias(ROW))
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that stand in a document with a smaller id."""
    rows = named_rows(docs)
    cut = debruijn.stripped(rows, ROW).select(*[F.col(c).alias(f"_cut_{c}") for c in ("key", "mark", "kept_text")])
    text = F.coalesce("_cut_kept_text", "text")
    same = (F.col(ROW) == F.col("_cut_key")) & (F.xxhash64("text") == F.col("_cut_mark"))
    joined = rows.join(cut, same, "left")
    size = F.when(F.col("_cut_key").isNotNull(), F.length("_cut_kept_text")).otherwise(F.col("n_chars"))
    return joined.withColumns({"text": text, "n_chars": size.cast("bigint")}).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: The toxicity model, components and token ids are beyond SQL: tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
