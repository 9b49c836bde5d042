"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.llm import align, bpe, debruijn, exact, licenses, minhash, packing, quality, repair, syncmers, toxicity, urls, wavelet
from clipwarden.llm.common import documents
from clipwarden.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_wavelet_matrix")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write_shards(documents(spark, sf_dir), path, tokenizer_path())
    return wavelet.shard_documents(spark, path, ids_crc32=F.crc32("ids"))


@query("op2_closed_syncmers")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


@query("op3_de_bruijn_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.deduplicated(documents(spark, sf_dir)).drop("kept_text")


@query("op4_bbit_minhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), threshold=0.85)


@query("op5_power_of_two_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


@query("op6_url_logistic")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.seed_table(spark))
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), model, URL_RULES)


@query("op7_prefix_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_path()).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op8_string_kernel_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score(documents(spark, sf_dir), labels).select(
        "doc_id",
        F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query(
    "op10_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op11_positive_unlabelled")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.score(documents(spark, sf_dir), labels).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op12_span_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@query("op13_lightest_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair.repair(rows, gone_col="gone")
