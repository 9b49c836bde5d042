"""Shared helpers: input columns, scratch tables, worker-wide state."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, renamed so that further columns of `df` cannot clash."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def stored(df: DataFrame, name: str, *partition_by: str, codec: str = "zstd") -> DataFrame:
    """Write `df` to a table in the shared folder and read it back; a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state() -> dict[str, Any]:
    """A dict that lives as long as the Python worker.

    Kernels travel to the workers by value, so their own globals are fresh in every task.
    """
    name = "_clipwarden_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def text_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, str]]:
    """(doc_id, text) with null texts as empty ones."""
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield key, text or ""
