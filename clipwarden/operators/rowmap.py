"""Row functions with retries."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ADDED = ["ok", "value", "error", "attempts"]


def map_rows_with_retry(
    df: DataFrame,
    fn: Callable[[dict[str, Any]], str | None],
    max_retries: int = 3,
    backoff_seconds: float = 0.0,
) -> DataFrame:
    """Apply a row function; failures come back as rows instead of failing the job.

    Adds `ok`, `value`, `error` and `attempts`. Retries wait `backoff_seconds * 2**attempt`.
    """
    def one(row: dict[str, Any]):
        error = None
        for attempt in range(1, max_retries + 1):
            try:
                return True, fn(row), None, attempt
            except Exception as exc:  # noqa: BLE001  any failure becomes a row
                error = f"{type(exc).__name__}: {exc}"
                if attempt < max_retries and backoff_seconds:
                    time.sleep(backoff_seconds * 2**attempt)
        return False, None, error, max_retries

    def run(batches):
        for batch in batches:
            done = list(zip(*(one(r) for r in batch.to_pylist()))) or [[], [], [], []]
            made = [pa.array(list(v), k) for v, k in zip(done, (pa.bool_(), pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *ADDED])

    fields = T._parse_datatype_string("ok boolean, value string, error string, attempts int").fields
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))
