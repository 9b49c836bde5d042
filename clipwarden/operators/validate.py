"""Checks of a finished dataset and their verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.paths import resolve_path
from clipwarden.spec import CLIP_COLUMNS, SPEC_DURATION_SEC, TargetSpec


def schema_check(df: DataFrame, required: list[str] = CLIP_COLUMNS) -> DataFrame:
    """One row per required or further column: whether it is there, of all rows how many have a value."""
    kinds = [(c, "present" if c in df.columns else "missing") for c in required]
    kinds += [(c, "extra") for c in df.columns if c not in required]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f"`{c}`").alias(f"_n{i}") for i, (c, kind) in enumerate(kinds) if kind != "missing"],
    )
    found = [
        F.struct(
            F.lit(kind).alias("kind"), F.lit(c).alias("column"),
            (F.lit(0).cast("bigint") if kind == "missing" else F.col(f"_n{i}")).alias("non_null"), "rows",
        )
        for i, (c, kind) in enumerate(kinds)
    ]
    return counted.select(F.inline(F.array(*found)))


def spec_violations(df: DataFrame, spec: TargetSpec = TargetSpec()) -> DataFrame:
    """Violations (a row may have several) and rows with at least one."""
    rules = [
        F.col("width") != spec.width,
        F.col("height") != spec.height,
        F.abs(F.col("fps") - spec.fps) > 0.5,
        F.col("num_frames") != spec.frames,
        F.abs(F.col("duration_sec") - SPEC_DURATION_SEC) > 0.5,
    ]
    per_row = reduce(lambda a, b: a + b, [F.when(r, 1).otherwise(0) for r in rules])
    return df.agg(
        F.coalesce(F.sum(per_row), F.lit(0)).alias("violations"),
        F.count_if(per_row > 0).alias("rows_violating"),
        F.count(F.lit(1)).alias("rows"),
    )


def id_set_difference(a: DataFrame, b: DataFrame, col_a: str, col_b: str) -> DataFrame:
    """Ids found on one side only; one shuffle of pre-aggregated ids."""
    both = a.select(F.col(col_a).alias("id"), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(F.col(col_b).alias("id"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return (
        both.groupBy("id")
        .agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
        .filter("_a <> _b")
        .select("id", F.when(F.col("_a") == 1, "a_only").otherwise("b_only").alias("side"))
    )


def sets_equal(a: DataFrame, b: DataFrame, col_a: str, col_b: str) -> DataFrame:
    diff = id_set_difference(a, b, col_a, col_b)
    return diff.agg(
        (F.count(F.lit(1)) == 0).alias("equal"),
        F.count_if(F.col("side") == "a_only").alias("a_only"),
        F.count_if(F.col("side") == "b_only").alias("b_only"),
    )


def file_count_check(df: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Row count against file count."""
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    found = files.agg(F.count(F.lit(1)).alias("files"))
    return rows.crossJoin(F.broadcast(found)).select(  # one row on either side
        F.lit(name).alias("kind"), "rows", "files", (F.col("rows") == F.col("files")).alias("ok")
    )


def hash_check(
    df: DataFrame, files: DataFrame, uri: str, expected: str, missing: str = "skip", base: str = "/"
) -> DataFrame:
    """Compare recorded hashes with content hashes (`files`: path, sha256) of the file at `base`/`uri`.

    A row without a file passes with `missing="skip"` and fails with `missing="fail"`.
    """
    there = files.groupBy(resolve_path(F.col("path"), base).alias("_path")).agg(F.max("sha256").alias("_actual"))
    joined = df.withColumn("_path", resolve_path(F.col(uri), base)).join(there, "_path", "left")
    gone = F.col("_actual").isNull()
    state = (
        F.when(gone, F.lit("missing"))
        .when(F.col("_actual") == F.col(expected), "match")
        .otherwise("mismatch")
    )
    ok = F.when(gone, F.lit(missing == "skip")).otherwise(F.col("_actual") == F.col(expected))
    return joined.withColumns({"hash_state": state, "hash_ok": ok}).drop("_path", "_actual")


def hash_totals(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count_if(F.col("hash_state") == "mismatch").alias("mismatches"),
        F.count_if(F.col("hash_state") == "missing").alias("missing"),
        F.count_if(~F.col("hash_ok")).alias("failures"),
    )


def check_row(df: DataFrame, name: str, ok: str, detail: str) -> DataFrame:
    """A one-row check `(check, ok, detail)` from SQL expressions over `df`."""
    return df.selectExpr(f"'{name}' as check", f"({ok}) as ok", f"cast(({detail}) as string) as detail")


def verdict(checks: list[DataFrame]) -> DataFrame:
    """All checks with the overall outcome."""
    together = reduce(DataFrame.unionByName, checks)
    overall = together.agg(F.every("ok").alias("ok"), F.count_if(~F.col("ok")).alias("_bad")).select(
        F.lit("verdict").alias("check"), "ok", F.col("_bad").cast("string").alias("detail")
    )
    return together.unionByName(overall)
