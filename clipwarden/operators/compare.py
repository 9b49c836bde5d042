"""Comparison of two versions of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwarden.functions.numbers import comparable_text, field_equal
from clipwarden.spec import COMPARE_FIELDS


def compare_versions(
    original: DataFrame, processed: DataFrame, key: str = "clip_id", fields: list[str] = COMPARE_FIELDS
) -> DataFrame:
    """Full outer pairing by key with one `<field>_same` flag per field.

    Equal rows of a side are counted before the join, so a group of copies stays one row; `pairs`
    tells how many row pairs a result row stands for.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        return (
            df.groupBy(key, *fields)
            .agg(F.count(F.lit(1)).alias(f"_n_{tag}"))
            .select(key, *[F.col(f).alias(f"{f}_{tag}") for f in fields], f"_n_{tag}")
        )

    joined = side(original, "orig").join(side(processed, "target"), key, "full_outer")
    side_of = (
        F.when(F.col("_n_target").isNull(), "original_only")
        .when(F.col("_n_orig").isNull(), "processed_only")
        .otherwise("both")
    )
    return joined.select(
        key,
        side_of.alias("present"),
        (F.coalesce("_n_orig", F.lit(1)) * F.coalesce("_n_target", F.lit(1))).alias("pairs"),
        *[f"{f}_{t}" for f in fields for t in ("orig", "target")],
        *[field_equal(F.col(f"{f}_orig"), F.col(f"{f}_target")).alias(f"{f}_same") for f in fields],
    )


def field_agreement(compared: DataFrame, fields: list[str] = COMPARE_FIELDS) -> DataFrame:
    """Same and different counts per field."""
    same = [F.sum(F.when(F.col(f"{f}_same"), F.col("pairs")).otherwise(0)).alias(f) for f in fields]
    totals = compared.agg(F.sum("pairs").alias("_all"), *same)
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("same")) for f in fields])
    return totals.select(F.explode(rows).alias("_r"), "_all").select(
        "_r.field",
        F.coalesce("_r.same", F.lit(0)).alias("same"),
        (F.coalesce("_all", F.lit(0)) - F.coalesce("_r.same", F.lit(0))).alias("different"),
    )


def versions_agreement(
    original: DataFrame, processed: DataFrame, key: str = "clip_id", fields: list[str] = COMPARE_FIELDS
) -> DataFrame:
    """What `field_agreement` tells of `compare_versions`, without pairing the versions of a key.

    Rows are counted per key, field and value; a value that n rows of one side and m of the other have stands for
    n * m equal pairs. So a key of very many versions costs as much as its rows. Rows whose key is null or stands
    on one side only have no partner, and agree where they have no value.
    """
    none = F.lit(0).cast("bigint")

    def side(df: DataFrame, here: str) -> DataFrame:
        values = F.array(*[F.struct(F.lit(f).alias("field"), comparable_text(F.col(f)).alias("value")) for f in fields])
        one = F.lit(1).cast("bigint")
        counts = {n: one if n == here else none for n in ("n_o", "n_t")}
        return df.select(F.col(key).alias("key"), F.inline(values), *[v.alias(n) for n, v in counts.items()])

    by_value = (
        side(original, "n_o").unionByName(side(processed, "n_t"))
        .groupBy("key", "field", "value").agg(F.sum("n_o").alias("n_o"), F.sum("n_t").alias("n_t"))
    )
    gone = F.col("value") == "missing"
    by_key = by_value.groupBy("key", "field").agg(
        F.sum("n_o").alias("n_o"), F.sum("n_t").alias("n_t"), F.sum(F.col("n_o") * F.col("n_t")).alias("equal"),
        F.sum(F.when(gone, F.col("n_o") + F.col("n_t")).otherwise(0)).alias("empty"),
    )
    alone = F.col("key").isNull() | (F.col("n_o") == 0) | (F.col("n_t") == 0)
    pairs = F.when(alone, F.col("n_o") + F.col("n_t")).otherwise(F.col("n_o") * F.col("n_t"))
    same = F.when(alone, F.col("empty")).otherwise(F.col("equal"))
    return by_key.groupBy("field").agg(F.sum(same).alias("same"), F.sum(pairs - same).alias("different"))


def size_totals(compared: DataFrame, size_orig: str, size_target: str) -> DataFrame:
    """Total sizes of both versions and their ratio in percent."""
    o, t = F.sum(size_orig), F.sum(size_target)
    return compared.agg(
        o.alias("total_orig"), t.alias("total_target"),
        F.when(o != 0, t / o * F.lit(100.0)).alias("size_percent"),
    )


def comparison_report(compared: DataFrame, key: str = "clip_id", fields: list[str] = COMPARE_FIELDS) -> DataFrame:
    """The report's columns: ids, sizes where known and the flags."""
    sizes = [c for c in ("size_orig", "size_target", "size_ratio") if c in compared.columns]
    return compared.select(key, *sizes, *[f"{f}_same" for f in fields])
