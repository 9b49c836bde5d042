"""The first or last row per key, in two steps and without gathering a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipwarden.operators.ordered import join_null_safe

# types of a buffer that a hash aggregate can update in place
_FIXED = ("bigint", "int", "smallint", "tinyint", "double", "float", "date", "timestamp", "timestamp_ntz", "boolean")


def edge_rows(df: DataFrame, keys: list[str], order: list[str], last: bool = True, narrow_first: bool = True) -> DataFrame:
    """One whole row per key: the last one in `order`, or the first one. Null keys are one key.

    The extreme of the leading order column is a hash aggregate of (keys, column) alone, so no payload is
    sorted or shuffled for it; a semi join keeps the rows that reach it. Ties among these go by the other
    order columns: every map task passes on one row per key at most, so a hot key stays spread. A leading
    column of variable width, such as text, skips the first step, and so does `narrow_first=False`, which
    suits keys that mostly have one row, where the aggregate would not shrink anything. Nulls sort below all values; of rows
    that tie in all of `order` any one stays.
    """
    lead = order[0]
    kind = dict(df.dtypes)[lead]
    if narrow_first and (kind in _FIXED or kind.startswith("decimal")):
        absent = F.max(F.col(lead).isNull())
        # a null is the first value, and the last one only where there is no other
        top = F.max(lead) if last else F.when(~absent, F.min(lead))
        tops = df.groupBy(*keys).agg(top.alias("_top")).withColumnRenamed("_top", lead)
        df = join_null_safe(df, tops, [*keys, lead], "left_semi")
    way = [F.desc(c) if last else F.asc(c) for c in order]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*way)))
    return ranked.filter("_rn = 1").drop("_rn")
