"""Merging of datasets with unique ids, set union of histories, renumbering."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions import paths
from clipwarden.operators.ordered import carry_fold, global_index, running_sums
from clipwarden.session import cut_lineage

# an id that a repeat of a shorter id could be given: `<parent>_<k>`, k without leading zeros
_CHILD = r"^(.*)_([1-9][0-9]{0,17})$"
_TAIL = r"((?:_[1-9][0-9]{0,17})*)$"


def stack_datasets(frames: list[DataFrame | None], ordinal: str = "dataset_no") -> DataFrame:
    """Union of datasets in the given order; missing ones (`None`) are skipped."""
    tagged = [f.withColumn(ordinal, F.lit(i)) for i, f in enumerate(frames) if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def unique_ids(
    df: DataFrame, column: str, order: list[str], name: str = "new_id", partitions: int | None = None
) -> DataFrame:
    """Give repeated ids the suffix `_1`, `_2`, ... in row order, skipping ids already taken.

    The outcome equals going through the rows one by one, but nothing is gathered per id. Only rows
    of repeated ids are ranked. Rows whose own id looks like a suffixed one are settled level by
    level: the n-th repeat takes the n-th suffix that no earlier row holds, and a row whose id was
    taken before it came becomes a repeat itself. `order` has to be unique.
    """
    repeated = cut_lineage(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    suffixed = F.nullif(F.regexp_extract(column, _CHILD, 1), F.lit(""))
    contested = df.select(suffixed.alias(column)).filter(F.col(column).isNotNull())
    if contested.join(repeated, column, "left_semi").isEmpty():
        return _suffix_simple(df, repeated, column, order, name, partitions)

    # a plain minimum is a hash aggregate, that of a struct sorts the rows by id; a null comes first
    least = F.when(~F.max(F.col(order[0]).isNull()), F.min(order[0]))
    first = F.struct(least.alias(order[0])) if len(order) == 1 else F.min(F.struct(*order))
    ids = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    ids = ids.withColumns(
        {
            "_parent": suffixed,
            "_k": F.regexp_extract(column, _CHILD, 2).try_cast("bigint"),
            "_depth": _depth(F.col(column)),
        }
    )
    ids = cut_lineage(ids)  # it is looked at three times
    parents = ids.select(F.col(column).alias("_parent"))
    edges = cut_lineage(ids.filter("_k is not null").join(parents, "_parent").select(*ids.columns))
    ids = ids.filter("_n > 1").unionByName(edges.filter("_n = 1"))
    displaced = edges.select(F.col(column).alias("_fam")).limit(0)
    # bounded by the longest chain of suffixes in one id
    last = max(
        edges.agg(F.max("_depth")).first()[0] or 0,
        ids.filter("_n > 1").agg(F.max("_depth")).first()[0] or 0,
    )
    settled = []
    for depth in range(int(last) + 1):
        moved = displaced.withColumn("_moved", F.lit(1))
        fams = (
            ids.filter(F.col("_depth") == depth)
            .withColumn("_fam", F.col(column))
            .join(moved, "_fam", "left")
            .filter((F.col("_n") > 1) | F.col("_moved").isNotNull())
            .select("_fam", "_first", F.coalesce("_moved", F.lit(0)).alias("_moved"))
        )
        # a row is only looked at in the level of its own id
        rows = df.filter(_depth(F.col(column)) == depth).withColumn("_fam", F.col(column)).join(fams, "_fam")
        is_first = F.struct(*order) == F.col("_first")
        rows = rows.withColumn("_rep", F.when(is_first & (F.col("_moved") == 0), 0).otherwise(1))
        marks = (
            edges.filter(F.col("_depth") == depth + 1)
            .withColumn("_fam", F.col("_parent"))
            .join(fams.select("_fam"), "_fam")
            .select("_fam", F.col(column).alias("_child"), "_k", "_first.*", F.lit(0).alias("_rep"))
        )
        line = rows.drop("_first", "_moved").unionByName(marks, allowMissingColumns=True)
        counted = cut_lineage(
            running_sums(line, ["_fam"], order, {"_c": F.col("_rep").cast("bigint")}, partitions)
        )
        judged = carry_fold(
            counted.filter("_child is not null").select("_fam", "_child", "_k", "_c"),
            ["_fam"],
            ["_k"],
            ["_k", "_c"],
            _judge,
            {"_at": "bigint", "_taken": "boolean"},
            partitions=partitions,
            bulk=_judge_many,
        )
        judged = cut_lineage(judged)
        repeats = counted.filter("_child is null and _rep = 1")
        firsts = counted.filter("_child is null and _rep = 0")
        shifts = judged.filter("not _taken").select(
            "_fam", F.col("_at").alias("_c"), F.lit(1).cast("bigint").alias("_hit"), F.lit(0).alias("_kind")
        )
        merged = repeats.withColumns({"_hit": F.lit(0).cast("bigint"), "_kind": F.lit(1)}).unionByName(
            shifts, allowMissingColumns=True
        )
        named = running_sums(merged, ["_fam"], ["_c", "_kind", *order], {"_skip": F.col("_hit")}, partitions)
        settled.append(
            named.filter("_kind = 1").select(
                *df.columns,
                F.concat(F.col(column), F.lit("_"), (F.col("_c") + F.col("_skip")).cast("string")).alias(name),
            )
        )
        settled.append(firsts.select(*df.columns, F.col(column).alias(name)))
        displaced = judged.filter("_taken").select(F.col("_child").alias("_fam"))
        done = fams.select(F.col("_fam").alias(column))
        settled_ids = done if depth == 0 else settled_ids.unionByName(done)
    rest = df.join(settled_ids, column, "left_anti").withColumn(name, F.col(column))
    return reduce(DataFrame.unionByName, settled, rest.select(*df.columns, name))


def _depth(column: Column) -> Column:
    """Number of suffixes at the end of an id."""
    return F.length(F.regexp_replace(F.regexp_extract(column, _TAIL, 1), "[^_]", ""))


def _judge_many(rows: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray):
    """`_judge` of many ids at a time, each from its start: their first suffixes, then their second ones, and so on."""
    k, before = rows["_k"].to_numpy("int64"), rows["_c"].to_numpy("int64")
    at, taken = np.empty(len(k), "int64"), np.empty(len(k), bool)
    held = np.zeros(len(starts), "int64")
    live = np.arange(len(starts))
    for nth in range(int(sizes.max(initial=0))):
        live = live[sizes[live] > nth]
        here = starts[live] + nth
        at[here] = k[here] - held[live]
        taken[here] = before[here] >= at[here]
        held[live] += ~taken[here]
    return {"_at": at, "_taken": taken}


def _judge(state, rows: pd.DataFrame):
    """Decide per suffixed id, by rising suffix, whether a repeat took it before its row came."""
    held = state or 0
    at, taken = [], []
    for k, before in zip(rows["_k"].tolist(), rows["_c"].tolist()):
        nth = k - held
        took = before >= nth
        at.append(nth)
        taken.append(took)
        held += 0 if took else 1
    return held, {"_at": at, "_taken": taken}


def _suffix_simple(df, repeated, column, order, name, partitions):
    repeated = repeated.select(column)
    once = df.join(repeated, column, "left_anti").withColumn(name, F.col(column))
    many = running_sums(
        df.join(repeated, column, "left_semi"), [column], order, {"_c": F.lit(1).cast("bigint")}, partitions
    )
    again = F.concat(F.col(column), F.lit("_"), (F.col("_c") - 1).cast("string"))
    many = many.withColumn(name, F.when(F.col("_c") == 1, F.col(column)).otherwise(again))
    return once.select(*df.columns, name).unionByName(many.select(*df.columns, name))


def merge_datasets(
    frames: list[DataFrame | None], order: list[str], partitions: int | None = None
) -> DataFrame:
    """Union of clip datasets with unique ids and file paths that follow the new id."""
    # the paths are made anew from the id: they need not be sorted and stored with the rows
    stacked = stack_datasets([f if f is None else f.drop("clip_uri", "first_frame_uri") for f in frames])
    named = unique_ids(stacked, "clip_id", ["dataset_no", *order], "new_id", partitions)
    renamed = named.withColumns({"original_id": F.col("clip_id"), "clip_id": F.col("new_id")}).drop("new_id")
    return renamed.withColumns(
        {"clip_uri": paths.clip_uri(F.col("clip_id")), "first_frame_uri": paths.frame_uri(F.col("clip_id"))}
    )


def union_history(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def renumber(
    df: DataFrame,
    prefix: str,
    order: list[str],
    start: int = 1,
    width: int = 4,
    partitions: int | None = None,
) -> DataFrame:
    """Uniform new ids in the given order; keeps the old id as `old_id` and rewrites the paths."""
    placed = global_index(df, order, "_i", partitions)
    new_id = paths.padded_name(prefix, F.col("_i") + F.lit(start), width)
    return (
        placed.withColumns({"old_id": F.col("clip_id"), "clip_id": new_id})
        .withColumns(
            {"clip_uri": paths.clip_uri(F.col("clip_id")), "first_frame_uri": paths.frame_uri(F.col("clip_id"))}
        )
        .drop("_i")
    )
