"""Order-dependent operators that stay distributed when one key holds most rows.

A window partitioned by a hot key would put that key into one task. Here the rows are range
partitioned by (key, order) instead, so a hot key spans many evenly sized blocks. Each block is
worked on by itself and only one small summary per block crosses block borders.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwarden.session import cut_lineage

BLOCK, POS = "_block", "_pos"


def layout(
    df: DataFrame, order: Sequence[str], partitions: int | None = None, block_rows: int | None = None
) -> DataFrame:
    """Range partition and sort by `order`; adds block number and position inside the block.

    There are `partitions` blocks, or as many as blocks of about `block_rows` rows need; by default Spark
    decides from the data's size. The result is checkpointed: range borders come from a sample, so a second
    evaluation could otherwise place rows differently.
    """
    if block_rows and not partitions:
        partitions = max(1, -(-df.count() // block_rows))
    cols = [F.col(c) for c in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    fixed = cut_lineage(ranged.sortWithinPartitions(*cols))
    return fixed.withColumns(
        {
            BLOCK: F.spark_partition_id(),
            POS: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def global_index(
    df: DataFrame, order: Sequence[str], name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """0-based position of each row in the total order, without a single-task window."""
    laid = layout(df, order, partitions)
    sizes = laid.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    # one row per block: the window and the broadcast are bounded by the partition count
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(BLOCK, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        laid.join(F.broadcast(base), BLOCK)
        .withColumn(name, F.col("_base") + F.col(POS))
        .drop(BLOCK, POS, "_base")
    )


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"_r_{c}"])
    return cond


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on `keys` with nulls equal, so that a group without a key is not lost."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(renamed, _null_safe(left, renamed, keys), how).drop(*[f"_r_{k}" for k in keys])


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
    """First rows of the runs of one key in a batch, and the keys of the first and the last run."""
    n = batch.num_rows
    changed = np.zeros(n, bool)
    changed[:1] = True
    ends = []
    for k in keys:
        col = batch.column(batch.schema.get_field_index(k))
        ends.append((col[0].as_py(), col[n - 1].as_py()))
        if n > 1:
            gone = col.is_null()
            differs = pc.fill_null(pc.not_equal(col[1:], col[:-1]), False)
            either = pc.or_(differs, pc.xor(gone[1:], gone[:-1]))
            changed[1:] |= either.to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed), [tuple(e[i] for e in ends) for i in (0, 1)]


def _scan_blocks(
    laid: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> dict[int, tuple[tuple, tuple, list]]:
    """Per block: its first key, its last key, and the sums of `values` over the run of the last key."""

    def run(batches):
        block = first = last = None
        tail = [0] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, (low, high) = _runs(batch, keys)
            if block is None:
                block, first = batch.column(batch.schema.get_field_index(BLOCK))[0].as_py(), low
            at = int(starts[-1])
            if len(starts) > 1 or low != last:
                tail = [0] * len(values)
            last = high
            for i, v in enumerate(values):
                tail[i] += pc.sum(batch.column(batch.schema.get_field_index(v))[at:]).as_py() or 0
        if block is not None:
            body = pickle.dumps((first, last, tail))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "body": pa.array([body], pa.binary())})

    found = laid.select(*dict.fromkeys([*keys, *values, BLOCK])).mapInArrow(run, "block int, body binary").collect()
    return {r["block"]: pickle.loads(bytes(r["body"])) for r in found}


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums per key in `order`; one output column per entry of `sums`.

    Rows are shuffled once, into sorted blocks. Sums run inside each block in one Arrow pass; only the first key of a
    block can have begun before, so its base is what the blocks before it leave, one row per block.
    """
    keys, vals = list(keys), {f"_v_{name}": col for name, col in sums.items()}
    laid = layout(df.withColumns(vals), [*keys, *order], partitions)
    kinds = {name: dict(laid.dtypes)[f"_v_{name}"] for name in sums}
    bases: dict[int, list] = {}
    if laid.rdd.getNumPartitions() > 1:
        carried_key, carried = None, [0] * len(vals)
        # the driver sees one row per block
        for block, (first, last, tail) in sorted(_scan_blocks(laid, keys, list(vals)).items()):
            go_on = first == carried_key
            if go_on:
                bases[block] = carried
            carried = [a + b for a, b in zip(carried, tail)] if go_on and first == last else tail
            carried_key = last
    kept, names = df.columns, list(sums)

    def add(batches):
        last, tails, block = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, (low, high) = _runs(batch, keys)
            if block is None:
                block = batch.column(batch.schema.get_field_index(BLOCK))[0].as_py()
                before = bases.get(block)
            else:
                before = tails if low == last else None
            sizes = np.diff(starts, append=batch.num_rows)
            made, tails = [], []
            for i, name in enumerate(names):
                col = pc.fill_null(batch.column(batch.schema.get_field_index(f"_v_{name}")), 0)
                upto = np.cumsum(col.to_numpy(zero_copy_only=False))
                shift = np.concatenate((upto[:1] * 0, upto))[starts]
                if before is not None:
                    shift[0] -= before[i]
                upto = upto - np.repeat(shift, sizes)
                tails.append(upto[-1].item())
                made.append(pa.array(upto))
            last = high
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, *made], names=[*kept, *names])

    fields = [T.StructField(n, T._parse_datatype_string(k)) for n, k in kinds.items()]
    return laid.mapInArrow(add, T.StructType([*df.schema.fields, *fields]))


def neighbours(
    df: DataFrame, keys: Sequence[str], value: str, asked: str, there: str, partitions: int | None = None
) -> DataFrame:
    """The nearest places before and after each asked row: (keys, value, before, after).

    `df` has distinct (keys, value) rows with two flags: `asked` rows get the greatest smaller and the least greater value
    among the `there` rows of their key. As-of search in both directions over one sorted layout: within a block in
    one Arrow pass, and the last and next place of a key that spans blocks are carried over their borders.
    """
    keys = list(keys)
    slim = df.select(*keys, F.col(value).cast("double").alias(value), asked, there)
    laid = layout(slim, [*keys, value], partitions)

    def borders(batches):
        """(first key, last key, first place of the first key, last place of the last key)."""
        block = first = last = least = most = None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, (low, high) = _runs(batch, keys)
            if block is None:
                block, first = batch.column(batch.schema.get_field_index(BLOCK))[0].as_py(), low
            at = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False)
            real = batch.column(batch.schema.get_field_index(there)).to_numpy(zero_copy_only=False).astype(bool)
            if least is None and low == first:
                stop = starts[1] if len(starts) > 1 else len(at)
                head = at[:stop][real[:stop]]
                least = float(head[0]) if len(head) else None
            if len(starts) > 1 or low != last:
                most = None
            tail = at[starts[-1] :][real[starts[-1] :]]
            most = float(tail[-1]) if len(tail) else most
            last = high
        if block is not None:
            body = pickle.dumps((first, last, least, most))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "body": pa.array([body], pa.binary())})

    before: dict[int, float | None] = {}
    after: dict[int, float | None] = {}
    if laid.rdd.getNumPartitions() > 1:
        rows = laid.select(*keys, value, there, BLOCK).mapInArrow(borders, "block int, body binary").collect()
        seen = sorted((r["block"], pickle.loads(bytes(r["body"]))) for r in rows)
        key, place = None, None
        for block, (first, last, _, most) in seen:
            before[block] = place if first == key else None
            place = most if most is not None or first != last or first != key else place
            key = last
        key, place = None, None
        for block, (first, last, least, _) in reversed(seen):
            after[block] = place if last == key else None
            place = least if least is not None or first != last or last != key else place
            key = first

    def search(batches):
        key = block = place = None  # `place`: the last one of the current key
        waiting: list[tuple] = []  # asked rows of the current key whose next place is still to come

        def told(nxt: float | None) -> Iterator[pa.RecordBatch]:
            for cols, at, low in waiting:
                high = np.full(len(at), np.nan if nxt is None else nxt)
                yield answers(cols, at, low, high)
            waiting.clear()

        def answers(cols, at, low, high) -> pa.RecordBatch:
            found = [pa.array(x, from_pandas=True) for x in (low, high)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(at), *found], [*keys, value, "before", "after"])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts, (low_key, high_key) = _runs(batch, keys)
            at, want, real = (
                batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (value, asked, there)
            )
            want, real, rows = want.astype(bool), real.astype(bool), np.arange(n)
            sizes = np.diff(starts, append=n)
            begin, end = np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
            earlier = np.concatenate(([-1], np.maximum.accumulate(np.where(real, rows, -1))))[:-1]
            following = np.minimum.accumulate(np.where(real, rows, n)[::-1])[::-1]
            later = np.concatenate((following, [n]))[1:]
            if block is None:
                block = batch.column(batch.schema.get_field_index(BLOCK))[0].as_py()
                key, place = low_key, before.get(block)
            elif low_key != key:
                yield from told(None)
                place = None
            head = following[0] if following[0] < end[0] else None
            if head is not None:
                yield from told(float(at[head]))
            elif len(starts) > 1:
                yield from told(None)
            first = np.nan if place is None else place
            low = np.where(earlier >= begin, at[earlier], np.where(begin == 0, first, np.nan))
            high = np.where(later < end, at[np.minimum(later, n - 1)], np.nan)
            open_rows = (later >= end) & (end == n)
            for chosen, wait in ((want & ~open_rows, False), (want & open_rows, True)):
                if chosen.any():
                    cols = [batch.column(batch.schema.get_field_index(k)).filter(pa.array(chosen)) for k in keys]
                    if wait:
                        waiting.append((cols, at[chosen], low[chosen]))
                    else:
                        yield answers(cols, at[chosen], low[chosen], high[chosen])
            tail = at[starts[-1] :][real[starts[-1] :]]
            if len(tail):
                place = float(tail[-1])
            elif len(starts) > 1:
                place = None
            key = high_key
        yield from told(after.get(block))

    kinds = dict(slim.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, value]) + ", before double, after double"
    return laid.mapInArrow(search, schema)


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """1-based row number per key in `order`."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("bigint")}, partitions)


def haloed_window(
    df: DataFrame,
    keys: Sequence[str],
    rank: str,
    halo: int,
    exprs: Callable[[Any], dict[str, Column]],
    block_rows: int = 8192,
) -> DataFrame:
    """Evaluate window expressions that look back at most `halo` rows.

    `rank` is the 1-based row number per key. Rows are cut into blocks of `block_rows`; the last
    `halo` rows of a block are also sent to the next one, so no window group grows with the key.
    """
    size = max(block_rows, halo + 1)
    own = F.floor((F.col(rank) - 1) / F.lit(size))
    tail = (F.col(rank) - 1) % F.lit(size) >= F.lit(size - halo)
    spread = df.withColumn("_own", own).withColumn(
        "_at", F.explode(F.when(tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))
    )
    win = Window.partitionBy(*keys, "_at").orderBy(rank)
    return spread.withColumns(exprs(win)).filter("_own = _at").drop("_own", "_at")


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int = 100,
    name: str = "rolling_mean",
    block_rows: int = 8192,
) -> DataFrame:
    """Mean of the last `rows` values per key, the current row included."""
    ranked = rank_within(df, keys, order, "_rank")
    return haloed_window(
        ranked,
        keys,
        "_rank",
        rows - 1,
        lambda w: {name: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))},
        block_rows,
    ).drop("_rank")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Linear-interpolated exact quantiles per key; one column per entry of `probs`.

    Equal values are counted first, then the counts are ranked by block. Unlike `percentile`
    no task ever holds all distinct values of a group.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c"))
    )
    ranked = running_sums(counted, keys, [value], {"_upto": F.col("_c")}, partitions)
    totals = ranked.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    if keys:
        both = join_null_safe(ranked, totals, keys)
    else:
        both = ranked.crossJoin(F.broadcast(totals))  # a single row
    return ranked_quantiles(both, keys, value, probs)


def rank_columns(probs: dict[str, float], total: Column) -> list[tuple[Column, Column]]:
    """Ranks (from 0) of the two values that each quantile of `total` values lies between."""
    places = [F.lit(float(p)) * (total - 1) for p in probs.values()]
    return [(F.floor(at), F.ceil(at)) for at in places]


def ranked_quantiles(counted: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Quantiles from values with their count `_c`, the running count `_upto` and the key's total `_n`.

    Only the rows at the quantiles' ranks need to be there.
    """
    aggs, outs = [], []
    first = F.col("_upto") - F.col("_c")
    for i, ((name, p), ranks) in enumerate(zip(probs.items(), rank_columns(probs, F.col("_n")))):
        for side, rank in zip(("lo", "hi"), ranks):
            hit = (first <= rank) & (rank < F.col("_upto"))
            aggs.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{side}{i}"))
        frac = F.lit(float(p)) * (F.max("_n") - 1)
        aggs.append((frac - F.floor(frac)).alias(f"_f{i}"))
        outs.append(
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(name)
        )
    return counted.groupBy(*keys).agg(*aggs).select(*keys, *outs)


# --- folds whose next state depends on every earlier row of the key --------

Step = Callable[[Any, pd.DataFrame], "tuple[Any, dict[str, Any]]"]

ARROW_TYPES = {
    "string": pa.string(),
    "double": pa.float64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
}


#: Outputs of many keys at once: rows, first row of each key, rows of each key.
Bulk = Callable[[pd.DataFrame, np.ndarray, np.ndarray], "dict[str, Any]"]


def _key_runs(batch: pa.RecordBatch, keys: list[str], inputs: list[str]):
    """(rows, starts, sizes, key of a run) of the consecutive rows of one key in a batch; whole numbers stay exact."""
    names = list(dict.fromkeys([*keys, *inputs, BLOCK]))
    pdf = pa.Table.from_batches([batch]).select(names).to_pandas(integer_object_nulls=True)
    changed = pd.Series(False, index=pdf.index)
    for k in keys:
        prev = pdf[k].shift()
        changed |= (pdf[k] != prev) & ~(pdf[k].isna() & prev.isna())
    changed.iloc[0] = True
    starts = np.flatnonzero(changed.to_numpy())

    def key(run: int) -> tuple:
        found = (pdf[k].iloc[starts[run]] for k in keys)
        return tuple(None if pd.isna(v) else v for v in found)

    return pdf, starts, np.diff(starts, append=len(pdf)), key


def carry_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    inputs: Sequence[str],
    step: Step,
    outputs: dict[str, str],
    merge: Callable[[Any, Any], Any] | None = None,
    partitions: int | None = None,
    block_rows: int | None = None,
    bulk: Bulk | None = None,
) -> DataFrame:
    """Ordered fold per key, split over blocks; adds the `outputs` columns to each row.

    `step(state, rows)` consumes consecutive rows of one key (only the `inputs` columns) and returns
    the new state and one value per row for each output; the state is `None` at the start of a key.
    Only blocks that lie wholly inside one key make their successor depend on them. With
    `merge(before, tail)` such a block is composed instead, `tail` being its state when started from `None`.
    Without it, these blocks are run from several entering states at a time: all those which their predecessor
    was seen to leave with, those that blocks further back leave with after a fresh start, looking back twice as
    far in each round, and the true state where the chain is known. The chain is followed through what was seen:
    a state that is soon forgotten, persists over many blocks or is one of a few that take turns costs a number
    of rounds that hardly grows with the blocks. The result is exact. All other columns pass through as Arrow data.

    Borders ask for the state of the last key of a block alone. `bulk` gives the outputs of `step` for many keys that start and end within
    an Arrow batch, in one call; without it each of them is a call of `step`.
    """
    keys, inputs = list(keys), list(inputs)
    laid = layout(df, [*keys, *order], partitions, block_rows)

    def border_states(tried: dict[int, list]):
        def run(batches):
            block = first = last = None
            states: list = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                pdf, starts, _, key = _key_runs(batch, keys, inputs)
                if block is None:
                    block, first = int(pdf[BLOCK].iloc[0]), key(0)
                    states = list(tried.get(block, [None]))
                    last = first
                # of the keys that end within the batch nothing is carried on
                if key(-1) != last:
                    states = [None]
                last = key(-1)
                tail = pdf.iloc[starts[-1] :]
                states = [step(state, tail)[0] for state in states]
            if block is not None:
                body = pickle.dumps((first, last, states))
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int32()), "body": pa.array([body], pa.binary())}
                )

        return run

    needed = list(dict.fromkeys([*keys, *inputs, BLOCK]))

    def measure(tried: dict[int, list] | None) -> dict[int, tuple]:
        part = laid.filter(F.col(BLOCK).isin(list(tried))) if tried else laid
        found = part.select(*needed).mapInArrow(border_states(tried or {}), "block int, body binary")
        return {r["block"]: pickle.loads(bytes(r["body"])) for r in found.collect()}

    # the driver sees a few states per block, never rows; a single block needs no states at all
    tails = measure(None) if laid.rdd.getNumPartitions() > 1 else {}
    blocks = sorted(tails)
    left = {b: {repr(None): tails[b][2][0]} for b in blocks}  # state on leaving, by the state on entering
    whole = {b: tails[b][0] == tails[b][1] for b in blocks}
    entering: dict[int, Any] = {}
    back = 1
    while True:
        entering, tried = {}, {}
        lost = None  # the true state of the last known block, while the chain cannot be followed
        for i, here in enumerate(blocks):
            prev = blocks[i - 1] if i else None
            if prev is None or tails[prev][1] != tails[here][0]:
                lost = None
                continue
            if lost is None:
                state = entering.get(prev)
                if not whole[prev]:
                    entering[here] = left[prev][repr(None)]
                elif merge:
                    tail = left[prev][repr(None)]
                    entering[here] = merge(state, tail) if prev in entering else tail
                elif repr(state) in left[prev]:
                    entering[here] = left[prev][repr(state)]
                else:
                    lost = (state,)
                    tried[prev] = [state]
            if lost is not None and whole[here]:
                before = [left[b][repr(None)] for b in blocks[max(0, i - back) : i]] + list(left[prev].values())
                fresh = {repr(s): s for s in [lost[0], *before] if repr(s) not in left[here]}
                if fresh:
                    tried[here] = list(fresh.values())
        if not tried:
            break
        for b, (_, _, states) in measure(tried).items():
            left[b].update({repr(s): out for s, out in zip(tried[b], states)})
        back *= 2

    final = dict(entering)
    kept = df.columns
    kinds = {name: ARROW_TYPES[kind] for name, kind in outputs.items()}

    def emit(batches):
        block = last = state = None
        for batch in batches:
            made: dict[str, list] = {name: [] for name in kinds}
            runs = 0
            if batch.num_rows:
                pdf, starts, sizes, key = _key_runs(batch, keys, inputs)
                runs = len(starts)

            def tell(out):
                for name, kind in kinds.items():
                    made[name].append(pa.array(out[name], kind, from_pandas=False))

            i = 0
            while i < runs:
                if bulk and 0 < i < runs - 1:
                    low, high = starts[i], starts[-1]
                    tell(bulk(pdf.iloc[low:high], starts[i:-1] - low, sizes[i:-1]))
                    i = runs - 1
                    continue
                if block is None:
                    block = int(pdf[BLOCK].iloc[0])
                    state = final.get(block)
                elif i or key(0) != last:
                    state = None
                state, out = step(state, pdf.iloc[starts[i] : starts[i] + sizes[i]])
                tell(out)
                i += 1
            if runs:
                last = key(-1)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            cols += [pa.concat_arrays(made[n]) if made[n] else pa.array([], k) for n, k in kinds.items()]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *kinds])

    schema = T.StructType(
        [*df.schema.fields, *T._parse_datatype_string(", ".join(f"`{n}` {k}" for n, k in outputs.items())).fields]
    )
    return laid.mapInArrow(emit, schema)
