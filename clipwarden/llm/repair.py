"""Repair of conversations as Knuth's lightest derivation over a weighted hypergraph.

A repaired conversation has the role initials `(s?(ua)+)?`. Its derivation is made of items:

* `row i` (axiom, weight 0) yields `kept i`, `reroled i to u or a` (2) and `gone i` (3); a row that is cut off adds 1
  unless it goes, and blank and repeated rows only yield `gone i`;
* `filler u`, `filler a` (axioms, weight 2) are empty turns that may stand anywhere;
* `prefix i q`: the rows before i are settled and the automaton of the grammar is in state q. It follows from a
  prefix and an item of the next row, or from a prefix and a filler, by hyperedges with two antecedents;
* the goal follows from a prefix of all rows in an accepting state.

Weights are pairs (cost, audit), audits being strings of the edits' initials, compared by cost and then by byte
order. A hyperedge adds costs and appends its letter to the prefix's audit, so it is a superior function: never
below an antecedent, and monotone, since an audit determines its cost and thus no two audits of one item with
equal cost are prefixes of each other. Items are popped in ascending order, each is final when popped, and the
goal's pop ends the search.

One conversation may hold a third of all rows. Rows are range partitioned by (conversation, turn, role, text), so
a long one spans many tasks. Conversations that lie inside one task are solved there. Of those at a task's borders
or longer than `BUFFER_ROWS`, first occurrences are found by an aggregation, pieces of `CHUNK` rows are solved
apart from every entering to every leaving state, and one small matrix per piece is composed in order. Only
the digest of such a conversation's text is inherently sequential: its rows stream through one task in constant memory.

Defined results: null roles and texts are one space; null turns sort first; a null conversation id is one
conversation; rows of one turn are ordered by role and text, so repeated rows are adjacent; roles count by their
first character, an empty role by none; a conversation without rows has zeros, an empty audit and the digest of the
empty string; an empty table gives an empty result; further columns are ignored. Very long texts are passed through
in pieces of one row and hashed as they come.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os.path
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clipwarden.llm.common import stored

#: Rows of a conversation that are solved together, and rows that a task holds of one conversation.
CHUNK, BUFFER_ROWS = 128, 4096

# Costs of the edits and the grammar's automaton.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = {
    (START, "s"): AFTER_SYSTEM, (START, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
    (AFTER_USER, "a"): AFTER_ASSISTANT, (AFTER_ASSISTANT, "u"): AFTER_USER,
}
ACCEPTING = (START, AFTER_ASSISTANT)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
FINE, BLANK, CUT_OFF, REPEATED = range(4)

Weight = tuple[int, str]


def lightest(rows: list[tuple[str, int]], start: int, goal: bool) -> dict[int, Weight]:
    """Weights of the derivations of `rows`, given as (role initial, fault), from state `start`.

    With `goal` only the accepting state whose derivation is popped first is returned, else every reachable state.
    """
    n = len(rows)
    heap: list[tuple[int, str, tuple]] = [(0, "", ("prefix", 0, start)), (INSERT, "", ("filler", "u")), (INSERT, "", ("filler", "a"))]
    heap += [(0, "", ("row", i)) for i in range(n)]
    heapq.heapify(heap)
    final: set[tuple] = set()
    prefixes: list[dict[int, Weight]] = [{} for _ in range(n + 1)]
    edits: list[list[tuple[str, str | None, int]]] = [[] for _ in range(n)]  # (letter, role, cost) that are final
    fillers: list[str] = []
    found: dict[int, Weight] = {}

    def push(cost: int, audit: str, item: tuple) -> None:
        if item not in final:
            heapq.heappush(heap, (cost, audit, item))

    def join(i: int, state: int, weight: Weight, letter: str, role: str | None, cost: int) -> None:
        to = state if role is None else NEXT.get((state, role))
        if to is not None:
            push(weight[0] + cost, weight[1] + letter, ("prefix", i, to))

    while heap:
        cost, audit, item = heapq.heappop(heap)
        if item in final:
            continue
        final.add(item)
        kind = item[0]
        if kind == "row":
            initial, fault = rows[item[1]]
            push(DELETE, "", ("edit", item[1], "D", None))
            if fault not in (BLANK, REPEATED):
                extra = CUT if fault == CUT_OFF else 0
                push(extra, "", ("edit", item[1], "K", initial))
                for role in ROLES:
                    push(REROLE + extra, "", ("edit", item[1], "R", role))
        elif kind == "edit":
            _, i, letter, role = item
            edits[i].append((letter, role, cost))
            for state, weight in prefixes[i].items():
                join(i + 1, state, weight, letter, role, cost)
        elif kind == "filler":
            fillers.append(item[1])
            for i in range(n + 1):
                for state, weight in prefixes[i].items():
                    join(i, state, weight, "I", item[1], INSERT)
        elif kind == "prefix":
            _, i, state = item
            weight = prefixes[i][state] = (cost, audit)
            if i == n:
                if goal and state in ACCEPTING:
                    push(cost, audit, ("goal", state))
                found[state] = weight
            else:
                for letter, role, edit_cost in edits[i]:
                    join(i + 1, state, weight, letter, role, edit_cost)
            for role in fillers:
                join(i, state, weight, "I", role, INSERT)
        else:
            return {item[1]: (cost, audit)}
    return found


class Chain:
    """Pieces of a conversation composed in order; what all live derivations have in common is put aside."""

    def __init__(self) -> None:
        self.common: list[str] = []
        self.live: dict[int, Weight] = {START: (0, "")}

    def add(self, matrix: Iterable[tuple[int, int, int, str]]) -> None:
        """`matrix`: (entering state, leaving state, cost, audit) of a piece."""
        after: dict[int, Weight] = {}
        for enter, leave, cost, audit in matrix:
            if enter in self.live:
                weight = (self.live[enter][0] + cost, self.live[enter][1] + audit)
                if leave not in after or weight < after[leave]:
                    after[leave] = weight
        shared = os.path.commonprefix([a for _, a in after.values()])
        self.common.append(shared)
        self.live = {q: (c, a[len(shared) :]) for q, (c, a) in after.items()}

    def finish(self) -> Weight:
        cost, audit = min(self.live[q] for q in ACCEPTING if q in self.live)
        return cost, "".join(self.common) + audit


def piece_matrix(rows: list[tuple[str, int]]) -> list[tuple[int, int, int, str]]:
    return [(q, p, *w) for q in range(4) for p, w in lightest(rows, q, goal=False).items()]


def solve(rows: list[tuple[str, int]]) -> Weight:
    if len(rows) <= CHUNK:
        return next(iter(lightest(rows, START, goal=True).values()))
    chain = Chain()
    for at in range(0, len(rows), CHUNK):
        chain.add(piece_matrix(rows[at : at + CHUNK]))
    return chain.finish()


class Writer:
    """Repaired lines `role:text` from an audit, and their digest; texts are kept on demand."""

    def __init__(self, audit: str, keep: bool = False) -> None:
        self.audit, self.at, self.state, self.lines = audit, 0, START, 0
        self.hash, self.kept = hashlib.sha256(), ([] if keep else None)

    def _write(self, role: str, text: str, initial: str) -> None:
        self.state = NEXT[self.state, initial]
        line = ("\n" if self.lines else "") + f"{role}:{text}"
        self.lines += 1
        self.hash.update(line.encode())
        if self.kept is not None:
            self.kept.append(line)

    def _fillers(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            initial = "a" if self.state == AFTER_USER else "u"
            self._write(ROLES[initial], "", initial)

    def row(self, role: str, text: str) -> None:
        self._fillers()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._write(role, text, role[:1])
        elif letter == "R":
            initial = "a" if self.state == AFTER_USER else "u"
            self._write(ROLES[initial], text, initial)

    def digest(self) -> str:
        self._fillers()
        return self.hash.hexdigest()


class Tally:
    """Counts over consecutive rows of a conversation; two of them can be joined."""

    FIELDS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last")

    def __init__(self, values: Iterable[Any] = (None, None, 0, 0, 0, 0, 0, None, None)) -> None:
        self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last = values

    def row(self, turn: int | None, initial: str, fault: int) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == REPEATED
        self.truncated += fault == CUT_OFF
        same = turn is None
        self.join(Tally((turn, turn, 0 if same else 1, 0, 0, 0, 0, initial, initial)))

    def join(self, after: Tally) -> None:
        if after.first is None:
            return
        if self.last is not None:
            self.illegal += self.last + after.first not in LEGAL
        self.turns += after.turns - (self.high is not None and self.high == after.low)
        self.low = after.low if self.low is None else self.low
        self.high = self.high if after.high is None else after.high
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        self.first = after.first if self.first is None else self.first
        self.last = after.last

    def counts(self) -> tuple[int, int, int, int, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal

    def values(self) -> list[Any]:
        return [getattr(self, f) for f in self.FIELDS]


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string, repaired string"
RESULT_KINDS = [*[pa.int64()] * 6, pa.string(), pa.string(), pa.string()]
RESULT_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def repaired_whole(rows: list[tuple[int | None, str, str, int]], keep: bool) -> tuple:
    """The result of a conversation of rows (turn, role, text, fault) in order."""
    seen: set[tuple[str, str]] = set()
    tally, short = Tally(), []
    for turn, role, text, fault in rows:
        if fault != BLANK:
            if (role, text) in seen:
                fault = REPEATED
            seen.add((role, text))
        tally.row(turn, role[:1], fault)
        short.append((role[:1], fault))
    cost, audit = solve(short)
    writer = Writer(audit, keep)
    for _, role, text, _ in rows:
        writer.row(role, text)
    digest = writer.digest()
    return (*tally.counts(), cost, audit, digest, "".join(writer.kept) if keep else None)


def fault_of(text: Column) -> Column:
    """BLANK, CUT_OFF or FINE, as far as a row's own text tells."""
    bare = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT_OFF)


def repair(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    gone_col: str | None = None, with_text: bool = False,
) -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows marked by `gone_col` only name their conversation. `with_text` adds the repaired text as `repaired`.
    """
    kind = df.schema[conv_col].dataType.simpleString()
    conv_type = to_arrow_type(df.schema[conv_col].dataType)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    rows = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        fault_of(text).cast("int").alias("fault"), (F.col(gone_col) if gone_col else F.lit(False)).alias("gone"),
    )
    # equal rows are interchangeable: the salt lets a range border fall between them
    order = ["conv", "turn", "role", "text"]
    laid = rows.repartitionByRange(*order, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions(*order)
    row_names = ["conv", "block", "pos", "turn", "role", "text", "fault", "gone"]
    row_kinds = [conv_type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.bool_()]

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of the conversations that lie inside a task; the rows of the others."""
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        held: list[tuple] = []  # rows of the current conversation
        out: list[tuple] = []  # rows and results
        size, pos = 0, 0
        current, passing, begun = None, True, False

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            kinds = [*row_kinds, pa.bool_(), *RESULT_KINDS]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], [*row_names, "done", *RESULT_NAMES]
            )

        nothing = (None,) * len(RESULT_KINDS)

        def pass_on() -> None:
            out.extend((*r, False, *nothing) for r in held)
            held.clear()

        for part in batches:
            for conv, turn, role, text, fault, gone in zip(*[c.to_pylist() for c in part.columns]):
                if not begun or conv != current:
                    if begun and not passing:
                        real = [r[3:7] for r in held if not r[7]]
                        result = repaired_whole(real, with_text)
                        out.append((current, block, None, None, None, None, None, None, True, *result))
                        held.clear()
                    # the first conversation of a task may have begun in the task before
                    current, passing, begun = conv, not begun, True
                held.append((conv, block, pos, turn, role, text, fault, gone))
                pos += 1
                size += len(text) + 100
                if len(held) >= BUFFER_ROWS:
                    passing = True
                if passing:
                    pass_on()
                if size >= 8 << 20 and out:
                    yield batch()
                    out, size = [], 0
        pass_on()
        if out:
            yield batch()

    schema = f"conv {kind}, block int, pos bigint, turn bigint, role string, text string, fault int, gone boolean, done boolean, {RESULT}"
    table = stored(laid.mapInArrow(split, schema), "conversations")
    whole = table.filter("done").select("conv", *RESULT_NAMES)
    long = _repair_split(table.filter("not done").select(*row_names), kind, conv_type, with_text)
    both = whole.unionByName(long)
    return both.select(F.col("conv").alias(conv_col), *(RESULT_NAMES if with_text else RESULT_NAMES[:-1]))


def _repair_split(rows: DataFrame, kind: str, conv_type: pa.DataType, with_text: bool) -> DataFrame:
    """Results of conversations whose rows (conv, block, pos, ...) lie in several tasks."""
    live = ~F.col("gone") & (F.col("fault") != BLANK)
    content = F.sha2(F.concat_ws("\x00", F.length("role").cast("string"), "role", "text"), 256)
    # a row is new if it is the first of its content: looked up by place, which is unique, not by content
    fresh = (
        rows.filter(live)
        .groupBy("conv", content.alias("content"))
        .agg(F.min(F.struct("block", "pos")).alias("at"))
        .select("at.block", "at.pos", F.lit(True).alias("fresh"))
    )
    fault = F.when(live & F.col("fresh").isNull(), REPEATED).otherwise(F.col("fault"))
    short = (
        rows.join(fresh, ["block", "pos"], "left")
        .select(
            "conv", "block", F.floor(F.col("pos") / CHUNK).alias("piece"), "pos", "turn",
            F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"), "gone",
        )
        .repartition("block", "piece")
        .sortWithinPartitions("block", "piece", "pos")
    )

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per piece: its counts and its matrix."""
        from itertools import groupby

        def every() -> Iterator[tuple]:
            for part in batches:
                yield from zip(*[c.to_pylist() for c in part.columns])

        out: list[tuple] = []
        # a piece of the table's rows may hold parts of several conversations
        for (block, piece, conv), group in groupby(every(), key=lambda r: (r[1], r[2], r[0])):
            tally, items, first = Tally(), [], None
            for _, _, _, pos, turn, initial, fault, gone in group:
                first = pos if first is None else first
                if not gone:
                    tally.row(turn, initial, fault)
                    items.append((initial, fault))
            out.append((conv, block, first, json.dumps([tally.values(), piece_matrix(items)])))
            if len(out) >= 512:
                yield matrices(out)
                out = []
        if out:
            yield matrices(out)

    def matrices(out: list[tuple]) -> pa.RecordBatch:
        kinds = [conv_type, pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv", "block", "pos", "body"]
        )

    pieces = short.mapInArrow(measure, f"conv {kind}, block int, pos bigint, body string")

    def compose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per conversation: counts, cost and audit."""
        current, begun, tally, chain = None, False, Tally(), Chain()

        def result() -> pa.RecordBatch:
            values = (*tally.counts(), *chain.finish())
            return pa.RecordBatch.from_arrays(
                [pa.array([current], conv_type), *[pa.array([v], k) for v, k in zip(values, RESULT_KINDS)]],
                ["conv", *RESULT_NAMES[:7]],
            )

        for part in batches:
            for conv, _, _, body in zip(*[c.to_pylist() for c in part.columns]):
                if not begun or conv != current:
                    if begun:
                        yield result()
                    current, begun, tally, chain = conv, True, Tally(), Chain()
                counts, matrix = json.loads(body)
                tally.join(Tally(counts))
                chain.add(matrix)
        if begun:
            yield result()

    results = ", ".join(RESULT.split(", ")[:7])
    composed = stored(
        pieces.repartition("conv").sortWithinPartitions("conv", "block", "pos").mapInArrow(compose, f"conv {kind}, {results}"),
        "composed",
    )
    # the audit comes first, then the rows it speaks of
    counts = [F.col(n) for n in RESULT_NAMES[:6]]
    heads = composed.select(
        "conv", F.lit(-1).alias("block"), F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("role"),
        F.col("audit").alias("text"), F.array(*counts).alias("counts"),
    )
    body = rows.filter("not gone").select(
        "conv", "block", "pos", "role", "text", F.lit(None).cast("array<bigint>").alias("counts")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, counts, writer = None, None, None

        def result() -> pa.RecordBatch:
            digest = writer.digest()
            text = "".join(writer.kept) if with_text else None
            values = [*counts, writer.audit, digest, text]
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], conv_type), *[pa.array([v], k) for v, k in zip(values, RESULT_KINDS)]],
                ["conv", *RESULT_NAMES],
            )

        for part in batches:
            for key, _, _, role, text, found in zip(*[c.to_pylist() for c in part.columns]):
                if found is None:
                    writer.row(role, text)
                    continue
                if writer is not None:
                    yield result()
                conv, counts, writer = key, found, Writer(text, with_text)
        if writer is not None:
            yield result()

    lined = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "block", "pos")
    return lined.mapInArrow(write, f"conv {kind}, {RESULT}")


def damaged(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Conversations with planted faults, chosen by a checksum of id and turn: conv_id, turn, role, text, gone.

    Of twenty rows one is lost (it stays as a `gone` row), one is emptied, one loses its sentence ends, one is repeated
    and one gets the role `user`.
    """
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space)
    )
    rows = df.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"), (F.crc32(name) % 20).alias("_kind"),
    )
    kind = F.col("_kind")
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (kind == 0).alias("gone"), copies.alias("_copy"),
    ).drop("_copy")
