"""Conversation repair against a plain search over all edits in order."""

import random
import zlib

import plain
import pytest
from clipwarden.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
LETTERS = {"K": 0, "R": 2, "D": 3, "I": 2}


def damage(rows):
    """rows: (conv, turn, role, text). The damaged rows, and all conversation ids."""
    out, text_of = [], lambda v: " " if v is None else v
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out, {r[0] for r in rows}


def cheapest(rows):
    """(cost, audit, lines) by dynamic programming over whole audits; rows: (role, text, fault)."""
    best = {(0, "", ""): (0, "", ())}  # (rows consumed, last output, anything but s) -> weight
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}
    order = [{} for _ in range(len(rows) + 1)]
    order[0] = {"": (0, "", ())}
    del best
    for i in range(len(rows) + 1):
        changed = True
        while changed:  # insertions
            changed = False
            for last, (cost, audit, lines) in list(order[i].items()):
                for r in grammar[last]:
                    if r == "s":
                        continue
                    new = (cost + 2, audit + "I", (*lines, ({"u": "user", "a": "assistant"}[r], "")))
                    if r not in order[i] or new[:2] < order[i][r][:2]:
                        order[i][r], changed = new, True
        if i == len(rows):
            break
        role, text, fault = rows[i]
        for last, (cost, audit, lines) in order[i].items():
            options = [(last, cost + 3, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in grammar[last]:
                    options.append((role[:1], cost + extra, audit + "K", (*lines, (role, text))))
                for r in "ua":
                    if r in grammar[last]:
                        name = {"u": "user", "a": "assistant"}[r]
                        options.append((r, cost + 2 + extra, audit + "R", (*lines, (name, text))))
            for to, c, a, l in options:
                if to not in order[i + 1] or (c, a) < order[i + 1][to][:2]:
                    order[i + 1][to] = (c, a, l)
    return min((order[-1][q] for q in ("", "a") if q in order[-1]), key=lambda w: w[:2])


def expected(rows, ids):
    out = {}
    for conv in ids:
        own = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()),
        )
        seen, judged = set(), []
        for _, _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        roles = [r[2][:1] for r in own]
        cost, audit, lines = cheapest(judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(f == k for *_, f in judged) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])),
            cost, audit, plain.sha("\n".join(f"{r}:{t}" for r, t in lines)),
        )
    return out


def compare(got, want):
    found = {r.conv_id: tuple(r)[1:9] for r in got.collect()}
    assert found.keys() == want.keys()
    for key in want:
        assert found[key] == want[key], key


SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, block int, gone boolean, cost int"


def odd_conversations():
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "use"]
    texts = ["a.", "b!", "c", "", " \t", None, "d? \n", "e ", "f.", "g?", "h", "é🎉."]
    rows = []
    for conv in [None, *range(120)]:
        for i in range(rnd.randint(1, 9)):
            turn = rnd.choice([None, i, i, i, i + 2])
            rows += [(conv, turn, rnd.choice(roles), rnd.choice(texts))] * rnd.choice([1, 1, 1, 1, 2, 3])
    rows += [(900, i, ["user", "assistant"][i % 2], f"t{i}.") for i in range(40)]
    return rows


@pytest.fixture
def make_rows(spark):
    return lambda rows, n=3: spark.createDataFrame([(*r, "x", 1, False, 2) for r in rows], SCHEMA).repartition(n)


def test_odd_conversations(make_rows):
    rows = odd_conversations()
    damaged, ids = damage(rows)
    compare(repair.repair(repair.damaged(make_rows(rows)), gone_col="gone"), expected(damaged, ids))


def test_long_and_split_conversations(spark, make_rows, monkeypatch):
    """Small pieces and buffers: one conversation of most rows spans all tasks."""
    monkeypatch.setattr(repair, "CHUNK", 7)
    monkeypatch.setattr(repair, "BUFFER_ROWS", 16)
    rnd = random.Random(9)
    rows = [(5, i // 2, rnd.choice(["user", "assistant", "system"]), f"{rnd.randint(0, 300)}{rnd.choice('.!? ')}") for i in range(700)]
    rows += [(6, 1, "user", "same.")] * 300
    rows += [(k, t, rnd.choice(["user", "assistant"]), f"{t}.") for k in range(7, 40) for t in range(rnd.randint(1, 30))]
    damaged, ids = damage(rows)
    compare(repair.repair(repair.damaged(make_rows(rows, 5)), gone_col="gone"), expected(damaged, ids))


def test_text_and_nothing(spark, make_rows):
    rows = [(1, 1, "user", "hi"), (1, 2, "assistant", "x" * 200_000 + "."), (2, None, None, None), (3, 0, "system", "s.")]
    got = {r.conv_id: r for r in repair.repair(make_rows(rows), with_text=True).collect()}
    assert got[1].repaired == "user:hi\nassistant:" + "x" * 200_000 + "." and (got[1].cost, got[1].audit) == (1, "KK")
    assert (got[2].audit, got[2].repaired, got[2].blank) == ("D", "", 1)
    assert got[3].audit == "D" and got[3].cost == 3
    assert repair.repair(make_rows(rows).limit(0)).count() == 0


def test_agenda_pops_in_order():
    """The goal's weight equals the plain search on random rows, also when pieces are composed."""
    rnd = random.Random(1)
    kinds = {"": repair.FINE, "blank": repair.BLANK, "truncated": repair.CUT_OFF, "duplicate": repair.REPEATED}
    for _ in range(300):
        rows = [(rnd.choice(["user", "assistant", "system", ""]), "", rnd.choice(list(kinds))) for _ in range(rnd.randint(0, 12))]
        short = [(r[:1], kinds[f]) for r, _, f in rows]
        want = cheapest(rows)[:2]
        assert repair.solve(short) == want
        chain = repair.Chain()
        for at in range(0, len(short), 3):
            chain.add(repair.piece_matrix(short[at : at + 3]))
        assert chain.finish() == want


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare(queries.op13(spark, sf), expected(*damage(rows)))
