"""Conversation repair against plain versions and against SQL."""

import hashlib
import random

import duckdb
import pyarrow as pa
import pytest

from ledgerlake.llm import conversations as C
from ledgerlake.llm.twins import CONVERSATIONS

SCHEMA = "conv_id long, turn long, role string, text string"


def moves(rows, i, state):
    """Edits at a place: name, cost, next row, next state."""
    if i < len(rows) // 2:
        yield "D", 3, i + 1, state
    yield "I", 2, i, C._WANTED[state][1]
    if i < len(rows) // 2 and rows[2 * i + 1] != "x":
        more = rows[2 * i + 1] == "t"
        if (state, rows[2 * i]) in C._NEXT:
            yield "K", more, i + 1, C._NEXT[state, rows[2 * i]]
        yield "R", 2 + more, i + 1, C._WANTED[state][1]


def every_path(rows, most):
    """All accepted paths that cost no more than ``most``."""
    def go(i, state, cost, audit):
        if i == len(rows) // 2 and state in (0, 3):
            yield cost, audit
        for name, more, to, after in moves(rows, i, state):
            if cost + more <= most:
                yield from go(to, after, cost + more, audit + name)

    return go(0, 0, 0, "")


def by_rows(rows):
    """Least (cost, audit) by a table over rows and states."""
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                to, made = C._WANTED[state][1], (cost + 2, audit + "I")
                best[to] = min(best.get(to, made), made)
        return best

    for i in range(len(rows) // 2):
        after = {}
        for state, (cost, audit) in inserted(dict(best)).items():
            for name, more, _, to in moves(rows, i, state):
                if name != "I":
                    made = (cost + more, audit + name)
                    after[to] = min(after.get(to, made), made)
        best = after
    return min(v for s, v in inserted(dict(best)).items() if s in (0, 3))


@pytest.mark.parametrize("block", [1, 2, 3, 8, 32])
def test_cheapest_edits(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    draw = random.Random(block)
    for _ in range(400):
        rows = "".join(draw.choice("sua-") + draw.choice("xt...") for _ in range(draw.randrange(13)))
        cost, audit = C.cheapest_edits(rows)
        assert (cost, audit) == by_rows(rows)
        if len(rows) <= 8:
            assert (cost, audit) == min(every_path(rows, cost))


def test_long_conversation():
    draw = random.Random(9)
    rows = "".join(("ua"[k % 2] if draw.random() < 0.9 else "s") + draw.choice("....t.x") for k in range(3_000))
    assert C.cheapest_edits(rows) == by_rows(rows)


def sql(rows):
    con = duckdb.connect()
    con.register("conversations", pa.table({c: pa.array([r[k] for r in rows], pa.int64() if k < 2 else pa.string()) for k, c in enumerate(("conv_id", "turn", "role", "text"))}))
    out = con.sql(CONVERSATIONS)
    return sorted(map(str, (dict(zip(out.columns, r)) for r in out.fetchall())))


def spark_rows(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted(str({c: r[c] for c in names}) for r in df.collect())


def test_awkward_conversations(spark):
    rows = [
        (1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, None, "system", None), (1, 5, None, "a"), (2, None, None, None), (None, 3, "user", "q?"),
        (None, 4, "assistant", "  "), (3, 1, "assistant", ""), (3, 9, "tool", "x! "), (4, 2, "", "z"), (4, 1, "user", "é."), (4, 3, "assistant", "ok.\n\t"),
        (5, 0, "user", "long " * 50_000 + "."),
        *((10 + k % 7, k % 23, ("user", "assistant", "system", "u")[k % 4], ("a.", "b", "", "c?")[k % 3]) for k in range(300)),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' as audit", "1 as cost", "2 as found", "array(1) as copies")
    assert spark_rows(C.repair_digests(df)) == sql(rows)
    assert C.repair_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_turns(spark):
    rows = [(7, 0, "assistant", "a."), (7, 1, "user", "b."), (7, 2, "user", "b."), (7, 3, "assistant", "c")]
    (got,) = C.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    # a rerole costs as much as an insertion, and I is before R
    assert (got.cost, got.audit, got.illegal, got.duplicate, got.truncated) == (6, "IKKDK", 1, 1, 1)
    assert [(t.role, t.text) for t in got.turns] == [("user", ""), ("assistant", "a."), ("user", "b."), ("assistant", "c")]


def test_all_rows_dropped(spark):
    rows = [(k, 0, "user", "x.") for k in range(200)]
    got = {r.conv_id: r for r in C.repair_digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 200
    gone = [r for r in got.values() if r.cost == 0]
    assert gone and all(r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest() for r in gone)
