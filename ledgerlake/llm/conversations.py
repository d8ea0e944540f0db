"""Conversation structure repair: the cheapest edits that make the turns alternate, by iterative-deepening A*.

A repaired conversation is empty, or an optional system turn and then pairs of a user and an assistant turn. The
grammar has four states, and a state and an edit fix the next one. Depth-first search tries the edits in ASCII order
(Delete, Insert, Keep, Rerole) within a cost bound that rises by one until a path is accepted; as edits are tried in
order, the first accepted path is the least of the cheapest. What the rows to come cost at least (required deletions,
unfinished texts) is the estimate, and a table of failed (row, state) with the budget they failed at spares the search
from failing twice.

A conversation of any length is searched in blocks of ``BLOCK`` rows, for each pair of states before and after a block,
so that the effort grows with its length and no further. Blocks are joined from the last to the first by their costs and read off
from the first to the last: a block's audits end with an edit of its last row, so none begins another, and the least
audit is the least in each block in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers

BLOCK = 8
CACHED = 50_000  # blocks whose answers a worker remembers
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
_NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: What Insert and Rerole give in each state, and the state after it.
_WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_LEGAL = {"su", "ua", "au"}
_ENDS = (START, ASSISTANT)
_SPACE = " \t\n\x0b\x0c\r"


def _search(rows: str, start: int, goal: int | None) -> tuple[int, str] | None:
    """Least cost and audit from ``start`` over all rows: to ``goal`` right after the last one, or (None) to an accepting end.

    ``rows`` has two characters a row: the role's initial (``-`` for any other), and ``x`` if it must go, ``t`` if its text is unfinished, else ``.``.
    """
    n = len(rows) // 2
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + {"x": DELETE, "t": UNFINISHED, ".": 0}[rows[2 * i + 1]]
    failed: dict[tuple[int, int], int] = {}

    def edits(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, state
        if i < n or goal is None:  # an insertion after a block's last row is the next block's
            yield "I", INSERT, i, _WANTED[state][1]
        if i < n and rows[2 * i + 1] != "x":
            more = UNFINISHED if rows[2 * i + 1] == "t" else 0
            kept = _NEXT.get((state, rows[2 * i]))
            if kept is not None:
                yield "K", more, i + 1, kept
            yield "R", REROLE + more, i + 1, _WANTED[state][1]

    def accepted(i: int, state: int) -> bool:
        return i == n and (state in _ENDS if goal is None else state == goal)

    for bound in range(rest[0], DELETE * n + 2 * INSERT + 1):  # deleting all and inserting two turns reaches any state there is
        if accepted(0, start):
            return 0, ""
        path, spent = [], [0]
        stack = [(0, start, edits(0, start))]
        while stack:
            i, state, todo = stack[-1]
            for name, cost, to, after in todo:
                left = bound - spent[-1] - cost
                if left < rest[to] or failed.get((to, after), -1) >= left:
                    continue
                path.append(name)
                if accepted(to, after):
                    return spent[-1] + cost, "".join(path)
                spent.append(spent[-1] + cost)
                stack.append((to, after, edits(to, after)))
                break
            else:
                stack.pop()
                failed[i, state] = max(failed.get((i, state), -1), bound - spent.pop())
                if path:
                    path.pop()
    return None


_block = lru_cache(CACHED)(_search)


def cheapest_edits(rows: str) -> tuple[int, str]:
    """Least cost and, among the cheapest, the ASCII-least audit for a conversation's ``rows`` (see ``_search``)."""
    blocks = [rows[k : k + 2 * BLOCK] for k in range(0, len(rows), 2 * BLOCK)] or [""]
    least: list[dict[int, int]] = [{} for _ in blocks]  # cost from a block's start on, by the state there
    for k in range(len(blocks) - 1, -1, -1):
        for state in range(4):
            if k == len(blocks) - 1:
                found = _block(blocks[k], state, None)
                costs = [found[0]] if found else []
            else:
                costs = [f[0] + least[k + 1][to] for to in least[k + 1] if (f := _block(blocks[k], state, to))]
            if costs:
                least[k][state] = min(costs)
    state, audit = START, []
    for k, block in enumerate(blocks[:-1]):
        piece, state = min(
            (f[1], to) for to in least[k + 1] if (f := _block(block, state, to)) and f[0] + least[k + 1][to] == least[k][state]
        )
        audit.append(piece)
    return least[0][START], "".join(audit) + _block(blocks[-1], state, None)[1]


def repaired_turns(turns: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the repaired conversation."""
    state, rows = START, iter(turns)
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        if edit == "K":
            role, text = next(rows)
            state = _NEXT[state, role[:1]]
        else:
            role, after = _WANTED[state]
            text = next(rows)[1] if edit == "R" else ""
            state = after
        yield role, text


def fault(role: str, text: str, seen: set[bytes]) -> str:
    """A turn's first fault: ``blank``, ``duplicate``, ``truncated`` or ``""``. ``seen`` collects digests of earlier turns."""
    digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    again = digest in seen
    seen.add(digest)
    solid = text.rstrip(_SPACE)
    return "blank" if not solid else "duplicate" if again else "truncated" if solid[-1] not in ".!?" else ""


class _Conversation:
    """Rows of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.rows, self.seen = conv_id, [], [], set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:  # turns come in order
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        why = fault(role, text, self.seen)
        self.faults[why] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in _LEGAL
        self.before = initial
        self.rows.append((initial if initial in ("s", "u", "a") else "-") + ("x" if why in ("blank", "duplicate") else "t" if why else "."))
        self.turns.append((role, text))

    def result(self) -> tuple:
        cost, audit = cheapest_edits("".join(self.rows))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        turns = list(repaired_turns(self.turns, audit))
        return self.conv_id, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, cost, audit, turns


_FIELDS = [("conv_id", "bigint"), *((c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", "string")]
_RESULT = ", ".join(f"{n} {t}" for n, t in _FIELDS) + ", turns array<struct<role: string, text: string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn -> one row per conversation."""

    def out(done: list[_Conversation]) -> pa.RecordBatch:
        columns = list(zip(*(c.result() for c in done)))
        arrays = [pa.array(c, pa.string() if t == "string" else pa.int64()) for c, (_, t) in zip(columns, _FIELDS)]
        turns = pa.array([[{"role": r, "text": t} for r, t in x] for x in columns[-1]], _TURNS)
        return pa.RecordBatch.from_arrays([*arrays, turns], names=[n for n, _ in _FIELDS] + ["turns"])

    now: _Conversation | None = None
    for batch in batches:
        done = []
        for conv_id, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now)
                now = _Conversation(conv_id)
            now.add(turn, role, text)
        if done:
            yield out(done)
    if now is not None:
        yield out([now])


def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage by the checksum of ``conv_id:turn``, modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    ``[.!?]`` out, 3 repeats it, 4 makes it the user's. Nulls count as one space, in results too."""
    kind = F.pmod(F.crc32(F.concat(_or_blank("conv_id"), F.lit(":"), _or_blank("turn")).cast("binary")), F.lit(20))
    text = _or_blank("text")
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(_or_blank("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    ).select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, turns``: missing turn numbers, counts of
    turns by their first fault, neighbouring turns whose roles may not follow each other, the least cost of a repair, its edits'
    initials, and the repaired turns. Rows are taken by turn, nulls first; rows of the same turn by role and text. Blank and duplicate turns are
    deleted, unfinished ones that stay cost one more. Null roles and texts count as one space; rows without a
    ``conv_id`` are one conversation; an empty table gives no rows; other columns are not looked at. A conversation's rows go through one task one after the
    other, which holds the texts of that conversation only.
    """
    rows = conversations.select("conv_id", "turn", _or_blank("role").alias("role"), _or_blank("text").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return on_workers(dealt.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"), _repair, _RESULT)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """``repair_conversations`` of the damaged table, with the repaired turns as a digest, one row per ``conv_id`` of the table itself."""
    repaired = repair_conversations(damaged(conversations))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    found = repaired.select(
        F.col("conv_id").alias("found"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256")
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
