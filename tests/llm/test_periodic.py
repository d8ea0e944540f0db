"""Periodic runs against a plain search over all lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from ledgerlake.llm.periodic import periodic_runs, run_digests, runs_of
from ledgerlake.llm.words import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if all(x[i] == x[i + q] for i in range(len(x) - q)))


def plain_runs(x):
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i and smallest_period(x[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out)


def plain(doc_id, text):
    x = WORD.findall(text or "")
    n, h = len(x), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(x)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(x) if i not in dropped).encode()).hexdigest(),
    )


def test_runs_of_many_texts():
    draw = random.Random(3)
    for _ in range(800):
        texts = []
        for _ in range(draw.randrange(1, 4)):
            x = []
            while len(x) < draw.randrange(1, 60):
                if draw.random() < 0.5:
                    x += [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randrange(1, 8))]
                else:
                    period = [draw.randrange(draw.choice([2, 3, 30])) for _ in range(draw.randrange(1, 9))]
                    x += (period * 12)[: draw.randrange(1, len(period) * 8)]
            texts.append(x)
        h = mix(np.array([w for x in texts for w in x], dtype=np.uint64))
        got = runs_of(h, np.cumsum([0, *map(len, texts)]))
        assert [tuple(r) for r in got.tolist()] == [(t, *r) for t, x in enumerate(texts) for r in plain_runs(x)]


def test_one_word_many_times():
    assert runs_of(np.zeros(200_000, dtype=np.uint64), np.array([0, 200_000])).tolist() == [[0, 0, 200_000, 1]]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 12000")
    got = sorted(tuple(r) for r in run_digests(docs).collect())
    assert got == sorted(plain(r.doc_id, r.text) for r in docs.collect())
    assert sum(r[1] for r in got) > 20


def test_awkward_documents(spark):
    rows = [
        (1, "a b a b a b a b a b"), (1, "a b a b a b a b a b"), (2, None), (3, ""), (4, " \n\t "), (5, "x" * 60_000), (6, "wo rd " * 300), (None, "é é é é é é é"),
        (7, "a a a a a"), (8, "a a a a a a"), (22, "one two three four five six seven eight"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as start", "'x' as runs", "2 as n_runs")
    assert sorted(map(str, (tuple(r) for r in run_digests(df).collect()))) == sorted(str(plain(*r)) for r in rows)
    assert run_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    found = {r.doc_id: r for r in periodic_runs(df).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 10, 2)] and found[1].collapsed == "a b"
    assert found[7].runs == [] and found[8].collapsed == "a" and found[None].collapsed == "é" and found[2].collapsed == ""
