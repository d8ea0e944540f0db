"""Substring dedup against SQL and a plain version."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa

from ledgerlake.llm import substrings as S
from ledgerlake.llm.twins import SUBSTRINGS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def plain(rows, edge):
    texts = [(S.NO_ID if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, x in texts:
        for k in range(len(x) - edge + 1):
            w = tuple(x[k : k + edge])
            first[w] = min(first.get(w, (i, k)), (i, k))
    out = []
    for (doc_id, _), (i, x) in zip(rows, texts):
        gone = {j for k in range(len(x) - edge + 1) if first[tuple(x[k : k + edge])] < (i, k) for j in range(k, k + edge)}
        kept = " ".join(w for j, w in enumerate(x) if j not in gone)
        out.append(str((doc_id, len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest())))
    return sorted(out)


def result(df):
    return sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in df.collect())


def test_gram_hash():
    h = S.mix(np.arange(40, dtype=np.uint64) % np.uint64(7))
    for width in (1, 2, 3, 10, 19, 20):
        got = S.gram_hash(h, width)
        assert len(got) == 41 - width
        seen = {}
        for k, g in enumerate(got):
            assert seen.setdefault(tuple(h[k : k + width]), g) == g
        assert len(set(seen.values())) == len(seen)
    assert len(S.gram_hash(h, 41)) == 0


def test_least_places():
    draw = random.Random(2)
    for width in (1, 2, 5, 11):
        v = np.array([draw.randrange(6) for _ in range(60)], dtype=np.uint64)
        assert S.least_places(v, width).tolist() == [k + int(np.argmin(v[k : k + width])) for k in range(61 - width)]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as from '{SF}/documents.parquet'")
    rows = con.sql(f"select doc_id, n_words, n_removed, kept_sha256 from ({SUBSTRINGS})").fetchall()
    assert result(S.without_repeats(docs)) == sorted(map(str, rows))
    assert sum(r[2] > 0 for r in rows) > 10


def test_many_slices_and_shards(spark, monkeypatch):
    """Texts of few words over several slices and shards, with copies, periodic texts and shared ids."""
    monkeypatch.setattr(S, "SLICE", 300)
    monkeypatch.setattr(S, "SHARD_BYTES", 2_000)
    draw = random.Random(4)
    phrases = [" ".join(str(draw.randrange(30)) for _ in range(draw.randrange(1, 14))) for _ in range(12)]
    rows = []
    for k in range(400):
        text = " ".join(draw.choice(phrases) if draw.random() < 0.6 else str(draw.randrange(900)) for _ in range(draw.randrange(8)))
        rows.append((draw.choice([None, k, k, k, 7]), draw.choice([text, text, text + " " + text, " ".join(["a b"] * draw.randrange(12))])))
    rows += rows[:40]
    for edge in (3, 12):
        assert result(S.without_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), edge)) == plain(rows, edge)


def test_paths(spark):
    shared = " ".join(f"s{k}" for k in range(40))
    rows = [(1, "a b " + shared + " c"), (2, "x " + shared + " y z"), (3, shared)]
    _, _, paths = S.repeated_paths(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r.id, r.start, r.n, r.src, r.src_start) for r in paths.collect())
    assert got == [(2, 1, 21, 1, 2), (3, 0, 21, 1, 2)]


def test_awkward_documents(spark):
    line = " ".join(f"w{k}" for k in range(25))
    rows = [
        (1, line), (1, line), (2, None), (3, ""), (4, "  \n\t "), (5, "x" * 60_000), (6, "wo rd " * 2_000), (None, line + " tail"), (7, line), (8, "one"), (9, line.replace(" ", "\n")),
        (10, "é " * 30), (None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as key", "'x' as kept", "3 as n", "4 as slice", "5 as shard", "6 as first_id")
    assert result(S.without_repeats(df)) == plain(rows, 20)
    assert S.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    assert sorted(map(str, con.sql(f"select doc_id, n_words, n_removed, kept_sha256 from ({SUBSTRINGS})").fetchall())) == plain(rows, 20)


def test_a_false_match_takes_nothing_out(spark, monkeypatch):
    """If two different edges shared a hash, the digests of their words would tell."""
    monkeypatch.setattr(S, "gram_hash", lambda h, width: np.full(max(len(h) - width + 1, 0), 5, dtype=np.uint64))
    rows = [(1, " ".join(f"a{k}" for k in range(22))), (2, " ".join(f"b{k}" for k in range(20)))]
    assert result(S.without_repeats(spark.createDataFrame(rows, SCHEMA))) == plain(rows, 20)
