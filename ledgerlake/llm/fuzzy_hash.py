"""Context-triggered piecewise hashing: fingerprints that change only where a text does.

A rolling hash over the last seven bytes says where chunks end: where it is -1 modulo the block size. The hash
of each chunk gives one character. A fingerprint is ``block:signature:signature``, the second one at twice
the block size, so that texts whose block sizes are a step apart can still be compared. Two signatures of the same block
size are compared by their edit distance (insertions and deletions), if they share a run of seven characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers
from ledgerlake.llm.words import span_hash

LEAST_BLOCK = 3
LENGTH = 64  # characters of a signature at most
WINDOW = 7
RUN = 7
PART_BYTES = 16 << 20
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the seven bytes up to each place (fewer at the start), from three sums of them."""
    wide = data.astype(np.uint32)
    n = len(wide)
    total, weighted, shifted = wide.copy(), wide * np.uint32(WINDOW), wide.copy()
    for back in range(1, WINDOW):
        if back >= n:
            break
        total[back:] += wide[: n - back]
        weighted[back:] += wide[: n - back] * np.uint32(WINDOW - back)
        shifted[back:] ^= wide[: n - back] << np.uint32(5 * back)
    return total + weighted + shifted


def _signature(data: np.ndarray, ends: np.ndarray, most: int) -> str:
    """One character for each chunk; what follows the last allowed chunk belongs to it."""
    ends = ends[: most - 1]
    cuts = np.concatenate(([0], ends + 1, [len(data)]))
    if cuts[-2] == cuts[-1]:
        cuts = cuts[:-1]
    if len(cuts) < 2:
        return ""
    return _ALPHABET[(span_hash(data, cuts[:-1], cuts[1:], False) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: bytes) -> str:
    """Fingerprint of a text's bytes. The empty text's is ``3::``."""
    data = np.frombuffer(text, dtype=np.uint8)
    block = LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    if not len(data):
        return f"{block}::"
    rolled = _rolling(data)
    while True:
        ends = np.flatnonzero(rolled % np.uint32(block) == block - 1)
        if block == LEAST_BLOCK or len(ends) >= LENGTH // 2:
            break
        block //= 2
    wide = ends[rolled[ends] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(data, ends, LENGTH)}:{_signature(data, wide, LENGTH // 2)}"


def _distance(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Least insertions and deletions that turn the one string into the other, for many pairs at once.

    That is both lengths less twice the longest common subsequence, which is kept as one bit per character:
    a column of the table is a machine word.
    """
    if not pairs:
        return np.zeros(0)
    n = len(pairs)
    codes = [np.zeros((n, LENGTH), dtype=np.uint8) for _ in range(2)]
    lengths = np.array([[len(a), len(b)] for a, b in pairs])
    for k, pair in enumerate(pairs):
        for side, s in enumerate(pair):
            codes[side][k, : len(s)] = np.frombuffer(s.encode(), dtype=np.uint8)
    where = np.zeros((n, 128), dtype=np.uint64)
    rows = np.arange(n)
    for i in range(int(lengths[:, 0].max(initial=0))):
        some = i < lengths[:, 0]
        where[rows[some], codes[0][some, i]] |= np.uint64(1 << i)
    open_bits = np.full(n, 2**64 - 1, dtype=np.uint64)
    for j in range(int(lengths[:, 1].max(initial=0))):
        match = where[rows, codes[1][:, j]]
        match[j >= lengths[:, 1]] = 0
        met = open_bits & match
        open_bits = (open_bits + met) | (open_bits - met)
    used = np.where(lengths[:, 0] == 64, 2**64 - 1, (1 << np.minimum(lengths[:, 0], 63)) - 1).astype(np.uint64)
    common = np.bitwise_count(~open_bits & used).astype(np.int64)
    return lengths.sum(axis=1) - 2 * common


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints: 1 for equal ones, 0 for incompatible block sizes or no common run."""
    out = np.zeros(len(pairs))
    jobs: list[tuple[int, str, str]] = []
    for k, (x, y) in enumerate(pairs):
        if x == y:
            out[k] = 1.0
            continue
        (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
        bx, by = int(bx), int(by)
        for a, b in ([(x1, y1), (x2, y2)] if bx == by else [(x1, y2)] if bx == 2 * by else [(x2, y1)] if by == 2 * bx else []):
            runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
            if any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1)):
                jobs.append((k, a, b))
    if jobs:
        value = 1 - _distance([(a, b) for _, a, b in jobs]) / np.array([len(a) + len(b) for _, a, b in jobs])
        np.maximum.at(out, np.array([k for k, _, _ in jobs]), value)
    return out


def _edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order -> results of each row and the next one. A part's last row comes from the part after it and
    only serves as a neighbour."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    before: tuple | None = None
    for batch in batches:
        rows = []
        for doc_id, text, part in zip(*(batch.column(k).to_pylist() for k in range(3))):
            text = text or ""
            now = (doc_id, text, fingerprint(text.encode()), part)
            if before is not None and before[3] == part:
                edited = _edited(before[1], text).encode()
                rows.append((before[0], len(before[1]), hashlib.sha256(edited).hexdigest(), before[2], fingerprint(edited), now[2]))
            before = now
        if rows:
            columns = list(zip(*rows))
            near = likeness([(r[3], r[4]) for r in rows] + [(r[3], r[5]) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *map(pa.array, columns[2:5]), pa.array(near[: len(rows)]), pa.array(near[len(rows) :])],
                names=names,
            )


def edit_fingerprints(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    The edited text has its last quarter replaced by the start of the next document's text, by ascending id; the last one's next
    is the first. Null texts count as empty, rows without an id come first, equal ids go by their text. One row
    is its own next; an empty table gives no rows. Rows are dealt by ranges of ids, found from quantiles
    and summed up exactly, about ``part_bytes`` of text each; every range also gets the first row of the next one.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size.n:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    parts = max(1, -(-(size.bytes or 0) // part_bytes))
    cuts = sorted(set(rows.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    bounds = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))).cast("int")
    dealt = rows.select("doc_id", "text", part.alias("part"))
    heads = sorted(dealt.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("head")).select("part", "head.doc_id").collect())
    # each range's first row goes to the range before it as well, and the very first to the last
    own = dealt.withColumn("after", F.lit(0))
    first = dealt.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("head"))
    order = [h.part for h in heads]
    to = F.create_map(*[F.lit(x) for k, p in enumerate(order) for x in (p, order[k - 1])])
    guests = first.select("head.doc_id", "head.text", to[F.col("part")].cast("int").alias("part"), F.lit(1).alias("after"))
    ranged = own.unionByName(guests).repartition(len(order), "part").sortWithinPartitions("part", "after", "doc_id", "text")
    return on_workers(
        ranged.select("doc_id", "text", "part"), _neighbours,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
