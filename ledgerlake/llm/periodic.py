"""Periodic runs of words, by seeds on diagonals.

A run is a stretch of words that repeats with its smallest period ``q``, at least ``max(6, 4 * q)`` long, and that no
neighbouring word continues. On the diagonal of lag q it gives at least 3 q matching places (5 for q = 1). Lags are
taken by octaves: a run of a lag from Q to 2 Q - 1 holds a k-gram of k = 3 Q words (5 for Q = 1) and, since k is no less than the period, that k-gram's next
occurrence in the document is exactly one period on. So only neighbouring occurrences are
paired, and a text that is one word a million times gives a million pairs and not their square. A k-gram that occurs once in its document is
no part of a longer one that occurs twice, so every octave looks only at what the one before it left.

Seeds of one lag in a row are one stretch; it is extended in both directions, and a table of how far each
(document, lag) is covered keeps later seeds from being extended again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import on_workers
from ledgerlake.llm.words import joined, mix, slices, window_hash, words_of

LEAST = 6  # words of a run
REPEATS = 4
_STEP = 4_096


def _matching(h: np.ndarray, at: int, lag: int, low: int, high: int, step: int) -> int:
    """Number of matches on the diagonal from ``at`` on, upwards (step 1, below ``high``) or downwards (step -1, from ``low`` on)."""
    found, size = 0, 16
    while True:
        if step > 0:
            a, b = at + found, min(at + found + size, high - lag)
        else:
            a, b = max(low, at - found - size + 1), at - found + 1
        if a >= b:
            return found
        same = h[a:b] == h[a + lag : b + lag]
        if step < 0:
            same = same[::-1]
        if not same.all():
            return found + int(np.argmin(same))
        found += b - a
        size = min(2 * size, _STEP)


def runs_of(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``text, start, length, period`` of all runs, by text, start and period. Text i has the word hashes ``h[first[i]:first[i + 1]]``."""
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(first[1:], counts)
    found: list[tuple[int, int, int, int]] = []
    at = np.arange(len(h))  # places whose k-grams can occur twice
    grams, width = h, 1  # hashes of `width` words
    while len(at) and REPEATS * width <= counts.max(initial=0):
        k = 3 * width if width > 1 else LEAST - 1
        at = at[at + k <= last[at]]
        if width == 1:
            seed = window_hash(h, k)[at]
        else:
            seed = mix(mix(mix(grams[at], 1) + grams[at + width], 2) + grams[at + 2 * width], 3)
        seed = mix(seed + mix(text[at].astype(np.uint64), 7))
        order = np.argsort(seed, kind="stable")  # places of one k-gram stay in order
        twin = seed[order][1:] == seed[order][:-1]
        here, there = at[order][:-1][twin], at[order][1:][twin]
        lag = there - here
        near = (lag >= width) & (lag < 2 * width)
        found += _extended(h, first, text, here[near], lag[near], k)
        at = np.unique(np.concatenate([here, there]))
        if len(grams) > width:
            grams = mix(mix(grams[:-width], 4) + grams[width:], 5)
        width *= 2
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 4)


def _extended(h: np.ndarray, first: np.ndarray, text: np.ndarray, here: np.ndarray, lag: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    order = np.lexsort((here, lag))
    here, lag = here[order], lag[order]
    of = text[here]
    new = np.ones(len(here), dtype=bool)
    new[1:] = (np.diff(here) != 1) | (np.diff(lag) != 0) | (np.diff(of) != 0)
    begin = np.flatnonzero(new)
    covered: dict[tuple[int, int], int] = {}
    out = []
    for a, b in zip(begin, np.append(begin[1:], len(here))):
        t, q, low, high = int(of[a]), int(lag[a]), int(here[a]), int(here[b - 1]) + k
        if covered.get((t, q), -1) >= high:
            continue
        low -= _matching(h, low - 1, q, int(first[t]), int(first[t + 1]), -1)
        high += _matching(h, high, q, int(first[t]), int(first[t + 1]), 1)
        covered[t, q] = high
        if high - low + q >= max(LEAST, REPEATS * q):
            out.append((t, low - int(first[t]), high - low + q, q))
    return out


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """Word numbers of a text of ``n`` words after the test's repetition, drawn from the id's checksum; a text without an id stays."""
    index = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        index[a:] = a + (index[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return index


Edit = Callable[[int | None, int], np.ndarray]


def _found(batches: Iterator[pa.RecordBatch], edit: Edit | None) -> Iterator[tuple[list, list[np.ndarray], list[bytes]]]:
    """Ids, runs and collapsed texts of ``doc_id, text``."""
    for batch in batches:
        for part in slices(batch):
            words = words_of(part.column(part.schema.get_field_index("text")), fold=False)
            ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            index = np.arange(len(words.hashes))
            if edit is not None:
                for doc_id, a, b in zip(ids, words.first[:-1], words.first[1:]):
                    index[a:b] = a + edit(doc_id, int(b - a))
            runs = runs_of(words.hashes[index], words.first)
            kept = np.ones(len(index), dtype=bool)
            for t, start, length, period in runs:
                kept[words.first[t] + start + period : words.first[t] + start + length] = False
            ends = np.concatenate([[0], np.cumsum(kept)])[words.first]
            cuts = np.searchsorted(runs[:, 0], np.arange(len(ids) + 1))
            yield ids, [runs[a:b, 1:] for a, b in zip(cuts, cuts[1:])], joined(words, index[kept], ends)


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``doc_id, runs array<struct<start, length, period>>, collapsed`` for every row of ``docs`` (``doc_id``, ``text``).

    Words are runs of ``[^\\x20\\x09-\\x0D]``, numbered from 0 and compared unchanged. Runs come by start, then period. ``collapsed`` is the text's words
    by one space, without those that a run contains after its first period. Null and wordless texts have no runs and an empty
    ``collapsed``; repeated rows are worked on each; other columns are not looked at; an empty table gives no rows. ``edit`` renumbers a text's words first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for ids, runs, collapsed in _found(batches, edit):
            rows = [[dict(zip(("start", "length", "period"), map(int, r))) for r in x] for x in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, kind), pa.array([c.decode() for c in collapsed])], names=["doc_id", "runs", "collapsed"]
            )

    return on_workers(docs.select("doc_id", "text"), run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(docs: DataFrame, edit: Edit | None = planted) -> DataFrame:
    """Number of runs, the run of the greatest exponent, and digests of all runs and of the collapsed text, for every row (see ``periodic_runs``)."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, runs, collapsed in _found(batches, edit):
            best = [max(x.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if len(x) else None for x in runs]
            columns = [
                ids, [len(x) for x in runs], *([b and b[k] for b in best] for k in range(3)), [b and 1000 * b[1] // b[2] for b in best],
            ]
            digests = [
                [hashlib.sha256("".join("%d,%d,%d\n" % tuple(r) for r in x.tolist()).encode()).hexdigest() for x in runs],
                [hashlib.sha256(c).hexdigest() for c in collapsed],
            ]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), *map(pa.array, digests)], names=names)

    return on_workers(docs.select("doc_id", "text"), run, ", ".join(f"{n} {'string' if n.endswith('256') else 'long'}" for n in names))
