"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, beginnings of longer words (``STEMS`` bytes, so that inflected and unseen forms
share weight), word pairs and pairs with one word between them of a whole text, hashed to ``2 ** BITS``
places; letters A-Z are folded and outer punctuation is no part of a word. Training takes a bounded
sample of labelled rows (``SAMPLE_ROWS``, by a hash of the id, so reruns take the same rows), in one task and in the
order of that hash, which Spark sorts; the task keeps no rows. Each coordinate has its own learning rate, and L1 leaves few weights: the model is a sorted
array of places and weights whose size is bounded by ``2 ** BITS`` however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, small_batches
from ledgerlake.llm.words import mix, slices, span_hash, words_of

BITS = 20
SAMPLE_ROWS = 30_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2.0, 1.0
EPOCHS = 2
SLICE = 512 << 10  # bytes of text worked on at once
THRESHOLD = 0.3
STEMS = (4, 6)
OUTER = b".,;:!?\"'()[]|"  # taken off both ends of a word


@dataclass(frozen=True)
class Weights:
    """Logistic model: ``places`` (sorted) and their ``values``; every other place weighs nothing."""

    bias: float
    places: np.ndarray
    values: np.ndarray


def _trimmed(batch: pa.RecordBatch):
    words = words_of(batch.column(batch.schema.get_field_index("text")))
    outer = np.zeros(256, dtype=bool)
    outer[list(OUTER)] = True
    start, end = words.start.copy(), words.end.copy()
    for _ in range(3):  # "word.", "word!!", "(word)," and the like
        some = (end - start > 1) & outer[words.data[np.minimum(end - 1, len(words.data) - 1)]] if len(end) else np.zeros(0, dtype=bool)
        end[some] -= 1
        some = (end - start > 1) & outer[words.data[start]] if len(start) else some
        start[some] += 1
    return words, start, end


def features(batch: pa.RecordBatch, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of every feature of a batch's texts, repeats included."""
    words, start, end = _trimmed(batch)
    h = span_hash(words.data, start, end, True) if len(start) else np.zeros(0, dtype=np.uint64)
    doc = words.text_of()
    parts, owners = [mix(h, 1)], [doc]
    for length in STEMS:
        longer = end - start > length
        if longer.any():
            parts.append(mix(span_hash(words.data, start[longer], start[longer] + length, True), 10 + length))
            owners.append(doc[longer])
    for gap, seed in ((1, 2), (2, 3)):
        if len(h) > gap:
            same = doc[:-gap] == doc[gap:]
            parts.append(mix(mix(h[:-gap], seed) + h[gap:], seed)[same])
            owners.append(doc[:-gap][same])
    return np.concatenate(owners), (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64)


def fit_ftrl(
    rows: Iterator[tuple[np.ndarray, int]], bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2
) -> Weights:
    """One pass of FTRL-proximal over ``(distinct places, label)``. The bias is not regularised."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias, bias_n = 0.0, 0.0
    for places, label in rows:
        zi, ni = z[places], n[places]
        root = np.sqrt(ni)
        w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
        p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30)))
        g = p - label
        z[places] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
        n[places] = ni + g * g
        bias_n += g * g
        bias -= alpha * g / (beta + bias_n**0.5)
    root = np.sqrt(n)
    weights = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + root) / alpha + l2))
    places = np.flatnonzero(weights)
    return Weights(bias, places, weights[places])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of training, each epoch's after the one before -> the model. Rows are not kept."""

    def rows() -> Iterator[tuple[np.ndarray, int]]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                doc, place = features(part)
                by = np.argsort(doc, kind="stable")
                place = place[by]
                cut = np.searchsorted(doc[by], np.arange(part.num_rows + 1))
                for k, label in enumerate(part.column(part.schema.get_field_index("label")).to_pylist()):
                    yield np.unique(place[cut[k] : cut[k + 1]]), int(label)

    model = fit_ftrl(rows())
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.bias]), pa.array([model.places.astype(np.int64).tobytes()], pa.binary()), pa.array([model.values.tobytes()], pa.binary())],
        names=["bias", "places", "weights"],
    )


def train(docs: DataFrame, labels: DataFrame, usable: Column, most: int = SAMPLE_ROWS) -> Weights:
    """Model of ``labels.toxic`` from rows of ``docs`` for which ``usable`` holds.

    At most about ``most`` rows are taken, those with the least hashes of their ids. Rows without a label or
    text count not at all or as empty; without any labelled row the model says 0.5 of everything. An id
    labelled twice counts as toxic if one label says so; of rows that share an id the least text is taken, so the bound holds for rows.
    """
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = marked.filter(usable)
    total = chosen.count()
    share = min(1.0, most / total) if total else 1.0
    key = F.xxhash64(F.col("doc_id"), F.lit(7))
    sample = chosen.withColumn("key", key).filter(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "label", "key").agg(F.min("text").alias("text"))
    # bounded by `most` rows; the model needs them in one order, once for each epoch
    epochs = rows.repartition(1).withColumn("epoch", F.explode(F.array(*[F.lit(k) for k in range(EPOCHS)])))
    ordered = epochs.sortWithinPartitions("epoch", "key", "doc_id").select("text", "label")
    got = on_workers(ordered, _train, "bias double, places binary, weights binary").first()
    if got is None:  # no row at all: no task ran
        return Weights(0.0, np.zeros(0, dtype=np.int64), np.zeros(0))
    return Weights(got.bias, np.frombuffer(got.places, dtype=np.int64), np.frombuffer(got.weights))


def _probability(batch: pa.RecordBatch, dense: np.ndarray, bias: float) -> np.ndarray:
    doc, place = features(batch)
    some = dense[place] != 0
    pairs = np.unique(doc[some].astype(np.int64) << BITS | place[some])
    total = np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=batch.num_rows)
    return 1 / (1 + np.exp(-np.clip(bias + total, -30, 30)))


def score(docs: DataFrame, model: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``. Null and empty texts get the bias alone."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[model.places] = model.values
        for batch in batches:
            for part in slices(batch, most=SLICE):
                p = _probability(part, dense, model.bias)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return on_workers(docs.select("doc_id", "text"), scored, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that the model does not predict as toxic, all columns as they are. Nothing is shuffled."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[model.places] = model.values
        for batch in batches:
            for part in slices(batch, most=SLICE):
                yield part.filter(pa.array(_probability(part, dense, model.bias) < threshold))

    # a dot in a column's name would be taken for a field of a struct on the way to the workers
    plain = docs.toDF(*[f"column_{k}_" if set(c) & set(".`") else c for k, c in enumerate(docs.columns)])
    return on_workers(plain, kept, plain.schema).toDF(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``: trained on labelled rows that are not ``held_out``, scoring all rows."""
    model = train(docs, labels, ~held_out)
    return score(docs, model, threshold).select("doc_id", held_out.alias("held_out"), "score", "predicted")
