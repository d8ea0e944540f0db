"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

A document's set is its distinct five-word shingles. 32 minima of hashed shingles, 16 bits of each, are
its signature; the distance of two signatures is the number of slots that differ. The slots are split
into six chunks. By the pigeonhole principle two signatures at a distance of at most 17 differ by at most
two slots in one chunk, so every chunk is written once for each pair of its slots left out: equal keys
then give all pairs within the distance. Documents with a similarity of 0.75 differ in 8 slots on
average and in more than 17 with a chance below 0.0003. A second signature, 4 bits of 256 minima, sorts
out pairs before sets are read: at 0.75 it differs in 128 bits, and in more than 192 with a chance of about 0.0001.

Equal sets are merged before. A key's documents are not paired with each other: all meet the least of
them, then, if they are not yet one component, the greatest. What still lies in different components is
compared exactly, but only pairs that can be similar: shingles that no other candidate has bound a document's
similarity to any other, and signatures must be near. In a group of copies that were edited ever more heavily
this leaves few pairs of the square. Links are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, small_batches, staged
from ledgerlake.llm.components import components
from ledgerlake.llm.words import Words, mix, slices, window_hash, words_of

WIDTH = 5
SLICE = 512 << 10  # bytes of text worked on at once
SIMILARITY = 75  # per cent
SLOTS = 32
CHUNKS = 6
RADIUS = 17
LANES = SLOTS // 4  # four 16-bit slots in a long
SIEVE = 256
SIEVE_RADIUS = 192
NIBBLES = SIEVE // 16  # sixteen 4-bit slots in a long
_FACTORS = np.random.default_rng(5).integers(1, 2**62, SIEVE, dtype=np.uint64) * np.uint64(4) + np.uint64(3)


_LANES = [f"l{k}" for k in range(LANES)]
_NIBBLES = [f"n{k}" for k in range(NIBBLES)]


def chunk_plan(slots: int = SLOTS, chunks: int = CHUNKS, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Slots of each chunk, and how many of them may differ. The allowances plus one each exceed the radius."""
    cuts = np.linspace(0, slots, chunks + 1).round().astype(int)
    allowed = [radius // chunks - (k > radius % chunks) for k in range(chunks)]
    return [(list(range(cuts[k], cuts[k + 1])), e) for k, e in enumerate(allowed) if e >= 0]


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, repeats included, and where each text's begin. A text with fewer words is one shingle."""
    counts = np.diff(words.first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=first[1:])
    rolled = window_hash(words.hashes, width)
    at = np.arange(first[-1]) - np.repeat(first[:-1], n) + np.repeat(words.first[:-1], n)
    out = np.zeros(first[-1], dtype=np.uint64)
    short = np.repeat((counts < width) & (counts > 0), n)
    out[~short] = rolled[at[~short]]
    for k in np.flatnonzero((counts < width) & (counts > 0)):
        h = np.zeros(1, dtype=np.uint64)
        for x in words.hashes[words.first[k] : words.first[k + 1]]:
            h = mix(h + x, 100 + int(counts[k]))
        out[first[k]] = h[0]
    return out, first


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, one text after the other."""
    words = words_of(batch.column(batch.schema.get_field_index("text")))
    all_of, first = shingles(words)
    sets = [np.unique(all_of[first[k] : first[k + 1]]) for k in range(len(first) - 1)]
    ends = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(s) for s in sets], out=ends[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), ends


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _digests(flat: np.ndarray, at: np.ndarray, some: np.ndarray) -> np.ndarray:
    digest = np.zeros((2, len(some)), dtype=np.uint64)
    if len(at):
        for k in range(2):
            digest[k, some] = np.add.reduceat(mix(flat, 1000 + k), at)
    return digest


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` -> ``doc_id, n_shingles, set_a, set_b, l0.., n0..``: size, 128-bit digest and signatures of each set. Columns after ``text`` come along."""
    for batch in batches:
        for part in slices(batch, most=SLICE):
            flat, ends = _sets(part)
            n = np.diff(ends)
            some = n > 0
            at = ends[:-1][some]
            digest = _digests(flat, at, some)
            lanes, sieve = np.zeros((LANES, len(n)), dtype=np.uint64), np.zeros((NIBBLES, len(n)), dtype=np.uint64)
            if len(at):
                for k in range(SLOTS):
                    least = np.minimum.reduceat(mix(flat, 1 + k), at) & np.uint64(0xFFFF)
                    lanes[k // 4, some] |= least << np.uint64(16 * (k % 4))
                for k in range(SIEVE):
                    least = mix(np.minimum.reduceat(flat * _FACTORS[k], at)) & np.uint64(0xF)
                    sieve[k // 16, some] |= least << np.uint64(4 * (k % 16))
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), pa.array(n), _long(digest[0]), _long(digest[1]), *map(_long, lanes), *map(_long, sieve), *part.columns[2:]],
                names=["doc_id", "n_shingles", "set_a", "set_b", *_LANES, *_NIBBLES, *part.schema.names[2:]],
            )


def chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, l0..`` -> ``doc_id, keys``: a key for every chunk and every choice of slots that may differ."""
    plan = chunk_plan()
    for batch in batches:
        lanes = [np.asarray(batch.column(batch.schema.get_field_index(f"l{k}"))).view(np.uint64) for k in range(LANES)]
        slot = [(lanes[k // 4] >> np.uint64(16 * (k % 4))) & np.uint64(0xFFFF) for k in range(SLOTS)]
        keys = []
        for where, errors in plan:
            for kept in combinations(where, len(where) - errors):
                h = np.full(batch.num_rows, len(keys), dtype=np.uint64)
                for k in kept:
                    h = mix(h * np.uint64(65536) + slot[k])
                keys.append(h)
        flat = np.stack(keys, axis=1).reshape(-1) if batch.num_rows else np.zeros(0, dtype=np.uint64)
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(keys))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("doc_id")), pa.ListArray.from_arrays(offsets, _long(flat))], names=["doc_id", "keys"]
        )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` -> ``doc_id, n_shingles, set_a, set_b, shingles``: size, digest, and the sorted set as bytes."""
    for batch in batches:
        for part in slices(batch, most=SLICE):
            flat, ends = _sets(part)
            n = np.diff(ends)
            digest = _digests(flat, ends[:-1][n > 0], n > 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), pa.array(n), *map(_long, digest), pa.array([flat[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "shingles"],
            )


def single_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, shingles`` -> one row ``doc_id, shingle`` for each."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column(1)]
        for at in range(0, len(sets), 256):
            part = sets[at : at + 256]
            ids = np.repeat(np.asarray(batch.column(0))[at : at + 256], [len(x) for x in part])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(part))], names=["doc_id", "shingle"])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b, shingles, other`` -> ``a, b, n_a, n_b, shared``: sizes of two sets and of what they share."""
    for batch in batches:
        column = {f: batch.column(k) for k, f in enumerate(batch.schema.names)}
        shared, sizes = np.zeros(batch.num_rows, dtype=np.int64), np.zeros((2, batch.num_rows), dtype=np.int64)
        for k, (a, b) in enumerate(zip(column["shingles"], column["other"])):
            x, y = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
            at = np.searchsorted(x, y)
            sizes[:, k] = len(y), len(x)
            shared[k] = np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y)
        yield pa.RecordBatch.from_arrays([column["a"], column["b"], pa.array(sizes[0]), pa.array(sizes[1]), pa.array(shared)], names=["a", "b", "n_a", "n_b", "shared"])


def _differing(left: str, right: str) -> Column:
    """Bits in which two sieve signatures differ. Kept short: the JVM interprets long conditions."""
    total = F.lit(0)
    for name in _NIBBLES:
        total = total + F.bit_count(F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}")))
    return total


def _similar(shared: Column, m: Column, n: Column, percent: int) -> Column:
    return shared * 100 >= (m + n - shared) * percent


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` and the long columns ``carry`` for every row of ``docs`` (``doc_id``, ``text``).

    Documents are linked from ``percent`` on, 75 or more. Null and wordless texts have an empty set and are linked
    with nothing. ``component_id`` is the least id that a document reaches, and ``kept`` marks that document;
    rows that repeat an id and its text are the same document, and texts that share an id are documents of their own. Rows without an id never become a class of
    others; unlinked, they are kept. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    signed = staged(on_workers(
        docs.select("doc_id", "text", *carry), sign,
        "doc_id long, n_shingles long, set_a long, set_b long, " + ", ".join(f"{c} long" for c in (*_LANES, *_NIBBLES, *carry)),
    ), "signed")
    # one row per set; its class's least document carries the signatures. Below, doc_id is the class's number: they rise with that
    # document's id, and texts that share an id have several
    least = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = staged(least.orderBy("rep", "set_a", "set_b", "n_shingles").withColumn("class", F.monotonically_increasing_id()), "classes")

    def by_class(df: DataFrame) -> DataFrame:
        """Rows of the classes' least documents, one each, with the class's number for the id."""
        of = classes.select(F.col("rep").alias("doc_id"), "set_a", "set_b", "n_shingles", "class")
        return df.join(of, ["doc_id", "set_a", "set_b", "n_shingles"]).dropDuplicates(["class"]).drop("doc_id", "set_a", "set_b").withColumnRenamed("class", "doc_id")

    reps = staged(by_class(signed.drop(*carry)), "reps")
    keyed = on_workers(reps.select("doc_id", *_LANES), chunk_keys, "doc_id long, keys array<long>").select("doc_id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")).filter("n > 1")
    members = staged(keyed.join(shared.drop("n"), "key"), "members")
    wanted = members.select("doc_id").distinct()
    sieves = staged(reps.select("doc_id", "n_shingles", *_NIBBLES).join(wanted, "doc_id", "left_semi"), "sieves")
    wanted_ids = classes.join(wanted, F.col("class") == F.col("doc_id"), "left_semi").select(F.col("rep").alias("doc_id"))
    sets = staged(by_class(on_workers(
        docs.select("doc_id", "text").join(wanted_ids, "doc_id", "left_semi"), full_sets, "doc_id long, n_shingles long, set_a long, set_b long, shingles binary"
    )).drop("n_shingles"), "sets")

    def linked(pairs: DataFrame, sieved: bool) -> DataFrame:
        """Links ``a, b`` among the pairs. The sets of ``b`` travel, those of ``a`` wait."""
        if not sieved:
            pairs = pairs.join(sieves.alias("x"), F.col("a") == F.col("x.doc_id")).join(
                sieves.alias("y"), (F.col("b") == F.col("y.doc_id")) & (_differing("x", "y") <= SIEVE_RADIUS)
            ).select("a", "b")
        with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), "shingles"), "b")
        with_a = with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("other")), "a")
        sized = on_workers(with_a.select("a", "b", "shingles", "other"), _measured, "a long, b long, n_a long, n_b long, shared long")
        return staged(sized.filter(_similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b"), "near")

    found = staged(components(linked(members.filter("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct(), False)), "found")

    def open_members(of: DataFrame, name: str) -> DataFrame:
        """Rows of keys whose documents are not yet one component."""
        placed = of.join(found, of.doc_id == found.node, "left").select(*of.columns, F.coalesce("component", "doc_id").alias("component"))
        several = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1").select("key")
        return staged(placed.join(several, "key", "left_semi"), name)

    first_open = open_members(members, "open")
    candidates = sets.join(first_open.select("doc_id").distinct(), "doc_id", "left_semi")
    lonely = on_workers(candidates.select("doc_id", "shingles"), single_shingles, "doc_id long, shingle long").groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id")
    ).filter("n = 1").groupBy("doc_id").agg(F.count("*").alias("lonely"))
    # what a document can share with any other
    shareable = staged(sieves.join(candidates.select("doc_id"), "doc_id").join(lonely, "doc_id", "left").withColumn(
        "most", F.col("n_shingles") - F.coalesce("lonely", F.lit(0))
    ).drop("lonely").filter(F.col("most") * 100 >= F.col("n_shingles") * percent), "shareable")
    hopeful = first_open.drop("component").join(shareable.select("doc_id"), "doc_id", "left_semi")
    for last in (False, True):
        rest = open_members(hopeful, "rest")
        if not last:
            ends = rest.groupBy("key").agg(F.max_by(F.struct("doc_id", "component"), "doc_id").alias("top"))
            tops = ends.select("key", F.col("top.doc_id").alias("a"), F.col("top.component").alias("ca"))
            pairs = rest.join(tops, "key").filter("component <> ca").select("a", F.col("doc_id").alias("b")).distinct()
        else:
            # of two documents in different components, one at least is outside the key's largest
            main = rest.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
            keys_of = rest.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))  # a document's keys: 70 at most
            side = rest.join(main, "key").join(keys_of, "doc_id").withColumn("minor", F.col("component") != F.col("main")).drop("main", "low").join(shareable, "doc_id")
            x, y = side.filter("minor").alias("x"), side.alias("y")
            once = ~F.col("y.minor") | (F.col("x.doc_id") < F.col("y.doc_id"))
            possible = _similar(F.least("x.most", "y.most"), F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
            # a pair meets in the least of its keys only
            first = F.col("x.key") == F.array_min(F.array_intersect("x.keys", "y.keys"))
            pairs = x.join(
                y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & once & possible
                & (_differing("x", "y") <= SIEVE_RADIUS) & first
            ).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        more = linked(pairs, last)
        if more.head(1):
            spokes = found.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = staged(components(more.unionByName(spokes)), "found")

    placed = classes.join(found, F.col("class") == found.node, "left").withColumn("component", F.coalesce("component", "class"))
    least = placed.join(classes.select(F.col("class").alias("first"), F.col("rep").alias("least")), F.col("component") == F.col("first")).select(
        "set_a", "set_b", F.col("n_shingles").alias("n"), "least", (F.col("class") == F.col("first")).alias("leads")
    )
    of = signed.select("doc_id", "n_shingles", *carry, F.col("set_a").alias("s_a"), F.col("set_b").alias("s_b"))
    out = of.join(least, (F.col("s_a") == F.col("set_a")) & (F.col("s_b") == F.col("set_b")) & (F.col("n_shingles") == F.col("n")), "left")
    component = F.coalesce("least", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.when(component.isNull(), True).otherwise(F.coalesce((F.col("doc_id") == component) & F.coalesce("leads", F.lit(True)), F.lit(False))).alias("kept"), *carry,
    )
