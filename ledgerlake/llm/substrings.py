"""Substring dedup over a compacted De Bruijn graph of words.

Twenty consecutive words are an edge between the nodes of their first and last nineteen; a document is a walk. Words
under an edge that some document, or the same one, has walked before go. Four steps, all over whole texts:

1. *Seeds.* An edge's seed is the least hash of the ten-word grams in it: equal edges have equal seeds, and a walk changes its seed
   only about every sixth word. Seeds are counted by shards of their hash; edges whose seed occurs once in the corpus need not travel.
   Texts with the same words as one of a smaller id are copies: they go whole and do not travel either.
2. *Edges.* The other edges go to shards of their own hash, where each finds its first place (least id, least start).
   A slice of texts settles what repeats inside of it and asks for every seed and edge once, so an edge that all documents
   have reaches its shard once for each slice.
3. *Paths.* Edges with an earlier place are compacted: as long as the next edge of the walk is the next edge at the source too, the node
   between them does not branch and both belong to one path, ``id, start, n`` and its source's coordinates.
4. *Proof.* Paths are joined with the texts of their sources, which digest the words at those coordinates, and then with
   their own: only where both digests agree are words taken out. Hashes of 64 bits alone would err at some trillion words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, staged
from ledgerlake.llm.words import Words, joined, mix, slices, words_of
from ledgerlake.operators.joins import join_dim

EDGE = 20
SEED = 10
SLICE = 1 << 20
SHARD_BYTES = 8 << 20  # bytes of text whose seeds or edges a shard takes, on average
HOT_ROWS = 100_000  # rows of one key in a join's task
BROADCAST = 1 << 20  # bytes of a table that a join sends to all, by the optimizer's estimate
NO_ID = -(2**63)  # rows without an id come before all others
_NOTHING = hashlib.sha256(b"").hexdigest()


def gram_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbouring word hashes, put together from widths that are powers of two."""
    if len(h) < width:
        return np.zeros(0, dtype=np.uint64)
    done, at, piece, size = None, 0, h, 1
    while at < width:
        if width & size:
            tail = piece[at:]
            done = tail if done is None else mix(mix(done[: len(tail)], 11) + tail, size)
            at += size
        piece = mix(mix(piece[:-size], 12) + piece[size:], size)
        size *= 2
    return done


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least of every ``width`` neighbouring values."""
    place, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = place[:-step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        have += step
    return place


def _edges(words: Words, edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all edges inside texts, the place of each one's seed, and the hashes of all grams of a seed's width."""
    last = np.repeat(words.first[1:], np.diff(words.first))
    at = np.flatnonzero(np.arange(len(last)) + edge <= last)
    width = min(SEED, edge)
    grams = gram_hash(words.hashes, width)
    return at, least_places(grams, edge - width + 1)[at] if len(at) else at, grams


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(h, 77) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _grouped(*by: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Places of equal values, for each combination of them; within one in their order."""
    if not len(by[0]):
        return
    order = np.lexsort(by[::-1])
    sorted_by = [b[order] for b in by]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([np.diff(b) != 0 for b in sorted_by])
    begin = np.flatnonzero(new)
    for a, b in zip(begin, np.append(begin[1:], len(order))):
        yield tuple(int(s[a]) for s in sorted_by), order[a:b]


def _numbers(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a binary column, one row after the other, and each row's count."""
    parts = [np.frombuffer(x.as_buffer(), dtype=kind) for x in column]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=kind)), np.array([len(p) for p in parts], dtype=np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID))


def _slice_number(ids: list, keys: list) -> int:
    return int.from_bytes(hashlib.blake2b(repr((ids, keys)).encode(), digest_size=8).digest(), "little", signed=True)


_SCANNED = "shard int, slice long, no int, doc_id long, key long, n_words long, words_sha256 string, seeds binary, who binary"
_SEEDED = "slice long, no int, doc_id long, key long, n_words long, words_sha256 string, seeds binary, who binary"
_HITS = "slice long, no int, seeds binary"


def _rows(names: str, columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _scan(edge: int, shards: int):
    """``doc_id, key, text`` -> a row for each document, with its seeds known to repeat, and rows of seeds for the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                words = words_of(part.column(2), fold=False)
                _, place, grams = _edges(words, edge)
                place = place[np.append(True, place[1:] != place[:-1])] if len(place) else place
                seed, doc = grams[place], words.text_of()[place].astype(np.int32)
                values, where, counts = np.unique(seed, return_inverse=True, return_counts=True)
                many = counts[where] > 1
                here = dict.fromkeys(range(part.num_rows), b"")
                here.update((k, np.unique(seed[many][some]).tobytes()) for (k,), some in _grouped(doc[many]))
                ids, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
                number = _slice_number(ids, keys)
                texts = joined(words, np.arange(len(words.hashes)), words.first)
                n = part.num_rows
                yield _rows(_SCANNED, [
                    [number % shards] * n, [number] * n, range(n), ids, keys, np.diff(words.first),
                    [hashlib.sha256(t).hexdigest() for t in texts], list(here.values()), [None] * n,
                ])
                # seeds that occur here once are asked for; others are only announced
                sent = np.concatenate([seed[~many], values[counts > 1]])
                who = np.concatenate([doc[~many], np.full(int((counts > 1).sum()), -1, dtype=np.int32)])
                rows = [(s, number, sent[some].tobytes(), who[some].tobytes()) for (s,), some in _grouped(_shard(sent, shards))]
                if rows:
                    s, numbers, seeds, whose = zip(*rows)
                    none = [None] * len(rows)
                    yield _rows(_SCANNED, [s, numbers, none, none, none, none, none, seeds, whose])

    return run


def _seeded(t: pa.Table) -> pa.Table:
    """A shard's rows -> the documents' rows as they are, and for each slice the seeds that occur elsewhere too, with their documents."""
    names = [f.split()[0] for f in _SEEDED.split(", ")]
    documents = t.filter(pc.is_valid(t["words_sha256"])).select(names)
    asked = t.filter(pc.is_valid(t["who"]))
    seeds, lengths = _numbers(asked["seeds"], np.uint64)
    who, _ = _numbers(asked["who"], np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    _, where, counts = np.unique(seeds, return_inverse=True, return_counts=True)
    known = np.zeros(len(counts), dtype=bool)
    known[where[who < 0]] = True
    hit = (who >= 0) & (known | (counts > 1))[where] if len(seeds) else np.zeros(0, dtype=bool)
    seeds, row, who = seeds[hit], row[hit], who[hit]
    numbers = np.asarray(asked["slice"])
    found = [(int(numbers[r]), seeds[some].tobytes(), who[some].tobytes()) for (r,), some in _grouped(row)]
    columns = [list(c) for c in zip(*found)] if found else [[], [], []]
    none = [None] * len(found)
    rows = _rows(_SEEDED, [columns[0], none, none, none, none, none, columns[1], columns[2]])
    return pa.concat_tables([documents, pa.Table.from_batches([rows])])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``slice, found`` -> a row for each document of the slice with its seeds."""
    for batch in batches:
        for number, found in zip(*(c.to_pylist() for c in batch.columns)):
            seeds, who = (np.concatenate([np.frombuffer(f[c], dtype=k) for f in found]) for c, k in (("seeds", np.uint64), ("who", np.int32)))
            rows = [(number, w, seeds[some].tobytes()) for (w,), some in _grouped(who)]
            yield _rows(_HITS, list(zip(*rows)))


_SENT = "shard int, slice long, edges binary, used binary, ids binary, keys binary, doc binary, pos binary, src binary, src_pos binary"
_ANSWERS = "slice long, ids binary, keys binary, doc binary, pos binary, src binary, src_pos binary"


def _walk(edge: int, shards: int):
    """``id, key, text, seeds`` -> a row for each slice, with what it can answer itself, and its other edges for the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                words = words_of(part.column(2), fold=False)
                at, place, grams = _edges(words, edge)
                wanted = [np.frombuffer(x, dtype=np.uint64) for row in part.column(3).to_pylist() for x in row]
                at = at[np.isin(grams[place], np.concatenate(wanted))] if wanted and len(at) else at[:0]
                if not len(at):
                    continue
                h = gram_hash(words.hashes, edge)[at]
                doc = words.text_of()[at].astype(np.int32)
                pos = (at - words.first[doc]).astype(np.int32)
                ids, keys = np.asarray(part.column(0)), np.asarray(part.column(1))
                source = _first_places(h, ids[doc], pos)
                later = (ids[doc] != ids[doc][source]) | (pos != pos[source])
                of = source[later]
                number = _slice_number(ids.tolist(), keys.tolist())
                rows = [(
                    number % shards, number, None, None, ids.tobytes(), keys.tobytes(),
                    doc[later].tobytes(), pos[later].tobytes(), ids[doc[of]].tobytes(), pos[of].tobytes(),
                )]
                h, doc, pos = h[~later], doc[~later], pos[~later]
                for (s,), some in _grouped(_shard(h, shards)):
                    used = np.unique(doc[some])
                    rows.append((s, number, h[some].tobytes(), used.tobytes(), ids[used].tobytes(), None, doc[some].tobytes(), pos[some].tobytes(), None, None))
                yield _rows(_SENT, list(zip(*rows)))

    return run


def _first_places(h: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For every edge the place of an equal one of the least id and start."""
    order = np.lexsort((pos, ids, h))
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[order][1:] != h[order][:-1]
    group = np.cumsum(new) - 1
    out = np.empty(len(h), dtype=np.int64)
    out[order] = order[np.flatnonzero(new)][group]
    return out


def _answers(t: pa.Table) -> pa.Table:
    """A shard's rows -> the slices' rows as they are, and for each slice the places of edges that start earlier elsewhere, and where."""
    names = [f.split()[0] for f in _ANSWERS.split(", ")]
    done = t.filter(pc.is_null(t["edges"])).select(names)
    asked = t.filter(pc.is_valid(t["edges"]))
    h, lengths = _numbers(asked["edges"], np.uint64)
    doc, _ = _numbers(asked["doc"], np.int32)
    pos, _ = _numbers(asked["pos"], np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    ids = np.zeros(len(h), dtype=np.int64)
    at = 0
    for used, of, n in zip(asked["used"], asked["ids"], lengths):
        ids[at : at + n] = np.frombuffer(of.as_buffer(), dtype=np.int64)[np.searchsorted(np.frombuffer(used.as_buffer(), dtype=np.int32), doc[at : at + n])]
        at += n
    source = _first_places(h, ids, pos)
    later = np.flatnonzero((ids != ids[source]) | (pos != pos[source]))
    numbers = np.asarray(asked["slice"])
    found = []
    for (r,), some in _grouped(row[later]):
        mine, of = later[some], source[later[some]]
        found.append((int(numbers[r]), None, None, doc[mine].tobytes(), pos[mine].tobytes(), ids[of].tobytes(), pos[of].tobytes()))
    rows = _rows(_ANSWERS, [list(c) for c in zip(*found)] if found else [[]] * len(names))
    return pa.concat_tables([done, pa.Table.from_batches([rows])])


_PATH = "id long, key long, start long, n long, src long, src_start long"
_PLACE = (("doc", np.int32), ("pos", np.int32), ("src", np.int64), ("src_pos", np.int32))


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids, keys, places`` of slices -> paths: stretches of edges along which the walk and its source go on together."""
    for batch in batches:
        for ids, keys, places in zip(*(c.to_pylist() for c in batch.columns)):
            doc, pos, src, of = (np.concatenate([np.frombuffer(p[c], dtype=k) for p in places]).astype(np.int64) for c, k in _PLACE)
            order = np.lexsort((of, src, pos, doc))
            order = order[np.append(True, (np.diff(pos[order]) != 0) | (np.diff(doc[order]) != 0))[: len(order)]]
            if not len(order):
                continue
            doc, pos, src, of = doc[order], pos[order], src[order], of[order]
            new = np.append(True, (np.diff(doc) != 0) | (np.diff(pos) != 1) | (src[1:] != src[:-1]) | (np.diff(of) != 1))
            begin = np.flatnonzero(new)
            whose = doc[begin]
            yield _rows(_PATH, [
                np.frombuffer(ids, dtype=np.int64)[whose], np.frombuffer(keys, dtype=np.int64)[whose], pos[begin], np.diff(np.append(begin, len(pos))), src[begin], of[begin],
            ])


def _spans(words: Words, spans: list[list[tuple[int, int]]], edge: int) -> list[int]:
    """Digest of the words of each span (start, edges) of every text; a span that is not in its text has digest 0."""
    index, lengths, inside = [], [0], []
    for k, some in enumerate(spans):
        a, b = int(words.first[k]), int(words.first[k + 1])
        for start, n in some:
            fits = a + start + n + edge - 1 <= b
            inside.append(fits)
            index.append(np.arange(a + start, a + start + n + edge - 1) if fits else np.zeros(0, dtype=np.int64))
            lengths.append(len(index[-1]))
    texts = joined(words, np.concatenate(index) if index else np.zeros(0, dtype=np.int64), np.cumsum(lengths))
    return [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) if ok else 0 for t, ok in zip(texts, inside)]


def _sources(edge: int):
    """``id, text, spans`` of sources -> ``src, src_start, n, proof``: the digest of the words at each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                spans = [[(s["src_start"], s["n"]) for s in row] for row in part.column(2).to_pylist()]
                proofs = _spans(words_of(part.column(1), fold=False), spans, edge)
                flat = [(i, s, n) for i, some in zip(part.column(0).to_pylist(), spans) for s, n in some]
                yield _rows("src long, src_start long, n long, proof long", [*([f[k] for f in flat] for k in range(3)), proofs])

    return run


_KEPT = "id long, key long, n_removed long, kept string"


def _take_out(edge: int):
    """``id, key, text, paths`` -> the text's words without those under proved paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE):
                words = words_of(part.column(2), fold=False)
                paths = part.column(3).to_pylist()
                proofs = iter(_spans(words, [[(p["start"], p["n"]) for p in row] for row in paths], edge))
                gone = np.zeros(len(words.hashes) + 1, dtype=np.int64)
                for k, row in enumerate(paths):
                    for p in row:
                        if next(proofs) in p["proofs"]:
                            gone[words.first[k] + p["start"]] += 1
                            gone[words.first[k] + p["start"] + p["n"] + edge - 1] -= 1
                stays = np.cumsum(gone)[:-1] == 0
                ends = np.concatenate([[0], np.cumsum(stays)])[words.first]
                texts = joined(words, np.flatnonzero(stays), ends)
                yield _rows(_KEPT, [part.column(0), part.column(1), np.diff(words.first) - np.diff(ends), [t.decode() for t in texts]])

    return run


def _shards(texts: DataFrame) -> int:
    return (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES + 1


def repeated_paths(docs: DataFrame, edge: int = EDGE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, texts and paths of the compacted graph of ``docs`` (``doc_id``, ``text``).

    Documents: a row per row, ``id`` (``doc_id``, or ``NO_ID``), ``key`` (hash of the text), ``n_words``, ``words_sha256``, and ``first_id``, the
    least id with the same words if there are ``edge`` at least. Texts: ``id, key, text`` of documents that can hold a repeated edge and are no copies.
    Paths: ``id, key, start, n, src, src_start, proofs``: ``n`` edges from word ``start`` on are also at word ``src_start`` of the document ``src``; ``proofs`` are
    digests of the words there.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    scanned = on_workers(keyed, _scan(edge, _shards(docs)), _SCANNED)
    seeded = staged(scanned.groupBy("shard").applyInArrow(_seeded, _SEEDED), "seeded")
    rows = seeded.filter("words_sha256 is not null").select("slice", "no", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "doc_id", "key", "n_words", "words_sha256")
    firsts = rows.filter(F.col("n_words") >= edge).groupBy("words_sha256").agg(F.min("id").alias("first_id"))
    known = staged(join_dim(rows, firsts, ["words_sha256"], spread_by=["id", "key"], least_rows=HOT_ROWS, limit=BROADCAST), "known")
    # what a slice knew itself, and what the shards found, by slices and then by documents
    found = seeded.filter("who is not null").groupBy("slice").agg(F.collect_list(F.struct("seeds", "who")).alias("found"))
    own = seeded.filter("words_sha256 is not null and octet_length(seeds) > 0").select("slice", "no", "seeds")
    hits = on_workers(found, _by_document, _HITS).unionByName(own).groupBy("slice", "no").agg(F.collect_list("seeds").alias("seeds"))
    wanted = known.filter("id = first_id").join(hits, ["slice", "no"]).select("id", "key", "seeds").dropDuplicates(["id", "key"])
    texts = staged(keyed.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key", "text").join(wanted, ["id", "key"]), "texts")
    sent = on_workers(texts.select("id", "key", "text", "seeds"), _walk(edge, _shards(texts)), _SENT)
    answers = staged(sent.groupBy("shard").applyInArrow(_answers, _ANSWERS), "answers")
    places = answers.groupBy("slice").agg(
        F.max("ids").alias("ids"), F.max("keys").alias("keys"), F.collect_list(F.struct("doc", "pos", "src", "src_pos")).alias("places")
    )
    paths = staged(on_workers(places.select("ids", "keys", "places"), _compact, _PATH), "paths")
    claims = paths.select("src", "src_start", "n").distinct().groupBy("src").agg(F.collect_list(F.struct("src_start", "n")).alias("spans"))
    claimed = texts.select("id", "text").join(claims, F.col("id") == F.col("src")).select("id", "text", "spans")
    proofs = staged(
        on_workers(claimed, _sources(edge), "src long, src_start long, n long, proof long")
        .groupBy("src", "src_start", "n").agg(F.collect_set("proof").alias("proofs")), "proofs",
    )
    proved = join_dim(paths, proofs, ["src", "src_start", "n"], how="inner", spread_by=["id", "key", "start"], least_rows=HOT_ROWS, limit=BROADCAST)
    return known.drop("slice", "no"), texts.drop("seeds"), proved


def without_repeats(docs: DataFrame, edge: int = EDGE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` for every row of ``docs`` (``doc_id``, ``text``).

    Every word goes that is under ``edge`` consecutive words which also start earlier: in a document of a smaller id, or in the same one before. Words are runs of
    ``[^\\x20\\x09-\\x0D]``, compared unchanged. ``kept`` has the words that stay, by one space, where some went, and is null where all stayed or
    all went as a copy. Rows without an id come before all others. Rows that share an id are not earlier than each
    other, except at earlier starts; so equal rows have equal results. Null and wordless texts have no words; other columns are not looked at; an empty
    table gives no rows.
    """
    known, texts, paths = repeated_paths(docs, edge)
    mine = paths.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n", "proofs")).alias("paths"))
    cut = on_workers(texts.join(mine, ["id", "key"]).select("id", "key", "text", "paths"), _take_out(edge), _KEPT).dropDuplicates(["id", "key"])
    copy = F.coalesce(F.col("id") > F.col("first_id"), F.lit(False))
    return known.join(cut, ["id", "key"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"), "kept",
        F.when(copy, F.lit(_NOTHING)).when(F.col("kept").isNull(), F.col("words_sha256")).otherwise(F.sha2(F.col("kept").cast("binary"), 256)).alias("kept_sha256"),
    )
