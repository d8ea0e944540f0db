"""LM scoring: a trigram model over sharded Elias-Fano tries.

Three passes, each over written tables. (1) Texts become blocks: a block's distinct word hashes, and its texts as places in
that list. (2) Blocks send their words, each once, to shards that add up training counts, number the words by falling
count and answer. (3) Blocks work out the base score and send their distinct events (word two before, word before, word), each once
with its training count, to the shard of the word before. A shard builds the trie of its training events, writes it to the
model table, maps it into memory and scores each distinct event; a block deals its answers out to its tokens.

Smoothing is interpolated absolute discounting over the base unigram. A word before, or the beginning of a text, with
``CONTEXT_EVENTS`` training events or more is split by the other two words. Its counts are then added up over all
parts first, in a table of distinct events, and every part gets these exact figures: probabilities do not depend on the split.
A shard holds each distinct event of its contexts at most once a block. Shards grow in number with the corpus.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import on_workers, remainder, staged
from ledgerlake.llm.ngram_trie import STEP, Trie, quantise
from ledgerlake.llm.words import mix, slices, words_of

BLOCK_BYTES = 8 << 20
SHARD_WORDS = 400_000  # words of blocks in a vocabulary shard
SHARD_EVENTS = 1_500_000
CONTEXT_EVENTS = 500_000
SMOOTHING = 0.5
END, BEGIN = np.uint64(1), np.uint64(2)  # hashes that stand for the end and the beginning of a text


def _pack(x: np.ndarray) -> bytes:
    """Numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _pack_kinds(x: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers as their distinct values and places among them; returns the distinct values' first places, too."""
    kinds, first, at = np.unique(x, return_index=True, return_inverse=True)
    a, b = _pack(np.diff(kinds, prepend=0)), _pack(at.astype(np.uint16 if len(kinds) < 65536 else np.uint32))
    return np.array([len(kinds), len(a)], dtype=np.int64).tobytes() + a + b, first


def _unpack_kinds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, a = np.frombuffer(data[:16], dtype=np.int64)
    return np.cumsum(_unpack(data[16 : 16 + a], np.int64)), _unpack(data[16 + a :], np.uint16 if n < 65536 else np.uint32).astype(np.int64)


def _unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).reshape(-1) if len(planes) else np.zeros(0, dtype=dtype)


_BLOCKS = "block string, doc_ids array<long>, held binary, counts binary, words binary, places binary, n_words long, n_tokens long"


def _shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so that sorted words are sorted by shard."""
    return ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = 0
    for batch in batches:
        for part in slices(batch, most=BLOCK_BYTES):
            w = words_of(part.column(part.schema.get_field_index("text")))
            counts = np.diff(w.first) + 1
            ends = np.cumsum(counts) - 1
            tokens = np.full(int(counts.sum()), END, dtype=np.uint64)
            inner = np.ones(len(tokens), dtype=bool)
            inner[ends] = False
            tokens[inner] = w.hashes
            words, places = np.unique(tokens, return_inverse=True)
            row = {
                "block": f"{TaskContext.get().partitionId()}-{number}", "doc_ids": part.column(part.schema.get_field_index("doc_id")).to_pylist(),
                "held": np.asarray(part.column(part.schema.get_field_index("held_out")).cast(pa.int8())).tobytes(), "counts": _pack(counts.astype(np.int32)),
                "words": words.tobytes(), "places": _pack(places.astype(np.int32)), "n_words": len(words), "n_tokens": len(tokens),
            }
            number += 1
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("block", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.binary()), ("counts", pa.binary()), ("words", pa.binary()),
                ("places", pa.binary()), ("n_words", pa.int64()), ("n_tokens", pa.int64()),
            ]))


def _open(batch: pa.RecordBatch, k: int):
    get = lambda name: batch.column(batch.schema.get_field_index(name))[k].as_py()
    return (
        get("block"), get("doc_ids"), np.frombuffer(get("held"), dtype=np.int8) > 0, _unpack(get("counts"), np.int32).astype(np.int64),
        np.frombuffer(get("words") or b"", dtype=np.uint64), _unpack(get("places"), np.int32).astype(np.int64),
    )


def _deal(words: np.ndarray, counts: np.ndarray, held: np.ndarray, places: np.ndarray, hot: tuple[np.ndarray, np.ndarray], shards: int):
    """A block's distinct events: places of v, u and w among its words, from 1 on, 0 being the beginning of a text; training count,
    part of v, whether v is split, shard; and the distinct event of each token. Needs nothing but the block, so that answers can be dealt out again."""
    size, starts = len(words) + 1, np.cumsum(counts) - counts
    w = places + 1
    v = np.concatenate(([0], w[:-1]))
    v[starts] = 0
    u = np.concatenate(([0], v[:-1]))
    u[starts] = 0
    long, at = np.unique(v * size + u, return_inverse=True) if size >= 1 << 21 else (None, v * size + u)
    kinds, of = np.unique(at * size + w, return_inverse=True)
    at, w = kinds // size, kinds % size
    v, u = np.divmod(at if long is None else long[at], size)
    n = np.bincount(of[np.repeat(~held, counts)], minlength=len(kinds))
    hashes = np.concatenate(([BEGIN], words))
    parts = np.ones(size, dtype=np.uint64)
    if len(hot[0]):
        near = np.minimum(np.searchsorted(hot[0], hashes), len(hot[0]) - 1)
        parts = np.where(hot[0][near] == hashes, hot[1][near], parts)
    split = parts[v] > 1
    part = mix(mix(hashes[u], 5) + hashes[w], 7) % parts[v]
    shard = (mix(mix(hashes[v], 6) + part, 8) % np.uint64(shards)).astype(np.int64)
    return v, u, w, n, part.astype(np.int64), split, shard, of


def _vocabulary_rows(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, _, held, counts, words, places = _open(batch, k)
                trained = np.bincount(places[np.repeat(~held, counts)], minlength=len(words))
                filled, at = np.unique(_shard_of(words, shards), return_index=True)
                for s, a, b in zip(filled, at, [*at[1:], len(words)]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([int(s)]), pa.array([words[a:b].tobytes()]), pa.array([_pack(trained[a:b].astype(np.int32))])],
                        names=["block", "shard", "words", "trained"],
                    )

    return run


def _number_words(shards: int, context_events: int):
    def run(key, rows):
        shard = key[0].as_py()
        words = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in rows["words"]]
        lengths = [len(x) for x in words]
        kinds, of = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(of, weights=np.concatenate([_unpack(x.as_py(), np.int32) for x in rows["trained"]]), minlength=len(kinds)).astype(np.int64)
        ids = np.empty(len(kinds), dtype=np.int64)
        ids[np.lexsort((kinds, -count))] = np.arange(len(kinds), dtype=np.int64) * shards + shard  # frequent words get small ids
        cuts = np.cumsum([0, *lengths])
        n = len(lengths)
        hot = count >= context_events
        return pa.table({
            "hot": pa.array([kinds[hot].tobytes()] + [None] * (n - 1), pa.binary()), "hot_counts": pa.array([count[hot].tobytes()] + [None] * (n - 1), pa.binary()),
            "block": rows["block"], "shard": pa.array([shard] * n, pa.int64()),
            "ids": [_pack(ids[of[a:b]]) for a, b in zip(cuts, cuts[1:])], "counts": [_pack(count[of[a:b]]) for a, b in zip(cuts, cuts[1:])],
            "kinds": pa.array([int((count > 0).sum())] + [0] * (n - 1), pa.int64()), "tokens": pa.array([int(count.sum())] + [0] * (n - 1), pa.int64()),
        })

    return run


_ANSWERS = "hot binary, hot_counts binary, block string, shard long, ids binary, counts binary, kinds long, tokens long"
_HOT = "shard long, v long, u long, w long, n long"
_EVENTS = "kind string, block string, shard long, totals binary, events binary"


def _answered(right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 on of a block's words, 0 being the beginning of a text, and the words' training counts."""
    # answers by shard are in the order of the block's words
    answers = right.sort_by("shard")
    ids = np.concatenate([_unpack(x.as_py(), np.int64) for x in answers["ids"]])
    return np.concatenate(([0], ids + 1)), np.concatenate([_unpack(x.as_py(), np.int64) for x in answers["counts"]])


def _hot_events(shards: int, hot: tuple[np.ndarray, np.ndarray]):
    """Blocks with their words' answers -> their distinct events whose word before is split, with training counts."""
    def run(key, left, right):
        _, _, held, counts, words, places = _open(left.combine_chunks().to_batches()[0], 0)
        ids, _ = _answered(right)
        v, u, w, n, part, split, shard, _ = _deal(words, counts, held, places, hot, shards)
        return pa.table({"shard": shard[split], "v": ids[v[split]] << 20 | part[split], "u": ids[u[split]], "w": ids[w[split]], "n": n[split].astype(np.int64)})

    return run


def _events(shards: int, kinds: int, tokens: int, hot: tuple[np.ndarray, np.ndarray]):
    """Blocks with their words' answers -> a ``doc`` row with base scores, and an ``event`` row per shard."""
    def run(key, left, right):
        block, _, held, counts, words, places = _open(left.combine_chunks().to_batches()[0], 0)
        ids, seen = _answered(right)
        chance = (seen + SMOOTHING) / (tokens + SMOOTHING * (kinds + 1))
        doc = np.repeat(np.arange(len(counts)), counts)
        totals = np.stack([
            counts.astype(float), np.bincount(doc, weights=seen[places] > 0, minlength=len(counts)), np.bincount(doc, weights=np.log10(chance)[places], minlength=len(counts)),
        ])
        v, u, w, n, part, _, shard, _ = _deal(words, counts, held, places, hot, shards)
        context, base = ids[v] << 20 | part, quantise(chance)[w - 1]
        order = np.argsort(shard, kind="stable")
        # the document row goes to a group of its own, the others to their shards
        rows = [{"kind": "doc", "block": block, "shard": -1 - int(mix(places[:1].astype(np.uint64) + np.uint64(len(places)))[0] % np.uint64(1 << 40)), "totals": totals.tobytes(), "events": None}]
        filled, at = np.unique(shard[order], return_index=True)
        for s, low, high in zip(filled, at, [*at[1:], len(order)]):
            own = order[low:high]
            word, first = _pack_kinds(ids[w[own]])
            fields = [_pack_kinds(context[own])[0], _pack_kinds(ids[u[own]])[0], word, _pack(base[own][first]), _pack(n[own].astype(np.int32))]
            head = np.array([len(f) for f in fields], dtype=np.int64).tobytes()
            rows.append({"kind": "event", "block": block, "shard": int(s), "totals": None, "events": head + b"".join(fields)})
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("kind", pa.string()), ("block", pa.string()), ("shard", pa.int64()), ("totals", pa.binary()), ("events", pa.binary()),
        ]))

    return run


def _fields(data: bytes) -> list[np.ndarray]:
    sizes = np.frombuffer(data[:40], dtype=np.int64)
    cuts = np.cumsum([40, *sizes])
    part = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    (contexts, c), (us, u), (ws, w) = (_unpack_kinds(x) for x in part[:3])
    return [contexts[c], us[u], ws[w], _unpack(part[3], np.uint16)[w], _unpack(part[4], np.int32)]


_SCORED = pa.schema([("kind", pa.string()), ("block", pa.string()), ("shard", pa.int64()), ("totals", pa.binary()), ("data", pa.binary())])


def _score_shard(keep_model: bool):
    def run(key, rows):
        return _shard_scores(key, rows, None, keep_model)

    return run


def _score_split_shard(keep_model: bool):
    def run(key, rows, exact):
        return _shard_scores(key, rows, exact, keep_model)

    return run


def _shard_scores(key, rows, exact, keep_model: bool):
    """A shard's distinct events of all blocks -> its trie, and each block's scores. Document rows pass through.

    ``exact`` has, for the distinct events of split words, figures over all parts."""
    if key[0].as_py() < 0:
        return rows.rename_columns([*rows.column_names[:-1], "data"]).select(_SCORED.names).cast(_SCORED)
    each = [_fields(x.as_py()) for x in rows["events"]]
    context, u, w, base, n = (np.concatenate([f[k] for f in each]) for k in range(5))
    figures = None
    if exact is not None and len(exact):
        figures = [np.asarray(exact[name]) for name in ("v", "u", "w", "total", "kinds", "pair_n", "total3", "kinds3")]
    if n.any() or figures is not None:
        made = Trie.build(context, u, w, base, n, figures).to_bytes()
        with tempfile.NamedTemporaryFile() as f:  # goes with the task
            f.write(made)
            f.flush()
            score = Trie.from_words(np.memmap(f.name, dtype=np.uint64, mode="r")).score(context, u, w, base)
    else:
        made, score = b"", base
    out, at = [{"kind": "trie", "block": None, "shard": key[0].as_py(), "data": made}] if keep_model else [], 0
    for block, fields in zip(rows["block"].to_pylist(), each):
        size = len(fields[0])
        out.append({"kind": "score", "block": block, "shard": key[0].as_py(), "data": _pack(score[at : at + size].astype(np.int32))})
        at += size
    return pa.Table.from_pylist(out, schema=_SCORED)


def _add_up(shards: int, tokens: int, hot: tuple[np.ndarray, np.ndarray]):
    def run(key, left, right):
        _, doc_ids, held, counts, words, places = _open(left.combine_chunks().to_batches()[0], 0)
        # rows in the order of their shard; the document row comes first
        answers = right.sort_by("shard")
        n_tokens, n_known, base = np.frombuffer(answers["totals"][0].as_py()).reshape(3, -1)
        *_, shard, of = _deal(words, counts, held, places, hot, shards)
        code = np.empty(len(shard), dtype=np.int64)
        code[np.argsort(shard, kind="stable")] = np.concatenate([_unpack(x.as_py(), np.int32) for x in answers["data"][1:]])
        n = len(doc_ids)
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "held_out": pa.array(held), "n_tokens": n_tokens.astype(np.int64),
            "n_known": n_known.astype(np.int64), "train_tokens": np.full(n, tokens, dtype=np.int64), "base_score": base,
            "score": np.bincount(np.repeat(np.arange(n), counts), weights=code[of], minlength=n) * -STEP,
        })

    return run


def _exact_figures(events: DataFrame) -> DataFrame:
    """Distinct events of split words -> the same with figures over all parts, at the event's shard.

    Joins are by pairs of words, whose rows are distinct events; the table by word alone has a row for each split word."""
    word = F.shiftright("v", 20)
    once = staged(events.groupBy("shard", "v", "u", "w").agg(F.sum("n").alias("n")).withColumn("word", word), "lm-hot")
    pairs = staged(once.groupBy("word", "w").agg(F.sum("n").alias("pair_n")), "lm-hot-pairs")
    heads = once.groupBy("word", "u").agg(F.sum("n").alias("total3"), F.count_if(F.col("n") > 0).alias("kinds3"))
    totals = pairs.groupBy("word").agg(F.sum("pair_n").alias("total"), F.count_if(F.col("pair_n") > 0).alias("kinds"))
    return once.join(pairs, ["word", "w"]).join(heads, ["word", "u"]).join(F.broadcast(totals), "word").select(
        "shard", "v", "u", "w", "total", "kinds", "pair_n", "total3", "kinds3"
    )


def score_documents(docs: DataFrame, held_out: Column | None = None, keep_model: bool = True) -> tuple[DataFrame, DataFrame]:
    """Scores of every row of ``docs`` (``doc_id``, ``text``), and the model, one trie per shard.

    Without ``keep_model`` the tries live in their tasks only, and the model table is empty.

    Scores: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``. Rows for which ``held_out`` holds (by
    default a fifth, by a hash of the id) are scored but not learned from; rows without an id are learned from.
    Null and empty texts are the end token alone. Without training rows every score is the base's.
    """
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 1, F.lit(False)) if held_out is None else held_out
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    spark = docs.sparkSession
    blocks = staged(on_workers(docs.select("doc_id", "text", held.alias("held_out")), _blocks, _BLOCKS), "lm-blocks")
    sizes = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens"), F.sum(F.size("doc_ids")).alias("docs")).first()
    if not sizes.tokens:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "shard long, trie binary")
    word_shards, event_shards = -(-sizes.words // SHARD_WORDS), -(-sizes.tokens // SHARD_EVENTS)
    asked = on_workers(blocks, _vocabulary_rows(word_shards), "block string, shard long, words binary, trained binary")
    answers = staged(asked.groupBy("shard").applyInArrow(_number_words(word_shards, CONTEXT_EVENTS), _ANSWERS), "lm-words")
    total = answers.agg(F.sum("kinds").alias("kinds"), F.sum("tokens").alias("tokens")).first()
    # words before with many events, of which there are at most tokens / CONTEXT_EVENTS
    found = answers.filter("length(hot) > 0").select("hot", "hot_counts").collect()
    hashes = np.concatenate([np.array([BEGIN]), *(np.frombuffer(r.hot, dtype=np.uint64) for r in found)])
    parts = np.concatenate([[sizes.docs], *(np.frombuffer(r.hot_counts, dtype=np.int64) for r in found)]) // CONTEXT_EVENTS + 1
    use = np.argsort(hashes)
    use = use[(parts[use] > 1) & (hashes[use] != END)]
    hot = hashes[use], parts[use].astype(np.uint64)
    # events are not written: they go from the blocks to their shards in one shuffle
    answered = blocks.groupBy("block").cogroup(answers.select("block", "shard", "ids", "counts").groupBy("block"))
    events = answered.applyInArrow(_events(event_shards, total.kinds, total.tokens, hot), _EVENTS).groupBy("shard")
    schema_of = "kind string, block string, shard long, totals binary, data binary"
    if len(hot[0]):
        exact = _exact_figures(answered.applyInArrow(_hot_events(event_shards, hot), _HOT))
        shards = events.cogroup(exact.groupBy("shard")).applyInArrow(_score_split_shard(keep_model), schema_of)
    else:
        shards = events.applyInArrow(_score_shard(keep_model), schema_of)
    scored = staged(shards, "lm-scores")
    model = scored.filter("kind = 'trie'").select("shard", F.col("data").alias("trie"))
    block_rows = scored.filter("kind <> 'trie'").select("block", "shard", "totals", "data")
    return blocks.groupBy("block").cogroup(block_rows.groupBy("block")).applyInArrow(_add_up(event_shards, total.tokens, hot), schema), model
