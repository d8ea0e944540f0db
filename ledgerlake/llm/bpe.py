"""Byte-level BPE by recursive SQL inside each partition.

A partition's texts are split by the tokenizer's pattern. Its distinct pieces go to an in-process DuckDB as
token-position rows. One recursive query joins neighbouring rows with the merge table, takes each piece's
leftmost pair of least rank, contracts it, and goes on with the pieces that still had one, until none has.
Decoding joins the ids with the vocabulary and concatenates the bytes by ordered aggregation.

Pieces go in blocks whose rows over all rounds are bounded (``BLOCK_ROWS``). The rounds of a piece grow with the
square of its length, so pieces above ``LONG_PIECE`` bytes use a heap over the same merge table instead, with the same
result. Encoded pieces are remembered, ``REMEMBERED`` of them at most, while a worker lives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import on_workers
from ledgerlake.llm.words import slices

BLOCK_ROWS = 2_000_000
LONG_PIECE = 1_000
REMEMBERED = 600_000
SLICE = 1 << 20  # bytes of text worked on at once; the lists of its pieces take many times that

# A row's place is its piece's number times 1,024 plus its byte position, as pieces of a block are no longer.
_ENCODE = """
create or replace temp table tokens as
with recursive state as (
    select 0 as round, place, token from pieces
    union all
    select round + 1, place, (case when place = best then merged else token end)::int
    from (
        select s.round, s.place, s.token, b.best, b.merged, b.gone
        from state s join (
            select place >> 10 as piece, (min(key) >> 10)::int as merged, ((place >> 10) << 10) | (min(key) & 1023) as best, arg_min(next_place, key) as gone
            from (
                select n.place, n.next_place, (m.merged::bigint << 10) | (n.place & 1023) as key
                from (
                    select place, token, lead(place) over w as next_place, lead(token) over w as next_token
                    from state window w as (order by place)
                ) n join merges m on m.pair = (n.token::bigint << 20) | n.next_token
                where n.next_place >> 10 = n.place >> 10
            )
            group by place >> 10
        ) b on s.place >> 10 = b.piece
    )
    where place <> gone
)
select (place >> 10)::int as piece, (place & 1023)::int as pos, token
from state semi join (select place >> 10 as piece, max(round) as round from state group by all) last
    on state.place >> 10 = last.piece and state.round = last.round
"""
_DECODE = """
select piece, list(token order by pos) as ids, string_agg(v.hex, '' order by pos) as hex
from tokens join vocabulary v using (token) group by piece
"""


def read_ranks(path: str) -> bytes:
    """A rank file's content, for sending it to the workers: bounded by the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Ragged:
    """Lists of numbers, one after the other in ``flat``; list k begins at ``first[k]``."""

    def __init__(self, flat: np.ndarray, first: np.ndarray | None = None):
        self.flat = flat
        self.first = np.zeros(1, dtype=np.int64) if first is None else first

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def take(self, which: np.ndarray) -> Ragged:
        lengths = self.first[which + 1] - self.first[which]
        first = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.first[which] - first[:-1], lengths)
        at += np.arange(len(at))
        return Ragged(self.flat[at], first)


class Codec:
    """Merge table and vocabulary of one rank file, with the pieces encoded so far."""

    def __init__(self, rank_file: bytes):
        import duckdb

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        pairs, merged = [], []
        for token, rank in self.ranks.items():  # every way in which two tokens make a third
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append(a << 20 | b)
                    merged.append(rank)
        self.merges = dict(zip(pairs, merged))
        self.single = np.array([self.ranks.get(bytes([k]), -1) for k in range(256)], dtype=np.int32)
        self.index: dict[str, int] = {}  # where a piece is in the two lists below
        self.ids = Ragged(np.zeros(0, dtype="<u4"))
        self.text = Ragged(np.zeros(0, dtype=np.uint8))
        self.con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        self.con.register("given", pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())}))
        self.con.execute("create table merges as select * from given")
        self.con.unregister("given")
        self.con.register("given", pa.table({"token": pa.array(list(self.bytes_of), pa.int32()), "hex": [b.hex() for b in self.bytes_of.values()]}))
        self.con.execute("create table vocabulary as select * from given")
        self.con.unregister("given")

    def _long(self, piece: bytes) -> list[int]:
        """Leftmost least pair first, over a linked list and a heap."""
        token: list[int | None] = [int(self.single[b]) for b in piece]
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.merges.get(token[i] << 20 | token[j])) is not None:
                heappush(heap, (rank, i, token[i], token[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heappop(heap)
            j = after[i] if token[i] is not None else n
            if j >= n or token[i] != a or token[j] != b:
                continue
            token[i], token[j] = rank, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in token if t is not None]

    def _block(self, pieces: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(b) for _, b in pieces])
        direct = [self.ranks.get(b) for _, b in pieces]
        alone = np.array([d is not None for d in direct])
        data = np.frombuffer(b"".join(b for _, b in pieces), dtype=np.uint8)
        number = np.repeat(np.arange(len(pieces)), lengths)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        token = self.single[data]
        keep = ~alone[number] | (pos == 0)  # a piece that is a token is one row
        token = np.where(alone[number], np.array([d or 0 for d in direct], dtype=np.int32)[number], token)
        self.con.register("pieces", pa.table({"place": (number << 10 | pos)[keep], "token": token[keep]}))
        self.con.execute(_ENCODE)
        self.con.unregister("pieces")
        self._decode([p for p, _ in pieces])

    def _decode(self, pieces: list[str]) -> None:
        found = self.con.sql(_DECODE).to_arrow_table().combine_chunks()
        number, ids, texts = (found.column(c).combine_chunks() for c in ("piece", "ids", "hex"))
        self.index.update(zip((pieces[k] for k in number.to_pylist()), range(len(self.index), len(self.index) + len(number))))
        self.ids.add(np.asarray(ids.flatten()), np.asarray(ids.value_lengths()))
        texts = texts.to_pylist()
        self.text.add(np.frombuffer(bytes.fromhex("".join(texts)), dtype=np.uint8), np.array([len(t) // 2 for t in texts], dtype=np.int64))

    def learn(self, pieces: Iterable[str]) -> None:
        """Encodes and decodes pieces that are not known yet."""
        block: list[tuple[str, bytes]] = []
        rows = 0
        for piece in pieces:
            data = piece.encode()
            if len(data) > LONG_PIECE:
                ids = self._long(data)
                self.con.register("given", pa.table({"piece": pa.array([0] * len(ids), pa.int32()), "pos": pa.array(range(len(ids)), pa.int32()), "token": pa.array(ids, pa.int32())}))
                self.con.execute("create or replace temp table tokens as select * from given")
                self.con.unregister("given")
                self._decode([piece])
                continue
            block.append((piece, data))
            rows += len(data) * len(data) // 2 + 1
            if rows >= BLOCK_ROWS:
                self._block(block)
                block, rows = [], 0
        if block:
            self._block(block)

    def encode(self, texts: list[str], pattern) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each text, little-endian unsigned 32-bit, and the bytes that these decode to."""
        split, both = [pattern.findall(t) for t in texts], []
        used = set().union(*split)
        if len(self.index) + len(used - self.index.keys()) > REMEMBERED:  # what this slice needs stays
            again = {p: self.index[p] for p in used & self.index.keys()}
            which = np.fromiter(again.values(), dtype=np.int64, count=len(again))
            self.index = dict(zip(again, range(len(again))))
            self.ids, self.text = self.ids.take(which), self.text.take(which)
        self.learn(used - self.index.keys())
        counts = np.array([len(pieces) for pieces in split], dtype=np.int64)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(counts)])
        for part in (self.ids.take(which), self.text.take(which)):
            at = part.first[ends].tolist()
            both.append([part.flat[x:y].tobytes() for x, y in zip(at, at[1:])])
        yield from zip(*both)


_CODECS: dict[str, Codec] = {}


def codec(rank_file: bytes) -> Codec:
    """This worker's codec of a rank file; one is kept."""
    name = hashlib.sha256(rank_file).hexdigest()
    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(rank_file)
    return _CODECS[name]


def _encoded(docs: DataFrame, rank_file: bytes, pattern: str) -> Iterator:
    import regex

    sent = docs.sparkSession.sparkContext.broadcast(rank_file)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[bytes, bytes]]]]:
        split = regex.compile(pattern)
        own = codec(sent.value)
        for batch in batches:
            for part in slices(batch, most=SLICE):
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                yield part.column(part.schema.get_field_index("doc_id")), list(own.encode(texts, split))

    return each


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>`` for every row of ``docs`` (``doc_id``, ``text``). Null and empty texts have no ids."""
    each = _encoded(docs, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, coded in each(batches):
            ids = pa.array([np.frombuffer(a, dtype="<u4").astype(np.int32) for a, _ in coded], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([doc_id, ids], names=["doc_id", "ids"])

    return on_workers(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode_documents(ids: DataFrame, rank_file: bytes) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, decoded binary``: ordered aggregation of the ids' bytes. Null ids decode to nothing."""
    sent = ids.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(1).fill_null([]) if part.column(1).null_count else part.column(1)
                lengths = np.array([len(x) for x in lists], dtype=np.int64)
                number = np.repeat(np.arange(len(lists), dtype=np.int32), lengths)
                pos = np.arange(len(number)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                own.con.register("given", pa.table({"piece": number, "pos": pos, "token": lists.flatten()}))
                own.con.execute("create or replace temp table tokens as select * from given")
                own.con.unregister("given")
                out = [b""] * len(lists)
                for k, _, text in own.con.execute(_DECODE).fetchall():
                    out[k] = bytes.fromhex(text)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return on_workers(ids.select("doc_id", "ids"), run, "doc_id long, decoded binary")


def token_digests(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoding every text and decoding its ids.

    Null and empty texts have no tokens. Repeated rows are coded each; other columns are not looked at.
    """
    each = _encoded(docs, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, coded in each(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    doc_id, pa.array([len(a) // 4 for a, _ in coded], pa.int64()),
                    pa.array([hashlib.sha256(a).hexdigest() for a, _ in coded]), pa.array([hashlib.sha256(b).hexdigest() for _, b in coded]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return on_workers(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
