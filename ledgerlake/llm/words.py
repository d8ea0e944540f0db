"""Words of whole texts as NumPy arrays, for work inside tasks.

A word is a run of ``[^\\x20\\x09-\\x0D]``. Texts come as an Arrow string array whose bytes are
looked at in place. Every word gets a 64-bit hash; equal words have equal hashes, and two different
words share one with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]  # A-Z hash like a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, 1 << 16)
_POWER_BACK = _powers(_INVERSE, 1 << 16)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWER, _POWER_BACK
    if n > len(_POWER):
        size = 1 << int(n - 1).bit_length()
        made = _powers(_BASE, size), _powers(_INVERSE, size)
        if size > 1 << 22:  # one huge text: do not keep its tables
            return made
        _POWER, _POWER_BACK = made
    return _POWER, _POWER_BACK


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scrambles 64-bit numbers, one to one."""
    z = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """64-bit hash of each span of bytes."""
    power, back = _grown(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((_FOLDED if fold else _BYTE)[data] * power[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * back[start])


@dataclass
class Words:
    """Words of some texts: text i has the words ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray  # byte positions in ``data``
    end: np.ndarray
    data: np.ndarray
    offsets: np.ndarray  # byte positions of the texts in ``data``

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[low:high] if high > low else np.zeros(0, dtype=np.uint8)
    return data, offsets.astype(np.int64) - low


def words_of(texts: pa.Array, fold: bool = True) -> Words:
    """Words of each text. ``fold`` lower-cases A-Z."""
    data, offsets = text_bytes(texts)
    n = len(data)
    solid = np.empty(n + 1, dtype=bool)
    solid[n] = False
    np.logical_not(_SPACE[data], out=solid[:n])
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True  # a word ends with its text
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:]
    start = np.flatnonzero(begins)
    ends = ~solid | edge
    ends[1:] &= solid[:-1]
    ends[0] = False
    end = np.flatnonzero(ends)
    hashes = span_hash(data, start, end, fold) if len(start) else np.zeros(0, dtype=np.uint64)
    return Words(hashes, np.searchsorted(start, offsets), start, end, data, offsets)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text; a longer text is a part of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def window_hash(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``width`` neighbouring word hashes, by their first word; the last ones run over texts' ends."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out = mix(out + hashes[j : j + n], seed + j + 1)
    return out


def joined(words: Words, index: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Bytes of the words ``index``, by one space each, of every text: text i has ``index[first[i]:first[i + 1]]``."""
    length = (words.end - words.start)[index] + 1
    ends = np.zeros(len(index) + 1, dtype=np.int64)
    np.cumsum(length, out=ends[1:])
    out = np.full(int(ends[-1]), 32, dtype=np.uint8)
    for at in range(0, len(index), 1 << 18):
        some = slice(at, at + (1 << 18))
        base = int(ends[at])
        size = length[some] - 1
        to = np.repeat(ends[:-1][some] - base - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[base + to] = words.data[np.repeat(words.start[index[some]] - (ends[:-1][some] - base), size) + to]
    flat = memoryview(out)
    return [bytes(flat[ends[a] : max(ends[b] - 1, ends[a])]) for a, b in zip(first[:-1], first[1:])]
