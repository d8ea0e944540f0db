"""N-gram trie in Elias-Fano levels, for one shard of a language model.

Levels: contexts ``v``; their successors ``w``; the words ``u`` before them; and for each ``u v`` its successors, written
not as words but as places among the successors of ``v``, which are small numbers. The numbers of a level are made monotone by
adding the last one of the sibling range before, pointers are monotone by nature, and both are Elias-Fano coded. Smoothed
probabilities and back-off weights are quantised to steps of ``STEP`` in log10. A trie is one block of
bytes that can be memory-mapped; look-ups go through a level's nodes in rising order and unpack ``BLOCK`` of them at a time.
"""

from __future__ import annotations

import numpy as np

STEP = 0.001
DISCOUNT = 0.75
BLOCK = 1 << 16
_LOWS = np.array([(1 << k) - 1 for k in range(65)], dtype=np.uint64)


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-65)) / STEP), 0, 65535).astype(np.uint16)


class Monotone:
    """Elias-Fano sequence of numbers that never fall: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs, self.ranks = n, low_bits, lows, highs, ranks

    @classmethod
    def build(cls, values: np.ndarray) -> Monotone:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, int(values[-1]).bit_length() - int(n).bit_length()) if n else 0
        lows = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        if low_bits:
            low, at = values & _LOWS[low_bits], np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(lows, word, low << shift)
            over = shift + np.uint64(low_bits) > 64
            np.bitwise_or.at(lows, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 64, dtype=np.uint8)
        bits[ones] = 1
        highs = np.packbits(bits, bitorder="little").view(np.uint64)
        ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(highs), dtype=np.uint64)[:-1])).astype(np.uint64)
        return cls(n, low_bits, lows, highs, ranks)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Numbers at the places ``i``, each found by selecting its unary bit."""
        i = i.astype(np.uint64)
        word = np.searchsorted(self.ranks, i, side="right") - 1
        bits, left = self.highs[word], i - self.ranks[word]
        place = np.zeros(len(i), dtype=np.uint64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word that holds the bit
            count = np.bitwise_count((bits >> place) & _LOWS[width]).astype(np.uint64)
            beyond = left >= count
            left = np.where(beyond, left - count, left)
            place = np.where(beyond, place + np.uint64(width), place)
        high = word.astype(np.uint64) * np.uint64(64) + place - i
        if not self.low_bits:
            return high
        return high << np.uint64(self.low_bits) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * np.uint64(self.low_bits)
        k, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        low = self.lows[k] >> shift
        low |= np.where(shift > 0, self.lows[k + 1] << ((np.uint64(64) - shift) & np.uint64(63)), 0).astype(np.uint64)
        return low & _LOWS[self.low_bits]

    def block(self, start: int, end: int) -> np.ndarray:
        """Numbers at the places from ``start`` up to ``end``, unpacked together."""
        if start >= end:
            return np.zeros(0, dtype=np.uint64)
        first, last = np.searchsorted(self.ranks, [start, end - 1], side="right") - 1
        bits = np.unpackbits(self.highs[first : last + 1].view(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits)[start - int(self.ranks[first]) :][: end - start] + int(first) * 64
        places = np.arange(start, end, dtype=np.uint64)
        high = ones.astype(np.uint64) - places
        return high << np.uint64(self.low_bits) | self._low(places) if self.low_bits else high

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Successor search: place of the first number that is at least ``value``, and whether it is equal."""
        at, equal = np.full(len(value), self.n, dtype=np.int64), np.zeros(len(value), dtype=bool)
        if not self.n or not len(value):
            return at, equal
        order = np.argsort(value, kind="stable")
        wanted = value[order]
        firsts = self.get(np.arange(0, self.n, BLOCK))
        cuts = np.searchsorted(wanted, firsts[1:])
        for k, (low, high) in enumerate(zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(wanted)])))):
            if low < high:
                start, end = k * BLOCK, min(self.n, (k + 1) * BLOCK)
                numbers = self.block(start, end)
                near = np.searchsorted(numbers, wanted[low:high])
                at[order[low:high]] = start + near
                equal[order[low:high]] = numbers[np.minimum(near, len(numbers) - 1)] == wanted[low:high]
        return at, equal

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], dtype=np.uint64), self.lows, self.highs, self.ranks]


class Level:
    """Sibling ranges of rising numbers: each number is stored on top of the last one before its range."""

    def __init__(self, pointers: Monotone, nodes: Monotone):
        self.pointers, self.nodes = pointers, nodes

    @classmethod
    def build(cls, parent: np.ndarray, number: np.ndarray, parents: int) -> Level:
        first = np.searchsorted(parent, np.arange(parents + 1))
        last = np.zeros(parents + 1, dtype=np.uint64)
        some = np.diff(first) > 0
        tops = np.zeros(parents, dtype=np.uint64)
        tops[some] = number[first[1:][some] - 1].astype(np.uint64) + np.uint64(1)
        np.cumsum(tops, out=last[1:])
        return cls(Monotone.build(first), Monotone.build(number.astype(np.uint64) + last[parent]))

    def find(self, parent: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of ``number`` among the children of ``parent``, and whether it is there. Parent -1 has none."""
        start = self.pointers.block(0, self.pointers.n).astype(np.int64)
        base = np.zeros(len(start), dtype=np.uint64)
        some = start > 0
        base[some] = self.nodes.get(start[some] - 1) + np.uint64(1)
        at, equal = self.nodes.find(number.astype(np.uint64) + base[parent])
        return at, equal & (parent >= 0) & (at < start[parent + 1])

    def start(self, parent: np.ndarray) -> np.ndarray:
        return self.pointers.block(0, self.pointers.n).astype(np.int64)[parent]


class Trie:
    """Trigram trie of one shard; see the module."""

    def __init__(self, contexts: Monotone, after: Level, before: Level, deep: Level, codes: list[np.ndarray]):
        self.contexts, self.after, self.before, self.deep, self.codes = contexts, after, before, deep, codes

    @classmethod
    def build(cls, v: np.ndarray, u: np.ndarray, w: np.ndarray, base: np.ndarray, n: np.ndarray, exact: list[np.ndarray] | None = None) -> Trie:
        """From events: context key, word before it, next word, the code of the next word's base probability, and training count.

        An event may come several times; those without training counts are not held. ``exact`` gives, for events
        whose context is split over tries, ``v, u, w``, total and kinds of the context, the count of ``v w``, and total and kinds of ``u v``, over all tries.
        """
        given = slice(len(v), None)
        if exact is not None:
            v, u, w = (np.concatenate(x) for x in zip((v, u, w), exact[:3]))
            n = np.concatenate((n, np.zeros(len(exact[0]), dtype=n.dtype)))
        contexts, c = np.unique(v, return_inverse=True)
        pair, pair_at, pair_of = np.unique(c.astype(np.int64) << 40 | w, return_index=True, return_inverse=True)
        pair_c = pair >> 40
        place = pair_of - np.searchsorted(pair_c, np.arange(len(contexts)))[c]
        long, long_of = np.unique(c.astype(np.int64) << 40 | u, return_inverse=True)
        three, three_at, three_of = np.unique(long_of.astype(np.int64) << 32 | place, return_index=True, return_inverse=True)
        three_l, three_p = three >> 32, pair_of[three_at]
        total, pair_n, total3, three_n = (np.bincount(x, weights=n, minlength=len(y)) for x, y in ((c, contexts), (pair_of, pair), (long_of, long), (three_of, three)))
        kinds, kinds3 = np.bincount(pair_c[pair_n > 0], minlength=len(contexts)), np.bincount(three_l[three_n > 0], minlength=len(long))
        if exact is not None:
            for figure, at, value in zip((total, kinds, pair_n, total3, kinds3), (c, c, pair_of, long_of, long_of), exact[3:]):
                figure[at[given]] = value
        share = DISCOUNT * kinds / np.maximum(total, 1)
        # an event of exact is among the others, which come first and have its base
        p2 = np.maximum(pair_n - DISCOUNT, 0) / np.maximum(total[pair_c], 1) + share[pair_c] * 10.0 ** (-STEP * base[pair_at])
        share3 = DISCOUNT * kinds3 / np.maximum(total3, 1)
        p3 = np.maximum(three_n - DISCOUNT, 0) / np.maximum(total3[three_l], 1) + share3[three_l] * p2[three_p]
        # nodes without training counts go
        has, has2, has_u, has3 = total > 0, pair_n > 0, total3 > 0, three_n > 0
        c_at, pair_to, long_to = (np.cumsum(x) - 1 for x in (has, has2, has_u))
        after = Level.build(c_at[pair_c[has2]], pair[has2] & ((1 << 40) - 1), int(has.sum()))
        before = Level.build(c_at[long[has_u] >> 40], long[has_u] & ((1 << 40) - 1), int(has.sum()))
        first = np.searchsorted(c_at[pair_c[has2]], np.arange(int(has.sum())))
        # of w among the successors of v
        deep = Level.build(long_to[three_l[has3]], pair_to[three_p[has3]] - first[c_at[pair_c[three_p[has3]]]], int(has_u.sum()))
        return cls(Monotone.build(contexts[has]), after, before, deep, [quantise(x) for x in (share[has], p2[has2], share3[has_u], p3[has3])])

    def score(self, v: np.ndarray, u: np.ndarray, w: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Code of the probability of each event, backing off where the trie lacks it."""
        at, known = self.contexts.find(v.astype(np.uint64))
        c = np.where(known, at, -1)
        share, p2, share3, p3 = self.codes
        out = base.astype(np.int64)
        pair, has_pair = self.after.find(c, w)
        out[known & ~has_pair] += share[c[known & ~has_pair]]
        out[has_pair] = p2[pair[has_pair]]
        long, has_long = self.before.find(c, u)
        has_deep = np.zeros(len(v), dtype=bool)
        both = has_pair & has_long
        if both.any():
            deep, found = self.deep.find(long[both], pair[both] - self.after.start(c[both]))
            has_deep[np.flatnonzero(both)[found]] = True
            out[has_deep] = p3[deep[found]]
        rest = has_long & ~has_deep
        out[rest] += share3[long[rest]]
        return out

    def to_bytes(self) -> bytes:
        """One block: a table of lengths, then all levels, each on a multiple of eight bytes."""
        arrays = [x for m in (self.contexts, *(m for level in (self.after, self.before, self.deep) for m in (level.pointers, level.nodes))) for x in m.parts()]
        arrays += [np.concatenate((c, np.zeros(-len(c) % 4, dtype=np.uint16))).view(np.uint64) for c in self.codes]
        return np.concatenate([np.array([len(arrays), *map(len, arrays)], dtype=np.uint64), *arrays]).tobytes()

    @classmethod
    def from_words(cls, words: np.ndarray) -> Trie:
        """From the block's 64-bit words, such as a memory map of its file."""
        count = int(words[0])
        ends = np.cumsum([1 + count, *(int(x) for x in words[1 : count + 1])])
        arrays = [words[a:b] for a, b in zip(ends[:-1], ends[1:])]
        m = [Monotone(int(arrays[k][0]), int(arrays[k][1]), *arrays[k + 1 : k + 4]) for k in range(0, 28, 4)]
        return cls(m[0], Level(m[1], m[2]), Level(m[3], m[4]), Level(m[5], m[6]), [a.view(np.uint16) for a in arrays[28:]])
