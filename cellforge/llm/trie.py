"""An Elias-Fano n-gram trie of two levels in one memory-mapped buffer.  (Deeper levels are
further tries, whose contexts are the places of the level above.)

Level 1 holds the contexts' ids, level 2 the successors' ids, context after context.  The
pointers from level 1 into level 2 are a monotone sequence.  A context's successors are
stored relative to it: its base, the sum of the last ids of all contexts before it, is added
to each, so level 2 is monotone as a whole.  All four sequences are Elias-Fano coded.  Each
successor has its smoothed probability as a 16-bit code of its logarithm.

A lookup finds the context by successor search in level 1, its range by two pointers, and
the word by successor search for base + id in that range.  All lookups work on arrays.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np

CODES = 65535  # of quantised log10 probabilities; 0 stands for "not in the trie"
LOWEST = -12.0  # log10 probability of code 1; code CODES is 0.0
ONE, WORD = np.uint64(1), 64


def quantise(log10: np.ndarray) -> np.ndarray:
    step = (CODES - 1) / -LOWEST
    return (1 + np.rint((np.clip(log10, LOWEST, 0.0) - LOWEST) * step)).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return LOWEST + (codes.astype(np.float64) - 1) * (-LOWEST / (CODES - 1))


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit; before: set bits ahead of each word, and in all."""
    at = np.searchsorted(before, k, side="right") - 1
    word, left, place = words[at], (k - before[at]).astype(np.uint64), np.zeros(len(k), dtype=np.uint64)
    for width in (32, 16, 8, 4, 2, 1):
        low = word & np.uint64((1 << width) - 1)
        count = np.bitwise_count(low).astype(np.uint64)
        above = left >= count
        left = np.where(above, left - count, left)
        place = place + np.where(above, np.uint64(width), np.uint64(0))
        word = np.where(above, word >> np.uint64(width), low)
    return at * WORD + place.astype(np.int64)


class EliasFano:
    """A non-decreasing sequence: the low bits of each value packed, the high parts as one
    bit for each value behind a zero for each step."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate(([0], np.cumsum(ones)))  # a number for each 64 bits
        self.zeros = np.arange(len(self.ones)) * WORD - self.ones

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        high = np.zeros((((top >> low_bits) + n + 1 + WORD) // WORD) * WORD, dtype=np.uint8)
        high[(v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        low = np.zeros((n * low_bits + 2 * WORD) // WORD * WORD, dtype=np.uint8)
        for b in range(low_bits):
            low[b : n * low_bits : low_bits] = (v >> np.uint64(b)) & ONE
        pack = [np.packbits(x, bitorder="little").tobytes() for x in (low, high)]
        return struct.pack("<4q", n, low_bits, len(pack[0]), len(pack[1])) + pack[0] + pack[1]

    @classmethod
    def open(cls, buffer, at: int) -> tuple["EliasFano", int]:
        n, low_bits, a, b = struct.unpack_from("<4q", buffer, at)
        at += 32
        low = np.frombuffer(buffer, dtype="<u8", count=a // 8, offset=at)
        high = np.frombuffer(buffer, dtype="<u8", count=b // 8, offset=at + a)
        return cls(n, low_bits, low, high), at + a + b

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        at, shift = bit // WORD, (bit % WORD).astype(np.uint64)
        value = self.low[at] >> shift
        over = np.where(shift > 0, self.low[np.minimum(at + 1, len(self.low) - 1)] << ((np.uint64(WORD) - shift) % np.uint64(WORD)), np.uint64(0))
        return (value | over) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = _select(self.high, self.ones, i) - i
        return ((high.astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(i)).astype(np.int64)

    def successor(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place in [start, stop) whose value is x or more within x's high part or,
        if there is none, its end; whether the value there is x)."""
        high = x >> self.low_bits
        last = int(self.zeros[-1]) - 1  # zeros beyond the top value end every bucket
        inside = high <= last
        h = np.minimum(high, last)
        ends = _select(~self.high, self.zeros, h) - h
        starts = np.where(h > 0, _select(~self.high, self.zeros, np.maximum(h - 1, 0)) - (h - 1), 0)
        at, stop = np.maximum(starts, start), np.minimum(ends, stop)
        want = x.astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        end = np.maximum(stop, at)
        open_ = np.flatnonzero(inside & (at < end))
        top = end.copy()
        while len(open_):  # bisection of the bucket's low bits
            mid = (at[open_] + top[open_]) >> 1
            less = self.lows(mid) < want[open_]
            at[open_[less]], top[open_[~less]] = mid[less] + 1, mid[~less]
            open_ = open_[at[open_] < top[open_]]
        found = inside & (at < end)
        found[found] = self.lows(at[found]) == want[found]
        return at, found


class Trie:
    """(context, word) -> code of its probability."""

    def __init__(self, buffer) -> None:
        self.contexts, at = EliasFano.open(buffer, 0)
        self.pointers, at = EliasFano.open(buffer, at)
        self.bases, at = EliasFano.open(buffer, at)
        self.words, at = EliasFano.open(buffer, at)
        self.codes = np.frombuffer(buffer, dtype="<u2", count=self.words.n, offset=at)

    @staticmethod
    def encode(contexts: np.ndarray, words: np.ndarray, log10: np.ndarray) -> bytes:
        """From pairs sorted by (context, word), without repeats."""
        first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(contexts) else np.empty(0, dtype=np.int64)
        pointers = np.append(first, len(contexts))
        last = words[pointers[1:] - 1] if len(first) else words[:0]
        bases = np.concatenate(([0], np.cumsum(last)))[: len(first)]
        relative = words + np.repeat(bases, np.diff(pointers))
        levels = [EliasFano.encode(x) for x in (contexts[first], pointers, bases, relative)]
        return b"".join(levels) + quantise(log10).astype("<u2").tobytes()

    @classmethod
    def mapped(cls, data: bytes) -> "Trie":
        """The levels in a memory map of their own."""
        region = mmap.mmap(-1, max(len(data), 1))
        region.write(data)
        return cls(region)

    def lookup(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of pairs; 0 where the trie has none.  Contexts sorted, for speed only."""
        return self.locate(contexts, words)[0]

    def locate(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes as ``lookup``, places in the level of words; 0 where the trie has none)."""
        out, places = np.zeros(len(contexts), dtype=np.uint16), np.zeros(len(contexts), dtype=np.int64)
        if not len(contexts) or not self.words.n:
            return out, places
        each, where = np.unique(contexts, return_inverse=True)
        place, known = self.contexts.successor(each, np.zeros(len(each), dtype=np.int64), np.full(len(each), self.contexts.n))
        place = np.where(known, place, 0)
        start, stop, base = self.pointers.get(place), self.pointers.get(place + 1), self.bases.get(place)
        ask = np.flatnonzero(known[where])
        c = where[ask]
        at, found = self.words.successor(base[c] + words[ask], start[c], stop[c])
        out[ask[found]], places[ask[found]] = self.codes[at[found]], at[found]
        return out, places
