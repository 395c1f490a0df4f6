"""Elias-Fano sequences: monotone integers in about 2 + log2(universe / n) bits each, searched without unpacking."""

from __future__ import annotations

import numpy as np

U = np.uint64
ONE = U(1)


def bits(n: int) -> np.uint64:
    return U((1 << n) - 1)


def select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place of the set bit number ``rank`` (from 0) of each word."""
    word, rank, place = word.copy(), rank.astype(np.int64), np.zeros(len(word), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = word & bits(width)
        ones = np.bitwise_count(low).astype(np.int64)
        up = rank >= ones
        rank -= np.where(up, ones, 0)
        place += np.where(up, width, 0)
        word = np.where(up, word >> U(width), low)
    return place


def distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique(keys, return_inverse=True)`` of unsigned integers; where key and place fit into one word, words are sorted."""
    keys, n = keys.astype(U, copy=False), len(keys)
    width = max(1, n - 1).bit_length()
    if int(keys.max(initial=0)).bit_length() + width <= 64:
        both = np.sort((keys << U(width)) | np.arange(n, dtype=U))
        order, both = (both & bits(width)).astype(np.int64), both >> U(width)
    else:
        order = np.argsort(keys, kind="stable")
        both = keys[order]
    new = np.r_[True, both[1:] != both[:-1]][:n]
    inverse = np.empty(n, np.int64)
    inverse[order] = np.cumsum(new) - 1
    return both[new], inverse


class EliasFano:
    """A view of ``encode``'s three arrays: (n, low width, highest upper part), the low bits, the upper bits in unary."""

    def __init__(self, head: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.top = (int(x) for x in head)
        self.low, self.high = low, high
        self.cache: dict[str, np.ndarray] = {}

    def kept(self, name: str, make) -> np.ndarray:
        if name not in self.cache:
            self.cache[name] = make()
        return self.cache[name]

    def directory(self, zeros: bool) -> np.ndarray:
        """Set (or unset) bits up to the end of each word of the upper part."""
        return self.kept(f"directory {zeros}", lambda: np.cumsum(np.bitwise_count(~self.high if zeros else self.high), dtype=np.int64))

    def places(self, zeros: bool) -> np.ndarray:
        """All set (or unset) bits: the upper part unpacked, for batches about as large as the sequence."""
        return self.kept(f"places {zeros}", lambda: np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") != zeros))

    def select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """The place of the set (or unset) bit number ``k``."""
        if len(k) * 16 > self.n:
            return self.places(zeros)[k]
        directory = self.directory(zeros)
        word = np.searchsorted(directory, k, "right")
        before = np.where(word > 0, directory[word - 1], 0)
        return word * 64 + select_in_word(~self.high[word] if zeros else self.high[word], k - before)

    @staticmethod
    def encode(values: np.ndarray) -> list[np.ndarray]:
        """``values``: nondecreasing unsigned integers, equal ones allowed."""
        v = values.astype(U)
        n, most = len(v), int(v[-1]) if len(v) else 0
        width = max(0, ((most + 1) // max(1, n)).bit_length() - 1)
        low = np.zeros(n * width // 64 + 2, U)
        if width:
            at = np.arange(n, dtype=U) * U(width)
            word, shift, part = (at >> U(6)).astype(np.int64), at & U(63), v & bits(width)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][:n])
            if n:
                low[word[first]] = np.add.reduceat(part << shift, first)  # fields don't overlap
            over = shift + U(width) > U(64)  # at most one field of a word goes on into the next
            low[word[over] + 1] |= part[over] >> (U(64) - shift[over])
        upper = (v >> U(width)).astype(np.int64)
        top = int(upper[-1]) if n else 0
        unary = np.zeros(-(-(n + top + 1) // 64) * 64, bool)
        unary[upper + np.arange(n)] = True
        return [np.array([n, width, top], np.int64), low, np.packbits(unary, bitorder="little").view(U)]

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), U)
        at = i.astype(U) * U(self.width)
        word, shift = (at >> U(6)).astype(np.int64), at & U(63)
        above = np.where(shift > 0, self.low[word + 1] << ((U(64) - shift) & U(63)), U(0))
        return ((self.low[word] >> shift) | above) & bits(self.width)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i`` (0 to n - 1)."""
        i = i.astype(np.int64)
        place = self.select(i, False)
        return ((place - i).astype(U) << U(self.width)) | self.lows(i)

    def up_to(self, upper: np.ndarray) -> np.ndarray:
        """How many values have an upper part of ``upper`` or less; -1 gives 0."""
        k = np.clip(upper, 0, self.top)
        place = self.select(k, True)
        return np.where(upper < 0, 0, np.where(upper >= self.top, self.n, place - k))

    def bucket(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place whose value is ``x`` or more, end of the values that share its upper part, low part of ``x``)."""
        x = x.astype(U)
        upper = np.minimum(x >> U(self.width), U(self.top + 1)).astype(np.int64)
        a, b, low = self.up_to(upper - 1), self.up_to(upper), x & bits(self.width)
        end = b.copy()
        while len(wide := np.flatnonzero(a < b)):
            middle = (a[wide] + b[wide]) // 2
            less = self.lows(middle) < low[wide]
            a[wide] = np.where(less, middle + 1, a[wide])
            b[wide] = np.where(less, b[wide], middle)
        return a, end, low

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first value that is ``x`` or more; n where there is none."""
        return self.bucket(x)[0]

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of ``x``, -1 where it is absent."""
        out = np.full(len(x), -1, np.int64)
        if self.n and len(x):
            at, end, low = self.bucket(x)
            inside = np.flatnonzero(at < end)
            same = inside[self.lows(at[inside]) == low[inside]]
            out[same] = at[same]
        return out
