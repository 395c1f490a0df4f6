"""An FM-index over word sequences: Burrows-Wheeler order, wavelet matrix, backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` symbols (or more) by prefix doubling.

    Positions that agree in these stand in any order; that is enough to search patterns of up to ``depth`` symbols.
    """
    n = len(t)
    rank = t.astype(np.int64)
    order, length = np.argsort(rank), 1
    while length < depth:
        after = np.zeros(n, np.int64)
        after[: n - length] = rank[length:] + 1
        key = rank * (int(after.max(initial=0)) + 1) + after
        order = np.argsort(key)
        k = key[order]
        new = np.cumsum(np.r_[0, k[1:] != k[:-1]])
        rank[order] = new
        if new[-1] == n - 1:
            break
        length *= 2
    return order


class WaveletMatrix:
    """Bit planes of a sequence, from the highest bit, each with the zeros moved ahead of the ones; ranks from packed words."""

    def __init__(self, s: np.ndarray, bits: int):
        self.planes, self.n = [], len(s)
        s = s.astype(np.uint32)
        for level in range(bits - 1, -1, -1):
            bit = ((s >> np.uint32(level)) & np.uint32(1)).astype(np.uint8)
            padded = np.zeros((len(s) // 64 + 1) * 64, np.uint8)
            padded[: len(s)] = bit
            packed = np.packbits(padded, bitorder="little").view("<u8")
            before = np.r_[0, np.cumsum(np.bitwise_count(packed))].astype(np.int32)
            self.planes.append((level, packed, before, int(len(s) - bit.sum())))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def ones(self, plane, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits of a plane."""
        _, packed, before, _ = plane
        word, rest = i >> 6, (i & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << rest) - np.uint64(1)))

    def place(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i symbols end in the run of symbol c, counted from the start of the last plane."""
        for plane in self.planes:
            one = self.ones(plane, i)
            i = np.where((c >> plane[0]) & 1, plane[3] + one, i - one)
        return i


class FMIndex:
    """Counts patterns in weighted segments of 64-bit words. A segment's weight is the number of its copies."""

    def __init__(self, segments: list[np.ndarray], weights: np.ndarray, depth: int):
        lengths = np.array([len(s) for s in segments], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths + 1) - lengths - 1
        words, coded = np.unique(np.concatenate(segments), return_inverse=True)
        text = np.zeros(int((lengths + 1).sum()), np.int64)  # 0 parts the segments
        inside = np.ones(len(text), dtype=bool)
        inside[self.starts + lengths] = False
        text[inside] = coded + 1
        order = suffix_order(text, depth)
        self.text, self.n = text, len(text)
        bits = max(1, int(len(words)).bit_length())
        self.wavelet = WaveletMatrix(text[order - 1], bits)
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=len(words) + 1))]
        symbols = np.arange(len(words) + 1)
        self.zero = self.wavelet.place(symbols, np.zeros(len(symbols), np.int64))
        self.weight = np.r_[0, np.cumsum(np.repeat(weights, lengths + 1)[order])]

    def step(self, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of c followed by the present matches."""
        base = self.first[c] - self.zero[c]
        return base + self.wavelet.place(c, low), base + self.wavelet.place(c, high)

    def repeated_windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment, first start, last start) of runs of windows that occur twice or more, copies counted.

        Each segment is matched from its end to the left as far as the match occurs twice;
        all windows inside a match repeat. Then the matching goes on from the end of the
        last window that isn't decided. All segments advance together.
        """
        seg = np.flatnonzero(self.lengths >= window)
        start = self.lengths[seg] - window  # the last undecided window of each segment
        out: list[np.ndarray] = []
        state = None
        while len(seg):
            if state is None:
                at = start + window  # one after the next symbol to match
                low, high = np.zeros(len(seg), np.int64), np.full(len(seg), self.n, np.int64)
            else:
                at, low, high = state
            more = at > 0
            c = self.text[self.starts[seg] + np.maximum(at - 1, 0)]
            new_low, new_high = self.step(c, low, high)
            more &= self.weight[new_high] - self.weight[new_low] >= 2
            at, low, high = np.where(more, at - 1, at), np.where(more, new_low, low), np.where(more, new_high, high)
            ended = ~more
            if ended.any():
                full = ended & (at <= start)  # the match covers the window, and those to its left down to ``at``
                out.append(np.stack([seg[full], at[full], start[full]]))
                start = np.where(full, at - 1, np.where(ended, start - 1, start))
                at = np.where(ended, start + window, at)
                low, high = np.where(ended, 0, low), np.where(ended, self.n, high)
                left = start >= 0
                seg, start, at, low, high = seg[left], start[left], at[left], low[left], high[left]
            state = (at, low, high)
        runs = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return runs[0], runs[1], runs[2]
