"""FM-index over word sequences: wavelet matrix, backward search, matching statistics, in numpy."""

from __future__ import annotations

import numpy as np

from lakestrata.llm.suffixes import common_prefix, suffix_array


class BitRank:
    """Packed bits with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32)
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Occurrences of a symbol before a position, for arrays of symbols and positions."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels: list[BitRank] = []
        self.bits = max(1, int(symbols - 1).bit_length())
        for k in reversed(range(self.bits)):
            bit = (sequence >> k) & 1
            self.levels.append(BitRank(bit.astype(bool)))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.start = self.place(np.arange(symbols), np.zeros(symbols, np.int64))

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in zip(reversed(range(self.bits)), self.levels):
            ones = level.rank(at)
            at = np.where((symbol >> k) & 1, level.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.place(symbol, at) - self.start[symbol]


class FmIndex:
    """Index of word sequences, each with the number of its document.

    Words are numbers from 1; a 0 that sorts first ends each sequence.  Besides
    the compressed sequence itself it holds, for each row, the smallest document
    among the rows that share the first `window` words; the common prefixes of
    neighbours, which shorten a match that cannot go on, are made when one has to.
    """

    NOWHERE = np.iinfo(np.int64).max

    def __init__(self, sequences: list[np.ndarray], documents: np.ndarray, window: int):
        self.window = window
        zero = np.zeros(1, np.int64)
        text = np.concatenate([x for s in sequences for x in (s, zero)])
        size = np.array([len(s) + 1 for s in sequences])
        end = np.repeat(np.cumsum(size), size)
        order, levels = suffix_array(text, np.zeros(len(text), np.int64), end)
        first = np.zeros(len(text), bool)
        first[np.cumsum(size) - size] = True
        before = np.where(first[order], 0, text[order - 1])
        symbols = int(text.max()) + 1
        self.n = len(text)
        self.counts = np.concatenate([zero, np.cumsum(np.bincount(text, minlength=symbols))])
        self.tree = WaveletMatrix(before, symbols)
        self.symbols = symbols
        self.sorted = order, levels, end
        self.minima: list[np.ndarray] | None = None
        # Runs of rows that share their first `window` words, without the closing 0: by the
        # ranks of the first and of the last 2**k words of the window.
        whole = order + window < end[order]
        k = window.bit_length() - 1
        new = np.ones(self.n, bool)
        if k < len(levels):
            tail = np.minimum(order + window - (1 << k), self.n - 1)
            a, b = levels[k][order], levels[k][tail]
            new[1:] = ~(whole[1:] & whole[:-1] & (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
        owner = np.repeat(documents, size)[order]
        starts = np.flatnonzero(new)
        lowest = np.minimum.reduceat(np.where(whole, owner, self.NOWHERE), starts)
        self.lowest = lowest[np.cumsum(new) - 1]

    def lcp_levels(self) -> list[np.ndarray]:
        """Common prefixes of neighbouring rows, and their minima over 2, 4, ... rows; made when first needed."""
        if self.minima is None:
            order, levels, end = self.sorted
            lcp = np.zeros(self.n, np.int32)
            lcp[1:] = common_prefix(levels, order[:-1], order[1:], end)
            self.minima = [lcp]
            while 2 ** len(self.minima) < self.n:
                held, step = self.minima[-1], 1 << (len(self.minima) - 1)
                self.minima.append(np.minimum(held[:-step], held[step:]) if len(held) > step else held[:0])
        return self.minima

    def widen(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest row intervals around [low, high) whose rows share `depth` words."""
        low, high = low.copy(), high.copy()
        for k, minima in reversed(list(enumerate(self.lcp_levels()))):
            step = 1 << k
            if not len(minima):
                continue
            at = low - step + 1  # lcp of rows low-step+1 .. low
            ok = (at >= 1) & (minima[np.clip(at, 0, len(minima) - 1)] >= depth)
            low = np.where(ok, low - step, low)
            ok = (high + step <= self.n) & (minima[np.clip(high, 0, len(minima) - 1)] >= depth)
            high = np.where(ok, high + step, high)
        return low, high

    def extend(
        self, word: np.ndarray, low: np.ndarray, high: np.ndarray, length: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Put a word before each match; a match that cannot take it is cut from its end until it can."""
        low, high, length = low.copy(), high.copy(), length.copy()
        known = (word > 0) & (word < self.symbols)
        todo = np.flatnonzero(known)
        for x, empty in ((low, 0), (high, self.n), (length, 0)):
            x[~known] = empty
        while len(todo):
            c = word[todo]
            new_low = self.counts[c] + self.tree.rank(c, low[todo])
            new_high = self.counts[c] + self.tree.rank(c, high[todo])
            ok = new_low < new_high
            done = todo[ok]
            low[done], high[done] = new_low[ok], new_high[ok]
            length[done] += 1
            todo = todo[~ok]
            if not len(todo):
                break
            edges = self.lcp_levels()[0]
            left = edges[low[todo]]
            right = np.where(high[todo] < self.n, edges[np.minimum(high[todo], self.n - 1)], 0)
            depth = np.minimum(np.maximum(left, right), length[todo] - 1)
            stuck = length[todo] == 0
            depth = np.where(stuck, 0, depth)
            wide_low, wide_high = self.widen(low[todo], high[todo], depth)
            empty = depth == 0
            low[todo] = np.where(empty, 0, wide_low)
            high[todo] = np.where(empty, self.n, wide_high)
            length[todo] = depth
            todo = todo[~stuck]
        return low, high, length

    def stream(self, queries: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query and word: matched length from there on, and the smallest document of the window that starts there.

        All queries go from their last word to their first together.  The document is NOWHERE
        where fewer than `window` words match.
        """
        size = np.array([len(q) for q in queries], np.int64)
        start = np.cumsum(size) - size
        flat = np.concatenate(queries) if len(queries) else np.empty(0, np.int64)
        length_at = np.zeros(len(flat), np.int64)
        lowest_at = np.full(len(flat), self.NOWHERE)
        rank = np.argsort(-size, kind="stable")
        m = len(queries)
        low, high, length = np.zeros(m, np.int64), np.full(m, self.n), np.zeros(m, np.int64)
        for step in range(int(size.max()) if m else 0):
            live = rank[: int(np.searchsorted(-size[rank], -step, side="left"))]
            at = start[live] + size[live] - 1 - step
            low[live], high[live], length[live] = self.extend(flat[at], low[live], high[live], length[live])
            length_at[at] = length[live]
            hit = length[live] >= self.window
            lowest_at[at[hit]] = self.lowest[low[live[hit]]]
        cuts = start[1:]
        return list(zip(np.split(length_at, cuts), np.split(lowest_at, cuts)))
