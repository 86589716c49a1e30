"""A word-level FM-index of one shard of texts, in numpy.

The shard is one string of symbols: words that phrases have are numbered from 1, each run of
other words is one separator. The suffixes are sorted by prefix doubling; the last symbols
of the rotations make the Burrows-Wheeler transform, kept as a wavelet matrix. Phrases are
found by backward search, many at once, and located by walking back to rows whose position
was sampled: those at every sixteenth position, and those behind a separator.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16
SEPARATOR = 0


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in sorted order.

    Separators sort by their place, so a comparison ends at the next one, and only suffixes
    that are still tied are sorted again in a round.
    """
    n = len(symbols)
    stops = symbols == SEPARATOR
    n_stops = int(np.count_nonzero(stops))
    rank = symbols.astype(np.int64) + n_stops
    rank[stops] = np.arange(n_stops)
    order = np.argsort(rank, kind="stable")
    rank, tied = _ranks(order, rank[order], rank)
    reach = 1
    while len(tied):
        ahead = tied + reach
        beyond = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        key = rank[tied] * np.int64(n + 1) + beyond + 1
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        # A tied group keeps the places it had; inside it the new keys decide.
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], rank[tied][1:] != rank[tied][:-1]])
        index = np.arange(len(tied))
        group_start = np.maximum.accumulate(np.where(group, index, 0))
        key_start = np.maximum.accumulate(np.where(first, index, 0))
        base = rank[tied]
        order[base + (index - group_start)] = tied
        rank[tied] = base + (key_start - group_start)
        alone = first & np.concatenate([first[1:], [True]])
        tied = tied[~alone]
        reach *= 2
    return order


def _ranks(order, sorted_keys, rank):
    """Rank of each position, the first place of its group, and the positions in ties."""
    first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = start
    alone = first & np.concatenate([first[1:], [True]])
    return rank, order[~alone]


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit vector with running counts per level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.ones, self.zeros = [], []
        for level in reversed(range(bits)):
            bit = ((values >> level) & 1).astype(bool)
            counts = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=counts[1:])
            self.ones.append(counts)
            self.zeros.append(len(values) - int(counts[-1]))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        low = np.zeros_like(places)
        for level, counts, zeros in zip(reversed(range(self.bits)), self.ones, self.zeros):
            bit = ((symbols >> level) & 1).astype(bool)
            ones_low, ones_high = counts[low], counts[places]
            low = np.where(bit, zeros + ones_low, low - ones_low)
            places = np.where(bit, zeros + ones_high, places - ones_high)
        return places - low

    def access(self, places: np.ndarray) -> np.ndarray:
        """The symbols at some places."""
        symbols = np.zeros(len(places), dtype=np.int64)
        for counts, zeros in zip(self.ones, self.zeros):
            bit = counts[places + 1] - counts[places]
            symbols = symbols * 2 + bit
            places = np.where(bit > 0, zeros + counts[places], places - counts[places])
        return symbols


class FmIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        """``symbols`` begin and end with a separator; words are 1 to ``alphabet``."""
        n = len(symbols)
        order = suffix_order(symbols)
        before = symbols[order - 1]
        self.bits = max(1, int(alphabet).bit_length())
        self.transform = WaveletMatrix(before.astype(np.int64), self.bits)
        counts = np.bincount(symbols, minlength=alphabet + 1)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.n = n
        sampled = (order % SAMPLE == 0) | (before == SEPARATOR)
        self.sampled_rows = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(sampled, out=self.sampled_rows[1:])
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows of phrases of one length, one phrase per row of a matrix."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbols = phrases[alive, column]
            base = self.starts[symbols]
            low[alive] = base + self.transform.rank(symbols, low[alive])
            high[alive] = base + self.transform.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        found = np.zeros(len(phrases), dtype=bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in some rows."""
        out = np.zeros(len(rows), dtype=np.int64)
        steps = np.zeros(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            at = rows[todo]
            known = self.sampled_rows[at + 1] > self.sampled_rows[at]
            done = todo[known]
            out[done] = self.samples[self.sampled_rows[rows[done]]] + steps[done]
            todo = todo[~known]
            at = rows[todo]
            symbols = self.transform.access(at)
            rows[todo] = self.starts[symbols] + self.transform.rank(symbols, at)
            steps[todo] += 1
        return out
