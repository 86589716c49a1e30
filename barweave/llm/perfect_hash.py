"""Minimal perfect hashing of distinct 64-bit keys by levels of bits.

Keys that are alone at their place in a level's bits are settled there, the others go on to the next
level. A key's index is the number of bits before its own, over all levels. Any other key has
some index too or none, so callers verify against the keys they have kept in order.
"""

from __future__ import annotations

import numpy as np

from barweave.llm.wordhash import mix

SPARE = 2  # bits of a level for each of its keys


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return mix(keys ^ mix(np.full(1, level + 1, dtype=np.uint64))) % np.uint64(bits)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        #: Each level's bits as 64-bit words, and how many bits are set before each word.
        self.levels = levels
        self.before, self.size = [], 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            ends = np.cumsum(counts)
            self.before.append(self.size + ends - counts)
            self.size += int(ends[-1]) if len(ends) else 0

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        levels, rest = [], keys.astype(np.uint64)
        while len(rest):
            n_words = -(-SPARE * len(rest) // 64)
            places = _places(rest, len(levels), 64 * n_words).astype(np.int64)
            alone = np.bincount(places, minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            rest = rest[~alone[places]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 for one that is certainly no key."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            places = _places(keys[open_], level, 64 * len(words))
            word, bit = (places >> np.uint64(6)).astype(np.int64), places & np.uint64(63)
            held = words[word]
            hit = (held >> bit) & np.uint64(1) == 1
            below = held & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[level][word] + np.bitwise_count(below)
            out[open_[hit]] = rank[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out

    def dumps(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<u8")
        return b"".join([sizes.tobytes(), *(w.astype("<u8").tobytes() for w in self.levels)])

    @classmethod
    def loads(cls, data: bytes) -> PerfectHash:
        words = np.frombuffer(data, dtype="<u8")
        n = int(words[0])
        ends = np.cumsum(words[1 : n + 1].astype(np.int64)) + n + 1
        return cls([words[b:e] for b, e in zip([n + 1, *ends[:-1].tolist()], ends.tolist())])
