"""Token ids of many texts by the tokenizers library, with a bounded cache of words.

The vocabularies used here drop white space before the merges and never merge a letter or
digit with a full stop or comma, so a text's ids are those of its pieces between ASCII
blanks, one after the other. Each different piece of some texts is encoded once while the
cache holds it, missing ones in few calls. A text in which a special token may be written
out is given to the library as it is.
"""

from __future__ import annotations

import os

import numpy as np

from barweave.llm.wordhash import BLANK, Words

CACHED_PIECES = 1_000_000
CALL_PIECES = 20_000
SPECIAL_MARK = b"<|"
DETACHED = b".,"


class CachedEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._forget()

    def _forget(self) -> None:
        #: Hashes of the pieces in order, where their ids begin in the pool, and how many.
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begins = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.pool, self.used = np.zeros(1 << 16, dtype=self.dtype), 0

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text; a null has none."""
        whole = {i for i, text in enumerate(texts) if text and SPECIAL_MARK in text}
        words = Words([None if i in whole else t for i, t in enumerate(texts)], BLANK, DETACHED)
        begins, sizes = self.pieces(words)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        limits = ends[words.first].tolist()
        return [
            self._direct(text) if i in whole else ids[limits[i] : limits[i + 1]]
            for i, text in enumerate(texts)
        ]

    def pieces(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """For each word, where its ids begin in the pool and how many there are."""
        if len(self.keys) > CACHED_PIECES:
            self._forget()
        unique, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        if not known.all():
            new = first[~known]
            starts, stops = words.starts[new].tolist(), words.stops[new].tolist()
            made = [words.buffer[a:b].decode() for a, b in zip(starts, stops)]
            begins, sizes = self._learn(made)
            self.keys = np.insert(self.keys, at[~known], unique[~known])
            self.begins = np.insert(self.begins, at[~known], begins)
            self.sizes = np.insert(self.sizes, at[~known], sizes)
            at = np.searchsorted(self.keys, unique)
        return self.begins[at][which], self.sizes[at][which]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of these pieces in the pool."""
        sizes = []
        for start in range(0, len(pieces), CALL_PIECES):
            some = pieces[start : start + CALL_PIECES]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, dtype=self.dtype)
            begins = np.fromiter((o[0] for o in found.offsets), dtype=np.int64, count=len(ids))
            ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)) + 1)
            sizes.append(np.diff(np.searchsorted(begins, ends), prepend=0))
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        all_sizes = np.concatenate(sizes)
        ends = self.used - int(all_sizes.sum()) + np.cumsum(all_sizes)
        return ends - all_sizes, all_sizes

    def _direct(self, text: bytes) -> np.ndarray:
        found = self.tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.array(found.ids, dtype=self.dtype)


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]
