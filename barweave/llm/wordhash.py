"""Words of many texts at once, as numpy arrays: where they are and 64-bit hashes.

Used inside tasks. Texts are joined to one buffer of UTF-8 bytes with A-Z lower-cased, and
a word's hash is a polynomial of its bytes modulo 2**64, taken from running sums over the
buffer, then mixed. A buffer holds some megabytes (see ``slices``), so memory is bounded by
that or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 2 << 20

_CLASSES = np.arange(256)
#: Bytes that end a word: blanks and the control characters 9 to 13.
BLANK = (_CLASSES == 32) | ((_CLASSES >= 9) & (_CLASSES <= 13))
#: Bytes that end a word: all of ASCII but digits and letters.
NOT_ALNUM = (_CLASSES < 128) & ~(
    ((_CLASSES >= 48) & (_CLASSES <= 57))
    | ((_CLASSES >= 65) & (_CLASSES <= 90))
    | ((_CLASSES >= 97) & (_CLASSES <= 122))
)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z = z ^ (z >> np.uint64(27))
    z = z * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """``base`` to 0, 1, ... n - 1; kept while a worker sees texts of like size."""
    known = _POWERS.get(int(base))
    if known is None or not n <= len(known) <= 4 * n + 4 * SLICE_BYTES:
        known = np.full(max(n, 1024), base, dtype=np.uint64)
        known[0] = 1
        known = _POWERS[int(base)] = np.multiply.accumulate(known)
    return known[:n]


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Words:
    """The words of some texts: byte ranges in ``buffer``, hashes, and each text's share."""

    def __init__(self, texts: list[bytes | None], ends: np.ndarray, detached: bytes = b""):
        """``ends`` are the bytes between words. A byte of ``detached`` that ends a word of
        a digit or an ASCII letter before it is a word of its own."""
        lowered = [(t or b"").lower() for t in texts]
        self.buffer = b"\n".join(lowered) + b"\n"
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in lowered), dtype=np.int64, count=len(texts))
        #: First byte of each text in the buffer, and the end of the last.
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)])
        inside = ~ends[data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        self.starts, self.stops = edge[0::2], edge[1::2]
        if detached:
            self._detach(data, detached)
        #: Words of text i are first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.hashes = self._hash(data)

    def _detach(self, data: np.ndarray, detached: bytes) -> None:
        last = np.zeros(256, dtype=bool)
        last[list(detached)] = True
        cut = np.flatnonzero(
            last[data[self.stops - 1]]
            & (self.stops - self.starts > 1)
            & ~NOT_ALNUM[data[self.stops - 2]]
            & (data[self.stops - 2] < 128)
        )
        ends = self.stops[cut]
        self.stops[cut] -= 1
        self.starts = np.insert(self.starts, cut + 1, ends - 1)
        self.stops = np.insert(self.stops, cut + 1, ends)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        powers = _powers(n, BASE)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
        inverse = _powers(n, _INVERSE)
        raw = (sums[self.stops] - sums[self.starts]) * inverse[self.starts]
        lengths = (self.stops - self.starts).astype(np.uint64)
        return mix(raw + lengths * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter sequence is one run as a whole."""
    if len(words) == 0:
        return words
    count = max(1, len(words) - size + 1)
    length = min(size, len(words))
    out = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        out = mix(out * BASE + words[k : k + count])
    return out


def slices(batches: Iterator, column: int, limit: int = SLICE_BYTES) -> Iterator:
    """Arrow batches cut so that the texts of each have some megabytes at most."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        sizes = sizes.to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def text_bytes(array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string array."""
    import pyarrow as pa

    return array.cast(pa.binary()).to_pylist()
