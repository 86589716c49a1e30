"""Static range asymmetric numeral system over interleaved lanes, in numpy.

A block is coded with one frequency table that all blocks share. Token ``t`` belongs to lane
``t % lanes``; all lanes take a step at once. States have 64 bits and give 32-bit words.
The encoder runs backward; the words of a step are stored by lane, so the decoder reads
forward. Every ``CHECKPOINT`` steps the block keeps the place in the words and all states:
from each such point decoding can start, and ``decode`` runs all of them side by side.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS = 20
MOST_LANES = 4096
LANE_STEPS = 256  # steps that a full block has at least
CHECKPOINT = 128
LOWEST = np.uint64(1 << 31)
MAGIC = b"LRA1"
HEADER = struct.Struct("<4sIQQIIII")  # magic, lanes, tokens, words, every, points, crc, crc


class Table:
    """Frequencies that sum to ``2**SCALE_BITS``; every counted symbol has one at least."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies.astype(np.uint64)
        starts = np.zeros(len(frequencies) + 1, dtype=np.uint64)
        np.cumsum(self.frequencies, out=starts[1:])
        self.starts = starts[:-1]
        self.symbol = np.repeat(np.arange(len(frequencies)), frequencies.astype(np.int64))

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        total = 1 << SCALE_BITS
        seen = np.flatnonzero(counts)
        if len(seen) > total:
            raise ValueError(f"more than {total} different symbols")
        out = np.zeros(len(counts), dtype=np.int64)
        if not len(seen):
            return cls(out)
        share = counts[seen].astype(np.float64) / counts[seen].sum() * (total - len(seen))
        out[seen] = 1 + np.floor(share).astype(np.int64)
        # What rounding down has left goes to the largest remainders, by symbol when equal.
        rest = total - int(out.sum())
        by = np.argsort(-(share - np.floor(share)), kind="stable")[:rest]
        out[seen[by]] += 1
        out[seen[0]] += total - int(out.sum())
        return cls(out)


def encode(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = 1
    while lanes < MOST_LANES and lanes * LANE_STEPS < n:
        lanes *= 2
    steps = -(-n // lanes)
    state = np.full(lanes, LOWEST, dtype=np.uint64)
    words: list[np.ndarray] = []
    points: list[tuple[int, np.ndarray]] = []
    written = 0
    shift, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    scale = np.uint64(SCALE_BITS)
    for step in reversed(range(steps)):
        symbols = ids[step * lanes : (step + 1) * lanes]
        own = state[: len(symbols)]
        often = table.frequencies[symbols]
        full = own >= often << np.uint64(63 - SCALE_BITS)
        out = (own[full] & low).astype("<u4")
        words.append(out)
        written += len(out)
        own = np.where(full, own >> shift, own)
        quotient = own // often
        state[: len(symbols)] = (
            (quotient << scale) + (own - quotient * often) + table.starts[symbols]
        )
        if step % CHECKPOINT == 0:
            points.append((written, state.copy()))
    points.reverse()
    payload = b"".join(w.tobytes() for w in reversed(words))
    index = b"".join(
        struct.pack("<Q", written - left) + held.astype("<u8").tobytes() for left, held in points
    )
    body = index + payload
    plain = zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
    head = HEADER.pack(
        MAGIC, lanes, n, written, CHECKPOINT, len(points), zlib.crc32(body), plain
    )
    return head + body


def decode(block: bytes, table: Table) -> np.ndarray:
    """The ids of a block; a block that is damaged in any way is an error."""
    magic, lanes, n, n_words, every, n_points, crc, plain = HEADER.unpack_from(block)
    body = memoryview(block)[HEADER.size :]
    if magic != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("damaged block")
    width = 8 + 8 * lanes
    index = np.frombuffer(body[: n_points * width], dtype=np.uint8).reshape(n_points, width)
    place = index[:, :8].copy().view("<u8").ravel().astype(np.int64)
    state = index[:, 8:].copy().view("<u8").reshape(n_points, lanes)
    words = np.frombuffer(body[n_points * width :], dtype="<u4").astype(np.uint64)
    words = np.append(words, np.uint64(0))
    steps = -(-n // lanes)
    out = np.zeros((n_points, every, lanes), dtype="<u4")
    mask, scale = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    for step in range(min(every, steps)):
        live = -(-(steps - step) // every)  # points whose part has this step
        own = state[:live]
        slot = own & mask
        symbols = table.symbol[slot]
        out[:live, step] = symbols
        own = table.frequencies[symbols] * (own >> scale) + slot - table.starts[symbols]
        wants = own < LOWEST
        # Lanes behind the end of the text take no part in the last step.
        last = (live - 1) * every + step
        if last == steps - 1 and n < steps * lanes:
            wants[live - 1, n - last * lanes :] = False
        nth = np.cumsum(wants, axis=1)
        at = np.minimum(place[:live, None] + nth - 1, n_words)
        state[:live] = np.where(wants, (own << np.uint64(32)) | words[at], own)
        place[:live] += nth[:, -1]
    ids = out.reshape(-1)[:n] if n_points else np.zeros(0, dtype="<u4")
    if zlib.crc32(np.ascontiguousarray(ids).tobytes()) != plain:
        raise ValueError("damaged block")
    return ids
