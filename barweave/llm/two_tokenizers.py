"""Token ids of two tokenizers for the same texts, and which tokens stand over which.

Used inside tasks. Both are given a blank and the text. A text is cut before blanks that follow a
character other than a blank and that a visible character follows: there both vocabularies begin a
new token (which is looked up when they are loaded; otherwise texts are not cut). So
ids, links and groups of a text are those of its pieces, one after the other, and every different
piece is encoded and aligned once while the cache holds it.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

CACHED_PIECES = 300_000
CACHED_BYTES = 32 << 20
#: Bytes after a blank that do not begin a white-space character, in ASCII or beyond.
CUT = re.compile(rb"(?<=[^ ])(?= [!-~\xc3-\xdf\xe4-\xf4])")
MARK = "▁".encode()
#: Bytes of characters on which all libraries agree: a line's end, visible ASCII, and behind the byte
#: C3 Latin letters with marks.
_BYTES = np.arange(256)
ALONE = (_BYTES == 10) | ((_BYTES > 32) & (_BYTES < 127)) | (_BYTES == 0xC3)
BEHIND_C3 = (_BYTES >= 0x80) & (_BYTES <= 0xBF) & (_BYTES != 0x97) & (_BYTES != 0xB7)
# Fixed value: how byte-level vocabularies split a text before they merge.
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: visible ones for themselves,
    the others, in order, for what follows U+00FF."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def flat(lists) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64)


class Numbers(dict):
    """Numbers of pieces in the order they are first asked for; ``new`` has those not learnt yet."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        self.new.append(piece)
        number = self[piece] = len(self)
        return number


class Numerals:
    """Decimal numerals of 0, 1, ... n - 1 as bytes in one array."""

    def __init__(self, n: int):
        shown = [b"%d" % i for i in range(n)]
        self.data = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.sizes = np.fromiter(map(len, shown), dtype=np.int64, count=n)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Numerals, a mark behind each, and where each ends with its mark."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
        out[ends - 1] = marks
        inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(ends - 1 - sizes, sizes) + inner] = self.data[np.repeat(self.starts[ids], sizes) + inner]
        return out.tobytes(), ends


class Growing:
    """A numpy array that is appended to."""

    def __init__(self):
        self.data, self.used = np.zeros(1 << 12, dtype=np.int64), 0

    def extend(self, values: np.ndarray) -> None:
        while self.used + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.used : self.used + len(values)] = values
        self.used += len(values)


class Aligner:
    """Pieces by number; numbers hold until :meth:`trim` forgets all.

    New pieces are aligned together: with the ends of the tokens of both sides in order, every
    stretch between two neighbouring ends is one link, and every end of both one group.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        by_id = {i: piece for piece, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [
            bytes(alphabet.get(c, 0) for c in by_id.get(i, "")) for i in range(max(by_id) + 1)
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        #: A pair of ids is one number, the second in the lower bits.
        self.shift = len(pieces).bit_length()
        if self.shift + len(self.bytes_a).bit_length() > 42:
            raise ValueError("vocabularies are too large for pairs of ids and row numbers in 63 bits")
        with open(path_a, encoding="utf-8") as file:
            told = json.load(file)
        splitter = told.get("pre_tokenizer") or {}
        plain = told.get("normalizer") is None and splitter.get("type") == "ByteLevel"
        plain = plain and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        crossing = any(re.search("[^▁]▁", p) for p in pieces)
        self.cuts = bool(plain) and not crossing
        self.fast = self._fast(told) if self.cuts else None
        self.numerals = Numerals(max(len(self.bytes_a), len(self.bytes_b)))
        self.pool_a, self.starts_a = np.frombuffer(b"".join(self.bytes_a), np.uint8), _starts(self.sizes_a)
        self.pool_b, self.starts_b = np.frombuffer(b"".join(self.bytes_b), np.uint8), _starts(self.sizes_b)
        self.generation = 0
        self._forget()

    def _fast(self, told: dict):
        """The same vocabulary in a library that is faster, if ids are the order of the merges."""
        import tiktoken

        merges = [m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]]
        known = told["model"]["vocab"]
        ordered = all(known.get("".join(m)) == 256 + i for i, m in enumerate(merges))
        if not ordered or told["model"].get("ignore_merges"):
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("pieces", pat_str=SPLITS, mergeable_ranks=ranks, special_tokens={})

    def _forget(self) -> None:
        self.numbers = Numbers()
        #: By piece: tokens of both, groups, links, and if the tokens give the piece back.
        self.counts = [Growing() for _ in range(5)]
        self.groups: list[str] = []
        #: All links of all pieces, and where each piece's begin.
        self.links, self.first_link = Growing(), Growing()
        self.broken: set[int] = set()
        self.held = 0
        self.generation += 1

    def trim(self) -> None:
        if len(self.numbers) > CACHED_PIECES or self.held > CACHED_BYTES:
            self._forget()

    def read(self, texts: list[bytes | None]) -> list[list[int]]:
        """Numbers of each text's pieces, in order; none for a text that is null or empty, or that
        the tokens of one side do not give back."""
        out = []
        number = self.numbers.__getitem__
        for text in texts:
            if not text:
                out.append([])
                continue
            whole = not self.cuts or MARK in text
            out.append(list(map(number, [b" " + text] if whole else CUT.split(b" " + text))))
        if self.numbers.new:
            new, self.numbers.new = self.numbers.new, []
            self._learn(new)
        if self.broken:
            return [[] if any(p in self.broken for p in pieces) else pieces for pieces in out]
        return out

    def _plain(self, sizes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Which pieces are a blank and then characters on which the libraries agree."""
        behind = np.concatenate([[False], data[:-1] == 0xC3])
        fine = np.where(behind, BEHIND_C3[data], ALONE[data])
        starts = np.cumsum(sizes) - sizes
        fine[starts] = sizes > 1
        return np.logical_and.reduceat(fine, starts)

    def _encoded(self, new: list[bytes], sizes: np.ndarray, data: np.ndarray):
        """Ids by both tokenizers, and how many each piece has."""
        texts = [p.decode() for p in new]
        found_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        plain = np.zeros(len(new), dtype=bool) if self.fast is None else self._plain(sizes, data)
        counts = np.zeros(len(new), dtype=np.int64)
        ids = np.zeros(0, dtype=np.int64)
        if plain.any():
            joined = "".join(texts) if plain.all() else "".join([texts[i] for i in np.flatnonzero(plain)])
            ids = np.array(self.fast.encode_ordinary(joined), dtype=np.int64)
            stops = np.searchsorted(np.cumsum(self.sizes_a[ids]), np.cumsum(sizes[plain]), side="right")
            counts[plain] = np.diff(stops, prepend=0)
        if not plain.all():
            rest = [texts[i] for i in np.flatnonzero(~plain)]
            others = [e.ids for e in self.a.encode_batch(rest, add_special_tokens=False)]
            counts[~plain] = np.fromiter(map(len, others), np.int64, len(others))
            of_plain, both = np.repeat(plain, counts), np.empty(int(counts.sum()), dtype=np.int64)
            both[of_plain], both[~of_plain] = ids, flat(others)
            ids = both
        return ids, counts, flat(found_b), np.fromiter(map(len, found_b), np.int64, len(new))

    def _learn(self, new: list[bytes]) -> None:
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        bytes_of = np.frombuffer(b"".join(new), np.uint8)
        ids_a, n_a, ids_b, n_b = self._encoded(new, sizes, bytes_of)
        same = self._gives_back(ids_a, n_a, sizes, bytes_of, self.pool_a, self.starts_a, self.sizes_a)
        same &= self._gives_back(ids_b, n_b, sizes, bytes_of, self.pool_b, self.starts_b, self.sizes_b)
        if not same.all():
            # Pieces that do not come back are left out: no tokens, links or groups.
            ids_a, ids_b = ids_a[np.repeat(same, n_a)], ids_b[np.repeat(same, n_b)]
            self.broken |= {len(self.groups) + int(i) for i in np.flatnonzero(~same)}
            n_a, n_b, sizes = n_a * same, n_b * same, sizes * same
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        both = np.concatenate([ends_a, ends_b])
        both.sort(kind="stable")  # two runs in order, to be merged
        again = np.concatenate([[False], both[1:] == both[:-1]])[: len(both)]
        common, steps = both[again], both[~again]
        piece_ends = np.cumsum(sizes)

        def per_piece(ends: np.ndarray) -> np.ndarray:
            """How many of these ends each piece has."""
            return np.diff(np.searchsorted(ends, piece_ends, side="right"), prepend=0)

        links = (ids_a[np.searchsorted(ends_a, steps)] << self.shift) | ids_b[np.searchsorted(ends_b, steps)]
        n_links = per_piece(steps)
        begin = self.links.used
        self.links.extend(links)
        self.first_link.extend(begin + np.cumsum(n_links) - n_links)
        for made, values in zip(self.counts, (n_a, n_b, per_piece(common), n_links, same.astype(np.int64))):
            made.extend(values)
        self.groups += self._shown(ids_a, ends_a, ids_b, ends_b, common, n_a + n_b)
        self.held += len(bytes_of)

    @staticmethod
    def _gives_back(ids, counts, sizes, expected, pool, starts, lengths) -> np.ndarray:
        """For each piece, if its tokens' bytes are the piece."""
        each = lengths[ids]
        ends = np.concatenate([[0], np.cumsum(each)])
        made_ends = ends[np.cumsum(counts)]
        same_size = np.diff(made_ends, prepend=0) == sizes
        inner = np.arange(int(ends[-1])) - np.repeat(ends[:-1], each)
        made = pool[np.repeat(starts[ids], each) + inner]
        if same_size.all():
            differ = np.flatnonzero(made != expected)
            same = np.ones(len(sizes), dtype=bool)
            same[np.searchsorted(np.cumsum(sizes), differ, side="right")] = False
            return same
        stops = np.cumsum(sizes)
        return np.array(
            [
                bool(ok) and np.array_equal(made[e - n : e], expected[s - n : s])
                for ok, e, s, n in zip(same_size, made_ends, stops, sizes)
            ]
        )

    def _shown(self, ids_a, ends_a, ids_b, ends_b, common, n_tokens) -> list[str]:
        """Groups of each piece: ids of one side, a bar, ids of the other, a semicolon between."""
        of_a, of_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        at_a = np.arange(len(ids_a)) + np.searchsorted(of_b, of_a, side="left")
        at_b = np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, side="right")
        ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        ids[at_a], ids[at_b] = ids_a, ids_b
        marks = np.full(len(ids), ord(","), dtype=np.uint8)
        marks[at_a[np.isin(ends_a, common, assume_unique=True)]] = ord("|")
        marks[at_b[np.isin(ends_b, common, assume_unique=True)]] = ord(";")
        text, ends = self.numerals.joined(ids, marks)
        shown = text.decode("ascii")
        stops = np.concatenate([[0], ends])[np.cumsum(n_tokens)].tolist()
        return [shown[a : max(a, b - 1)] for a, b in zip([0, *stops], stops)]

    def gathered(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of these pieces in order, and how many each has."""
        counts = self.counts[3].data[pieces]
        ends = np.cumsum(counts)
        inner = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)
        return self.links.data[np.repeat(self.first_link.data[pieces], counts) + inner], counts


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]
