"""Alignment of two tokenizers against the libraries and plain loops."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barweave.llm import two_tokenizers
from barweave.llm.alignment import MADE, align_tokenizers, pair_table, segments_of
from barweave.llm.perfect_hash import PerfectHash
from barweave.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SCHEMA = "doc_id bigint, text string, n_best string, other int"


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    table = two_tokenizers._byte_alphabet()
    names = {i: bytes(table[c] for c in t) for t, i in a.get_vocab().items() if i < 50256}
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1]), names


def tokens(text, library):
    """(id, start, stop) lists of both, or none if bytes differ."""
    a, b, names = library
    whole = (" " + text).encode()
    found = []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    found.append([(i, names[i]) for i in ids])
    pieces = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        pieces.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    found.append(pieces)
    out = []
    for side in found:
        if b"".join(t for _, t in side) != whole:
            return None
        ends = np.cumsum([0, *(len(t) for _, t in side)]).tolist()
        out.append([(i, s, e) for (i, _), s, e in zip(side, ends, ends[1:])])
    return out


def by_hand(texts, library):
    described, count = [], Counter()
    for text in texts:
        both = tokens(text, library) if text else None
        if both is None:
            described.append(None)
            continue
        a, b = both
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in both]
            groups.append("|".join(sides))
            start = end
        described.append((len(a), len(b), len(groups), links, ";".join(groups)))
        count.update(set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for d in described:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = d
        high = sum(count[link] == best[link[0]] for link in links)
        out.append((n_a, n_b, n_groups, len(links), high, sum(count[link] for link in links), groups))
    return out


ODD = [
    None, "", " ", "  two  blanks ", "a b\tc\n d  e 　f", "▁ mark ▁x", "<|endoftext|> <s> </s> <unk> <0x0A>",
    "naïve café “quoted” — dash", "你好 \U0001f600 \U0001f600x", "x" * 5000, "don't I'll 12345 3.14", "\x00 \x01\x7f",
    "same words here", "same words here", " lead", "trail ", "é ́x", "ﬁ ² Ａ",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = ["the", "of", "Token", "aligned", "naïve", "42", "x,y", "(or)", "“no”", "été", "  ", "\n"]
    return [*ODD, *(" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(30))]


@pytest.mark.parametrize("segment_pairs, most_pairs", [(1 << 16, 1 << 20), (40, 1 << 20), (1 << 16, 5)])
def test_as_brute_force(spark, library, texts, segment_pairs, most_pairs):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    made = align_tokenizers(rows, *FILES, segment_pairs=segment_pairs, most_pairs=most_pairs)
    assert set(made.columns) == {"doc_id", "other", *MADE}
    found = {r.doc_id: tuple(r[c] for c in MADE) for r in made.collect()}
    assert found == dict(enumerate(by_hand(texts, library)))


def test_pieces_are_as_whole_texts(library, texts):
    rng = random.Random(4)
    chars = "ab  \t\n.,'  　éß▁“你<|>_1\u0085́"
    strings = [t for t in texts if t] + ["".join(rng.choices(chars, k=rng.randrange(1, 25))) for _ in range(2000)]
    both = two_tokenizers.aligner(*FILES)
    assert both.cuts
    for text, pieces in zip(strings, both.read([s.encode() for s in strings])):
        expected = tokens(text, library)
        assert bool(pieces) == (expected is not None), text
        if expected is not None:
            groups = ";".join(both.groups[p] for p in pieces)
            ids = [side.split(",") for g in groups.split(";") for side in g.split("|")]
            assert [int(i) for side in ids[0::2] for i in side] == [i for i, *_ in expected[0]], text
            assert [int(i) for side in ids[1::2] for i in side] == [i for i, *_ in expected[1]], text


def test_tree_sum_and_cache(spark, library, texts, monkeypatch):
    """Many tasks, several rounds of sums, a cache that forgets."""
    monkeypatch.setattr("barweave.llm.alignment.FAN_IN", 2)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 8)], "doc_id bigint, text string")
    segments, n_pairs = pair_table(rows.repartition(24), *FILES, segment_pairs=100)
    total = {}
    for r in segments.collect():
        keys, counts = np.frombuffer(r.keys, dtype=np.int64), np.frombuffer(r.counts, dtype=np.int64)
        total |= dict(zip(keys.tolist(), counts.tolist()))
        assert set(segments_of(keys >> 15, max(1, -(-n_pairs // 100))).tolist()) == {r.seg}
    count = Counter()
    for text in texts * 8:
        both = tokens(text, library) if text else None
        if both:
            a, b = both
            count.update({(i << 15) | j for i, s, e in a for j, t, f in b if s < f and t < e})
    assert total == dict(count) and n_pairs == len(count)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 5000, 70_000):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.int64))
        made = PerfectHash.loads(PerfectHash.of(keys).dumps())
        assert sorted(made.index(keys).tolist()) == list(range(len(keys))) and made.size == len(keys)


def test_empty_table_and_query(spark, library):
    assert align_tokenizers(spark.createDataFrame([], SCHEMA), *FILES).count() == 0
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    small = sorted(rows, key=lambda r: r.doc_id)
    found = {r.doc_id: r for r in QUERIES["op11_token_alignment"](spark, SF_DIR).collect()}
    for r, want in zip(small, by_hand_fast([r.text for r in small], library)):
        got = found[r.doc_id]
        digest = hashlib.sha256(want[-1].encode()).hexdigest() if want[0] else ""
        assert tuple(got)[1:] == (*want[:-1], digest), r.doc_id


def by_hand_fast(texts, library):
    """Like :func:`by_hand`, with links found in order instead of among all pairs."""
    described, count = [], Counter()
    for text in texts:
        both = tokens(text, library) if text else None
        if both is None:
            described.append(None)
            continue
        a, b = both
        owner_a = np.repeat([i for i, *_ in a], [e - s for _, s, e in a])
        owner_b = np.repeat([j for j, *_ in b], [e - s for _, s, e in b])
        starts = sorted({s for _, s, _ in a} | {s for _, s, _ in b})
        links = [(int(owner_a[s]), int(owner_b[s])) for s in starts]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        place = {e: n for n, e in enumerate(ends)}
        sides = []
        for side in both:
            held = [[] for _ in ends]
            at = np.searchsorted(ends, [e for *_, e in side])
            for (i, *_), n in zip(side, at.tolist()):
                held[n].append(str(i))
            sides.append(held)
        groups = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides))
        described.append((len(a), len(b), len(place), links, groups))
        count.update(set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    for d in described:
        if d is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            high = sum(count[link] == best[link[0]] for link in d[3])
            yield (*d[:3], len(d[3]), high, sum(count[link] for link in d[3]), d[4])
