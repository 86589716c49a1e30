"""Classes without counts of links: points that link with a pivot are contracted."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barweave.llm import near_join
from barweave.llm.near_join import keep_one, near_classes, postings_of


def brute_classes(texts: list[str], shingle: int, percent: int) -> list[int]:
    sets = []
    for text in texts:
        words = text.split(" ")
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))})
    least = list(range(len(texts)))
    linked = [
        (i, j)
        for i in least
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return least


def drifting(rng: random.Random, steps: int, words: int, each: int) -> list[str]:
    """A chain: each text differs from the one before in a few words, the ends do not link."""
    text = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(steps):
        out.append(" ".join(text))
        text = [*text]
        for at in rng.sample(range(words), each):
            text[at] = f"w{rng.randrange(10**6)}"
    return out


def dense(rng: random.Random, copies: int, words: int) -> list[str]:
    """Copies of one text with a word or so changed in each."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = [*base]
        for at in rng.sample(range(words), rng.choice([0, 1, 1, 2, 6])):
            text[at] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("points, grams, percent", [(8, 1 << 20, 80), (1024, 900, 80), (6, 1 << 20, 60)])
def test_classes_as_brute_force(spark, monkeypatch, points, grams, percent):
    monkeypatch.setattr(near_join, "REGION_POINTS", points)
    monkeypatch.setattr(near_join, "REGION_GRAMS", grams)
    rng = random.Random(points)
    texts = [*dense(rng, 40, 90), *drifting(rng, 30, 90, 2), *drifting(rng, 25, 60, 1), *dense(rng, 3, 30)]
    rng.shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = brute_classes(texts, 5, percent)
    found = near_classes(rows, percent=percent, shingle=5, count_links=False)
    assert "n_links" not in found.columns
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(expected))
    kept = sorted(r.doc_id for r in keep_one(rows, percent=percent, shingle=5).collect())
    assert kept == sorted(set(expected))


def test_a_group_around_pivots_goes_no_further(spark, monkeypatch):
    """Points that link with all pivots leave no region behind: no rows after one level."""
    monkeypatch.setattr(near_join, "REGION_POINTS", 8)
    sizes = []
    split = near_join._split

    def counted(*given):
        parts, measured = split(*given)
        sizes.append((measured.count(), parts.count()))
        return parts, measured

    monkeypatch.setattr(near_join, "_split", counted)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join([*base[:n], f"x{n}", *base[n + 1 :]]) for n in range(100)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.doc_id for r in keep_one(rows).collect()] == [0]
    assert sizes == [(100, 0)]


def test_linked_sets_share_a_posting():
    """Two sets at the limit of the rule have one posting in common, whichever grams differ."""
    import numpy as np

    rng = np.random.default_rng(3)
    for size, percent in ((20, 85), (60, 80), (200, 85), (500, 60)):
        for _ in range(40):
            both = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            spare = (100 - percent) * len(both) // percent
            cut = int(rng.integers(0, spare + 1))
            left = np.sort(np.concatenate([both, rng.integers(0, 1 << 63, cut, dtype=np.uint64)]))
            right = np.sort(np.concatenate([both, rng.integers(0, 1 << 63, spare - cut, dtype=np.uint64)]))
            assert near_join.links(len(both), len(left), len(right), percent)
            assert np.intersect1d(postings_of(left, 1, percent), postings_of(right, 2, percent)).size


def long_texts(rng: random.Random, count: int, words: int, shared: int) -> list[str]:
    """Long texts with a passage in common, far from links; the last one is a near copy of the first."""
    passage = [f"p{rng.randrange(10**6)}" for _ in range(shared)]
    texts = [passage + [f"w{rng.randrange(10**9)}" for _ in range(words - shared)] for _ in range(count)]
    texts.append([*texts[0][:-20], *(f"z{n}" for n in range(20))])
    return [" ".join(words) for words in texts]


def test_long_texts_with_a_common_passage_are_no_cell(spark, monkeypatch):
    """Cells do not grow with the length of texts: only the near copies are tied."""
    texts = long_texts(random.Random(8), 12, 4000, 1600)
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    points = near_join.add_nodes(rows, "text", 5).select("node", F.col("n_shingles").alias("size"), "ranges", "text")
    ranges, nodes = points.drop("text"), {r.text: r.node for r in points.collect()}
    cells = near_join._cells(rows, ranges, 80, 5)
    assert {r.node for r in cells.collect()} == {nodes[texts[0]], nodes[texts[-1]]}
    # Before, a region of such texts was cut into pairs of blocks, each set written once a block.
    monkeypatch.setattr(near_join, "REGION_GRAMS", 6000)
    split = []
    monkeypatch.setattr(near_join, "_split", lambda *given: split.append(given) or pytest.fail("split"))
    monkeypatch.setattr(near_join, "REGION_POINTS", 2)
    docs = rows.withColumn("doc_id", F.lit(1) + F.monotonically_increasing_id())
    assert near_classes(docs, percent=80, shingle=5).select("component_id").distinct().count() == 12
    assert not split


@pytest.mark.parametrize("tied_ranges, tied_points", [(64, 4096), (1 << 24, 3)])
def test_postings_in_rounds_and_small_bounds(spark, monkeypatch, tied_ranges, tied_points):
    """Rounds, few ranges at once, small buckets and stars leave the classes as they are."""
    monkeypatch.setattr(near_join, "ROUND_ROWS", 1)
    monkeypatch.setattr(near_join, "BUCKET_BYTES", 300)
    monkeypatch.setattr(near_join, "TIED_RANGES", tied_ranges)
    monkeypatch.setattr(near_join, "TIED_POINTS", tied_points)
    rng = random.Random(tied_points)
    texts = [*dense(rng, 12, 90), *drifting(rng, 12, 700, 8), *long_texts(rng, 4, 900, 400), *dense(rng, 3, 30)]
    rng.shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = near_classes(rows, percent=80, shingle=5)
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(brute_classes(texts, 5, 80)))


def test_counts_in_fewer_ranges():
    """Adding up neighbouring ranges gives what the wider range holds, cut at 255, too."""
    import numpy as np

    rng = np.random.default_rng(5)
    many = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    crowded = np.unique(np.concatenate([many, rng.integers(0, 1 << 50, 600, dtype=np.uint64)]))
    for grams in (many, crowded, many[:10], many[:300]):
        fine = near_join.range_counts(grams)
        assert len(fine) & (len(fine) - 1) == 0 and max(64, len(grams) // 4) <= len(fine) <= max(64, len(grams) // 2)
        for bits in (6, len(fine).bit_length() - 1):
            direct = np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
            assert np.array_equal(near_join.in_fewer([fine, fine], 1 << bits)[1], np.minimum(direct, 255))
