"""Operators on small tables with nulls, repeats, empty texts and clashing names."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barweave.llm import near_join, rans
from barweave.llm.common import literal_rows
from barweave.llm.decontamination import decontaminate
from barweave.llm.mixing import draw_shards, measure, mix
from barweave.llm.near_join import keep_one, near_classes
from barweave.llm.personal_data import SpanClassifier, find_personal_data
from barweave.llm.quality import judge_quality
from barweave.llm.sharding import assign_shards, fill_table
from barweave.llm.token_counts import apply_edits, build_trees
from barweave.llm.token_files import round_trip
from barweave.llm.toxicity import Model, buckets, score_toxicity, train
from barweave.llm.url_filter import RULE_COLUMNS, judge_urls

SCHEMA = "doc_id bigint, text string, source string, kept string, node string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    words = [f"w{n}" for n in range(400)]
    base = [rng.choice(words) for _ in range(80)]
    near = [*base[:40], "changed", *base[41:]]
    rows = [
        (1, " ".join(base), "a", "x", "y"),
        (1, " ".join(base), "a", "x", "y"),
        (2, " ".join(near), None, None, None),
        (3, None, "a", None, None),
        (None, "", None, None, None),
        (5, " \n\t ", "b", None, None),
        (6, "mail a.b@c.org or +1 (212) 555-0100, 10.0.0.256 and 10.0.0.1", "b", "k", "n"),
        (7, " ".join(rng.choice(words) for _ in range(3000)), "é", "k", "n"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_urls(spark):
    rules = literal_rows(
        spark,
        RULE_COLUMNS,
        [("com", "/", "allow"), ("b.com", "/x/", "block"), ("b.com", "/x/y", "allow")],
    )
    urls = ["http://a.b.COM/x/1?q", "s://b.com/x/y#z", "b.com/x/", None, "http://xb.com/x/", "://b.com"]
    pages = spark.createDataFrame(list(enumerate(urls)), "id int, url string").withColumn("rule", F.lit(9))
    found = {r.id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert found[0] == ("a.b.com", "/x/1", "b.com/x/", "block")
    assert found[1] == ("b.com", "/x/y", "b.com/x/y", "allow")
    assert found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == ("xb.com", "/x/", "com/", "allow") and found[5][1:] == ("", None, "allow")
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert judge_urls(pages, rules.limit(0)).where("rule is not null").count() == 0


def test_lookup_table_is_even_and_stable(spark, docs):
    names = [f"s{n}" for n in range(7)]
    counts = np.bincount(fill_table(names, 1009))
    assert counts.max() - counts.min() <= 1
    fewer = fill_table(names[:-1], 1009)
    same = [a == b for a, b in zip(fill_table(names, 1009), fewer) if a != 6]
    assert sum(same) > 0.8 * len(same)
    assert assign_shards(docs, ["doc_id"], names, 1009).count() == docs.count()
    with pytest.raises(ValueError):
        fill_table(names, 1000)


def test_quality(spark, docs):
    found = judge_quality(docs).select("doc_id", "n_words", "kept", "clean_text").collect()
    assert len(found) == 8 and {r.n_words for r in found if r.doc_id in (3, None, 5)} == {0}
    assert {r.kept for r in found if r.doc_id == 1} == {True}
    assert judge_quality(empty(spark)).count() == 0
    line = "one two three four"
    rng = random.Random(1)
    unlike = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(30)) for _ in range(30)]
    own = [(i, f"{line}\n{body}", "h", "", "") for i, body in enumerate(unlike)]
    shared = judge_quality(spark.createDataFrame(own, SCHEMA)).collect()
    assert all(r.n_removed_words == 4 and line not in r.clean_text and r.kept for r in shared)


@pytest.mark.parametrize("points", [1024, 3])
def test_near_classes(spark, docs, monkeypatch, points):
    monkeypatch.setattr(near_join, "REGION_POINTS", points)
    found = [(r.doc_id, r.component_id, r.n_links) for r in near_classes(docs).collect()]
    assert found.count((1, 1, 2)) == 2 and (2, 1, 2) in found
    assert {f for f in found if f[0] in (3, None, 5)} == {(3, 3, 0), (None, None, 0), (5, 5, 0)}
    kept = [r.doc_id for r in keep_one(docs).collect()]
    assert sorted(k or 0 for k in kept) == [0, 1, 3, 5, 6, 7]
    assert near_classes(empty(spark)).count() == 0


@pytest.mark.parametrize("tied", [4096, 3])
def test_near_classes_as_brute_force(spark, monkeypatch, tied):
    """Chains of near copies, crowded postings included, as all pairs have them."""
    monkeypatch.setattr(near_join, "TIED_POINTS", tied)
    rng = random.Random(11)
    words = [f"w{n}" for n in range(50)]
    texts = []
    for _ in range(6):
        text = [rng.choice(words) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(14):
            texts.append(" ".join(text))
            text = [*text]
            text[rng.randrange(len(text))] = rng.choice(words)
    sets = []
    for text in texts:
        split = text.split(" ")
        sets.append({tuple(split[i : i + 4]) for i in range(len(split) - 3)})
    least = list(range(len(texts)))
    linked = [
        (i, j)
        for i in least
        for j in range(i)
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    for _ in texts:
        for i, j in linked:
            least[i] = least[j] = min(least[i], least[j])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.component_id, r.n_links) for r in near_classes(rows).collect()}
    degree = [sum(n in pair for pair in linked) for n in range(len(texts))]
    assert found == {n: (least[n], degree[n]) for n in range(len(texts))}


@pytest.mark.parametrize("points, grams", [(8, 1 << 20), (1024, 1500)])
def test_near_classes_in_nested_cuts(spark, monkeypatch, points, grams):
    """One dense group, cut into pairs of blocks again and again, as all pairs have it."""
    monkeypatch.setattr(near_join, "REGION_POINTS", points)
    monkeypatch.setattr(near_join, "REGION_GRAMS", grams)
    levels = []
    split = near_join._split
    monkeypatch.setattr(near_join, "_split", lambda *given: (levels.append(given[-1]), split(*given))[1])
    rng = random.Random(5)
    texts = []
    for n in range(36):
        text = [f"w{k}" for k in range(160)]
        text[rng.randrange(160)] = f"x{n}"
        texts.append(text)
    sets = [{tuple(t[i : i + 4]) for i in range(len(t) - 3)} for t in texts]
    degree = [
        sum(a is not b and 100 * len(a & b) >= 85 * len(a | b) for b in sets) for a in sets
    ]
    rows = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: (r.component_id, r.n_links) for r in near_classes(rows).collect()}
    assert len(levels) > 1 and sum(degree) > 36 * 12
    assert found == {n: (0, degree[n]) for n in range(36)}


def test_stage_of_near_copies_at_five_words(spark):
    """Eleven scattered words of 500: linked by 5-grams at 80 %, not by 4-grams at 85 %."""
    import corpus_pipeline

    base = [f"w{n}" for n in range(500)]
    near = [f"x{n}" if n % 45 == 20 else word for n, word in enumerate(base)]
    other = [f"y{n}" if n % 25 == 20 else word for n, word in enumerate(base)]
    texts = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other)), (4, None)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.doc_id for r in keep_one(rows).collect()} == {1, 2, 3, 4}
    kept = corpus_pipeline.near_duplicates(spark, rows, "").collect()
    assert {r.doc_id for r in kept} == {1, 3, 4}


def test_decontamination(spark, docs):
    texts = [r.text for r in docs.where("doc_id = 7").collect()]
    quoted = " ".join(texts[0].split()[100:115])
    items = [(1, quoted), (2, None), (3, "..."), (4, "Mail"), (None, "nothing of this")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    for block_words in (1 << 20, 1):
        found = {
            r.doc_id: r for r in decontaminate(docs, benchmark, block_words=block_words).collect()
        }
        assert (found[7].n_hit, found[7].items) == (15, ["1"])
        assert quoted not in found[7].clean_text and len(found[7].clean_text.split()) == 2985
        assert found[6].items == ["4"] and found[6].clean_text.startswith("  a.b@c.org")
        assert found[3].clean_text is None and found[None].n_words == 0
    assert decontaminate(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate(empty(spark), benchmark).count() == 0


def test_mix(spark, docs):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 5 % 3}", "", "") for i in range(600)]
    many = spark.createDataFrame(rows, SCHEMA)
    mixed = mix(measure(many))
    sums = mixed.groupBy("source").agg(
        F.sum(F.col("size") * F.size("copies")).alias("taken"), F.first("target").alias("target")
    )
    assert all(abs(r.taken - r.target) <= 9 for r in sums.collect())
    assert mixed.where("size(copies) > 3").count() == 0
    drawn = draw_shards(mixed)
    assert drawn.count() == mixed.select(F.sum(F.size("copies"))).first()[0]
    assert mix(measure(docs)).count() == 8 and mix(measure(empty(spark))).count() == 0


def test_rans_round_trip_and_damage():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 40_000, 700_001):
        ids = rng.zipf(1.3, n).clip(max=49_000).astype(np.uint16)
        table = rans.Table.of_counts(np.bincount(ids, minlength=3))
        block = rans.encode(ids, table)
        assert np.array_equal(rans.decode(block, table), ids)
    with pytest.raises(ValueError):
        rans.decode(block[:-1] + bytes([block[-1] ^ 1]), table)


def test_tokens(spark, docs, tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer)
    found = round_trip(docs, tokenizer).orderBy("start").collect()
    texts = sorted(
        ((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect())
    )
    for row, (_, _, text) in zip(found, texts):
        ids = own.encode(text, add_special_tokens=False).ids + [1]
        assert row.n_tokens == len(ids) and row.ids == np.array(ids, dtype="<u4").tobytes()
    assert round_trip(empty(spark), tokenizer).count() == 0


def test_edits(spark, docs, tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer)
    rng = random.Random(3)
    rows = []
    for doc in docs.collect():
        size = len(doc.text or "")
        edits = [
            (a, min(size, a + rng.randrange(9)), rng.choice(["", " ", "x. y", None, "é"]))
            for a in (rng.randrange(size + 1) for _ in range(12))
        ] + [(None, 1, "q"), (size + 5, size + 6, "q")]
        rows.append((doc.doc_id, doc.text, edits))
    schema = "doc_id bigint, text string, edits array<struct<start:bigint,stop:bigint,replacement:string>>"
    trees = build_trees(spark.createDataFrame(rows, schema), tokenizer)
    for r in apply_edits(trees, tokenizer).collect():
        assert r.n_tokens == len(own.encode(r.text or "", add_special_tokens=False).ids)
        assert r.text is not None or r.n_edits == 0


def test_personal_data(spark, docs):
    found = {r.doc_id: r for r in find_personal_data(docs, SpanClassifier(-1.0, {})).collect()}
    text = next(r.text for r in docs.collect() if r.doc_id == 6)
    bodies = [(s.kind, text[s.start : s.stop]) for s in found[6].base_spans]
    assert bodies == [("email", "a.b@c.org"), ("phone", "+1 (212) 555-0100"), ("ip", "10.0.0.1")]
    assert not re.search("@|555", found[6].clean_text) and found[3].clean_text is None
    assert all(not found[k].base_spans for k in (1, 3, None, 5))


def test_clean_text_without_loose_spans(spark):
    text = "é a.b@c.org, joe [at] site.org; api_key=ABCDEFGH12345678 b a.b@c.org"
    rows = spark.createDataFrame([(1, text), (2, None), (3, "plain")], "doc_id bigint, text string")
    found = find_personal_data(rows, SpanClassifier(1.0, {})).collect()
    assert {r.doc_id: r.clean_text for r in found} == {
        1: "é [email], [at_mail]; [secret] b [email]",
        2: None,
        3: "plain",
    }


def test_names_of_secrets(spark):
    """Long names, names with digits, and names in quotes."""
    value = "ABCDEFGH12345678"
    names = ["aws_secret_access_key=", "api_key2=", '"password": "', "token: ", "12345:"]
    rows = spark.createDataFrame([(i, n + value) for i, n in enumerate(names)], "doc_id bigint, text string")
    found = find_personal_data(rows, SpanClassifier(1.0, {})).collect()
    stops = {r.doc_id: [s.stop for s in r.all_spans if s.kind == "secret"] for r in found}
    assert stops == {i: [len(n) + len(value)] if i < 4 else [] for i, n in enumerate(names)}


def test_toxicity(spark, docs):
    rows = [(i, f"this is {'awful stuff' if i % 3 == 0 else 'fine weather'} {i}", "", "", "") for i in range(300)]
    many = spark.createDataFrame(rows, SCHEMA).unionByName(docs)
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"))
    scored = score_toxicity(many, train(many, labels)).join(labels, "doc_id").where("held_out")
    assert scored.where("predicted <> toxic and doc_id > 7").count() == 0
    assert score_toxicity(docs, train(docs, labels.limit(0))).count() == 8


def test_labelled_texts_are_learnt_from_whole(spark):
    """Long labelled texts teach like short ones, and counts are those of one process."""
    filler = " ".join(f"w{n}" for n in range(3000))
    rows = [(i, f"{filler} {'awful stuff' if i % 2 else 'fine weather'}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = train(docs, labels)
    assert len(rows[0][1]) > 12_000
    assert model.score(rows[1][1]) > 0.5 > model.score(rows[0][1])
    learnt = [(t, i % 2) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    features = [np.unique(buckets(t)) for t, _ in learnt]
    alone = Model.fit(features, [toxic for _, toxic in learnt])
    assert model.bias == pytest.approx(alone.bias, abs=1e-9)
    assert np.allclose(model.weights, alone.weights, atol=1e-6)


def test_spelt_out_addresses_of_any_length(spark):
    """A long name or host before and after ``(at)`` is one candidate, whole."""
    name, host = "n" * 90, "h" * 90 + ".example.com"
    rows = spark.createDataFrame([(1, f"mail {name} (at) {host} now")], "doc_id bigint, text string")
    found = find_personal_data(rows, SpanClassifier(9.0, {})).first()
    spans = [(s.start, s.stop) for s in found.all_spans if s.kind == "at_mail"]
    assert spans == [(5, 5 + len(name) + 6 + len(host))]
