"""Queries and stages that SQL does not express, held against plain Python on small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from barweave.llm.queries import op3_personal_data, op7_decontamination

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of tables, written from rows of (doc_id, text, source) and (item_id, text)."""

    def written(docs, items=()):
        rows = [(n, text, "en", source, None if text is None else len(text)) for n, text, source in docs]
        spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
        benchmark = spark.createDataFrame(list(items), "item_id string, text string")
        benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return written


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            right = {
                "email": True,
                "ip": all(int(part) <= 255 for part in match[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if right:
                found.append((match.start(), rank, kind, match.end()))
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def test_personal_data(spark, folder):
    rng = random.Random(23)
    planted = [
        "a.b@c.org", "x@y", "a@b@c.de", "..@-.-", "10.0.0.1", "1.2.3.4.5", "300.1.1.1", "1.2.3",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+49 30 1234567", "++12",
        "4111111111111111 5", "mail: k.l@m.info", "é@ü.de", "0000 0000 0000 00", "+1234567890.1.2.3.4", "\U0001f600",
    ]
    texts = [None, "", " \n", "@", "+"]
    texts += [rng.choice(["", " ", ", "]).join(rng.choices(planted, k=rng.randrange(1, 9))) for _ in range(150)]
    texts += ["".join(rng.choices("ab1234567890.@+- ()é", k=80)) for _ in range(250)]
    texts.append(" ".join(planted * 60))
    texts += texts[:9]
    docs = [(n if n % 50 else n + 1, text, None if n % 7 else "s") for n, text in enumerate(texts)]
    expected = Counter()
    for doc_id, text, _ in docs:
        spans = base_spans(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[(doc_id, *(sum(s[0] == kind for s in spans) for kind in BASE), digest(joined))] += 1
    rows = op3_personal_data(spark, folder(docs)).collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == expected
    by_id = {r.doc_id: set(filter(None, r.spans.split(","))) for r in rows}
    for doc_id, text, _ in docs[60:100]:
        assert {f"{k}:{a}:{b}" for k, a, b in base_spans(text or "")} <= by_id[doc_id]


def alnum_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def hits(text: str | None, items) -> tuple[set[int], set[str]]:
    """Places of the words inside windows of items, and the items."""
    words, places, met = alnum_words(text), set(), set()
    for item, body in items:
        own = alnum_words(body)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i : i + size]) in windows:
                places.update(range(i, i + size))
                met.add(item)
    return places, met


def passages(rng: random.Random):
    vocabulary = [f"w{n}" for n in range(40)] + ["é", "Ünder", "A", "x-y", "don't"]
    items = [(f"{n}", " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 11, 40])))) for n in range(2, 25)]
    # Items of one very common word, or of none, tell little: keep the one-word items rare.
    items = [(n, t if len(alnum_words(t)) > 2 else f"rare{n}") for n, t in items]
    items += [("100", None), ("101", ""), ("102", "..."), ("5", items[0][1])]
    return vocabulary, items


def test_decontamination_query(spark, folder):
    rng = random.Random(31)
    vocabulary, items = passages(rng)
    docs = [(None, None, "s"), (1, "", None), (1, "...", "s")]
    for n in range(2, 120):
        words = rng.choices(vocabulary, k=rng.choice([2, 30, 200]))
        for _ in range(rng.randrange(3)):
            body = (rng.choice(items)[1] or "").split(" ")
            start = rng.randrange(len(body))
            at = rng.randrange(len(words) + 1)
            words[at:at] = body[start : start + rng.choice([5, 10, 40])]
        docs.append((n, rng.choice([" ", "\n", " ; "]).join(words).upper() if n % 3 else " ".join(words), "s"))
    docs += docs[5:9]
    expected = Counter()
    for doc_id, text, _ in docs:
        places, met = hits(text, items)
        row = (doc_id, len(alnum_words(text)), len(places), len(met), digest(",".join(sorted(met))), bool(places))
        expected[row] += 1
    found = op7_decontamination(spark, folder(docs, items)).collect()
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert Counter(tuple(r[c] for c in columns) for r in found) == expected
    assert sum(n for row, n in expected.items() if row[-1]) > 30


def test_stages_of_the_pipeline(spark, folder):
    """Every stage by its own input, over a hot source, copies, near copies, nulls and short texts."""
    import corpus_pipeline

    rng = random.Random(41)
    items = [(str(n), " ".join(f"b{n}x{k}" for k in range(25))) for n in range(3)]
    docs = [(0, None, "hot"), (1, "", None), (2, "too short", "b"), (3, "again " * 60, "hot")]
    for n in range(4, 64):
        # Lines that differ in digits only count as one, so words here have none.
        words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(60)]
        if n % 10 == 0:
            words[20:20] = items[n % 3][1].split(" ")[:15]
        docs.append((n, " ".join(words), "hot" if n % 3 else rng.choice(["a", "b", None])))
    docs += [(64, docs[8][1], "a"), (65, docs[8][1], "hot"), docs[9], (66, docs[12][1] + " more", "b")]
    sf_dir = folder(docs, items)
    held = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = held.columns, dict(corpus_pipeline.STAGES)

    def texts(rows):
        return Counter((r.doc_id, r.text) for r in rows.collect())

    good = stages["quality"](spark, held, sf_dir)
    assert good.columns == columns
    assert texts(good) == Counter((n, text) for n, text, _ in docs if n > 3)
    once = stages["near_duplicates"](spark, held, sf_dir)
    gone = {64, 65, 66}
    assert once.columns == columns
    assert texts(once) == Counter({(n, text): 1 for n, text, _ in docs if n not in gone})
    clean = stages["decontamination"](spark, held, sf_dir).collect()
    assert sorted(r.doc_id for r in clean) == sorted(n for n, *_ in docs)
    whole = {n: text for n, text, _ in docs}
    for row in clean:
        places, _ = hits(whole[row.doc_id], items)
        left = [w for i, w in enumerate(alnum_words(whole[row.doc_id])) if i not in places]
        assert alnum_words(row.text) == left
        assert row.text == whole[row.doc_id] or places
    mixed = stages["mixing"](spark, held, sf_dir)
    own = Counter((n, text, source) for n, text, source in docs)
    taken = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    assert mixed.columns == columns and all(n <= 3 * own[row] for row, n in taken.items())
    dealt = stages["sharding"](spark, held, sf_dir).collect()
    assert Counter((r.doc_id, r.text) for r in dealt) == Counter((n, text) for n, text, _ in docs)
    shards = {}
    for row in dealt:
        assert shards.setdefault(row.doc_id, row.shard) == row.shard and row.shard in corpus_pipeline.SHARDS
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, held.limit(0), sf_dir).count() == 0, name
