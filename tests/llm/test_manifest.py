"""The Merkle manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import os
import random

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from barweave.llm import manifest
from barweave.llm.manifest import merkle_manifest
from barweave.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, tree int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([sha(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)])
    return levels


def siblings(levels, at):
    for nodes in levels[:-1]:
        yield at % 2, nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
        at //= 2


def by_hand(rows, tampered):
    """Sorted rows of the proof; ``tampered`` gives the row that a check starts from."""
    groups = {}
    for row in rows:
        key = (row[2] is not None, (row[2] or "").encode())
        groups.setdefault(key, []).append(((row[0] is not None, row[0] or 0, leaf_of(row)), row))
    trees = [sorted(groups[key], key=lambda x: x[0]) for key in sorted(groups)]
    built = [levels_of([leaf_of(row) for _, row in tree]) for tree in trees]
    top = levels_of([levels[-1][0] for levels in built])
    out = []
    for k, (tree, levels) in enumerate(zip(trees, built)):
        for at, (_, row) in enumerate(tree):
            path = [*siblings(levels, at), *siblings(top, k)]
            node = leaf_of(tampered(row))
            for left, sibling in path:
                node = sha(sibling, node) if left else sha(node, sibling)
            proof = sha(*(s for _, s in path))
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def changed(row):
    if row[3] is None or row[0] is None or row[0] % 5:
        return row
    return (*row[:3], row[3] + 1, *row[4:])


def found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    more = F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    made = merkle_manifest(docs, tampered={"n_chars": more}).select(*manifest.PROOF)
    return sorted((tuple(r) for r in made.collect()), key=str)


def row(doc_id, lang, text, n_chars=4, source="s"):
    return (doc_id, source, lang, n_chars, text, 1, 2)


def test_trees_of_many_sizes(spark):
    """Ids dense, sparse and negative; one leaf, a full array, one over; an odd number of trees."""
    rng = random.Random(3)
    rows = [row(i, "en", f"t{i}") for i in range(700)]
    rows += [row(i, "a", "x") for i in range(256)] + [row(-i, "b", "x") for i in range(257)]
    rows += [row(rng.randrange(-(1 << 63), 1 << 63), "é", "y") for _ in range(40)]
    rows += [row(-(1 << 63), "z", ""), row((1 << 63) - 1, "z", ""), row(5, "only", "é" * 50_000)]
    assert found(spark, rows) == by_hand(rows, changed)


@pytest.mark.parametrize("run_bits", [16, 2])
def test_nulls_repeats_and_ties(spark, monkeypatch, run_bits):
    monkeypatch.setattr(manifest, "RUN_BITS", run_bits)
    rows = [row(i, lang, "t") for i in range(10) for lang in ("en", None, "")]
    rows += [row(3, "en", "t")] * 300 + [row(3, "en", "u")] * 5 + [row(4, "en", f"v{i}") for i in range(40)]
    rows += [row(None, "en", f"w{i}") for i in range(20)] + [row(None, None, None, None, None)] * 7
    rows += [row(1, "en", None), row(2, "en", "", None), row(6, "de", "t", 1, None)]
    assert found(spark, rows) == by_hand(rows, changed)


def test_many_groups_and_none(spark):
    """Roots of over 256 trees need arrays above arrays too; no rows, no proofs."""
    rows = [row(i, f"lang{i % 300}", "t") for i in range(900)]
    assert found(spark, rows) == by_hand(rows, changed)
    assert found(spark, []) == []
    alone = [row(5, "en", "t", None)]
    assert found(spark, alone) == by_hand(alone, changed)


def test_query_as_its_sql(spark):
    made = QUERIES["op12_merkle_manifest"](spark, SF_DIR)
    assert compare(made, connect(SF_DIR), ORACLES["op12_merkle_manifest"]) is None
