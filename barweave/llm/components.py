"""Connected components of a graph of links, by shuffles of its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import discard
from barweave.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for all nodes of ``a``-``b`` edges.

    Every round each node takes the smallest label among its neighbours, then the label of
    its label, so paths shorten by more than half; it ends when no label has changed. A node
    with very many links is combined on the map side, and its join partition is split by
    adaptive execution. Rounds are written to the shared folder; nothing but the number of
    changes comes to the driver; a round's tables go when the next one is written. Without edges the result is empty.
    """
    both = materialize(
        # An edge becomes two rows, so that the edges are made once.
        edges.where("a <> b")
        .select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        .distinct()
    )
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("label")
        )
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("least"))
        )
        taken = (
            labels.join(near, labels["node"] == near["a"])
            .select("node", F.least("label", "least").alias("via"), F.col("label").alias("old"))
        )
        ahead = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        jumped = taken.join(ahead, "via").select(
            "node", F.least("via", "next").alias("label"), "old"
        )
        before, labels = labels, materialize(jumped)
        discard(before)
        if labels.where("label <> old").isEmpty():
            discard(both)
            return labels.select("node", "label")
