"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words. Each source gets a target from its weight, at most three times its size.
Its documents are dealt by a hash into blocks in permuted order. Whole passes take every
block; the rest of the target takes blocks from the front of the permutation, and the block
in which the target is met gives documents from its own front. So a source is met to within
one document.

The blocks a source gives are its exact quota. A tree splits the quotas among the output
shards: at each node the blocks of every source that go to the left half are one draw from
the multivariate hypergeometric distribution, so shards have equal numbers of blocks and the
sources in them vary as in a perfect shuffle. A leaf's quotas are consecutive places in the
permutations of the sources: the blocks of shards are disjoint. Rows are then put in a
random order inside their shard only.

Blocks and quotas are planned on narrow rows (number, source, hash, size); the documents meet
the plan by their number. A source with a third of all
documents is many blocks; what meets in one task are a block's rows, one row per block of a
source, or one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import WORD, Packed, ordinal_bits
from barweave.session import materialize

CYCLE = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_DOCUMENTS = 64
SHARDS = 8
MOST_BLOCKS = 65_536  # of a source; larger sources have larger blocks
NODES = "first int, shards int, _s string, blocks bigint"


def targets(sizes: DataFrame, cycle: Sequence[int] = CYCLE) -> DataFrame:
    """Adds ``target`` to one row per source (``_s`` in order, ``source_size``).

    Weights repeat the cycle over the sources. A source is full at three times its size;
    what it can't take is dealt again by weight. Sources fill up in the order of full size
    over weight, so running sums in that order give the share per weight without rounds:
    the first source that does not fill sets it.
    """
    weights = F.array(*map(F.lit, cycle))
    place = F.row_number().over(Window.orderBy("_s"))
    ranked = sizes.select(
        "*",
        F.element_at(weights, (F.pmod(place - 1, F.lit(len(cycle))) + 1).cast("int")).alias("_w"),
        (F.lit(MOST_REPEATS) * F.col("source_size")).alias("_full"),
    )
    fills = Window.orderBy(F.col("_full") / F.col("_w"), "_s")
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    share = (
        F.sum("source_size").over(everything)
        - F.coalesce(F.sum("_full").over(before), F.lit(0))
    ) / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    shares = ranked.select("*", share.alias("_share"), F.row_number().over(fills).alias("_place"))
    open_place = F.when(F.col("_share") * F.col("_w") <= F.col("_full"), F.col("_place"))
    level = F.min_by("_share", open_place).over(everything)
    target = F.least(F.col("_full").cast("double"), level * F.col("_w"))
    return shares.select(*sizes.columns, target.alias("target"))


def measure(
    docs: DataFrame,
    ids: Sequence[str] = ("doc_id",),
    text: str = "text",
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The rows with ``size``, ``stratum`` and ``draw``, all that :func:`mix` asks for.

    ``size`` counts words; a null or empty text has none. ``stratum`` is the source in an
    order where null is a source of its own, the last. ``draw`` depends on the ids, the text
    and the seed only. Columns of ``docs`` named like the three are replaced.
    """
    packed = Packed(docs)
    name, body = packed[source].cast("string"), packed[text]
    return packed.rows.select(
        *packed.back(("size", "stratum", "draw")),
        F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.when(name.isNull(), "1").otherwise(F.concat(F.lit("0"), name)).alias("stratum"),
        ordinal_bits(F.lit(seed), *(packed[k] for k in ids), F.md5(body)).alias("draw"),
    )


def mix(measured: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """Every row of ``measured`` with ``source_size``, ``target`` and ``copies``.

    ``copies`` has a struct (``shard``, ``place``) for each time the mix takes the document,
    at most three; ``place`` orders the rows of a shard at random. Reruns agree; of rows
    with the same ids and text it takes any. Sources without words get a target of 0. An
    empty table stays empty. Columns named like an added one are replaced.

    The rows are written once to the shared folder, with the columns they have: drop the
    texts before if they are not wanted behind.
    """
    made = ("source_size", "target", "copies")
    packed = Packed(measured)
    stored = materialize(packed.rows.withColumn("_row", F.monotonically_increasing_id()))
    rows = stored.select(
        "_row",
        packed["stratum"].alias("_s"),
        packed["size"].alias("_size"),
        packed["draw"].alias("_bits"),
    )
    sources = targets(
        rows.groupBy("_s").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_docs"))
    )
    blocks_of = F.least(F.ceil(F.col("_docs") / BLOCK_DOCUMENTS), F.lit(MOST_BLOCKS))
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    sources = sources.select(
        "_s",
        "source_size",
        "target",
        blocks_of.alias("_blocks"),
        passes.alias("_passes"),
        (F.col("target") - passes * F.col("source_size")).alias("_rest"),
    )
    # Dealt by block: what follows would else be content with the join's deal by source.
    dealt = (
        rows.join(sources, "_s")
        .withColumn("_block", F.pmod("_bits", "_blocks"))
        .repartition("_s", "_block")
    )
    blocks = _permuted(dealt, seed)
    places = _leaves(blocks, shards, seed)
    in_block = (
        Window.partitionBy("_s", "_block")
        .orderBy("_bits")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = dealt.withColumn("_ahead", F.coalesce(F.sum("_size").over(in_block), F.lit(0)))
    placed = ordered.join(
        blocks.drop("_rest", "_passes").join(places, "_s"), ["_s", "_block"]
    )
    # Half of the document at most is on the wrong side of the target.
    taken = 2 * (F.col("_before") + F.col("_ahead")) + F.col("_size") <= 2 * F.col("_rest")
    taken = taken & F.col("_partly")
    n_copies = (F.col("_passes") + taken.cast("int")).cast("int")
    copies = F.transform(
        F.sequence(F.lit(1), n_copies),
        lambda k: F.struct(
            F.size(
                F.filter("_ends", lambda end: end <= (k - 1) * F.col("_blocks") + F.col("_rank"))
            ).alias("shard"),
            F.xxhash64(F.lit(seed), F.col("_bits"), k).alias("place"),
        ),
    )
    none = F.array().cast("array<struct<shard:int,place:bigint>>")
    planned = placed.select(
        "_row",
        "source_size",
        "target",
        F.when(n_copies > 0, copies).otherwise(none).alias("copies"),
    )
    return stored.join(planned, "_row").select(*packed.back(made), *made)


def _permuted(dealt: DataFrame, seed: int) -> DataFrame:
    """Per block: its place in its source's permutation and the words before it."""
    order = Window.partitionBy("_s").orderBy(
        ordinal_bits(F.lit(seed), F.col("_s"), F.col("_block")), "_block"
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_s", "_block").agg(
        F.sum("_size").alias("_words"),
        F.first("_rest").alias("_rest"),
        F.first("_passes").alias("_passes"),
    )
    return sums.select(
        "_s",
        "_block",
        "_rest",
        "_passes",
        (F.row_number().over(order) - 1).alias("_rank"),
        F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"),
    ).select("*", (F.col("_before") < F.col("_rest")).alias("_partly"))


def _leaves(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Per source: where in its permuted blocks each shard's quota ends."""

    def split(rows):
        import numpy as np
        import pandas as pd

        rows = rows.sort_values("_s")
        first, size = int(rows["first"].iloc[0]), int(rows["shards"].iloc[0])
        if size == 1:
            return rows
        left = size // 2
        counts = rows["blocks"].to_numpy(dtype="int64")
        draw = np.random.default_rng([seed, first, size]).multivariate_hypergeometric(
            counts, int(counts.sum()) * left // size, method="marginals"
        )
        right = rows.assign(first=first + left, shards=size - left, blocks=counts - draw)
        rows = rows.assign(shards=left, blocks=draw)
        return pd.concat([rows, right])

    quotas = blocks.groupBy("_s").agg(
        F.sum(F.col("_passes") + F.col("_partly").cast("int")).cast("bigint").alias("blocks")
    )
    nodes = quotas.select(
        F.lit(0).alias("first"), F.lit(shards).alias("shards"), "_s", "blocks"
    )
    for _ in range((shards - 1).bit_length()):
        nodes = nodes.groupBy("first").applyInPandas(split, NODES)
    until = Window.partitionBy("_s").orderBy("first")
    ends = nodes.select("_s", "first", F.sum("blocks").over(until).alias("_end"))
    return ends.groupBy("_s").agg(F.array_sort(F.collect_list("_end")).alias("_ends"))


def draw_shards(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, one per copy, with ``shard``; shuffled inside each shard."""
    packed = Packed(mixed)
    rows = packed.rows.withColumn("_copy", F.explode(packed["copies"]))
    return (
        rows.select(*packed.back(("copies", "shard", "place")), "_copy.*")
        .repartitionByRange("shard", "place")
        .sortWithinPartitions("shard", "place")
    )
