"""A Merkle manifest of a table: every row's place in a hash tree, with a proof for it.

Rows are leaves of one tree per group, in the order of their ids, and the trees' roots are
leaves of one more tree. No row is sorted to find its place:

1. *Bitmaps.* A group's ids are the bits of a bitmap, kept as 64-bit words of which only
   those with a bit are stored (a row of group and word number). Tasks merge theirs by
   ``bit_or``, which combines before the shuffle.
2. *Popcount directories.* The rows before a word are sums over the words before it, in four
   levels of digits of the word number, so a window never sees more than 65,536 rows.
3. *Rank queries.* A leaf's place is its word's directory entry and the number of bits below
   its own. Where ids repeat (a word has more rows than bits) equal rows are counted, and the
   digits of the leaf's hash are ranked by the same directories: rows of one id come by leaf.
4. *Slot arrays.* Leaves meet by group and place in arrays of 256 slots; eight levels of the
   tree are made inside an array, whose root is a slot of the next array. On the way back each
   array hands its slots their siblings, so only 256th parts of the rows move per round.

Built-in functions throughout. Each round is written to the shared folder, so a lost executor
has little to repeat. Nothing but the number of arrays comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import discard, shuffles_dropped
from barweave.operators.keys import number_rows
from barweave.session import materialize

SLOT_BITS = 8
WORD_BITS = 6  # a word has the bits of 64 ids
DIGIT_BITS = 16
LEVELS = 4
#: Word numbers are moved up so that all are over 0, the word of the rows without an id.
LOWEST = (1 << (63 - WORD_BITS)) + 1
NO_ID = 0
#: Copies of a row are given their places in runs of so many.
RUN_BITS = 16


def _sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """Hash of values: each ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    texts = [v.cast("string") for v in values]
    return _sha(
        *(
            F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        )
    )


def rows_before(counts: DataFrame, group: Sequence[str], key: str, n: str) -> DataFrame:
    """``counts`` with ``before``, the sum of ``n`` over smaller keys of the group.

    Keys are distinct in a group and not negative: four levels of digits of 16 bits, a window
    over siblings at each, so no window has more than 65,536 rows.
    """
    levels = [counts.select(*group, F.col(key).alias("_k0"), F.col(n).alias("_n0"))]
    for i in range(1, LEVELS):
        below = levels[-1]
        levels.append(
            below.groupBy(*group, F.shiftright(f"_k{i - 1}", DIGIT_BITS).alias(f"_k{i}")).agg(
                F.sum(f"_n{i - 1}").alias(f"_n{i}")
            )
        )
    offsets = None
    for i in reversed(range(LEVELS)):
        parent = F.shiftright(f"_k{i}", DIGIT_BITS)
        siblings = (
            Window.partitionBy(*group, f"_k{i + 1}")
            .orderBy(f"_k{i}")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        here = levels[i].withColumn(f"_k{i + 1}", parent)
        here = here.withColumn("_ahead", F.coalesce(F.sum(f"_n{i}").over(siblings), F.lit(0)))
        if offsets is None:
            offsets = here.select(*group, f"_k{i}", F.col("_ahead").alias("before"))
        else:
            offsets = here.join(offsets, [*group, f"_k{i + 1}"]).select(
                *group, f"_k{i}", (F.col("before") + F.col("_ahead")).alias("before")
            )
    return counts.join(offsets.withColumnRenamed("_k0", key), [*group, key])


def _word_of(doc_id: Column) -> Column:
    return F.coalesce(F.shiftright(doc_id, WORD_BITS) + LOWEST, F.lit(NO_ID))


def _bit_of(doc_id: Column) -> Column:
    return doc_id.bitwiseAND((1 << WORD_BITS) - 1).cast("int")


def places(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``tree``, ``doc_id``, ``leaf``, ...) with ``place``, 0 for a tree's first row.

    Rows of a tree come by id, those without one first; rows of one id by leaf. Equal rows
    take their places in any order, which no result shows.
    """
    numbered = leaves.withColumn("_word", _word_of(F.col("doc_id")))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit_of(F.col("doc_id")))
    words = materialize(
        numbered.groupBy("tree", "_word").agg(F.bit_or(one).alias("_bits"), F.count("*").alias("_rows"))
    )
    is_set = (F.col("_word") != NO_ID) & (F.col("_rows") == F.bit_count("_bits"))
    directory = rows_before(words, ["tree"], "_word", "_rows").withColumn("_set", is_set)
    directory = materialize(directory.select("tree", "_word", "_bits", "before", "_set"))
    from_here = F.call_function("shiftleft", F.lit(-1).cast("bigint"), _bit_of(F.col("doc_id")))
    below = F.bitwise_not(from_here).bitwiseAND(F.col("_bits"))
    met = numbered.join(directory, ["tree", "_word"])
    alone = met.where("_set").withColumn("place", F.col("before") + F.bit_count(below))
    alone = alone.select(*leaves.columns, "place")
    if directory.where("not _set").isEmpty():
        return alone
    # Words in which ids repeat: equal rows are one with a number of copies.
    copies = materialize(
        met.where("not _set").groupBy(*leaves.columns, "_word", "before").agg(F.count("*").alias("_copies"))
    )
    ids = copies.groupBy("tree", "_word", "doc_id").agg(F.sum("_copies").alias("_of_id"))
    in_word = (
        Window.partitionBy("tree", "_word").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    ids = ids.select(
        "tree", "_word", F.col("doc_id").alias("_id"), F.coalesce(F.sum("_of_id").over(in_word), F.lit(0)).alias("_in_word")
    )
    # Order by leaf inside an id: by 60 bits of it, then by all of it where those agree.
    short = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint")
    keyed = copies.withColumn("_short", short).withColumn("_id", F.coalesce("doc_id", F.lit(0)))
    own = ["tree", "_word", "_id"]
    of_short = keyed.groupBy(*own, "_short").agg(F.sum("_copies").alias("_n"))
    ranked = rows_before(of_short, own, "_short", "_n").select(
        *own, "_short", F.col("before").alias("_in_id")
    )
    same_short = (
        Window.partitionBy(*own, "_short").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = (
        keyed.withColumn("_in_short", F.coalesce(F.sum("_copies").over(same_short), F.lit(0)))
        .join(ranked, [*own, "_short"])
        .join(ids.withColumn("_id", F.coalesce("_id", F.lit(0))), own)
        .withColumn("_first", F.col("before") + F.col("_in_word") + F.col("_in_id") + F.col("_in_short"))
    )
    last = F.col("_copies") - 1
    runs = first.withColumn("_run", F.explode(F.sequence(F.lit(0), F.shiftright(last, RUN_BITS))))
    start = F.shiftleft("_run", RUN_BITS)
    stop = F.least(last, start + (1 << RUN_BITS) - 1)
    repeated = runs.withColumn("_nth", F.explode(F.sequence(start, stop)))
    return alone.unionByName(
        repeated.select(*leaves.columns, (F.col("_first") + F.col("_nth")).alias("place"))
    )


def _tree_levels(slots: Column, whole: Column) -> Column:
    """All levels of the tree over an array of hashes, the slots first.

    An array that is not its tree's ``whole`` top has all its levels, also those of one node:
    its neighbours go on. The top ends with one node.
    """

    def raised(nodes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
        return F.transform(
            starts,
            lambda i: _sha(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))),
        )

    def step(levels: Column, _: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.when(whole & (F.size(last) == 1), levels).otherwise(
            F.concat(levels, F.array(raised(last)))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(SLOT_BITS)), F.array(slots), step)


STEP = "array<struct<left:boolean,sibling:string>>"


def _path(levels: Column, slot: Column) -> Column:
    """A slot's siblings from below, null where its run is alone, and if they stand left."""

    def at(level: Column) -> Column:
        node = F.call_function("shiftright", slot, level)
        return F.struct(
            (node % 2 == 1).alias("left"),
            F.get(F.get(levels, level), node.bitwiseXOR(F.lit(1))).alias("sibling"),
        )

    height = F.size(levels) - 1
    path = F.transform(F.sequence(F.lit(0), height - 1), at)
    return F.when(height > 0, path).otherwise(F.array().cast(STEP))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def step(node: Column, p: Column) -> Column:
        beside = F.coalesce(p["sibling"], F.lit(""))
        return F.when(p["left"], _sha(beside, node)).otherwise(_sha(node, beside))

    return F.aggregate(path, start, step)


def _arrays(nodes: DataFrame, sizes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Slot arrays of ``nodes`` (``tree``, ``place``, ``hash``), with all levels above them.

    ``array`` numbers a tree's arrays; ``whole`` says that it is the tree's only one, going by
    ``sizes``, any table with a row of ``tree`` for each node.
    """
    count = sizes.groupBy("tree").agg(F.count("*").alias("_nodes"))
    filled = nodes.groupBy("tree", F.shiftright("place", SLOT_BITS).alias("array")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(F.col("place").bitwiseAND((1 << SLOT_BITS) - 1).cast("int").alias("slot"), "hash", *payload)
            )
        ).alias("slots")
    )
    small = F.col("_nodes") <= 1 << SLOT_BITS
    return filled.join(count.select("tree", small.alias("whole")), "tree").withColumn(
        "levels", _tree_levels(F.col("slots.hash"), F.col("whole"))
    )


def _roots(arrays: DataFrame) -> DataFrame:
    return arrays.select(
        "tree", F.col("array").alias("place"), F.get(F.element_at("levels", -1), F.lit(0)).alias("hash"), "whole"
    )


def _reduced(first: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Arrays of all rounds, those of leaves first, and ``tree``, ``hash`` of the trees' roots."""
    rounds, tops = [first], []
    while True:
        roots = _roots(rounds[-1])
        tops.append(roots.where("whole").select("tree", "hash"))
        rest = roots.where("not whole").drop("whole")
        if rest.isEmpty():
            return rounds, reduce(DataFrame.unionByName, tops)
        rounds.append(materialize(_arrays(rest, rest)))


def _seats(fields: Sequence[str]) -> Column:
    """The slots of an array row with ``place`` and whole ``path``, and ``fields`` of the slots.

    Made before slots become rows, so that no array is copied for each of its slots.
    """

    def seat(s: Column) -> Column:
        own = [s[f].alias(f) for f in fields]
        return F.struct(
            (F.shiftleft("array", SLOT_BITS) + s["slot"]).alias("place"),
            F.concat(_path(F.col("levels"), s["slot"]), F.col("path")).alias("path"),
            *own,
        )

    return F.transform("slots", seat)


def _descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``tree``, ``array`` and ``path`` to the root for the arrays of leaves.

    ``above`` has ``tree`` and ``path`` of the trees' roots.
    """
    paths = None
    for arrays in reversed(rounds):
        top = arrays.where("whole").join(above, "tree").select("tree", "array", "path")
        here = top if paths is None else top.unionByName(paths)
        if arrays is rounds[0]:
            return here
        below = arrays.join(here.hint("merge"), ["tree", "array"]).select(
            "tree", F.explode(_seats([])).alias("s")
        )
        paths = materialize(below.select("tree", F.col("s.place").alias("array"), "s.path"))


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    group: str = "lang",
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its place and its proof.

    Returns ``doc_id``, ``tree`` (the group's value), ``place``, ``leaf``, ``subroot``, ``root``,
    ``path`` (siblings from below), ``proof_sha256`` (hash of the siblings joined),
    ``folded_root`` and ``verified``. ``tampered`` replaces columns by expressions before the
    leaf that ``folded_root`` starts from is made; the tree is that of the rows as they are.

    Any of ``columns`` may be null (hashed as ``-``), an empty text is a value of no bytes, and
    texts of any length are hashed whole. Null is a group like others and comes first. Rows
    without an id come before those with one, rows of one id by their leaf; rows that repeat
    whole are leaves each. Without rows the result is empty. Other columns of ``docs`` are
    not looked at, whatever their names; ids must fit 64 bits.
    """
    plain = {c: F.col(f"`{c}`") for c in columns}
    changed = {**plain, **(tampered or {})}
    tree = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit(""))
    read = docs.select(
        tree.alias("tree"),
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        leaf_hash(list(plain.values())).alias("leaf"),
        (leaf_hash(list(changed.values())) if tampered else F.lit(None).cast("string")).alias("changed"),
    )
    # Only rows that differ keep a second hash.
    narrow = read.withColumn("changed", F.when(F.col("changed") != F.col("leaf"), F.col("changed")))
    with shuffles_dropped(docs.sparkSession):
        leaves = materialize(narrow)
        placed = places(leaves).withColumnRenamed("leaf", "hash")
        first = materialize(_arrays(placed, leaves, ["doc_id", "changed"]))
        discard(leaves)
        rounds, tops = _reduced(first)
        # The trees are few as a rule; they are numbered and reduced like leaves all the same.
        order = number_rows(tops, ["tree"], F.lit(0), "place").select(
            F.lit("").alias("tree"),
            F.col("place").cast("bigint").alias("place"),
            "hash",
            F.col("tree").alias("of"),
        )
        upper, whole = _reduced(materialize(_arrays(order, order, ["of"])))
        root = whole.select(F.col("hash").alias("root"))
        last = F.array().cast(STEP)
        roofs = _descended(upper, whole.select("tree", last.alias("path")))
        above = materialize(
            upper[0]
            .withColumnRenamed("tree", "_all")
            .join(roofs.withColumnRenamed("tree", "_all"), ["_all", "array"])
            .select(F.explode(_seats(["of", "hash"])).alias("s"))
            .select(F.col("s.of").alias("tree"), F.col("s.hash").alias("subroot"), "s.path")
            .withColumn("root", root.scalar())
        )
        paths = _descended(rounds, above.select("tree", "path"))
    shared = paths.join(above.drop("path"), "tree")
    leaf_rows = (
        first.join(shared.hint("merge"), ["tree", "array"])
        .select("tree", "subroot", "root", F.explode(_seats(["doc_id", "hash", "changed"])).alias("s"))
        .select(
            "tree",
            F.expr("substring(tree, 2)").alias("_name"),
            "subroot",
            "root",
            "s.doc_id",
            "s.place",
            F.col("s.hash").alias("leaf"),
            F.coalesce("s.changed", "s.hash").alias("_start"),
            "s.path",
        )
    )
    folded = leaf_rows.withColumn("folded_root", fold(F.col("_start"), F.col("path")))
    return folded.select(
        "doc_id",
        F.when(F.col("tree") != "", F.col("_name")).alias("tree"),
        "place",
        "leaf",
        "subroot",
        "root",
        "path",
        F.sha2(F.array_join("path.sibling", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
