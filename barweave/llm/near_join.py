"""N-gram Jaccard join: an exact self-join of documents in Jaccard's metric space.

The distance is one minus the Jaccard similarity of two sets of word 4-grams, and documents
link within ``1 - 0.85``, or of n-grams and within what the caller asks for. Equal sets are one point with a multiplicity. Then:

1. *Cells.* Most pairs of texts are at distance one, where pivots tell nothing. So points
   are first put in cells such that no link leaves a cell. The 4-grams are dealt by hash into
   more parts than two linked sets can differ in (the number follows from the size class), so
   linked sets have whole parts in common; each part's hash is a posting. Two points of a
   posting are tied if the triangle inequality leaves room for a link: the counts of a set's
   4-grams in ranges of the hash are its distances from the empty set in each range, and
   their differences add up to no more than the sets differ. There are 64 ranges, and more for a
   larger set, two to four of its 4-grams in each: chance differences grow with the root of a
   range's 4-grams only, so in wide ranges long unrelated texts look alike. Of the ties of a posting a
   spanning forest is kept, and its connected components are the cells. (A posting of over
   4,096 points is tied to its first as a star, which only makes cells larger.)
2. *Regions.* A cell with many points is split around pivots: every point's distance to the
   pivots of its cell is measured, it is at home in the Voronoi region of the nearest, and
   it is a guest where the triangle inequality leaves room for a link: where its distance
   is at most the home distance plus twice the link distance. Regions are split again until
   they are small. Where windows are so wide that a split does not make regions smaller,
   the region is cut into blocks and each pair of blocks is a region: always exact.
   Where only classes are asked for, points that link with a pivot are contracted: they are
   one class by that, so no two of them are compared, and one of them stays in the pivot's
   region only if a point that does not link with the pivot is near enough to link with it.
3. *Join.* In a small region all similarities come from products of a 0/1 matrix. A pair is
   counted where at each level one of the two at least is at home, or the two are of a
   region's two blocks, which is exactly once. ``mask`` has a byte for each level for that.

A region returns one row per point (its number of links, and the least point it reaches), so
a group of thousands of near copies gives thousands of rows. Components of those rows are the
classes. Everything that is shuffled is postings (16 bytes, a sixth as many as words), sets
of points in cells of two or more, or one row per point; each is spread by hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barweave.llm.common import Packed, discard, shuffles_dropped
from barweave.llm.components import components
from barweave.session import materialize

SHINGLE = 4
PERCENT = 85
REGION_POINTS = 1024
REGION_GRAMS = 1 << 20
RANGES = 64  # of a small set, and the number that all sets are compared by first
TIED_POINTS = 4096
TIED_RANGES = 1 << 24  # ranges of one posting that are held at once, in all its points
ROUNDS = 4  # the postings are matched in so many rounds, so that a part of their shuffles is on disk
ROUND_ROWS = 1 << 22  # postings that are not worth another round
BUCKET_ROWS = 1 << 16  # rows of postings with one least point that meet in a task
BUCKET_BYTES = 16 << 20  # ranges of the points of such rows
TIED_NODES = 1_000_000  # points that a task has tied before it gives its ties out
SETTLED_BYTES = 16 << 20  # sets of regions that are joined before their rows are given out
CHUNK_BYTES = 2 << 20  # sets, on average, that are measured against their pivots at once
SLICE_ROWS = 256
PIVOTS = 8
BLOOM_BITS = 26
KEPT_NODES = 200_000  # recent sets a task remembers, so as not to repeat their postings


def links(shared: int, left: int, right: int, percent: int = PERCENT) -> bool:
    """The rule of the join, in integers."""
    return 100 * shared >= percent * (left + right - shared)


def size_classes(size: int, percent: int) -> list[int]:
    """Classes of a set size; linked sets have one in common.

    Class ``c`` has sizes up to ``bounds[c]``, and takes in those of the class below that are
    large enough to link with one of its own.
    """
    bound, number = 1, 0
    while bound < size:
        bound, number = max(bound + 1, bound * 100 // percent), number + 1
    # The smallest own size of the next class is bound + 1.
    return [number, number + 1] if 100 * size >= percent * (bound + 1) else [number]


def class_bound(number: int, percent: int) -> int:
    bound = 1
    for _ in range(number):
        bound = max(bound + 1, bound * 100 // percent)
    return bound


def most_different(bound: int, percent: int) -> int:
    """How many 4-grams two linked sets of at most this size can have in one but not both."""
    return (100 - percent) * 2 * bound // (100 + percent)


def _set_hashes(grams):
    """Sums of mixed hashes over a set: equal for equal sets, whatever the order."""
    import numpy as np

    from barweave.llm.wordhash import mix

    return np.add.reduce(mix(grams)) if len(grams) else np.uint64(0)


def _distinct_grams(texts, shingle: int):
    """The set of n-gram hashes of each text, sorted."""
    import numpy as np

    from barweave.llm.wordhash import BLANK, Words, shingle_hashes

    words = Words(texts, BLANK)
    for i in range(len(texts)):
        found = words.hashes[words.first[i] : words.first[i + 1]]
        yield np.unique(shingle_hashes(found, shingle))


def postings_of(grams, node: int, percent: int):
    """Hashes of the parts of one set, for each of its size classes."""
    import numpy as np

    from barweave.llm.wordhash import mix

    out = []
    size = len(grams)
    mixed = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    low = (mixed & np.uint64(0xFFFFFFFF)).astype(np.float64)
    high = (mixed >> np.uint64(32)).astype(np.float64)
    for number in size_classes(size, percent):
        differ = most_different(class_bound(number, percent), percent)
        if differ == 0:
            continue  # linked sets of these sizes are equal
        parts = differ + 1 + max(1, differ // 8)
        part = (grams % np.uint64(parts)).astype(np.int64)
        held = np.bincount(part, minlength=parts) > 0
        # Sums of 32-bit halves are exact in doubles.
        sums = np.bincount(part, low, parts).astype(np.uint64) + (
            np.bincount(part, high, parts).astype(np.uint64) << np.uint64(32)
        )
        keys = mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(number << 32)))
        # Of the first n parts n - differ agree at least. With fewer empty ones among them, one that
        # agrees is not; the least such n of two sets do for both.
        enough = np.flatnonzero(np.cumsum(held) > differ)
        if len(enough):
            keys = keys[: enough[0] + 1][held[: enough[0] + 1]]
        out.append(keys)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def range_counts(grams) -> bytes:
    """How many of a set's grams are in each range of the hash, a byte each; a power of two of ranges."""
    import numpy as np

    bits = max(RANGES.bit_length() - 1, (len(grams) // 4 - 1).bit_length())
    held = np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(held, 255).astype(np.uint8).tobytes()


def in_fewer(ranges: list[bytes], width: int):
    """The counts of some sets in ``width`` ranges, a row each, as ``range_counts`` has them for so many."""
    import numpy as np

    out = np.zeros((len(ranges), width), dtype=np.uint8)
    lengths = np.array([len(r) for r in ranges])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        held = np.frombuffer(b"".join(ranges[i] for i in at), dtype=np.uint8)
        # A count that was cut at 255 makes the sum one that is cut, too.
        sums = held.reshape(len(at), width, length // width).sum(axis=2, dtype=np.int64)
        out[at] = np.minimum(sums, 255)
    return out


def add_nodes(rows: DataFrame, text: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with ``node``, the hash of the n-gram set, ``n_shingles`` and ``ranges``.

    The text may be any column; the others pass through as they are.
    """
    from pyspark.sql import types as T

    at = rows.columns.index(text)
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("node", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("ranges", T.BinaryType()),
        ]
    )

    def hashed(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm.wordhash import slices, text_bytes

        for batch in slices(batches, at):
            nodes, sizes, ranges = [], [], []
            for grams in _distinct_grams(text_bytes(batch.column(at)), shingle):
                nodes.append(_set_hashes(grams))
                sizes.append(len(grams))
                ranges.append(range_counts(grams))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(ranges, pa.binary()),
                ],
                [*batch.schema.names, "node", "n_shingles", "ranges"],
            )

    return rows.mapInArrow(hashed, schema)


def _fold(texts: DataFrame, make, schema: str, shingle: int) -> DataFrame:
    """Rows that ``make(node, grams)`` has for the sets of ``texts``; a task skips repeats.

    ``make`` gives arrays of equal length, or None.
    """

    def folded(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm.wordhash import slices, text_bytes

        names = [part.split()[0] for part in schema.split(", ")]
        seen: set[int] = set()
        for batch in slices(batches, 0):
            made = []
            for grams in _distinct_grams(text_bytes(batch.column(0)), shingle):
                node = int(_set_hashes(grams).view(np.int64))
                if len(grams) == 0 or node in seen:
                    continue
                if len(seen) >= KEPT_NODES:
                    seen.clear()
                seen.add(node)
                rows = make(node, grams)
                if rows is not None:
                    made.append(rows)
            if made:
                columns = [
                    pa.array(np.concatenate(c)) if isinstance(c[0], np.ndarray) else pa.array(sum(c, []))
                    for c in zip(*made)
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(folded, schema)


def _cells(texts: DataFrame, ranges: DataFrame, percent: int, shingle: int) -> DataFrame:
    """``node`` and ``cell`` of all points that are tied to another."""

    def make(node, grams):
        import numpy as np

        keys = postings_of(grams, node, percent)
        return keys.view(np.int64), np.full(len(keys), node, dtype=np.int64)

    # Aggregates and joins only, so that no posting, however many points it has, is one task's.
    posted = materialize(_fold(texts, make, "part bigint, node bigint", shingle))
    rounds = max(1, min(ROUNDS, posted.count() // ROUND_ROWS))
    shared = None
    for n in range(rounds):
        some = posted.where(F.pmod("part", F.lit(rounds)) == n)
        bounds = some.groupBy("part").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        met = materialize(bounds.where("low <> high").select("part"))
        # A set that several tasks have met repeats its postings.
        found = materialize(some.join(met, "part").distinct())
        shared = found if shared is None else shared.unionByName(found)
        discard(met)
    discard(posted)
    counts = shared.groupBy("part").agg(F.min("node").alias("b"), F.count("*").alias("points"))
    crowded = materialize(counts.where(F.col("points") > TIED_POINTS).select("part", "b"))
    stars = shared.join(crowded, "part").select(F.col("node").alias("a"), "b").distinct()
    # Postings of one group of near copies have its least point in common as a rule. They meet in one
    # task, or where they are many in as many as they need, so that a task ties their points once.
    sized = counts.where(F.col("points") <= TIED_POINTS).select("part", "b")
    few = shared.join(sized, "part")
    load = few.join(ranges.select("node", F.octet_length("ranges").alias("bytes")), "node")
    spans = load.groupBy("b", "node").agg(F.count("*").alias("rows"), F.first("bytes").alias("bytes"))
    load = spans.groupBy("b").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    shares = F.greatest(F.ceil(F.col("rows") / BUCKET_ROWS), F.ceil(F.col("bytes") / BUCKET_BYTES))
    share = F.pmod(F.xxhash64("part"), shares)
    placed = materialize(
        few.join(load, "b").select(F.xxhash64("b", share).alias("bucket"), "part", "node")
    )
    # A point's ranges come once a bucket, ahead of its postings there.
    points = placed.select("bucket", "node").distinct().join(ranges, "node")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("size", "bigint"), ("ranges", "binary"))]
    both = points.select("bucket", F.lit(None).cast("bigint").alias("part"), "node", "size", "ranges")
    both = both.unionByName(placed.select("bucket", "part", "node", *nothing))
    dealt = both.repartition("bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_first(), "node")
    ties = dealt.mapInArrow(_tie(percent), "a bigint, b bigint")
    cells = components(ties.unionByName(stars)).withColumnRenamed("label", "cell")
    discard(shared, crowded, placed)
    return cells


def _tie(percent: int):
    """Spanning edges of the ties in postings of at most ``TIED_POINTS``.

    Rows come by bucket, first the sizes and ranges of its points, without a ``part``, then its postings. A task remembers what it has tied, so points that are together already are not compared again,
    and gives out one edge per point in the end.
    """

    def tied(batches):
        import numpy as np
        import pyarrow as pa

        above: dict[int, int] = {}

        def root(node):
            while (up := above.setdefault(node, node)) != node:
                above[node] = above[up]
                node = above[node]
            return node

        def settle(nodes, sizes, ranges):
            groups: dict[int, list[int]] = {}
            for i, node in enumerate(nodes):
                groups.setdefault(root(node), []).append(i)
            if len(groups) == 1:
                return
            sizes = np.array(sizes, dtype=np.int64)
            width = min(min(map(len, ranges)), max(RANGES, 1 << (TIED_RANGES // len(nodes)).bit_length() - 1))
            counts = [in_fewer(ranges, n) for n in sorted({RANGES, width})]

            def near_to(at, others):
                """Those of the others that may link with a point; fewer ranges rule out most at less cost."""
                for held in counts:
                    if len(others):
                        apart = np.abs(held[others].astype(np.int16) - held[at]).sum(axis=1, dtype=np.int64)
                        room = (100 - percent) * (sizes[others] + sizes[at])
                        others = others[(100 + percent) * apart <= room]
                return others

            # Breadth first: every point is compared with the points of groups not reached yet.
            group_of = np.zeros(len(nodes), dtype=np.int64)
            members = list(groups.values())
            for g, own in enumerate(members):
                group_of[own] = g
            free = np.arange(len(nodes))
            while len(free):
                frontier = list(members[group_of[free[0]]])
                free = free[group_of[free] != group_of[free[0]]]
                first = root(nodes[frontier[0]])
                while frontier and len(free):
                    at = frontier.pop()
                    for g in set(group_of[near_to(at, free)].tolist()):
                        above[root(nodes[members[g][0]])] = first
                        frontier += members[g]
                        free = free[group_of[free] != g]

        def given():
            edges = [(n, r) for n in list(above) if (r := root(n)) != n]
            above.clear()
            columns = zip(*edges) if edges else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b"]
            )

        def ended():
            # The same points again have the same ties, those that have none among them.
            if len(points) > 1 and (same := tuple(points)) not in settled:
                settled.add(same)
                settle(points, *zip(*(known[n] for n in points)))

        bucket, known, settled, part, points = None, {}, set(), None, []
        for batch in batches:
            for place, posting, node, size, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                if (place, posting) != (bucket, part):
                    ended()
                    if len(above) > TIED_NODES:
                        yield given()
                    if place != bucket:
                        known, settled = {}, set()
                    bucket, part, points = place, posting, []
                if posting is None:
                    known[node] = (size, ranges)
                else:
                    points.append(node)
        ended()
        yield given()

    return tied


def _bloom(nodes: DataFrame) -> bytes:
    """A fixed number of bits, set where a node falls; however many nodes there are.

    With many more nodes than bits it lets all pass, and the join behind it decides alone.
    """
    import numpy as np

    low = F.col("node").bitwiseAND((1 << BLOOM_BITS) - 1)
    words = nodes.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(node & 63 as int))")).alias("bits")
    )
    filled = np.zeros(1 << (BLOOM_BITS - 6), dtype=np.int64)
    found = words.toPandas()
    filled[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return filled.tobytes()


def _points(texts: DataFrame, cells: DataFrame, weights: DataFrame, shingle: int) -> DataFrame:
    """Points of cells with their sets: ``region``, ``mask``, ``node``, ``copies``, ``grams``."""
    spark = texts.sparkSession
    bloom = spark.sparkContext.broadcast(_bloom(cells))

    def make(node, grams):
        import numpy as np

        bits = np.frombuffer(bloom.value, dtype=np.int64)
        low = node & ((1 << BLOOM_BITS) - 1)
        if not (int(bits[low >> 6]) >> (node & 63)) & 1:
            return None
        return [node], [grams.tobytes()]

    sets = _fold(texts, make, "node bigint, grams binary", shingle)
    # A task repeats a set rarely, tasks among them do.
    once = sets.groupBy("node").agg(F.first("grams").alias("grams"))
    return (
        once.join(cells, "node")
        .join(weights, "node")
        .select(F.col("cell").alias("region"), F.expr("X''").alias("mask"), "node", "copies", "grams")
    )


POINT = "region bigint, mask binary, node bigint, copies bigint, grams binary"


def _settled(points: DataFrame, percent: int, contract: bool) -> DataFrame:
    """``node``, ``least`` and ``links`` of every point in every region, split as needed.

    With ``contract`` the classes are whole, but not all links are counted.
    """
    done, level = None, 0
    points = materialize(points)
    while True:
        sizes = points.groupBy("region").agg(
            F.count("*").alias("points"), F.sum(F.octet_length("grams") / 8).alias("grams_in")
        )
        is_large = (F.col("points") > REGION_POINTS) | (F.col("grams_in") > REGION_GRAMS)
        # A pair of points is always joined as it is.
        large = materialize(sizes.where(is_large & (F.col("points") > 2)))
        small = points.join(large, "region", "left_anti")
        joined = materialize(_join_small(small, percent))
        done = joined if done is None else done.unionByName(joined)
        if large.isEmpty():
            discard(points, large)
            return done
        parts, measured = _split(points.join(large, "region"), large, percent, contract, level)
        if contract:
            tied = measured.select("node", F.explode("centres").alias("least"))
            done = done.unionByName(materialize(tied.withColumn("links", F.lit(0).cast("bigint"))))
        before, points = points, materialize(parts)
        discard(before, large, measured)
        level += 1


def _split(
    points: DataFrame, sizes: DataFrame, percent: int, contract: bool, level: int
) -> tuple[DataFrame, DataFrame]:
    """Regions around pivots, or pairs of blocks where pivots do not separate.

    Comes with the table that the regions are read from: a row per point with the pivots whose
    regions it is in (``child``, of which ``home`` is the last), how ``far`` they are, whether it
    is ``bound`` to them by a link, and the nodes of all pivots that it links with (``centres``).
    Without ``contract`` no point is bound.
    """
    ranked = Window.partitionBy("region").orderBy(F.xxhash64(F.lit(level), "node"))
    # Chunks are bounded by their bytes, too, as each is one frame and its rows are given out together.
    by_bytes = F.ceil(F.col("grams_in") * 8 / CHUNK_BYTES)
    chunks = F.least(F.col("points"), F.greatest(F.ceil(F.col("points") / REGION_POINTS), by_bytes))
    pivots = (
        points.select("region", "node", "grams", chunks.alias("chunks"), F.row_number().over(ranked).alias("n"))
        .where(F.col("n") <= PIVOTS)
        .select("region", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "node", "grams")
        .toDF("of", "part", "centre", "centre_grams")
    )
    dealt = points.select(
        *("region", "mask", "node", "copies", "grams"),
        F.pmod(F.xxhash64(F.lit(level + 1000), "node"), chunks).alias("chunk"),
    )
    reach = 1 - percent / 100
    schema = f"{POINT}, home int, child array<int>, far array<double>, bound array<boolean>, centres array<bigint>"
    names = [part.split()[0] for part in schema.split(", ")]

    def measure(members, centres):
        import numpy as np
        import pandas as pd

        out = []
        if len(members) and len(centres):
            centres = centres.sort_values("centre")
            centre_nodes = [int(n) for n in centres["centre"]]
            centre_sets = [np.frombuffer(g, dtype=np.uint64) for g in centres["centre_grams"]]
            for row in members.itertuples(index=False):
                own = np.frombuffer(row.grams, dtype=np.uint64)
                far, bound = [], []
                for centre in centre_sets:
                    shared = len(np.intersect1d(own, centre, assume_unique=True))
                    far.append(1 - shared / (len(own) + len(centre) - shared))
                    bound.append(contract and links(shared, len(own), len(centre), percent))
                home = int(np.argmin(far))
                child = [c for c in range(home + 1) if far[c] <= far[home] + 2 * reach + 1e-9]
                tied = [n for n, b in zip(centre_nodes, bound) if b and n != row.node]
                out.append(
                    (row.region, row.mask, row.node, row.copies, row.grams, home, child)
                    + ([far[c] for c in child], [bound[c] for c in child], tied)
                )
        return pd.DataFrame(out, columns=names)

    measured = materialize(
        dealt.groupBy("region", "chunk").cogroup(pivots.groupBy("of", "part")).applyInPandas(measure, schema)
    )
    # How far the nearest point that is not bound is from each pivot; eight rows of a region at most.
    around = F.explode(F.arrays_zip("child", "far", "bound")).alias("at")
    rings = (
        measured.select("region", around)
        .where("not at.bound")
        .groupBy("region", F.col("at.child").alias("child"))
        .agg(F.min("at.far").alias("ring"))
        .groupBy("region")
        .agg(F.map_from_entries(F.collect_list(F.struct("child", "ring"))).alias("rings"))
    )

    def stays(at):
        """A point by its pivot; a bound one links with none but what is bound, too, or in reach of it."""
        ring = F.col("rings")[at["child"]]
        met = (ring <= 2 * reach + 1e-9) & (at["far"] >= ring - reach - 1e-9)
        return ~at["bound"] | F.coalesce(met, F.lit(False))

    staying = F.filter(F.arrays_zip("child", "far", "bound"), stays)
    # Blocks that the region would be cut into, each with every other one.
    needed = F.greatest(
        F.lit(2),
        F.ceil(F.col("points") * 2 / REGION_POINTS),
        F.ceil(F.col("grams_in") * 2 / REGION_GRAMS),
    )
    blocks = F.least(F.col("points"), needed).cast("int")
    children = (
        measured.select("region", "child", "far", "bound")
        .join(rings, "region", "left")
        .select("region", F.explode(staying).alias("at"))
        .groupBy("region", "at.child")
        .agg(F.count("*").alias("n"))
        .groupBy("region")
        .agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    )
    # Pivots are worth their regions if these are smaller, and not more rows than blocks make.
    smaller = (F.col("most") <= 0.7 * F.col("points")) & (F.col("all") <= blocks * F.col("points"))
    worth = (
        sizes.join(children, "region", "left")
        .join(rings, "region", "left")
        .select("region", "points", "grams_in", "rings", F.coalesce(smaller, F.lit(True)).alias("apart"))
    )
    judged = measured.join(worth, "region")
    # One byte for each level; two points whose bytes of a level share a bit are no pair here.
    neither, first, second = (F.expr(f"X'0{n}'") for n in range(3))
    at = F.col("at")
    guest = at["child"] < F.col("home")
    side = (
        F.when(at["bound"], F.when(guest, F.expr("X'05'")).otherwise(F.expr("X'04'")))
        .when(guest, first)
        .otherwise(neither)
    )
    voronoi = (
        judged.where("apart")
        .withColumn("at", F.explode(staying))
        .select(
            F.xxhash64("region", at["child"], F.lit(level)).alias("region"),
            F.concat("mask", side).alias("mask"),
            "node",
            "copies",
            "grams",
        )
    )
    # Blocks: every point with its own and each other block; in a region of two blocks only
    # pairs across count, which the level's byte says: 1 in the first block, 2 in the second.
    own = F.pmod(F.xxhash64(F.lit(level + 2000), "node"), F.col("blocks")).cast("int")
    cross = (
        judged.where("not apart")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    side = (
        F.when(F.col("own") < F.col("other"), first)
        .when(F.col("own") > F.col("other"), second)
        .otherwise(neither)
    )
    paired = cross.select(
        F.xxhash64(
            "region", F.least("own", "other"), F.greatest("own", "other"), F.lit(level), F.lit("block")
        ).alias("region"),
        F.concat("mask", side).alias("mask"),
        "node",
        "copies",
        "grams",
    )
    return voronoi.unionByName(paired), measured


def _join_small(points: DataFrame, percent: int) -> DataFrame:
    """One row per point of each region: the least point it reaches there, and its links."""

    def joined(batches):
        import numpy as np
        import pyarrow as pa

        def settle(rows):
            counts = link_counts([np.frombuffer(r[4], dtype=np.uint64) for r in rows])
            sizes = np.array([len(r[4]) // 8 for r in rows], dtype=np.int64)
            levels = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.uint8)
            linked = 100 * counts >= percent * (sizes[:, None] + sizes[None, :] - counts)
            for sides in levels.reshape(len(rows), len(rows[0][1])).T:
                linked &= (sides[:, None] & sides[None, :]) == 0
            np.fill_diagonal(linked, False)
            copies = np.array([r[3] for r in rows], dtype=np.int64)
            nodes = np.array([r[2] for r in rows], dtype=np.int64)
            least, reached = nodes.copy(), nodes
            while True:  # the least node spreads along links
                around = np.where(linked, least[None, :], np.iinfo(np.int64).max)
                reached = np.minimum(least, around.min(axis=1))
                if np.array_equal(reached, least):
                    break
                least = reached
            return nodes, least, linked @ copies

        def rows_of(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    some = batch.slice(start, SLICE_ROWS)
                    yield from zip(*(c.to_pylist() for c in some.columns))

        def flush(groups):
            parts = [settle(g) for g in groups]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)],
                ["node", "least", "links"],
            )

        group, full, held, current = [], [], 0, None
        for row in rows_of(batches):
            if row[0] != current:
                if len(group) > 1:
                    full.append(group)
                    held += sum(len(r[4]) for r in group)
                if held > SETTLED_BYTES or len(full) >= 1000:
                    yield flush(full)
                    full, held = [], 0
                group, current = [], row[0]
            group.append(row)
        if len(group) > 1:
            full.append(group)
        if full:
            yield flush(full)

    dealt = points.repartition("region").sortWithinPartitions("region")
    return dealt.select("region", "mask", "node", "copies", "grams").mapInArrow(
        joined, "node bigint, least bigint, links bigint"
    )


def link_counts(sets):
    """Sizes of all intersections of some sets of distinct numbers."""
    import numpy as np

    n = len(sets)
    counts = np.zeros((n, n), dtype=np.int64)
    if n <= 4:
        for i in range(n):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                counts[i, j] = counts[j, i] = shared
    else:
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        width = 2048
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        often = np.bincount(column)
        keep = often[column] > 1
        column, owner = column[keep], owner[keep]
        if len(column):
            column = np.concatenate([[0], np.cumsum(np.diff(column) > 0)])
            for start in range(0, int(column[-1]) + 1, width):
                lo, hi = np.searchsorted(column, [start, start + width])
                held = np.zeros((n, width), dtype=np.float32)
                held[owner[lo:hi], column[lo:hi] - start] = 1
                counts += (held @ held.T).astype(np.int64)
    for i in range(n):
        counts[i, i] = len(sets[i])
    return counts


def near_classes(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    count_links: bool = True,
) -> DataFrame:
    """Every row of ``docs`` but its text, with ``n_shingles``, ``component_id``, ``n_links``.

    ``n_shingles`` is the size of the set of word n-grams, ``shingle`` words each (a shorter
    text is one, as a whole), words being split at blanks with A-Z lower-cased. ``component_id`` is the least
    id reachable by links, ``n_links`` the number of rows linked with the row, copies
    included; without ``count_links`` it is not made, which spares comparing points that are one
    class by a pivot. Also adds ``node``, the 64-bit hash of the set: equal sets, equal nodes.

    A null, empty or blank text has no n-grams, links with nothing and is a component by its
    own id. Rows that repeat link with each other. A null id is never the least unless all
    ids reachable are null. Very long texts need memory in proportion. An empty table stays
    empty. Columns named like an added one are replaced.
    """
    made = ("n_shingles", "component_id", "n_links", "node")
    packed = Packed(docs)
    at = f"in_{packed.names.index(text)}"
    texts = packed.rows.select(at)
    rows = materialize(add_nodes(packed.rows, at, shingle).drop(at))
    kept = [c for n, c in zip(packed.names, packed.back()) if n != text and n.lower() not in made]
    weights = (
        rows.where("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min(packed[doc_id]).alias("least_id"),
            F.first("n_shingles").alias("size"),
            F.first("ranges").alias("ranges"),
        )
    )
    # Every step writes a table, so its shuffle files are of no more use.
    with shuffles_dropped(docs.sparkSession):
        weights = materialize(weights)
        cells = _cells(texts, weights.select("node", "size", "ranges"), percent, shingle)
        points = _points(texts, cells, weights.select("node", "copies"), shingle)
        settled = _settled(points, percent, contract=not count_links)
        discard(cells)
        reached = settled.where("node <> least")
        labels = components(reached.select(F.col("node").alias("a"), F.col("least").alias("b")))
    counts = settled.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        weights.join(labels, "node", "left")
        .join(counts, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    least = known.groupBy("label").agg(F.min("least_id").alias("component"))
    classes = known.join(least, "label").select(
        "node",
        "component",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
    )
    joined = rows.join(classes.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    has_set = F.col("n_shingles") > 0
    return joined.select(
        *kept,
        "n_shingles",
        F.when(has_set, F.col("component")).otherwise(packed[doc_id]).alias("component_id"),
        *([F.when(has_set, F.col("links")).otherwise(F.lit(0)).cast("bigint").alias("n_links")] if count_links else []),
        "node",
    )


def keep_one(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row of each component, that of the least id; rows without n-grams stay, all.

    Where rows of that id repeat, one of them stays. A component whose ids are all null
    keeps one row. The columns are those of ``docs``.
    """
    classes = near_classes(docs.select(doc_id, text), text, doc_id, percent, shingle, count_links=False)
    own = F.col(doc_id)
    chosen = (
        classes.where(F.col("n_shingles") > 0)
        .where(own.eqNullSafe(F.col("component_id")))
        .groupBy(F.col("component_id"), F.when(own.isNull(), F.col("node")).alias("lone"))
        .agg(F.min("node").alias("_node"))
        .select(F.col("component_id").alias("_id"), "_node")
    )
    packed = Packed(docs)
    keyed = add_nodes(packed.rows, f"in_{packed.names.index(text)}", shingle)
    blank = keyed.where("n_shingles = 0").select(*packed.back())
    first = Window.partitionBy("_node", "_id").orderBy(packed[text])
    kept = (
        keyed.join(chosen, (F.col("node") == F.col("_node")) & packed[doc_id].eqNullSafe(F.col("_id")))
        .withColumn("_nth", F.row_number().over(first))
        .where("_nth = 1")
    )
    return kept.select(*packed.back()).unionByName(blank)
