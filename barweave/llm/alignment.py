"""How two tokenizers' tokens correspond, counted over a whole corpus.

1. *First pass.* Every task encodes its texts with both tokenizers, aligns the tokens by the bytes
   they stand for, and keeps how many of its documents hold each pair of ids that overlaps.
2. *Perfect hash.* The distinct pairs are cut into segments by their first id, and each segment gets
   a minimal perfect hash and the list of its keys in the hash's order.
3. *Tree sum.* Counts of a segment from a group of tasks become one dense vector, indexed by the hash;
   vectors are summed sixteen at a time until one is left. A first id's pairs are in one segment,
   so its highest count is known there.
4. *Second pass.* Documents are aligned again; each pair's index is verified against the keys, and
   its count looked up. The table (17 bytes a pair) is broadcast if there are at most
   ``most_pairs``. Beyond that, each document's distinct pairs are joined with the table.

A segment has some 65,000 pairs and at most as many more as the second vocabulary has ids. What comes
to the driver is the number of pairs, and the table where it is broadcast.
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import Packed, discard, shuffles_dropped
from barweave.session import materialize

SEGMENT_PAIRS = 1 << 16
MOST_PAIRS = 4_000_000
FAN_IN = 16
HELD_PAIRS = 2_000_000  # distinct pairs a task holds before it gives them out
SEGMENT = "seg int, hash binary, keys binary, counts binary"
MADE = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def _count_task(path_a: str, path_b: str):
    """Pairs of a task's texts with the number of texts that hold them."""

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm.two_tokenizers import aligner, flat
        from barweave.llm.wordhash import slices, text_bytes

        both = aligner(path_a, path_b)
        part = TaskContext.get().partitionId()
        held: list = []

        def merged():
            keys, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, which, np.concatenate([n for _, n in held]))
            return keys, total

        def given(keys, total):
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(total), pa.array(np.full(len(keys), part), pa.int32())],
                ["key", "n", "part"],
            )

        for batch in slices(batches, 0):
            both.trim()
            found = both.read(text_bytes(batch.column(0)))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            if sizes.sum():
                pieces = flat(found)
                row = np.repeat(np.arange(len(found)), sizes)
                # A row's piece, then a row's pair, counts once.
                own = np.unique((row << 32) | pieces)
                links, counts = both.gathered(own & 0xFFFFFFFF)
                pairs = np.unique((np.repeat(own >> 32, counts) << 42) | links)
                held.append(np.unique(pairs & ((1 << 42) - 1), return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_PAIRS:
                held = [merged()]
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield given(*held[0])
                    held = []
        if held:
            yield given(*merged())

    return counted


def _hashed(group):
    """One segment's keys in the order of their perfect hash."""
    import numpy as np
    import pandas as pd

    from barweave.llm.perfect_hash import PerfectHash

    keys = group["key"].to_numpy(dtype=np.int64).view(np.uint64)
    made = PerfectHash.of(keys)
    ordered = np.empty(len(keys), dtype=np.int64)
    ordered[made.index(keys)] = keys.view(np.int64)
    return pd.DataFrame({"seg": [int(group["seg"].iloc[0])], "hash": [made.dumps()], "keys": [ordered.tobytes()]})


def _vector(found, segment):
    """A dense vector of the counts that one group of tasks found."""
    import numpy as np
    import pandas as pd

    from barweave.llm.perfect_hash import PerfectHash

    if not len(found):
        return pd.DataFrame({"seg": [], "leaf": [], "counts": []})
    made = PerfectHash.loads(segment["hash"].iloc[0])
    counts = np.zeros(made.size, dtype=np.int64)
    np.add.at(counts, made.index(found["key"].to_numpy(dtype=np.int64)), found["n"].to_numpy())
    first = found.iloc[0]
    return pd.DataFrame({"seg": [int(first["seg"])], "leaf": [int(first["leaf"])], "counts": [counts.tobytes()]})


def _summed(group):
    import numpy as np
    import pandas as pd

    counts = sum(np.frombuffer(c, dtype=np.int64) for c in group["counts"])
    first = group.iloc[0]
    return pd.DataFrame({"seg": [int(first["seg"])], "leaf": [int(first["leaf"])], "counts": [counts.tobytes()]})


def _shift(path_a: str, path_b: str) -> int:
    from barweave.llm.two_tokenizers import aligner

    return aligner(path_a, path_b).shift


def pair_table(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", segment_pairs: int = SEGMENT_PAIRS
) -> tuple[DataFrame, int]:
    """The corpus's pairs in segments (:data:`SEGMENT`), and how many pairs there are.

    ``keys`` and ``counts`` are vectors of 64-bit numbers in the order of ``hash``; a key is the
    first id shifted by the bits of the second vocabulary, and the second id.
    """
    vector = "seg int, leaf int, counts binary"
    shift = _shift(path_a, path_b)
    with shuffles_dropped(docs.sparkSession):
        found = materialize(
            docs.select(text).mapInArrow(_count_task(path_a, path_b), "key bigint, n bigint, part int")
        )
        keys = materialize(found.select("key").distinct())
        n_pairs, n_found = keys.count(), found.count()
        n_segments = max(1, -(-n_pairs // segment_pairs))
        leaves = max(1, -(-n_found // (4 * max(1, n_pairs))))
        seg = F.pmod(F.xxhash64(F.shiftright("key", shift)), F.lit(n_segments)).cast("int")
        segments = materialize(
            keys.withColumn("seg", seg).groupBy("seg").applyInPandas(_hashed, "seg int, hash binary, keys binary")
        )
        dealt = found.select("key", "n", seg.alias("seg"), F.pmod("part", F.lit(leaves)).alias("leaf"))
        to_all = segments.select("seg", F.explode(F.sequence(F.lit(0), F.lit(leaves - 1))).alias("leaf"), "hash")
        counts = materialize(
            dealt.groupBy("seg", "leaf").cogroup(to_all.groupBy("seg", "leaf")).applyInPandas(_vector, vector)
        )
        discard(found, keys)
        while leaves > 1:
            leaves = -(-leaves // FAN_IN)
            fewer = counts.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN).cast("int"))
            before, counts = counts, materialize(fewer.groupBy("seg", "leaf").applyInPandas(_summed, vector))
            discard(before)
    return segments.join(counts.drop("leaf"), "seg").select("seg", "hash", "keys", "counts"), n_pairs


class PairTable:
    """Segments in memory: counts of pairs, and if a count is the highest of its first id."""

    def __init__(self, rows, n_segments: int, shift: int):
        import numpy as np

        self.shift = shift
        self.segments = [None] * n_segments
        for seg, hashed, keys, counts in rows:
            keys, counts = np.frombuffer(keys, dtype=np.int64), np.frombuffer(counts, dtype=np.int64)
            self.segments[seg] = (hashed, keys, counts, highest(keys, counts, shift))
        self._loaded: dict = {}

    def __getstate__(self):
        return {**self.__dict__, "_loaded": {}}

    def values(self, keys, segs):
        """Counts of keys, and whether each is the highest of its first id; 0 for no pair."""
        import numpy as np

        from barweave.llm.perfect_hash import PerfectHash

        counts, best = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        for seg in np.unique(segs).tolist():
            if self.segments[seg] is None:
                continue
            hashed, own, n, high = self.segments[seg]
            if seg not in self._loaded:
                self._loaded[seg] = PerfectHash.loads(hashed)
            at = np.flatnonzero(segs == seg)
            index = self._loaded[seg].index(keys[at])
            verified = (index >= 0) & (own[index] == keys[at])
            at, index = at[verified], index[verified]
            counts[at], best[at] = n[index], high[index]
        return counts, best


def highest(keys, counts, shift: int):
    """Which counts are the highest of their first id, ties included."""
    import numpy as np

    first, which = np.unique(keys >> shift, return_inverse=True)
    most = np.zeros(len(first), dtype=np.int64)
    np.maximum.at(most, which, counts)
    return counts == most[which]


def _sums(values, sizes):
    """Sums of runs of values, of these sizes each."""
    import numpy as np

    ends = np.concatenate([[0], np.cumsum(values)])
    stops = np.cumsum(sizes)
    return ends[stops] - ends[stops - sizes]


def _fields(docs: DataFrame, at: int) -> list:
    return [f for i, f in enumerate(docs.schema.fields) if i != at]


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text: str = "text",
    segment_pairs: int = SEGMENT_PAIRS,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """Every row of ``docs`` but its text, with how its tokens by both tokenizers correspond.

    ``path_a`` names a byte-level vocabulary of the tokenizers library, which gets a blank and the
    text, ``path_b`` a sentencepiece model, which puts the blank itself. Adds ``n_a`` and ``n_b``
    (tokens), ``groups`` (``a1,a2|b1;a3|b2``: ids between ends that both have) and
    ``n_groups``, ``n_links`` (pairs of tokens that overlap), ``n_best`` (links whose pair of ids is in
    as many documents as any of its first id, ties included) and ``count_sum`` (documents that hold
    the link's pair, over all links). Counts are of all rows of ``docs``.

    A text that is null or empty, or that the tokens of one side do not give back byte for byte, has
    no tokens: zeros and empty ``groups``. Rows that repeat are documents each; ids play no part. A
    very long text is encoded whole and needs memory in proportion. An empty table stays empty.
    Columns of ``docs`` named like an added one are replaced.
    """
    segments, n_pairs = pair_table(docs, path_a, path_b, text, segment_pairs)
    shift, n_segments = _shift(path_a, path_b), max(1, -(-n_pairs // segment_pairs))
    packed = Packed(docs)
    rows, at = packed.rows, packed.names.index(text)
    kept = [c for n, c in zip(packed.names, packed.back()) if n != text and n.lower() not in MADE]
    if n_pairs > most_pairs:
        return _joined(rows, at, path_a, path_b, segments, shift).select(*kept, *MADE)
    table = PairTable([tuple(r) for r in segments.collect()], n_segments, shift)
    sent = docs.sparkSession.sparkContext.broadcast(table)
    names = [f.name for f in _fields(rows, at)]

    def looked_up(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm.two_tokenizers import Growing, aligner, flat
        from barweave.llm.wordhash import slices, text_bytes

        both, generation = aligner(path_a, path_b), None
        for batch in slices(batches, at):
            both.trim()
            if both.generation != generation:
                generation, valued = both.generation, 0
                sums, highs = Growing(), Growing()
            found = both.read(text_bytes(batch.column(at)))
            # Values of the pieces that are new since the last slice.
            new = np.arange(valued, len(both.groups))
            valued = len(both.groups)
            if len(new):
                links, counts = both.gathered(new)
                keys, which = np.unique(links, return_inverse=True)
                n, best = sent.value.values(keys, segments_of(keys >> shift, n_segments))
                sums.extend(_sums(n[which], counts))
                highs.extend(_sums(best[which].astype(np.int64), counts))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            pieces = flat(found)
            totals = [_sums(made.data[pieces], sizes) for made in (*both.counts[:4], highs, sums)]
            groups = [";".join([both.groups[p] for p in own]) for own in found]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            columns += [pa.array(c) for c in totals]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(groups, pa.string())], [*names, *MADE])

    added = [T.StructField(n, T.LongType()) for n in MADE[:-1]]
    schema = T.StructType([*_fields(rows, at), *added, T.StructField("groups", T.StringType())])
    return rows.mapInArrow(looked_up, schema).select(*kept, *MADE)


def segments_of(ids, n_segments: int):
    """The segment of each first id, as ``xxhash64`` of a bigint has it in :func:`pair_table`."""
    import numpy as np
    import xxhash

    found, which = np.unique(ids, return_inverse=True)
    # Spark's hash of a bigint is that of its eight bytes, seed 42.
    hashes = [
        xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), seed=42) for i in found
    ]
    signed = np.array(hashes, dtype=np.uint64).view(np.int64)
    return np.mod(signed, n_segments)[which]


def _joined(rows: DataFrame, at: int, path_a: str, path_b: str, segments: DataFrame, shift: int) -> DataFrame:
    """The second pass with the table at rest: each row's distinct pairs meet it in a join."""
    names = [f.name for f in _fields(rows, at)]

    def described(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm.two_tokenizers import aligner, flat
        from barweave.llm.wordhash import slices, text_bytes

        both = aligner(path_a, path_b)
        for batch in slices(batches, at):
            both.trim()
            groups, keys, times = [], [], []
            found = both.read(text_bytes(batch.column(at)))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            pieces = flat(found)
            totals = [_sums(made.data[pieces], sizes) for made in both.counts[:4]]
            for own in found:
                links, _ = both.gathered(np.array(own, dtype=np.int64))
                held = np.unique(links, return_counts=True)
                groups.append(";".join([both.groups[p] for p in own]))
                keys.append(held[0])
                times.append(held[1])
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            columns += [pa.array(c) for c in totals]
            columns += [pa.array(groups, pa.string())]
            columns += [pa.array(c, pa.list_(pa.int64())) for c in (keys, times)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_a", "n_b", "n_groups", "n_links", "groups", "keys", "times"])

    def valued(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = np.frombuffer(keys, dtype=np.int64), np.frombuffer(counts, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(counts), pa.array(highest(keys, counts, shift))], ["key", "count", "high"]
                )

    long, many = T.LongType(), T.ArrayType(T.LongType())
    added = [(n, long) for n in ("n_a", "n_b", "n_groups", "n_links")]
    added += [("groups", T.StringType()), ("keys", many), ("times", many)]
    schema = T.StructType([*_fields(rows, at), *(T.StructField(n, t) for n, t in added)])
    # Written with their number, which must not change between the two sides of the join.
    found = materialize(rows.mapInArrow(described, schema).withColumn("_row", F.monotonically_increasing_id()))
    values = segments.select("keys", "counts").mapInArrow(valued, "key bigint, count bigint, high boolean")
    met = (
        found.select("_row", F.explode(F.arrays_zip("keys", "times")).alias("_l"))
        .select("_row", F.col("_l.keys").alias("key"), F.col("_l.times").alias("_times"))
        .join(values, "key")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("high"), F.col("_times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("count") * F.col("_times")).alias("count_sum"),
        )
    )
    return found.join(met, "_row", "left").withColumns(
        {n: F.coalesce(n, F.lit(0).cast("bigint")) for n in ("n_best", "count_sum")}
    )
