"""Edit-aware token counts: a segment tree per document, re-encoded only where edits touch it.

A text is cut at blanks into leaves of some dozens of pieces. As no token reaches over a
blank, the tokens of a text are the sum over its leaves, and a tree holds these sums. An
edit is re-encoded together with its boundary context: the leaves that hold the character
before it and the one behind it. The sums on the way to the root change, nothing else is
read. The tree of the edited text is a tree like any other, so edits can follow edits.

Trees are columns of the document's row: where leaves start (in code points), and sums as a
heap with the root first. They are a table that is kept between runs; edits reach their
documents by a join on the id or, made from the text, need no join at all.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import Packed

LEAF_PIECES = 64
EDITS = "array<struct<start:bigint,stop:bigint,replacement:string>>"


def heap_of(counts) -> list[int]:
    """Sums over a binary tree: node ``k`` has children ``2k + 1`` and ``2k + 2``."""
    width = 1
    while width < len(counts):
        width *= 2
    sums = [0] * (width - 1) + list(counts) + [0] * (width - len(counts))
    for node in reversed(range(width - 1)):
        sums[node] = sums[2 * node + 1] + sums[2 * node + 2]
    return sums


def set_leaf(sums: list[int], leaf: int, count: int) -> None:
    node = len(sums) // 2 + leaf
    change = count - sums[node]
    while change:
        sums[node] += change
        if node == 0:
            break
        node = (node - 1) // 2


def trees_of(texts: list[bytes | None], own) -> list[tuple[list[int], list[int]]]:
    """Leaf starts and sums of each text."""
    import numpy as np

    from barweave.llm.encoder import DETACHED, SPECIAL_MARK
    from barweave.llm.wordhash import BLANK, Words

    whole = {i for i, text in enumerate(texts) if text and SPECIAL_MARK in text}
    words = Words([None if i in whole else t for i, t in enumerate(texts)], BLANK, DETACHED)
    _, sizes = own.pieces(words)
    data = np.frombuffer(words.buffer, dtype=np.uint8)
    out = []
    for i in range(len(texts)):
        first, last = int(words.first[i]), int(words.first[i + 1])
        if i in whole:
            out.append(([0], heap_of([len(own.encode([texts[i]])[0])])))
            continue
        if first == last:
            out.append(([0], heap_of([0])))
            continue
        starts, stops = words.starts[first:last], words.stops[first:last]
        behind_blank = np.concatenate([[True], starts[1:] > stops[:-1]])
        piece = np.cumsum(behind_blank) - 1
        heads = np.flatnonzero(behind_blank & (piece % LEAF_PIECES == 0))
        counts = np.add.reduceat(sizes[first:last], heads)
        begin = int(words.text_starts[i])
        points = np.cumsum((data[begin : int(starts[-1]) + 1] & 0xC0) != 0x80) - 1
        at = points[starts[heads] - begin]
        at[0] = 0
        out.append((at.tolist(), heap_of(counts.tolist())))
    return out


def edit_tree(text: str, starts: list[int], sums: list[int], edits: list[dict], own):
    """Apply edits to a text and its tree.

    Returns the new text, starts and sums, the number of edits applied and the number of
    characters encoded again.
    """
    ordered = sorted(
        (
            (e["start"], e["stop"], e["replacement"] or "")
            for e in edits
            if e is not None
            and e["start"] is not None
            and e["stop"] is not None
            and 0 <= e["start"] <= e["stop"] <= len(text)
        ),
    )
    valid, reach = [], 0
    for edit in ordered:
        if edit[0] >= reach:
            valid.append(edit)
            reach = edit[1]
    groups: list[list] = []  # first leaf, last leaf, edits
    for edit in valid:
        low = bisect_right(starts, max(edit[0] - 1, 0)) - 1
        high = bisect_right(starts, edit[1]) - 1
        if groups and low <= groups[-1][1]:
            groups[-1][1] = max(groups[-1][1], high)
            groups[-1][2].append(edit)
        else:
            groups.append([low, high, [edit]])
    sums, pieces, recoded = list(sums), [], 0
    new_starts = list(starts)
    at = shift = 0
    next_leaf = 0
    for low, high, inside in groups:
        region_start = starts[low]
        region_stop = starts[high + 1] if high + 1 < len(starts) else len(text)
        for leaf in range(next_leaf, low + 1):
            new_starts[leaf] = starts[leaf] + shift
        pieces.append(text[at:region_start])
        made, place = [], region_start
        for start, stop, replacement in inside:
            made += [text[place:start], replacement]
            place = stop
        made.append(text[place:region_stop])
        region = "".join(made)
        pieces.append(region)
        recoded += len(region)
        set_leaf(sums, low, len(own.encode([region.encode()])[0]))
        shift += len(region) - (region_stop - region_start)
        for leaf in range(low + 1, high + 1):
            set_leaf(sums, leaf, 0)
            new_starts[leaf] = region_stop + shift
        at, next_leaf = region_stop, high + 1
    for leaf in range(next_leaf, len(starts)):
        new_starts[leaf] = starts[leaf] + shift
    pieces.append(text[at:])
    return "".join(pieces), new_starts, sums, len(valid), recoded


def build_trees(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row with ``leaf_starts``, ``sums`` and ``n_tokens``, its tree and its count.

    A null or empty text is a tree of one leaf without tokens. Ids play no part, so rows that
    repeat have equal trees; an empty table stays empty. A very long text needs memory in
    proportion. Columns of ``docs`` named like an added one are replaced.
    """
    made = ("leaf_starts", "sums", "n_tokens")
    packed = Packed(docs)
    at = packed.names.index(text)
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType(
        [*packed.rows.schema.fields, *(T.StructField(n, numbers) for n in made[:2])]
    )

    def grown(batches):
        import pyarrow as pa

        from barweave.llm.encoder import encoder
        from barweave.llm.wordhash import slices, text_bytes

        own = encoder(tokenizer)
        for batch in slices(batches, at):
            trees = trees_of(text_bytes(batch.column(at)), own)
            lists = [pa.array(column, pa.list_(pa.int64())) for column in zip(*trees)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *lists], [*batch.schema.names, *made[:2]]
            )

    rows = packed.rows.mapInArrow(grown, schema)
    return rows.select(*packed.back(made), *made[:2], F.get("sums", F.lit(0)).alias("n_tokens"))


def with_edits(rows: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows with the column ``edits`` from a table of ``doc_id, start, stop, replacement``.

    Rows with a null or unknown id have none; every row of an id gets that id's edits.
    """
    own = edits.groupBy(F.col(doc_id).alias("_edited")).agg(
        F.collect_list(F.struct("start", "stop", "replacement")).alias("edits")
    )
    packed = Packed(rows)
    joined = packed.rows.join(own, packed[doc_id] == F.col("_edited"), "left")
    none = F.array().cast(EDITS)
    return joined.select(*packed.back(("edits",)), F.coalesce("edits", none).alias("edits"))


def apply_edits(
    trees: DataFrame, tokenizer: str, text: str = "text", edits: str = "edits"
) -> DataFrame:
    """Every row of trees with its edits applied: text, tree and ``n_tokens`` are the new ones.

    Adds ``n_edits``, how many edits were applied, and ``n_recoded``, the characters that
    were encoded again. An edit replaces code points ``start`` to ``stop`` (exclusive) of the
    old text. Edits that lie outside the text, have a null place or overlap an earlier one
    are left out; a null replacement deletes. A null text has no edits and stays null.
    """
    made = ("n_edits", "n_recoded")
    packed = Packed(trees)
    at, starts, sums, wanted = (
        packed.names.index(n) for n in (text, "leaf_starts", "sums", edits)
    )
    schema = T.StructType(
        [*packed.rows.schema.fields, *(T.StructField(n, T.LongType()) for n in made)]
    )

    def edited(batches):
        import pyarrow as pa

        from barweave.llm.encoder import encoder
        from barweave.llm.wordhash import slices

        own = encoder(tokenizer)
        for batch in slices(batches, at):
            columns = [batch.column(i).to_pylist() for i in (at, starts, sums, wanted)]
            out = [
                (body, heads, tree, 0, 0)
                if body is None or not own_edits
                else edit_tree(body, heads, tree, own_edits, own)
                for body, heads, tree, own_edits in zip(*columns)
            ]
            new = [list(column) for column in zip(*out)]
            arrays = list(batch.columns)
            for place, values in zip((at, starts, sums), new):
                arrays[place] = pa.array(values, batch.schema.field(place).type)
            arrays += [pa.array(values, pa.int64()) for values in new[3:]]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *made])

    rows = packed.rows.mapInArrow(edited, schema)
    return rows.select(
        *packed.back(("n_tokens", *made)),
        F.get(f"in_{sums}", F.lit(0)).alias("n_tokens"),
        *made,
    )
