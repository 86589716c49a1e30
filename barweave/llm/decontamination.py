"""Benchmark decontamination: an FM-index per shard of training texts.

A task takes some megabytes of texts as a shard, indexes their words, searches all phrases
of the benchmark (windows of ten words of an item, or a shorter item as a whole) backward,
and locates the occurrences. They are merged to spans of words, and those to spans of text.
Texts are read once and nothing is shuffled; memory is bounded by the shard.

The benchmark is the stated set of queries. It goes to the tasks in blocks of a fixed number
of words; each block is one more step over the same rows, so a benchmark of any size passes
in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import Packed

WINDOW = 10
BLOCK_WORDS = 1 << 20

SPANS = "array<struct<start:bigint,stop:bigint>>"
_FOUND = ("n_words", "n_hit", "items", "spans")


class Phrases:
    """Windows of some items: a vocabulary of word hashes, and phrases by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        import numpy as np

        from barweave.llm.wordhash import NOT_ALNUM, Words

        words = Words([text for _, text in items], NOT_ALNUM)
        self.vocabulary = np.unique(words.hashes)
        symbols = np.searchsorted(self.vocabulary, words.hashes) + 1
        self.names = [name for name, _ in items]
        by_length: dict[int, tuple[list, list]] = {}
        for item in range(len(items)):
            own = symbols[words.first[item] : words.first[item + 1]]
            if not len(own):
                continue
            length = min(window, len(own))
            rows, owners = by_length.setdefault(length, ([], []))
            rows.append(np.lib.stride_tricks.sliding_window_view(own, length))
            owners.append(np.full(len(own) - length + 1, item))
        #: Per length: distinct phrases, and which phrase each window of an item is.
        self.groups = []
        for length, (rows, owners) in sorted(by_length.items()):
            phrases, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            self.groups.append((length, phrases, which.ravel(), np.concatenate(owners)))

    def find(self, texts: list[bytes | None]):
        """Per text: number of words, spans of words that are hit, positions of items hit."""
        import numpy as np

        from barweave.llm.fm_index import FmIndex
        from barweave.llm.wordhash import NOT_ALNUM, Words

        words = Words(texts, NOT_ALNUM)
        at = np.searchsorted(self.vocabulary, words.hashes)
        at_most = np.minimum(at, max(len(self.vocabulary) - 1, 0))
        known = (
            self.vocabulary[at_most] == words.hashes
            if len(self.vocabulary)
            else np.zeros(len(at), dtype=bool)
        )
        owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
        places = np.flatnonzero(known)
        hit = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        pairs = []
        if len(places):
            # A separator stands before a word that does not follow the last one known in
            # the same text, and behind the last.
            breaks = (np.diff(places) > 1) | (np.diff(owner[places]) > 0)
            shift = np.concatenate([[1], 1 + np.cumsum(breaks)]) + np.arange(len(places))
            symbols = np.zeros(int(shift[-1]) + 2, dtype=np.int64)
            symbols[shift] = at[places] + 1
            word_at = np.zeros(len(symbols), dtype=np.int64)
            word_at[shift] = places
            index = FmIndex(symbols, len(self.vocabulary))
            for length, phrases, which, items in self.groups:
                low, high = index.search(phrases)
                sizes = high - low
                phrase = np.repeat(np.arange(len(phrases)), sizes)
                if not len(phrase):
                    continue
                rows = np.arange(len(phrase)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                found = word_at[index.locate(rows + np.repeat(low, sizes))]
                np.add.at(hit, found, 1)
                np.add.at(hit, found + length, -1)
                pairs.append(self._owners(phrase, owner[found], which, items))
        covered = np.cumsum(hit[:-1]) > 0
        return words, covered, pairs

    @staticmethod
    def _owners(phrase, texts, which, items):
        """Distinct (text, item) for phrases found in texts."""
        import numpy as np

        found = np.unique(np.stack([phrase, texts], axis=1), axis=0)
        order = np.argsort(which, kind="stable")
        counts = np.bincount(which)
        starts = np.cumsum(counts) - counts
        sizes = counts[found[:, 0]]
        text = np.repeat(found[:, 1], sizes)
        offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        item = items[order[np.repeat(starts[found[:, 0]], sizes) + offset]]
        return np.unique(np.stack([text, item], axis=1), axis=0)


def benchmark_blocks(
    benchmark: DataFrame, item: str, text: str, block_words: int
) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of so many bytes as words at least, one block at a time."""
    rows = benchmark.select(F.col(item).cast("string"), text).where(F.col(text).isNotNull())
    block, size = [], 0
    for name, body in rows.toLocalIterator():
        block.append((name, body.encode()))
        size += len(body)
        if size >= block_words * 8:
            yield block
            block, size = [], 0
    if block:
        yield block


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every row of ``docs`` with what the benchmark has in common with it.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window), ``items`` (sorted
    ids of items with a window that occurs, as strings), ``spans`` (start and stop of merged
    occurrences, in code points of the text, ends exclusive) and ``clean_text``, the text
    with each span replaced by one blank.

    Words are runs of digits, letters A-Z in any case and characters beyond ASCII. A null
    text has no words, no spans and a null ``clean_text``; an empty one has none either. Items without
    words have no window. An item with a null id hits words but is not listed; items that
    repeat are listed once. Without documents or items the result is as it should be. A very
    long text is a shard of its own. Columns of ``docs`` named like an added one are replaced.
    """
    made = (*_FOUND, "clean_text")
    packed = Packed(docs)
    rows = packed.rows.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast(SPANS).alias("spans"),
    )
    at = packed.names.index(text)
    blocks = 0
    for block in benchmark_blocks(benchmark, item, item_text, block_words):
        rows = _searched(rows, at, Phrases(block, window))
        blocks += 1
    if not blocks:
        rows = _searched(rows, at, Phrases([], window))
    body = F.col(f"in_{at}")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("spans")),
        lambda k: F.substring(
            body,
            _stop_of(k) + 1,
            F.coalesce(F.get("spans", k)["start"], F.length(body).cast("bigint")).cast("int")
            - _stop_of(k),
        ),
    )
    cut = F.when(F.size("spans") > 0, F.array_join(pieces, " ")).otherwise(body)
    return rows.select(*packed.back(made), *_FOUND, cut.alias("clean_text"))


def _stop_of(k):
    before = F.when(k > 0, F.get("spans", k - 1)["stop"]).otherwise(F.lit(0))
    return before.cast("int")


def _searched(rows: DataFrame, at: int, phrases: Phrases) -> DataFrame:
    """One block's findings merged with those the rows bring along."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(phrases)
    names = rows.columns
    spans_type = T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    )

    def searched(batches):
        import pyarrow as pa

        from barweave.llm.wordhash import slices, text_bytes

        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in slices(batches, at):
            earlier = [batch.column(names.index(n)).to_pylist() for n in ("items", "spans")]
            found = merge_findings(sent.value, text_bytes(batch.column(at)), *earlier)
            columns = [batch.column(i) for i in range(len(names) - len(_FOUND))]
            n_words, n_hit, items, spans = zip(*found)
            columns += [
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
                pa.array(spans, span),
            ]
            yield pa.RecordBatch.from_arrays(columns, list(names))

    fields = [f for f in rows.schema.fields if f.name != "spans"]
    return rows.mapInArrow(searched, T.StructType([*fields, T.StructField("spans", spans_type)]))


def merge_findings(phrases: Phrases, texts, items_before, spans_before):
    """Per text: words, words hit, items, spans in code points."""
    import numpy as np

    words, covered, pairs = phrases.find(texts)
    data = np.frombuffer(words.buffer, dtype=np.uint8)
    items: dict[int, set] = {}
    for pair in pairs:
        for text, item in pair.tolist():
            if phrases.names[item] is not None:
                items.setdefault(text, set()).add(phrases.names[item])
    touched = np.flatnonzero(np.add.reduceat(np.append(covered, False), words.first[:-1]) * (np.diff(words.first) > 0)) if len(texts) else []
    touched = set(np.asarray(touched).tolist())
    out = []
    for i in range(len(texts)):
        first, last = int(words.first[i]), int(words.first[i + 1])
        if i not in touched and not spans_before[i]:
            out.append((last - first, 0, items_before[i], spans_before[i]))
            continue
        begin = int(words.text_starts[i])
        own = data[begin : int(words.text_starts[i + 1])]
        # Code points before each byte: all bytes but those that continue one.
        points = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
        starts = points[words.starts[first:last] - begin]
        stops = points[words.stops[first:last] - begin]
        hit = covered[first:last].copy()
        for s in spans_before[i]:
            hit |= (starts >= s["start"]) & (stops <= s["stop"])
        edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
        spans = [
            {"start": int(starts[a]), "stop": int(stops[b - 1])}
            for a, b in zip(edge[0::2], edge[1::2])
        ]
        names = sorted({*items_before[i], *items.get(i, ())})
        out.append((last - first, int(hit.sum()), names, spans))
    return out
