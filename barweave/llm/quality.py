"""Quality rules: counts of words and repetition, and line frequency across documents.

Lines are normalised and hashed; for each host the documents that hold a line are counted,
lines above the limit are taken out, and documents that lose too much are rejected. Copies
of a text on a host are one document for the count, else a page would be thrown out for
having been copied.

All of it is one pass over the texts to hashes, then shuffles of hashes. Rows are dealt by
(host, text, line) or (host, line) with partial sums before each shuffle; the join of lines
with the frequent ones is the only place where a common line's rows meet, and adaptive
execution splits such a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import BLANKS, Packed, ascii_lower, words_of
from barweave.session import materialize

WINDOW = 8  # words of a repeated passage
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def add_counts(rows: DataFrame, text: Column) -> DataFrame:
    """The rows with the counts of one text each; a null text counts as empty.

    Each step is a column of its own: an array that is used twice is then made once.
    """
    whole = F.coalesce(text, F.lit(""))
    step = rows.select("*", words_of(text).alias("_words"), _lines(text).alias("_split"))
    step = step.select(
        "*",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")))
        .cast("bigint")
        .alias("n_symbols"),
        (F.size("_split") - F.size(F.array_distinct("_split"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hash"),
    ).drop("_words", "_split")
    for reach in (1, 2, 4):  # hashes of two, four and eight words
        both = F.zip_with(
            "_hash",
            F.slice("_hash", F.lit(reach + 1), F.size("_hash")),
            lambda a, b: F.xxhash64(a, b),
        )
        whole_windows = F.slice(
            "_joined", F.lit(1), F.greatest(F.size("_joined") - reach, F.lit(0))
        )
        step = step.withColumn("_joined", both).drop("_hash")
        step = step.withColumn("_hash", whole_windows).drop("_joined")
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    step = step.withColumn("_sorted", F.when(repeats, _sorted_windows("_hash"))).drop("_hash")
    step = step.withColumn("_at", _repeated_places("_sorted")).drop("_sorted")
    step = step.withColumn("n_repeat_words", F.coalesce(_covered("_at"), F.lit(0).cast("bigint")))
    # Through a generator no filter on the counts is pushed: it would make them again.
    fixed = step.withColumn("_counts", F.struct(*COUNTS)).drop("_at", *COUNTS)
    rest = [c for c in fixed.columns if c != "_counts"]
    return fixed.select(*rest, F.inline(F.array("_counts")))


def _sorted_windows(windows: str) -> Column:
    places = F.sequence(F.lit(0), F.size(windows) - 1)
    pairs = F.zip_with(windows, places, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.sort_array(pairs)


def _repeated_places(windows: str) -> Column:
    """Places of windows that equal their neighbour in hash order, in text order."""
    end = F.size(windows)
    again = F.filter(
        F.sequence(F.lit(1), end),
        lambda k: ((k > 1) & (_hash_at(windows, k - 1) == _hash_at(windows, k)))
        | ((k < end) & (_hash_at(windows, k + 1) == _hash_at(windows, k))),
    )
    return F.sort_array(F.transform(again, lambda k: F.element_at(windows, k)["i"]))


def _hash_at(windows: str, place: Column) -> Column:
    return F.get(F.col(windows), place - 1)["h"]


def _covered(places: str) -> Column:
    """Words in windows at these places; each counts what it reaches beyond the one before."""
    steps = F.zip_with(
        places,
        F.slice(places, F.lit(2), F.size(places)),
        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, s: total + s)


def _lines(text: Column) -> Column:
    """Lines with a word in them."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda line: F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]")))


def _normal(line: Column) -> Column:
    """A line without case, digits and differences of blanks."""
    plain = F.regexp_replace(ascii_lower(line), "[0-9]+", "0")
    return F.trim(F.regexp_replace(plain, BLANKS, " "))


def judge_quality(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    most_share: float = 0.05,
    fewest_documents: int = 20,
    keep_percent: int = 30,
) -> DataFrame:
    """Every row of ``docs`` with its counts, verdict and the text that stays.

    Adds the counts of :func:`add_counts`, ``base_failed``, ``n_removed_words``,
    ``clean_text`` and ``kept``. A line is above the limit if more than ``most_share`` of
    the host's different texts, and at least ``fewest_documents`` of them, have it; case,
    digits and blanks make no difference. A document that fails the base rules (under 20
    words, or over 30 % of its words in repeated windows) is not kept, nor is one whose
    lines above the limit leave it under ``keep_percent`` of its words.
    ``clean_text`` is the text without the lines above the limit, whatever the verdict.

    A null or empty text has counts of 0 and fails; ``clean_text`` of a null is null. A null
    host is one host of its own. Rows that repeat get the same verdict each; ids play no
    part. Very long texts need memory in proportion. Columns of ``docs`` named like an
    added one are replaced.
    """
    made = (
        *COUNTS,
        *("base_failed", "n_removed_words", "clean_text", "kept"),
    )
    packed = Packed(docs)
    body = packed[text]
    keyed = packed.rows.select(
        "*",
        F.coalesce(packed[host].cast("string"), F.lit("")).alias("_host"),
        F.xxhash64(F.lit(1), packed[host].isNull(), body.isNull(), body).alias("_t1"),
        F.xxhash64(F.lit(2), packed[host].isNull(), body.isNull(), body).alias("_t2"),
    )
    gone = _removed_lines(keyed, body, most_share, fewest_documents)
    counted = add_counts(keyed, body)
    joined = counted.join(gone, ["_host", "_t1", "_t2"], "left")
    removed = F.coalesce("_removed", F.lit(0).cast("bigint"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    depleted = 100 * (F.col("n_words") - removed) < keep_percent * F.col("n_words")
    stays = F.array_join(
        F.filter(
            F.split(body, "\n", -1),
            lambda line: ~F.array_contains("_hashes", F.xxhash64(_normal(line))),
        ),
        "\n",
    )
    return joined.select(
        *packed.back(made),
        *made[:5],
        failed.alias("base_failed"),
        removed.alias("n_removed_words"),
        F.when(removed > 0, stays).otherwise(body).alias("clean_text"),
        (~failed & ~depleted).alias("kept"),
    )


def _removed_lines(
    keyed: DataFrame, body: Column, most_share: float, fewest_documents: int
) -> DataFrame:
    """Per host and text that loses lines: their hashes and the words they had."""
    lines = F.transform(
        _lines(body),
        lambda line: F.struct(
            F.xxhash64(_normal(line)).alias("hash"),
            F.size(F.array_remove(F.split(line, BLANKS, -1), "")).alias("words"),
        ),
    )
    text_keys = ["_host", "_t1", "_t2"]
    # Hashes only, written once: three steps below read them.
    texts = materialize(
        keyed.select(*text_keys, lines.alias("_lines"))
        .groupBy(*text_keys)
        .agg(F.first("_lines").alias("_lines"))
    )
    once = F.array_distinct(F.transform("_lines", lambda line: line["hash"]))
    held = (
        texts.select("_host", F.explode(once).alias("hash"))
        .groupBy("_host", "hash")
        .agg(F.count("*").alias("_with"))
        .where(F.col("_with") >= fewest_documents)
    )
    sizes = texts.groupBy("_host").agg(F.count("*").alias("_texts"))
    above = (
        held.join(sizes, "_host")
        .where(F.col("_with") > F.lit(most_share) * F.col("_texts"))
        .select("_host", "hash")
    )
    exploded = texts.select(*text_keys, F.explode("_lines").alias("_line")).select(
        *text_keys, F.col("_line.hash").alias("hash"), F.col("_line.words").alias("words")
    )
    return (
        exploded.join(above, ["_host", "hash"])
        .groupBy(*text_keys)
        .agg(
            F.sum("words").alias("_removed"),
            F.collect_set("hash").alias("_hashes"),
        )
    )
