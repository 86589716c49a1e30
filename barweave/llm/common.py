"""What several operators share: literal tables, word counts, row fingerprints."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are what lies between blanks and the control characters 9 to 13.
BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Packed:
    """A table whose columns are called ``in_0``, ``in_1``, ... while an operator works on it.

    The caller's columns can then have any names, those of an operator's own included.
    ``self[name]`` is a column of the caller's; ``back(made)`` lists the caller's columns by
    their names but for those that the operator makes itself.
    """

    def __init__(self, df: DataFrame):
        self.names = list(df.columns)
        self.rows = df.toDF(*(f"in_{i}" for i in range(len(self.names))))

    def __getitem__(self, name: str) -> Column:
        return F.col(f"in_{self.names.index(name)}")

    def back(self, made: Sequence[str] = ()) -> list[Column]:
        taken = {name.lower() for name in made}
        return [
            F.col(f"in_{i}").alias(name)
            for i, name in enumerate(self.names)
            if name.lower() not in taken
        ]


def literal_rows(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A small table of literals that exists in the plan only."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def ordinal_bits(*parts: Column) -> Column:
    """A 60-bit pseudo-random number that depends on the parts only."""
    digest = F.md5(F.concat_ws(":", *(p.cast("string") for p in parts)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Have the shuffle files of actions in here removed when each action is over.

    For steps whose result is written as a table: nothing reads the shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and no later step reads.

    To be called when the tables made of them are written whole: from then on a lost
    executor has its work repeated from those.
    """
    for table_read in tables:
        context = table_read.sparkSession.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs.Path
        folders = {file.rsplit("/", 1)[0] for file in table_read.inputFiles()}
        for folder in folders:
            path = hadoop(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often ``body`` names it.

    Inside higher-order functions nothing else keeps an expression from being evaluated for
    every element and every mention.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Elements of an array that are folded at a time, so that no long array is copied per element.
CHUNK = 256


def folded_before(values: Column, first: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` makes of ``first`` and the elements before each one; an array as long.

    ``join`` must be associative, and ``first`` leave values as they are. Folds run over chunks and
    inside each, so the work grows with the length and hardly with its square.
    """

    def running(some: Column, start: Column) -> Column:
        """``start`` and what it becomes with each value but the last."""
        return F.aggregate(
            F.slice(some, 1, F.size(some) - 1),
            F.array(start),
            lambda done, v: F.concat(done, F.array(join(F.element_at(done, -1), v))),
        )

    def in_chunks(all_: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int"))
        return F.transform(chunks, lambda c: F.slice(all_, c * CHUNK + 1, CHUNK))

    def total(some: Column) -> Column:
        return F.aggregate(some, first, lambda a, v: join(a, v))

    def folded(cut: Column) -> Column:
        return F.flatten(F.zip_with(cut, let(F.transform(cut, total), lambda t: running(t, first)), running))

    return let(
        values, lambda all_: F.when(F.size(all_) > 0, let(in_chunks(all_), folded)).otherwise(all_)
    )


#: Characters of a block that a piece of a text is cut from.
BLOCK_CHARS = 1024


def blocks_of(text: Column) -> Column:
    """A text in blocks of 1,024 code points, for :func:`piece_of`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def piece_of(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` of a text in blocks, without counting from its start."""
    first = F.floor(start / BLOCK_CHARS).cast("int")
    last = F.floor((stop - 1) / BLOCK_CHARS).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
    piece = F.substr(near, (start - first * BLOCK_CHARS + 1).cast("int"), (stop - start).cast("int"))
    return F.when(stop > start, piece).otherwise(F.lit(""))


def runs_of(text: str, pattern: str) -> Column:
    """Array of ``start`` and ``stop`` of all matches in a text column, in code points."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ends = F.zip_with(
        pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("run"))
    )
    spans = "array<struct<start:bigint,stop:bigint>>"
    zero = F.lit(0).cast("bigint")

    def placed(found: Column) -> Column:
        steps = F.transform(found, lambda e: (e["gap"] + e["run"]).cast("bigint"))
        return F.zip_with(
            found,
            folded_before(steps, zero, lambda a, b: a + b),
            lambda e, at: F.struct(
                (at + e["gap"]).cast("bigint").alias("start"),
                (at + e["gap"] + e["run"]).cast("bigint").alias("stop"),
            ),
        )

    walked = let(F.filter(ends, lambda e: e["run"].isNotNull()), placed)
    return F.coalesce(walked, F.array().cast(spans))
