"""Token-ID output: ids of all documents in id order, in blocks of an asymmetric numeral system.

1. Documents are dealt by ranges of their id and sorted in them, encoded, and packed into
   blocks of whole documents; a block knows how many ids its range had before it.
2. Ids are counted over all blocks. The counts, at most one per id of the vocabulary, make
   the frequency table that all blocks share.
3. Each block is coded by itself and written, with its documents and their lengths. The
   folder is complete with ``blocks`` and ``counts``; both are plain Spark tables, so any
   store and any number of executors can read them.

The texts are shuffled once. A document is never cut: one longer than a block is a block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.llm.common import shuffles_dropped
from barweave.session import materialize, shared_folder

BLOCK_TOKENS = 1 << 20
END_ID = 1


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int | None = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the ids of all documents, in ascending id, below ``folder``.

    A null or empty text has its end id only. Rows without an id come first; rows with equal
    ids follow each other by text. An empty table gives an empty folder of the same form.
    Very long texts need memory in proportion. Other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType
    with shuffles_dropped(spark):
        plain = materialize(_blocks(docs, doc_id, text, tokenizer, end_id, block_tokens))
    counts = _counts(plain)
    counts.write.parquet(f"{folder}/counts")
    table = spark.sparkContext.broadcast(read_table_counts(spark, folder))

    def coded(batches):
        import numpy as np
        import pyarrow as pa

        from barweave.llm import rans

        shared = rans.Table.of_counts(table.value)
        for batch in batches:
            at = batch.schema.names.index("ids")
            blocks = [
                rans.encode(np.frombuffer(ids, dtype="<u4" if wide else "<u2"), shared)
                for ids, wide in zip(
                    batch.column(at).to_pylist(), batch.column("wide").to_pylist()
                )
            ]
            columns = [batch.column(n) for n in batch.schema.names if n not in ("ids", "wide")]
            names = [n for n in batch.schema.names if n not in ("ids", "wide")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.binary())], [*names, "block"])

    plain.mapInArrow(coded, _schema(id_type, "block binary")).write.parquet(f"{folder}/blocks")


def _schema(id_type: T.DataType, rest: str) -> str:
    return (
        f"part int, before bigint, n_tokens bigint, doc_ids array<{id_type.simpleString()}>,"
        f" lengths array<bigint>, {rest}"
    )


def _blocks(
    docs: DataFrame, doc_id: str, text: str, tokenizer: str, end_id: int | None, block_tokens: int
) -> DataFrame:
    id_type = docs.schema[doc_id].dataType
    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def packed(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from barweave.llm.encoder import encoder
        from barweave.llm.wordhash import slices, text_bytes

        own = encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        tail = [] if end_id is None else [end_id]
        names = ["part", "before", "n_tokens", "doc_ids", "lengths", "ids", "wide"]
        ids, lengths, doc_ids = [], [], []

        def block(type_, total):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([total], pa.int64()),
                    pa.array([doc_ids], pa.list_(type_)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([b"".join(ids)], pa.binary()),
                    pa.array([own.dtype.itemsize == 4]),
                ],
                names,
            )

        kind, total = None, 0
        for batch in slices(batches, 1):
            kind = batch.column(0).type
            encoded = own.encode(text_bytes(batch.column(1)))
            for key, found in zip(batch.column(0).to_pylist(), encoded):
                ids.append(np.append(found, tail).astype(own.dtype).tobytes())
                lengths.append(len(found) + len(tail))
                doc_ids.append(key)
                total += lengths[-1]
                if total >= block_tokens:
                    yield block(kind, total)
                    before += total
                    ids, lengths, doc_ids, total = [], [], [], 0
        if ids:
            yield block(kind, total)

    return ordered.mapInArrow(packed, _schema(id_type, "ids binary, wide boolean"))


def _counts(blocks: DataFrame) -> DataFrame:
    """How often each id occurs in all blocks."""

    def counted(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids, wide in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.bincount(np.frombuffer(ids, dtype="<u4" if wide else "<u2"))
                if len(own) < len(total):
                    own = np.pad(own, (0, len(total) - len(own)))
                own[: len(total)] += total
                total = own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int64)), pa.array(total[seen])], ["id", "n"]
        )

    each = blocks.select("ids", "wide").mapInArrow(counted, "id bigint, n bigint")
    return each.groupBy("id").agg(F.sum("n").alias("n"))


def read_table_counts(spark, folder: str):
    """Counts by id; one number per id of the vocabulary at most."""
    import numpy as np

    found = spark.read.parquet(f"{folder}/counts").toPandas()
    size = int(found["id"].max()) + 1 if len(found) else 1
    out = np.zeros(size, dtype=np.int64)
    out[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def read_tokens(spark, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it. ``ids`` are little-endian unsigned
    32-bit numbers, ``ids_crc32`` their checksum. A damaged block is an error.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    table = spark.sparkContext.broadcast(read_table_counts(spark, folder))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    )
    # One row per range of ids.
    placed = blocks.join(F.broadcast(parts), "part")
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = (
        f"doc_id {id_type.simpleString()}, start bigint, n_tokens bigint, ids binary,"
        " ids_crc32 bigint"
    )

    def decoded(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        from barweave.llm import rans

        shared = rans.Table.of_counts(table.value)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for first, doc_ids, lengths, block in zip(*columns):
                ids = rans.decode(block, shared)
                ends = np.cumsum(lengths)
                data = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes())
                own = [bytes(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, batch.schema.field(1).type.value_type),
                        pa.array(first + ends - np.array(lengths), pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(own, pa.binary()),
                        pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    return placed.select(
        (F.col("ahead") + F.col("before")).alias("first"), "doc_ids", "lengths", "block"
    ).mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write to a new folder in the shared one, and read it back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4()}"
    write_tokens(docs, folder, tokenizer, **options)
    return read_tokens(spark, folder)
