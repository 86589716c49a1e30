"""Sharding by a lookup table that permutations fill.

Every shard has its own order of preference over the slots of a table of prime size, given
by an offset and a step from hashes of its name. The shards take turns: each claims the
first slot of its order that is free, until none is. All shards get the same number of
slots, to within one, and when a shard comes or goes few slots change their owner. The
table has a fixed size whatever the data, so it is broadcast, and a row is placed by one
hash and one lookup, without a shuffle of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import Packed, ordinal_bits

SLOTS = 2039  # prime, over a hundred slots for each of a few shards
MOST_SLOTS = 1_000_003  # what a broadcast may have at most


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The owner of each slot, as a position in ``shards``."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need names that differ")
    if not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"{slots} slots for {len(shards)} shards; at most {MOST_SLOTS}")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be prime, not {slots}")
    orders = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        offset, step = (int.from_bytes(digest[i : i + 8], "big") for i in (0, 8))
        orders.append([offset % slots, step % (slots - 1) + 1])
    owner, free = [-1] * slots, slots
    while free:
        for shard, order in enumerate(orders):
            while owner[order[0]] >= 0:
                order[0] = (order[0] + order[1]) % slots
            owner[order[0]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(keys: Sequence[Column], slots: int = SLOTS) -> Column:
    """Slot of a row by its keys; a null key counts as absent, not as zero."""
    return F.pmod(ordinal_bits(*keys), F.lit(slots)).cast("int")


def assign_shards(
    rows: DataFrame,
    keys: Sequence[str],
    shards: Sequence[str],
    slots: int = SLOTS,
) -> DataFrame:
    """Every row with ``slot`` and ``shard``; same keys, same shard.

    Null keys are left out of the hash, so rows whose keys are all null share one slot.
    Rows that repeat stay together. An empty table stays empty. Columns of ``rows`` named
    ``slot`` or ``shard`` are replaced.
    """
    spark = rows.sparkSession
    owner = fill_table(shards, slots)
    packed = Packed(rows)
    lookup = spark.createDataFrame(
        [(slot, shards[at]) for slot, at in enumerate(owner)], "slot int, shard string"
    )
    placed = packed.rows.withColumn("_key_slot", slot_of([packed[k] for k in keys], slots))
    joined = placed.join(F.broadcast(lookup), F.col("_key_slot") == F.col("slot"))
    return joined.select(*packed.back(("slot", "shard")), "slot", "shard")
