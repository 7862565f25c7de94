"""Shard placement by a permutation-filled lookup table.

Every shard has a permutation of the table's slots, its preference order. The shards take
turns; at each turn a shard claims its next slot that is still free, until none is. The table
is nearly even (shares differ by about one slot) and little moves when a shard leaves. It depends on the
shards' names alone, never on the data, so its size is a checked setting. A row is placed by
one hash and one lookup in the broadcast table: no shuffle, whatever its key's frequency.

Defined results: a NULL key is placed like an empty one; equal keys always share a shard; an
empty table gives an empty result; a clashing result column of the input is an error
here, and the pipeline keeps it under another name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SHARDS = tuple(f"shard-{number:03d}" for number in range(64))
DEFAULT_SLOTS = 65_537
#: The table is broadcast: at most this many slots, some 16 MB.
MOST_SLOTS = 1_048_583
RESULTS = frozenset(("slot", "shard", "shard_name"))


def _is_prime(number: int) -> bool:
    return number > 1 and all(number % divisor for divisor in range(2, int(number**0.5) + 1))


def fill_slots(shards: Sequence[str], slots: int = DEFAULT_SLOTS) -> list[int]:
    """The shard number of each slot, by turns over the shards' preference orders."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not _is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    place, step = [], []
    for shard in shards:
        digest = hashlib.sha256(shard.encode()).digest()
        place.append(int.from_bytes(digest[:8], "big") % slots)
        # A prime size makes every step walk through all slots.
        step.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1)
    owner = [-1] * slots
    free = slots
    while free:
        for number in range(len(shards)):
            while owner[place[number]] >= 0:
                place[number] = (place[number] + step[number]) % slots
            owner[place[number]] = number
            free -= 1
            if not free:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = DEFAULT_SLOTS) -> DataFrame:
    """The filled table as rows ``slot int, shard int, shard_name string``."""
    owners = ",".join(map(str, fill_slots(shards, slots)))
    names = F.array(*[F.lit(name) for name in shards])
    return (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
        .select("slot", F.col("owner").cast("int").alias("shard"), F.get(names, F.col("owner").cast("int")).alias("shard_name"))
    )


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key: the first 60 bits of its MD5, modulo the table's size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(
    rows: DataFrame, key: str = "doc_id", shards: Sequence[str] = DEFAULT_SHARDS, slots: int = DEFAULT_SLOTS
) -> DataFrame:
    """``rows`` with ``slot``, ``shard`` and ``shard_name`` of their key."""
    clash = RESULTS & {name.lower() for name in rows.columns}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results of the placement")
    table = F.broadcast(lookup_table(rows.sparkSession, shards, slots))
    return rows.withColumn("slot", slot_of(F.col(f"`{key}`"), slots)).join(table, "slot").select(
        *rows.columns, "slot", "shard", "shard_name"
    )
