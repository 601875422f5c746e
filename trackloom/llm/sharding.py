"""Operator 5: placing rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. Shards take turns, each claiming
the first slot of its order that is still free, until the table is full: shares differ by at most one slot, and when
a shard comes or goes few slots change hands. A row goes to the shard that holds the slot of its key's hash.

The table has ``slots`` entries whatever the data, so it may be broadcast; placing is a projection and one broadcast
join: no shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm.names import free_name

#: A prime well above a hundred slots for each shard, and the most that may be broadcast.
SLOTS, MOST_SLOTS = 65_537, 1_000_003
SHARDS = 64


def _number(text: str) -> int:
    """The first 60 bits of the MD5 of a text."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in the list) that holds each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names, each its own")
    if not _is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"{name}/offset") % slots for name in shards]
    step = [_number(f"{name}/skip") % (slots - 1) + 1 for name in shards]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            slot = at[shard]
            while owner[slot] >= 0:
                slot = (slot + step[shard]) % slots
            owner[slot] = shard
            at[shard] = (slot + step[shard]) % slots
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 60 bits of the MD5 of its text; a null key has the slot of the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``_slot, _shard``: one row for each slot."""
    names = F.lit(shards)
    owners = F.lit(",".join(map(str, lookup_table(shards, slots))))
    return (
        spark.range(1)
        .select(F.posexplode(F.split(owners, ",")).alias("_slot", "_owner"))
        .select(F.col("_slot").cast("long"), F.element_at(names, F.col("_owner").cast("int") + 1).alias("_shard"))
    )


def place(docs: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``.

    Every row has a place, null and repeated keys too (equal keys share one). Columns of ``docs`` named ``slot`` or
    ``shard`` in any case are replaced; all others stay, however they are named.
    """
    rest = [c for c in docs.columns if c.lower() not in ("slot", "shard")]
    slot, shard = (free_name(c, docs.columns) for c in ("_slot", "_shard"))
    keyed = docs.select(*[docs[c] for c in rest], slot_of(docs[key], slots).alias("slot"))
    table = table_frame(docs.sparkSession, shards, slots).toDF(slot, shard)
    return keyed.join(F.broadcast(table), F.col("slot") == F.col(slot)).select(*rest, "slot", F.col(shard).alias("shard"))
