"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table.
Shards take turns; at its turn a shard claims the first slot of its order that
is still free.  A key hashes to a slot, so placement is one look-up, shards hold
nearly equal numbers of slots, and adding a shard moves few keys.

The table has a fixed number of slots (a parameter, about 100 per shard), so it
is built once on the driver and its size does not depend on the data.  Placement
itself is one broadcast join on the slot number: no shuffle, no Python.

Defined cases: a null key is placed like the key ``"\\x00"``; repeated keys go to the
same shard; an empty input gives an empty result; other columns pass through, and
an input column with the name of an output column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS_PER_SHARD = 100
MOST_SLOTS = 1 << 24


def prime_at_least(n: int) -> int:
    def prime(k: int) -> bool:
        return k > 1 and all(k % d for d in range(2, int(k ** 0.5) + 1))
    while not prime(n):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards: list[str], slots: int) -> list[int]:
    """Index of the shard that owns each slot."""
    starts = [_number(f"start:{name}") % slots for name in shards]
    steps = [_number(f"step:{name}") % (slots - 1) + 1 for name in shards]
    turn = [0] * len(shards)
    owner = [-1] * slots
    left = slots
    while left:
        for i in range(len(shards)):
            slot = (starts[i] + turn[i] * steps[i]) % slots
            while owner[slot] >= 0:
                turn[i] += 1
                slot = (starts[i] + turn[i] * steps[i]) % slots
            owner[slot] = i
            turn[i] += 1
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int | None = None) -> DataFrame:
    """``slot, shard``: one row per slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    slots = prime_at_least(slots or SLOTS_PER_SHARD * len(shards) + 1)
    if slots > MOST_SLOTS:
        raise ValueError(f"the table is broadcast and must not exceed {MOST_SLOTS} slots")
    owners = ",".join(map(str, fill_table(shards, slots)))
    names = F.array(*[F.lit(name) for name in shards])
    return (spark.range(1)
            .select(F.posexplode(F.split(F.lit(owners), ",").cast("array<int>")).alias("slot", "_owner"))
            .select(F.col("slot").cast("bigint").alias("slot"),
                    F.element_at(names, F.col("_owner") + 1).alias("shard")))


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key: 32 bits of its MD5, modulo the number of slots."""
    text = F.coalesce(key.cast("string"), F.lit("\x00"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % F.lit(slots)


def assign(df: DataFrame, key: str, shards: list[str], slots: int | None = None) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``."""
    slots = prime_at_least(slots or SLOTS_PER_SHARD * len(shards) + 1)
    table = lookup_table(df.sparkSession, shards, slots)
    placed = df.withColumn("slot", slot_of(F.col(key), slots)).drop("shard")
    # Bounded: at most MOST_SLOTS rows, whatever the input.
    return placed.join(F.broadcast(table), "slot").select(*placed.columns, "shard")
