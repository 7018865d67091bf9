"""Placement of rows on shards through a permutation-filled lookup table.

Each shard prefers the slots of a table of prime size in an order of its own:
offset, offset + skip, offset + 2 skip, ... modulo the prime. The shards take
turns, each claiming its next preferred slot that is still free, until the
table is full. So every shard owns almost the same number of slots, and when a
shard goes, few slots of the others move. A row's key is hashed to a slot.

The table has `slots` rows whatever the input, so it is broadcast; placement
is one lookup a row, with no shuffle. Writing the shards shuffles each row
once. As placement goes by the key, a source that holds a third of all rows is
spread evenly.

Defined results: null keys hash as the text "\\N"; rows with equal keys share a
shard; an empty table stays empty; an input column with the name of an added
one gives way to it; other columns are untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65537
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str, below: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big") % below


def preference(name: str, slots: int) -> tuple[int, int]:
    """A shard's first slot and its step."""
    return _number(name, "offset", slots), 1 + _number(name, "skip", slots - 1)


def fill(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> np.ndarray:
    """slot -> index of its shard. A shard of weight w claims w slots a turn."""
    if not is_prime(slots):
        raise ValueError("the number of slots must be prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 0 or not any(weights):
        raise ValueError("weights must be one a shard, not negative, not all zero")
    owner = np.full(slots, -1, dtype=np.int32)
    at, skip = map(list, zip(*(preference(s, slots) for s in shards), strict=True))
    free = slots
    while True:
        for k, turns in enumerate(weights):
            for _ in range(turns):
                p = at[k]
                while owner[p] >= 0:
                    p = (p + skip[k]) % slots
                owner[p] = k
                at[k] = (p + skip[k]) % slots
                free -= 1
                if not free:
                    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The first 60 bits of the key's MD5, modulo the number of slots."""
    text = F.coalesce(key.cast("string"), F.lit("\\N"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % F.lit(slots)).cast("int")


def place(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS, weights: Sequence[int] | None = None, slot_column: str = "slot", shard_column: str = "shard") -> DataFrame:
    """Adds each row's slot and shard."""
    owner = fill(shards, slots, weights)
    rows = [(slot, shards[k]) for slot, k in enumerate(owner.tolist())]
    lookup = docs.sparkSession.createDataFrame(rows, "slot int, shard string")  # one row a slot
    kept = [c for c in docs.columns if c.lower() not in (slot_column.lower(), shard_column.lower())]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), slot_of(F.col(f"`{key}`"), slots).alias("slot"))
    return keyed.join(F.broadcast(lookup), "slot", "left").select("doc.*", F.col("slot").alias(slot_column), F.col("shard").alias(shard_column))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """Parquet folders shard=..., each row shuffled once; a shard is written by several tasks, split by slot."""
    placed = place(docs, key, shards, slots)
    placed.repartition("shard", F.col("slot") % 8).write.mode("overwrite").partitionBy("shard").parquet(path)
