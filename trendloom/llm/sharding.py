"""Sharding by a lookup table that the shards fill by turns.

Each shard has its own order of preference over the slots of a prime-sized table
(an offset and a step from hashes of its name).  The shards take turns, each
claiming its next free slot, until the table is full; so each gets within one slot
of its share.  Placing a document is one hash and one look-up.  Adding or removing a
shard moves little more than that shard's part.

The table is a parameter-sized constant (``slots`` numbers), never data.

Defined results: a null id is placed by the hash of the null (one fixed slot); equal
ids lie in one shard, repeated rows with them; texts, null or very long, are not read; an
empty table stays empty; other columns stay as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 16381
SHARDS = 64


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot; ``slots`` must be a prime above the number of shards."""
    if slots <= len(shards) or slots < 3 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime number above the number of shards")

    def number(name: str, salt: str) -> int:
        return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")

    at = [number(s, "offset") % slots for s in shards]
    step = [number(s, "step") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.lit(11), key), F.lit(slots)).cast("int")


def assign(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """Adds ``slot`` and ``shard`` (columns of these names are replaced)."""
    names = [f"shard-{i:05d}" for i in range(shards)]
    # One constant of fixed size; parsed once when the plan is made.
    table = F.from_json(F.lit(str(fill_table(names, slots))), "array<int>")
    return docs.withColumn("slot", slot(F.col(key), slots)).withColumn("shard", F.element_at(table, F.col("slot") + 1))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS, max_rows: int = 1_000_000) -> None:
    """One folder per shard.  A heavy shard is written by several tasks into several files."""
    placed = assign(docs, shards, slots)
    placed.hint("rebalance", "shard").write.option("maxRecordsPerFile", max_rows).partitionBy("shard").parquet(path)
