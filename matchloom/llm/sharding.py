"""Sharding by a lookup table that the shards fill in turns.

Every shard has an order of preference over the slots of a table of prime size, a permutation given
by an offset and a step. In turns each claims the first free slot of its order, until none is free. A
row's key is hashed to a slot, and the slot's claim is its shard: shares differ by at most one
slot, and when a shard leaves nearly all slots of the others stay.
"""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import free_names

TABLE = 65_537
SHARDS = 256


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE) -> list[int]:
    """Number of the shard that owns each slot. Names decide, not their order alone; at least one, and all different."""
    if not is_prime(size) or not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("a prime size and at most as many different shards are needed")
    at = [xxhash.xxh64_intdigest(s.encode(), 1) % size for s in shards]
    step = [xxhash.xxh64_intdigest(s.encode(), 2) % (size - 1) + 1 for s in shards]
    table, free = [-1] * size, size
    while True:
        for shard, jump in enumerate(step):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + jump) % size
            table[slot], at[shard] = shard, (slot + jump) % size
            free -= 1
            if not free:
                return table


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def place(rows: DataFrame, keys: Sequence[str], shards: Sequence[str], size: int = TABLE) -> DataFrame:
    """The rows with ``slot`` and ``shard`` (its number); columns of those names get an underscore in front.

    One hash per row and one lookup in the table, whose size is a parameter and which is broadcast; no
    row is shuffled. Equal keys get equal shards, nulls included; to spread a hot key, give more columns.
    """
    spark = rows.sparkSession
    for name in rows.columns:
        if name.lower() in ("slot", "shard"):
            rows = rows.withColumnRenamed(name, free_names([*rows.columns, "slot", "shard"], name)[0])
    table = spark.createDataFrame(list(enumerate(fill_table(shards, size))), "slot bigint, shard int")
    slotted = rows.withColumn("slot", F.pmod(F.xxhash64(*keys), F.lit(size).cast("bigint")))
    joined = slotted.join(F.broadcast(table), "slot")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], "slot", "shard")


def write_shards(placed: DataFrame, path: str, files: int = 1) -> None:
    """One folder per shard, with up to ``files`` files each; rows of a large shard are spread over its files."""
    salt = free_names(placed.columns, "salt")[0]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns], F.monotonically_increasing_id()), F.lit(files))
    dealt = placed.withColumn(salt, spread if files > 1 else F.lit(0)).repartition("shard", salt).drop(salt)
    dealt.write.partitionBy("shard").parquet(path)
