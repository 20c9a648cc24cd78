"""Exact best items of every user by |cosine|, without making the user x item pairs.

Exact top-k on vectors that need not cluster is a product of two matrices, so the work is users x
items whatever the plan; what can be saved is what moves. Inside a task users meet items in tiles,
and a running best k per user is all that leaves it.

An item dictionary of a checked size is broadcast, and users stay where they are. Beyond it both
sides are cut into blocks of bounded bytes: every user block meets every item block in a group of
its own, so users move once per item block and items once per user block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A worker holds the vectors of two blocks, their unit vectors, a few tiles and the results of a block of users.
TILE_ROWS = 1024  # users and items in one matrix product: 8 MB of scores
BROADCAST_BYTES = 16 * 1024 * 1024
BLOCK_BYTES = 16 * 1024 * 1024  # vectors of either side in one group
RESULT_BYTES = 64 * 1024 * 1024  # best items of the users of a group
MOST_PARTITIONS = 20_000  # a task takes its groups one after another, so memory does not grow beyond this


def vector_shape(df: DataFrame, vec: str) -> tuple[int, int]:
    """Number of vectors and their common size; vectors of different sizes are an error."""
    row = df.agg(F.count(vec).alias("n"), F.min(F.size(vec)).alias("least"), F.max(F.size(vec)).alias("most")).first()
    if row["n"] and row["least"] != row["most"]:
        raise ValueError("vectors differ in size")
    return row["n"], row["most"] or 0


def _rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Ids and vectors; a vector that is zero or has a NULL, NaN or infinite element has no cosine and leaves.

    Lengths of very small or very large elements would leave the range of numbers, so such vectors are
    divided by their largest element, which changes no angle.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))
    largest = F.array_max(F.transform("vec", F.abs))
    scaled = F.transform("vec", lambda v: v / F.col("largest"))
    extreme = (F.col("largest") < 1e-100) | (F.col("largest") > 1e100)
    rows = rows.withColumn("largest", largest).where("largest > 0")
    return rows.select("id", F.when(extreme, scaled).otherwise(F.col("vec")).alias("vec"))


def _best(k: int, digits: int, width: int, tile_rows: int) -> tuple[Callable, Callable]:
    """Unit vectors; and for each user's the best k of the items', ties included, as two positions and the score."""

    def unit(flat):
        import numpy as np

        rows = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
        out = np.empty_like(rows)
        for at in range(0, len(rows), tile_rows):
            some = rows[at : at + tile_rows]
            out[at : at + tile_rows] = some / np.sqrt((some * some).sum(axis=1, keepdims=True))
        return out

    def best(users, items):
        import numpy as np

        found = []
        for start in range(0, len(users), tile_rows):
            some = users[start : start + tile_rows]
            top = np.full((len(some), k), -1.0)  # the best k scores so far; the least of them is the edge
            kept, held = [], 0
            for at in range(0, len(items), tile_rows):
                scores = np.round(np.abs(some @ items[at : at + tile_rows].T), digits)
                if not (scores >= top.min(axis=1)[:, None]).any():
                    continue
                both = np.concatenate([top, scores], axis=1)
                top = np.partition(both, -k, axis=1)[:, -k:]
                user_at, item_at = np.nonzero(scores >= top.min(axis=1)[:, None])
                kept.append((user_at, item_at + at, scores[user_at, item_at]))
                held += len(user_at)
                if held > 8 * k * len(some):  # forget what was overtaken
                    kept = [over_edge(kept, top)]
                    held = len(kept[0][0])
            user_at, item_at, scores = over_edge(kept, top)
            found.append((user_at + start, item_at, scores))
        return over_edge(found, None)

    def over_edge(parts, top):
        import numpy as np

        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        user_at, item_at, scores = (np.concatenate(column) for column in zip(*parts))
        if top is None:
            return user_at, item_at, scores
        over = scores >= top.min(axis=1)[user_at]
        return user_at[over], item_at[over], scores[over]

    return unit, best


def _against_all(functions: tuple[Callable, Callable], held) -> Callable:
    """Task function: users against the broadcast items."""
    unit, best = functions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        ids, flat = held.value
        items = unit(flat)
        for batch in batches:
            user_at, item_at, scores = best(unit(batch.column("vec").flatten()), items)
            columns = [batch.column("id").take(pa.array(user_at)), ids.take(pa.array(item_at)), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["userId", "itemId", "score"])

    return run


def _block_against_block(functions: tuple[Callable, Callable]) -> Callable:
    """Task function: one block of users against one block of items."""
    unit, best = functions

    def run(users: pa.Table, items: pa.Table) -> pa.Table:
        import pyarrow as pa

        user_at, item_at, scores = best(*(unit(side.column("vec").combine_chunks().flatten()) for side in (users, items)))
        columns = [users.column("id").take(pa.array(user_at)), items.column("id").take(pa.array(item_at)), pa.array(scores)]
        return pa.table(columns, names=["userId", "itemId", "score"])

    return run


def _blocks(df: DataFrame, own: str, count: int, other: str, copies: int, partitions: int) -> DataFrame:
    """Rows in the block of their id, one copy for each block of the other side."""
    number = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    blocks = df.withColumn(own, number).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return blocks.repartition(partitions, "userBlock", "itemBlock")


def best_candidates(
    user_dict: DataFrame,
    item_dict: DataFrame,
    k: int,
    digits: int = 6,
    tile_rows: int = TILE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``userId, itemId, score`` holding the best k items of every user, ties included.

    Each user has at most k rows and ties for every item block, so ranking them moves few rows.
    """
    n_users, user_width = vector_shape(user_dict, "userVec")
    n_items, item_width = vector_shape(item_dict, "itemVec")
    if n_users and n_items and user_width != item_width:
        raise ValueError("vectors differ in size")
    users, items = _rows(user_dict, "userId", "userVec"), _rows(item_dict, "itemId", "itemVec")
    width = max(1, item_width)
    functions = _best(k, digits, width, tile_rows)
    schema = T.StructType(
        [
            T.StructField("userId", users.schema["id"].dataType),
            T.StructField("itemId", items.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    context = users.sparkSession.sparkContext
    tasks = context.defaultParallelism
    if n_items * width * 8 <= broadcast_bytes:
        held = items.toArrow().combine_chunks()
        ids, flat = (held.column(c).combine_chunks() for c in ("id", "vec"))
        if n_users * width * 8 <= BROADCAST_BYTES:  # so few bytes may come from fewer splits than there are tasks
            users = users.repartition(tasks)
        return users.mapInArrow(_against_all(functions, context.broadcast((ids, flat.flatten()))), schema)
    rows = max(1, block_bytes // (8 * width))
    item_blocks = math.ceil(n_items / rows)
    user_rows = max(1, min(rows, RESULT_BYTES // (24 * max(1, k))))
    user_blocks = max(1, math.ceil(n_users / user_rows), min(math.ceil(tasks / item_blocks), math.ceil(n_users / 128)))
    partitions = min(user_blocks * item_blocks, MOST_PARTITIONS)
    keys = ("userBlock", "itemBlock")
    asked = _blocks(users, keys[0], user_blocks, keys[1], item_blocks, partitions)
    offered = _blocks(items, keys[1], item_blocks, keys[0], user_blocks, partitions)
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(_block_against_block(functions), schema)
