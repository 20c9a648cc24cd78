"""Exact best items of every user by inner product, without scoring every pair.

Items are sorted by length and cut into blocks; no item of a block can score more than the length of the user times
that of the block's longest item. A task takes its users through the blocks from the longest items on, and a user
leaves once its k-th best score lies above the bound of the next block. Items go out in parts of bounded bytes, each
of which only the users still searching meet.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators.indexing import POSITION, with_position
from matchloom.operators.support import cut_lineage

BLOCK_ITEMS = 512
PART_BYTES = 64 * 1024 * 1024  # item vectors that each worker holds
SLACK = 1e-9  # of a bound, for what rounding may add to a score


def _search(k: int, width: int, block: int, handle, bound_after: float) -> Callable:
    """Task function: users, with the best items they have met, through the blocks of the part."""
    names, slack = ["userId", "vec", "items", "scores", "searching", "met"], SLACK

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids, vectors, lengths = handle.value
        starts = range(0, len(ids), block)
        for batch in batches:
            n = batch.num_rows
            users = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            own = np.sqrt((users * users).sum(axis=1))
            held = batch.column("items")
            sizes = held.value_lengths().to_numpy(zero_copy_only=False)
            best, score = np.zeros((n, k), np.int64), np.full((n, k), -np.inf)
            place = np.arange(k) < sizes[:, None]
            best[place] = held.flatten().to_numpy(zero_copy_only=False)
            score[place] = batch.column("scores").flatten().to_numpy(zero_copy_only=False)
            met = batch.column("met").to_numpy(zero_copy_only=False).copy()
            active = np.arange(n)
            for start in starts:
                limit = own[active] * lengths[start]
                going = score[active, -1] <= limit + slack * (1 + np.abs(limit))  # an equal score may win by its id
                active = active[going]
                if not len(active):
                    break
                met[active] += 1
                some = slice(start, start + block)
                found = users[active] @ vectors[some].T
                both = np.concatenate([score[active], found], axis=1)
                names_of = np.concatenate([best[active], np.broadcast_to(ids[some], found.shape)], axis=1)
                order = np.lexsort((names_of, -both), axis=1)[:, :k]
                score[active] = np.take_along_axis(both, order, axis=1)
                best[active] = np.take_along_axis(names_of, order, axis=1)
            searching = np.zeros(n, bool)
            if bound_after >= 0:
                left = own[active] * bound_after
                searching[active] = score[active, -1] <= left + slack * (1 + np.abs(left))
            real = np.isfinite(score)
            offsets = pa.array(np.concatenate([[0], np.cumsum(real.sum(axis=1))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[real], t)) for x, t in ((best, pa.int64()), (score, pa.float64()))]
            columns = [batch.column("userId"), batch.column("vec"), *lists, pa.array(searching), pa.array(met)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def best_products(
    users: DataFrame, items: DataFrame, k: int, block_items: int = BLOCK_ITEMS, part_bytes: int = PART_BYTES
) -> tuple[DataFrame, DataFrame]:
    """``userId, itemId, score, rank`` of the k items with the greatest inner product, ties by the smaller item; and the work done.

    ``users`` has ``userId`` and ``userVec``, ``items`` whole numbers ``itemId`` and ``itemVec``, one row each. A vector that is
    NULL or has a NULL, NaN or infinite element is left out. The second table has one row: ``users``, and user by
    user the blocks ``met`` and those that bounds ruled out (``skipped``). Parts are read while users search.
    """

    def clean(df: DataFrame, name: str, vec: str) -> DataFrame:
        rows = df.select(name, F.col(vec).cast("array<double>").alias("vec"))
        return rows.where(F.col("vec").isNotNull() & F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))))

    spark = users.sparkSession
    given = clean(users, "userId", "userVec")
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x))
    ordered = clean(items, "itemId", "itemVec").withColumn("itemId", F.col("itemId").cast("bigint")).withColumn("length", length)
    ordered = with_position(ordered, F.desc("length"), "itemId")
    shape = ordered.agg(F.max(F.size("vec")).alias("width"), F.min(F.size("vec")).alias("least")).first()
    width = shape["width"] or 0
    if shape["least"] is not None and shape["least"] != width:
        raise ValueError("vectors differ in size")
    per_part = max(block_items, part_bytes // (8 * max(1, width) + 16))
    number = F.floor(F.col(POSITION) / per_part).cast("int")
    parts = ordered.groupBy(number.alias("part")).agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n"))
    parts = parts.orderBy("part").collect()  # one row for each part of many items
    state = T.StructType(
        [
            given.schema["userId"],
            T.StructField("vec", T.ArrayType(T.DoubleType())),
            T.StructField("items", T.ArrayType(T.LongType())),
            T.StructField("scores", T.ArrayType(T.DoubleType())),
            T.StructField("searching", T.BooleanType()),
            T.StructField("met", T.LongType()),
        ]
    )
    nothing = F.array()
    searching = given.select(
        "userId", "vec", nothing.cast("array<bigint>").alias("items"), nothing.cast("array<double>").alias("scores"),
        F.lit(True).alias("searching"), F.lit(0).cast("bigint").alias("met"),
    )
    searching = searching.repartition(spark.sparkContext.defaultParallelism)
    finished: list[DataFrame] = []
    for part, following in zip(parts, [*parts[1:], None]):
        held = ordered.where(number == part["part"]).select("itemId", "vec", "length").toArrow().combine_chunks()
        flat = held.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        ids, lengths = (held.column(c).to_numpy() for c in ("itemId", "length"))
        order = np.lexsort((ids, -lengths))
        handle = spark.sparkContext.broadcast((ids[order], flat[order], lengths[order]))
        after = -math.inf if following is None else following["longest"]
        done = cut_lineage(searching.mapInArrow(_search(k, width, block_items, handle, after), state))
        finished.append(done.where("not searching"))
        searching = done.where("searching")
        if searching.isEmpty():
            break
    whole = searching
    for done in finished:
        whole = whole.unionByName(done)
    blocks = sum(math.ceil(p["n"] / block_items) for p in parts)
    work = whole.agg(F.count(F.lit(1)).alias("users"), F.coalesce(F.sum("met"), F.lit(0)).alias("met")).withColumn(
        "skipped", F.col("users") * F.lit(blocks) - F.col("met")
    )
    rows = whole.select("userId", F.posexplode(F.arrays_zip("items", "scores")).alias("at", "best"))
    rows = rows.select("userId", F.col("best.items").alias("itemId"), F.col("best.scores").alias("score"), (F.col("at") + 1).alias("rank"))
    return rows, work
