"""Numeric ids and train/test splits."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.operators.support import cut_lineage, hash_fraction, lookup_join

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within the partition below


POSITION = "_position"


def with_position(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows in order, stored, with their place from 0 on in ``_position``.

    Rows are sorted by range over all tasks, and each partition starts where the partitions before it end. Only
    one number per partition is ever gathered. Sort narrow rows and attach the rest by key afterwards.
    """
    ordered = cut_lineage(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftright("_pos", ROW_BITS)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_pos").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_start") + row).alias(POSITION))


def string_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """``column -> out``: 0.0 for the most frequent value, ties in alphabetical order.

    Counts combine before the shuffle; no label list is gathered.
    """
    counts = df.groupBy(F.col(column)).count().where(F.col(column).isNotNull())
    numbered = with_position(counts, F.desc("count"), F.col(column).cast("string"))
    return numbered.select(column, F.col(POSITION).cast("double").alias(out))


def index_pairs(
    df: DataFrame,
    user: str = "userId",
    item: str = "itemId",
    user_out: str = "userIdIndex",
    item_out: str = "itemIdIndex",
) -> DataFrame:
    """Add both indexes; frequencies count all rows."""
    return with_index(with_index(df, df, user, user_out), df, item, item_out)


def with_index(df: DataFrame, counted: DataFrame, column: str, out: str) -> DataFrame:
    """Add the index of a column by its frequency in ``counted``, which holds the rows of ``df``. Rows of a hot value are spread."""
    return lookup_join(df, string_index(counted, column, out), column, counted=counted)


def index_interactions(df: DataFrame) -> DataFrame:
    """Distinct ids, indexes and labels of interactions; these are stored, as both indexes and both joins read them."""
    rows = cut_lineage(df.select("userId", "itemId", "label"))
    indexed = with_index(rows.distinct(), rows, "userId", "userIdIndex")
    indexed = with_index(indexed, rows, "itemId", "itemIdIndex")
    return indexed.select("userId", "itemId", "userIdIndex", "itemIdIndex", "label")


def random_split(df: DataFrame, weights: list[float] | None = None, seed: int = 1) -> list[DataFrame]:
    return df.randomSplit(weights or [0.8, 0.2], seed)


def split_number(keys: list[str | Column], weights: list[float], seed: int = 1) -> Column:
    """Number of the part a row falls in, by digest of its keys."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    point = hash_fraction(F.lit(str(seed)), *columns)
    total = sum(weights)
    out = F.lit(len(weights) - 1)
    for number, edge in reversed(list(enumerate(accumulate(weights[:-1])))):
        out = F.when(point < F.lit(edge / total), F.lit(number)).otherwise(out)
    return out


def hash_split(
    df: DataFrame, keys: list[str | Column], weights: list[float] | None = None, seed: int = 1
) -> list[DataFrame]:
    """Split by digest of the keys: a recomputed row always falls in the same part."""
    weights = weights or [0.8, 0.2]
    number = split_number(keys, weights, seed)
    return [df.where(number == i) for i in range(len(weights))]
