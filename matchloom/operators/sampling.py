"""Negative samples.

Draws are digests of the row and draw number, so they are independent between users and
items, cover every index from 0 to the greatest, and repeat exactly when a task is rerun.
Observed pairs leave by anti join on both ids, which spreads the pairs of a hot user.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions import vectors
from matchloom.operators.indexing import POSITION, with_position
from matchloom.operators.support import BROADCAST_BYTES, hash_number, lookup_join, measured_bytes, stored

PAIR = ["userId", "itemId"]


def _extent(indexed: DataFrame) -> tuple[int, int, int]:
    """Number of rows, greatest user and greatest item, by one aggregate; ids of no rows end at 0."""
    greatest = [F.coalesce(F.max(c).cast("bigint"), F.lit(0)) for c in PAIR]
    return tuple(indexed.agg(F.count(F.lit(1)), *greatest).first())


def _as_negatives(drawn: DataFrame, indexed: DataFrame, types: dict[str, str]) -> DataFrame:
    drawn = drawn.select(*[F.col(c).cast(types[c]).alias(c) for c in PAIR])
    # both sides are distinct before the shuffle, and that shuffle serves the join as well
    unseen = drawn.distinct().join(indexed.select(*PAIR).distinct(), PAIR, "left_anti")
    return unseen.withColumn("label", F.lit(0.0))


def negatives_per_positive(
    indexed: DataFrame, k: int, seed: int = 0, kept: Callable[[DataFrame, str], DataFrame] = lambda pairs, key: pairs
) -> DataFrame:
    """For every interaction its user with ``k`` drawn items; unseen pairs, once each.

    ``kept`` leaves pairs out by an id, before any are moved. The input is read three times (extent, draws, observed
    pairs): store a costly one before.
    """
    _, _, top = _extent(indexed)
    seen = [F.col(c).cast("bigint") for c in PAIR]
    draw = hash_number(F.lit(f"per{seed}"), *seen, F.col("draw"))
    of_users = kept(indexed.select(*PAIR), "userId")
    draws = of_users.select(*PAIR, F.explode(F.sequence(F.lit(1), F.lit(k))).alias("draw"))
    drawn = kept(draws.select("userId", F.pmod(draw, top + 1).alias("itemId")), "itemId")
    return _as_negatives(drawn, kept(of_users, "itemId"), dict(indexed.dtypes))


def negatives_free(indexed: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k * rows + 1`` drawn user-item pairs; unseen pairs, once each. The input is read twice."""
    rows, users, items = _extent(indexed)
    draws = indexed.sparkSession.range(0, k * rows + 1 if rows else 0)
    drawn = draws.select(
        F.pmod(hash_number(F.lit(f"user{seed}"), F.col("id")), users + 1).alias("userId"),
        F.pmod(hash_number(F.lit(f"item{seed}"), F.col("id")), items + 1).alias("itemId"),
    )
    return _as_negatives(drawn, indexed, dict(indexed.dtypes))


def append_negatives(indexed: DataFrame, seed: int = 42) -> DataFrame:
    """Interactions and as many drawn negatives."""
    positives = indexed.select(*PAIR, F.col("label").cast("double").alias("label"))
    return positives.unionByName(negatives_free(indexed, 1, seed))


def attach_vectors(pairs: DataFrame, user_dict: DataFrame, item_dict: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add both vectors. Pairs of a hot id are spread when the dictionary is not small."""
    return lookup_join(lookup_join(pairs, user_dict, "userId", limit=limit), item_dict, "itemId", limit=limit)


def with_vectors_only(user_dict: DataFrame, item_dict: DataFrame, limit: int = BROADCAST_BYTES) -> Callable[[DataFrame, str], DataFrame]:
    """Leaves the pairs out whose user, or item, has no vector, where the ids of that dictionary are few enough to look up in place."""
    ids = {c: d.select(c).distinct() for c, d in zip(PAIR, (user_dict, item_dict))}
    small = {c for c, d in ids.items() if measured_bytes(d) <= limit}
    return lambda pairs, key: pairs.join(F.broadcast(ids[key]), key, "left_semi") if key in small else pairs


def scored_with_negatives(
    indexed: DataFrame, item_dict: DataFrame, user_dict: DataFrame, k: int = 50, seed: int = 0, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Interactions and negatives with vectors and |cosine|, in no order.

    The interactions are stored, as they are read four times. Pairs that no vector can be attached to leave before they move.
    """
    positives = stored(indexed.select(*PAIR, F.col("label").cast("double").alias("label")), "interactions")
    kept = with_vectors_only(user_dict, item_dict, limit)
    pairs = kept(kept(positives, "userId"), "itemId").unionByName(negatives_per_positive(positives, k, seed, kept))
    # lengths of vectors are computed per id, before the vectors are copied to the pairs
    users = user_dict.select("userId", "userVec", vectors.magnitude(F.col("userVec")).alias("_userLength"))
    items = item_dict.select("itemId", "itemVec", vectors.magnitude(F.col("itemVec")).alias("_itemLength"))
    dot = vectors.dot_product(F.col("userVec"), F.col("itemVec"))
    cosine = F.try_divide(dot, F.col("_userLength") * F.col("_itemLength"))
    return attach_vectors(pairs, users, items, limit).select(
        *PAIR, "label", "userVec", "itemVec", F.abs(cosine).alias("cosineSimilarity")
    )


def negative_join(
    indexed: DataFrame,
    item_dict: DataFrame,
    user_dict: DataFrame,
    k: int = 50,
    seed: int = 0,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Interactions and negatives with vectors and |cosine|, greatest first, ties by user and item.

    Ids and scores are sorted without vectors. Vectors join the sorted rows where they lie while the dictionaries
    are small; beyond the limit rows find their range again by their place.
    """
    scored = scored_with_negatives(indexed, item_dict, user_dict, k, seed, limit).select(*PAIR, "label", "cosineSimilarity")
    order = [F.desc_nulls_last("cosineSimilarity"), *PAIR, "label"]
    placed = with_position(scored, *order)
    wide = attach_vectors(placed, user_dict, item_dict, limit)
    if max(measured_bytes(user_dict), measured_bytes(item_dict)) > limit:
        wide = wide.repartitionByRange(POSITION).sortWithinPartitions(POSITION)
    return wide.select(*PAIR, "label", "userVec", "itemVec", "cosineSimilarity")
