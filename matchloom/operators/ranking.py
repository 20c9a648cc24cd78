"""Scoring users against items and ranking within users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.functions import vectors
from matchloom.operators.nearest import BLOCK_BYTES, BROADCAST_BYTES, TILE_ROWS, best_candidates


def rank_in_user(df: DataFrame, k: int, user: str = "userId", score: str = "score") -> DataFrame:
    """Rows ranked 1..k by score within their user. Ties share a rank, so more than k may stay.

    NULL scores come last. Spark drops rows beyond rank k before the shuffle, so a hot user
    sends few rows.
    """
    best_first = W.partitionBy(user).orderBy(F.desc_nulls_last(score))
    return df.withColumn("rank", F.rank().over(best_first)).where(F.col("rank") <= k)


def with_rank(df: DataFrame, k: int) -> DataFrame:
    """Rows up to rank k, ranking first where there is no ``rank`` column."""
    return df.where(F.col("rank") <= k) if "rank" in df.columns else rank_in_user(df, k)


def best_label_row(df: DataFrame, user: str = "userId") -> DataFrame:
    """One row per user: greatest label, then lowest rank, then lowest item. NULL labels last."""
    order = W.partitionBy(user).orderBy(F.desc_nulls_last("label"), F.asc("rank"), F.asc("itemId"))
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") == 1).drop("_rn")


def score_pairs(df: DataFrame, out: str = "score") -> DataFrame:
    return df.withColumn(out, vectors.abs_cosine(F.col("userVec"), F.col("itemVec")))


def label_ranked(ranked: DataFrame, indexed: DataFrame) -> DataFrame:
    """Labels of ranked pairs; NULL where user and item never met."""
    return ranked.join(indexed, ["userId", "itemId"], "left")


def best_items(
    user_dict: DataFrame,
    item_dict: DataFrame,
    k: int,
    digits: int = 6,
    tile_rows: int = TILE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Items up to rank k for every user by |cosine|, exact and with ties.

    Scores are rounded to ``digits`` before ranking, so equal vectors tie. A zero vector has
    no cosine, and its pairs no rank. See :mod:`matchloom.operators.nearest`.
    """
    found = best_candidates(user_dict, item_dict, k, digits, tile_rows, broadcast_bytes, block_bytes)
    return rank_in_user(found, k)


def cross_top_k(
    user_dict: DataFrame,
    item_dict: DataFrame,
    indexed: DataFrame,
    k: int = 50,
    digits: int = 6,
) -> DataFrame:
    """Ranked items of every user with the labels of the observed pairs."""
    return label_ranked(best_items(user_dict, item_dict, k, digits), indexed)
