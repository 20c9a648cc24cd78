"""Metrics of rankings: rank distribution, hit ratio, NDCG."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.ranking import best_label_row, rank_in_user, with_rank

# Depths of the hit ratio and NDCG sweep.
SWEEP_DEPTHS = [3, 5, 10, 15, 20, 30]


def mean_positive_rank(df: DataFrame, k: int = 30) -> DataFrame:
    """Mean rank of the positives of every user; ``k + 1`` for users without one up to rank k.

    One aggregate per user serves both groups: the mean over no positives is NULL.
    """
    positive_rank = F.when(F.col("label") == 1.0, F.col("rank"))
    return (
        with_rank(df, k)
        .groupBy("userId")
        .agg(F.coalesce(F.avg(positive_rank), F.lit(float(k + 1))).alias("meanRank"))
    )


def rank_distribution(df: DataFrame, k: int = 30) -> DataFrame:
    """Users per truncated mean rank, ordered."""
    rounded = mean_positive_rank(df, k).select(F.col("meanRank").cast("int").alias("roundRank"))
    return rounded.groupBy("roundRank").count().orderBy("roundRank")


def users_without_hit(df: DataFrame, k: int = 30) -> DataFrame:
    """Users with no positive up to rank k."""
    return any_hit(df, k).where("hit = 0").select("userId")


def any_hit(df: DataFrame, k: int = 30) -> DataFrame:
    """Every user with ``hit``: 1 with a positive up to rank k, else 0."""
    hit = F.max(F.when(F.col("label") == 1.0, 1).otherwise(0))
    return with_rank(df, k).groupBy("userId").agg(hit.alias("hit"))


def user_hits(df: DataFrame, k: int = 30) -> DataFrame:
    """``hit`` and ``ndcg`` of every user from its best-labelled row up to rank k."""
    label, rank = F.col("label"), F.col("rank")
    gain = F.when(label == 1, F.lit(math.log(2)) / F.log(rank + 1)).otherwise(F.lit(0.0))
    best = best_label_row(rank_in_user(df.drop("rank"), k))
    return best.select("userId", F.when(label != 0, 1).otherwise(0).alias("hit"), gain.alias("ndcg"))


def hit_ratio_ndcg(df: DataFrame, k: int = 30) -> DataFrame:
    """One row: mean hit and mean NDCG over the users."""
    return user_hits(df, k).agg(F.avg("hit").alias("hitRatio"), F.avg("ndcg").alias("ndcg"))


def hit_ratio_ndcg_sweep(df: DataFrame, depths: list[int] | None = None) -> DataFrame:
    """Hit ratio and NDCG at several depths from one ranking, for labels 0, 1 and NULL.

    The best row of a user at depth k is its first positive when that ranks within k.
    """
    depths = depths or SWEEP_DEPTHS
    ranked = rank_in_user(df.drop("rank"), max(depths))
    first = ranked.groupBy("userId").agg(F.min(F.when(F.col("label") == 1.0, F.col("rank"))).alias("first"))
    at = first.withColumn("k", F.explode(F.array(*[F.lit(d) for d in depths])))
    hit = F.col("first") <= F.col("k")
    gain = F.when(hit, F.lit(math.log(2)) / F.log(F.col("first") + 1)).otherwise(F.lit(0.0))
    return (
        at.groupBy("k")
        .agg(F.avg(F.when(hit, 1).otherwise(0)).alias("hitRatio"), F.avg(gain).alias("ndcg"))
        .orderBy("k")
    )
