"""Feature rows for Spark ML."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import vectors


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def random_order(df: DataFrame, seed: int | None = None) -> DataFrame:
    return df.orderBy(F.rand(seed))


def with_pair_features(df: DataFrame) -> DataFrame:
    """``features``: user vector followed by item vector, as an array of doubles."""
    require_columns(df, "userVec", "itemVec")
    return df.withColumn("features", vectors.concat_features(F.col("userVec"), F.col("itemVec")))


def _labelled(df: DataFrame, features: Column, *keep: str) -> DataFrame:
    return df.select(*keep, array_to_vector(features).alias("features"), F.col("label").cast("double").alias("label"))


def id_points(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Label and the vector (userId, itemId), in random order. Negative ids fail the job."""
    require_columns(df, "userId", "itemId", "label")
    ids = [F.col(c).cast("double") for c in ("userId", "itemId")]
    check = F.assert_true(F.least(*ids) >= 0, F.lit("ids must not be negative"))
    return random_order(_labelled(df, F.when(check.isNull(), F.array(*ids))), seed)


def vector_points(df: DataFrame, seed: int | None = None) -> DataFrame:
    """Label and the vector of both vectors, in random order."""
    require_columns(df, "userVec", "itemVec", "label")
    return random_order(_labelled(df, vectors.concat_features(F.col("userVec"), F.col("itemVec"))), seed)


def pair_rows(df: DataFrame) -> DataFrame:
    """userId, itemId, features as an ML vector and label; nothing is reordered."""
    require_columns(df, "userId", "itemId", "label")
    if "features" not in df.columns:
        df = with_pair_features(df)
    return _labelled(df, F.col("features"), "userId", "itemId")
