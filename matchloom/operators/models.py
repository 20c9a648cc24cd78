"""Recommenders, clusters and pair classifiers as Spark ML jobs."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

import numpy as np
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import vectors
from matchloom.operators.factor_cells import fit_on_factors
from matchloom.operators.inner_products import best_products
from matchloom.operators.support import lookup_join, use_checkpoint_dir
from matchloom.params import AlsParams, ClassifierParams, KMeansParams
from matchloom.sources.models import fit_or_load

PAIR_VECTOR = "_pairVector"
CLUSTER_VECTOR = "_clusterVector"
ROWS_PER_PART = 100_000  # users in a task of a clustering


# --- ALS ---------------------------------------------------------------------------------


def fit_als(train: DataFrame, params: AlsParams = AlsParams(), user: str = "userId", item: str = "itemId") -> ALSModel:
    """Implicit-feedback factors; pairs with an id unseen in training get no prediction."""
    use_checkpoint_dir(train.sparkSession)
    als = ALS(
        rank=params.rank,
        maxIter=params.max_iter,
        regParam=params.reg,
        implicitPrefs=params.implicit,
        userCol=user,
        itemCol=item,
        ratingCol="label",
        coldStartStrategy="drop",
        seed=params.seed,
    )
    return als.fit(train.select(user, item, F.col("label").cast("float").alias("label")))


def als_scores(model: ALSModel, pairs: DataFrame) -> DataFrame:
    return model.transform(pairs).withColumn("prediction", F.col("prediction").cast("double"))


def als_top_items(model: ALSModel, k: int) -> DataFrame:
    """The k best items of every user by factors, ties by the smaller item; blocks of items that cannot matter are not scored."""
    return als_top_items_and_work(model, k)[0]


def als_top_items_and_work(model: ALSModel, k: int) -> tuple[DataFrame, DataFrame]:
    """As :func:`als_top_items`, and one row with the blocks of items that users met and those that were ruled out."""
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("userVec"))
    items = model.itemFactors.select(F.col("id").alias("itemId"), F.col("features").alias("itemVec"))
    return best_products(users, items, k)


# --- clusters ----------------------------------------------------------------------------


def assign_clusters(model: KMeansModel, df: DataFrame, vec: str = "userVec") -> DataFrame:
    """Add the cluster number ``kth``."""
    with_vector = df.withColumn(CLUSTER_VECTOR, vectors.array_to_ml_vector(F.col(vec)))
    return model.transform(with_vector).drop(CLUSTER_VECTOR)


def fit_kmeans(df: DataFrame, params: KMeansParams) -> KMeansModel:
    if params.feature_col not in df.columns:
        raise ValueError(f"the users have no column {params.feature_col} to cluster by")
    kmeans = KMeans(
        k=params.k,
        seed=params.seed,
        initMode="k-means||",
        maxIter=params.max_iter,
        featuresCol=CLUSTER_VECTOR,
        predictionCol="kth",
    )
    rows = df.select(*[c for c in df.columns if c != "kth"])
    parts = max(1, math.ceil(rows.count() / ROWS_PER_PART))  # by the data alone, so that the start does not hang on the cluster
    digest = F.xxhash64(F.col("userId")) if "userId" in rows.columns else F.xxhash64(params.feature_col)
    dealt = rows.withColumn("_place", digest).repartition(parts, "_place").sortWithinPartitions("_place")
    return kmeans.fit(dealt.select(vectors.array_to_ml_vector(F.col(params.feature_col)).alias(CLUSTER_VECTOR)))


def cluster_users(users: DataFrame, params: KMeansParams) -> tuple[DataFrame, KMeansModel]:
    """Users with their cluster. Fits and saves, or loads, when a model path is given; loading needs one."""
    if not params.train and not params.model_path:
        raise ValueError("a model can only be loaded from a path")
    if params.model_path:
        model = fit_or_load(params.train, lambda: fit_kmeans(users, params), KMeansModel, params.model_path)
    else:
        model = fit_kmeans(users, params)
    return assign_clusters(model, users, params.feature_col), model


def silhouette(df: DataFrame, vec: str = "userVec", cluster: str = "kth") -> float:
    """Silhouette with squared Euclidean distance."""
    rows = df.select(
        vectors.array_to_ml_vector(F.col(vec)).alias(CLUSTER_VECTOR), F.col(cluster).cast("int").alias("kth")
    )
    return ClusteringEvaluator(featuresCol=CLUSTER_VECTOR, predictionCol="kth").evaluate(rows)


def in_cluster(interactions: DataFrame, users: DataFrame, kth: int) -> DataFrame:
    """Interactions of the users of a cluster."""
    members = users.where(F.col("kth") == kth).select("userId")
    return lookup_join(interactions, members, "userId", how="left_semi").select(*interactions.columns)


# --- pair classifiers --------------------------------------------------------------------


def _pair_vector(df: DataFrame) -> DataFrame:
    features = vectors.concat_features(F.col("userVec"), F.col("itemVec"))
    return df.withColumn(PAIR_VECTOR, vectors.array_to_ml_vector(features))


def pair_classifier(input_width: int, params: ClassifierParams) -> MultilayerPerceptronClassifier:
    """Unfitted perceptron with the hidden layers of the parameters and two classes."""
    return MultilayerPerceptronClassifier(
        layers=[input_width, *params.hidden_layers, 2],
        maxIter=params.epochs,
        blockSize=params.batch_size,
        stepSize=params.learning_rate,
        solver=params.solver,
        seed=params.seed,
        featuresCol=PAIR_VECTOR,
        labelCol="label",
        predictionCol="prediction",
    )


def fit_pair_classifier(
    train: DataFrame, dim: int, params: ClassifierParams = ClassifierParams()
) -> MultilayerPerceptronClassificationModel:
    """Perceptron over user vector followed by item vector; labels are 0 and 1."""
    rows = _pair_vector(train).select(PAIR_VECTOR, F.col("label").cast("double").alias("label"))

    def fit() -> Any:
        return pair_classifier(2 * dim, params).fit(rows)

    if not params.model_path:
        return fit()
    return fit_or_load(params.train, fit, MultilayerPerceptronClassificationModel, params.model_path)


def predict_pairs(model: MultilayerPerceptronClassificationModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``; all other columns are carried through."""
    return model.transform(_pair_vector(df)).drop(PAIR_VECTOR, "rawPrediction", "probability")


def train_per_cluster(
    k: int,
    data_of: Callable[[int], DataFrame],
    fit: Callable[[int, DataFrame], Any],
) -> dict[int, Any]:
    """One model per cluster that has data. ``k`` is small; each fit is a distributed job."""
    models = {}
    for kth in range(k):
        data = data_of(kth)
        if not data.isEmpty():
            models[kth] = fit(kth, data)
    return models


def predict_per_cluster(models: Mapping[int, Any], clustered: DataFrame) -> DataFrame:
    """Predictions of every row by the model of its cluster; NULL where there is no model."""
    parts = [predict_pairs(model, clustered.where(F.col("kth") == kth)) for kth, model in sorted(models.items())]
    rest = clustered.where(~F.col("kth").isin(*models)) if models else clustered
    parts.append(rest.withColumn("prediction", F.lit(None).cast("double")))
    return reduce(DataFrame.unionByName, parts)


# --- classifiers on ids ------------------------------------------------------------------


def factor_vectors(model: ALSModel, pairs: DataFrame, multiply: bool = True, unknown: bool = False) -> DataFrame:
    """ALS factors as embeddings: ``userVec``, and ``itemVec`` with the products of both behind it.

    Factors stay distributed tables. Without ``multiply`` only the two embeddings are given. Pairs with an
    id without factors are left out, or with ``unknown`` get zeros for it.
    """
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("userVec"))
    items = model.itemFactors.select(F.col("id").alias("itemId"), F.col("features").alias("itemVec"))
    how = "left" if unknown else "inner"
    joined = lookup_join(pairs, users, "userId", how=how)
    joined = lookup_join(joined, items, "itemId", how=how)
    if unknown:
        zeros = F.array_repeat(F.lit(0.0).cast("float"), model.rank)
        joined = joined.withColumns({c: F.coalesce(F.col(c), zeros) for c in ("userVec", "itemVec")})
    if not multiply:
        return joined
    product = F.zip_with("userVec", "itemVec", lambda u, i: u * i)
    return joined.withColumn("itemVec", F.concat("itemVec", product))


def fit_factor_classifier(
    train: DataFrame, als: AlsParams, params: ClassifierParams, multiply: bool = True, unknown: bool = False
) -> tuple[ALSModel, MultilayerPerceptronClassificationModel]:
    """Embeddings from ALS on the positives, then a perceptron over them, trained where each factor is stored once for many pairs.

    ``train`` should be stored, as it is read several times.
    """
    embeddings = fit_als(train.where(F.col("label") > 0), als)
    sides = [side.select("id", F.col("features").alias("vec")) for side in (embeddings.userFactors, embeddings.itemFactors)]
    layers, weights = fit_on_factors(train.select("userId", "itemId", "label"), *sides, als.rank, params, multiply, unknown)
    return embeddings, _perceptron(train.sparkSession, layers, weights)


def _perceptron(spark: SparkSession, layers: tuple[int, ...], weights: np.ndarray) -> MultilayerPerceptronClassificationModel:
    """Spark's model of these weights, which lie as it keeps them."""
    context = spark.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel
    model = MultilayerPerceptronClassificationModel(made(f"mlp_{uuid.uuid4().hex}", _py2java(context, Vectors.dense(weights))))
    model._set(layers=list(layers), featuresCol=PAIR_VECTOR, predictionCol="prediction")
    return model


def predict_factor_classifier(
    models: tuple[ALSModel, MultilayerPerceptronClassificationModel],
    pairs: DataFrame,
    multiply: bool = True,
    unknown: bool = False,
) -> DataFrame:
    embeddings, classifier = models
    predicted = predict_pairs(classifier, factor_vectors(embeddings, pairs, multiply, unknown))
    return predicted.select(*pairs.columns, "prediction")
