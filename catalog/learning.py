"""Models: factors, clusters and pair classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from catalog.base import (
    SQL_PAIRS,
    SQL_TRAINING,
    WORD_DIM,
    ctes,
    pairs,
    preprocessed,
    scratch_path,
    sql_round,
    table,
    training_pairs,
    user_dict,
)
from catalog.registry import query
from catalog.sampling import sql_free_negatives
from matchloom.functions.labels import rounded
from matchloom.functions.vectors import dot_product
from matchloom.operators import id_embeddings, models, networks
from matchloom.operators.classification import evaluate_binary_by
from matchloom.operators.indexing import hash_split
from matchloom.operators.sampling import negatives_free
from matchloom.operators.support import cut_lineage, lookup_join, stored
from matchloom.params import AlsParams, ClassifierParams, EmbeddingParams, KMeansParams

SMALL = ClassifierParams()
# held-out pairs by digest; models cannot be expressed in SQL, but which rows come out and what is valid can
SQL_HELD_OUT = (
    ctes(SQL_PAIRS)
    + """SELECT "userId", "itemId", label, true AS valid FROM pairs
    WHERE ('0x' || substr(md5('1|' || "userId" || '|' || "itemId"), 1, 8))::BIGINT / 4294967296e0 >= 0.8"""
)


_DRAWN = """drawn_and_seen AS MATERIALIZED (
  SELECT *, ('0x' || substr(md5('1|' || "userId" || '|' || "itemId"), 1, 8))::BIGINT / 4294967296e0 AS part
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM unseen))"""


def _is_class():
    return F.coalesce(F.col("prediction").isin(0.0, 1.0), F.lit(False))


def in_range(report):
    """Whether every metric of a report is a share, or -1 or NULL by rule where there was nothing to work it out from."""
    names = [c for c in ("accuracy", "precision", "recall", "auroc", "aupr", "weightedPrecision", "weightedRecall") if c in report.columns]
    areas = ("auroc", "aupr")  # NULL where a class has no row
    inside = [F.coalesce(F.col(c).between(0, 1) | (F.col(c) == -1), F.lit(c in areas)) for c in names]
    return reduce(Column.__and__, inside)


def _split(df):
    return hash_split(df, ["userId", "itemId"])


def _ids():
    return [F.col(c).cast("bigint").alias(c) for c in ("userId", "itemId")]


@query("als_scores", SQL_HELD_OUT)
def als_scores(spark, sf):
    """Held-out pairs, and whether their score is a finite number."""
    train, test = _split(pairs(spark, sf))
    scored = models.als_scores(models.fit_als(train), test)
    finite = F.coalesce(F.abs("prediction") < float("inf"), F.lit(False))
    return scored.select(*_ids(), "label", finite.alias("valid"))


@query(
    "als_top_items",
    ctes(SQL_PAIRS) + 'SELECT DISTINCT "userId", r::INT AS rank, true AS valid FROM pairs, range(1, 11) t(r)',
)
def als_top_items(spark, sf):
    """Ten ranks for every user; whether a score is the product of the factors and no higher than the one before."""
    model = models.fit_als(pairs(spark, sf))
    top = cut_lineage(models.als_top_items(model, 10))
    factors = models.factor_vectors(model, top, multiply=False)
    product = dot_product(F.col("userVec"), F.col("itemVec"))
    before = F.lag("score").over(Window.partitionBy("userId").orderBy("rank"))
    agrees = (F.abs(F.col("score") - product) < 1e-6) & (F.col("score") <= F.coalesce(before, F.col("score")))
    return factors.select(F.col("userId").cast("bigint").alias("userId"), F.col("rank").cast("int").alias("rank"), agrees.alias("valid"))


@query("kmeans_users", 'SELECT vec_id AS "userId", true AS valid FROM embeddings')
def kmeans_users(spark, sf):
    """Clusters fitted, saved, loaded again and applied by the loaded model; whether a user sits at its nearest centre."""
    path = scratch_path(spark, "kmeans")
    users = user_dict(spark, sf)
    models.cluster_users(users, KMeansParams(model_path=path))
    clustered, model = models.cluster_users(users, KMeansParams(model_path=path, train=False))

    def distance(centre):
        there = F.array(*[F.lit(float(x)) for x in centre])
        apart = F.zip_with("userVec", there, lambda a, b: (a - b) * (a - b))
        return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x)

    apart = F.array(*[distance(c) for c in model.clusterCenters()])
    valid = F.get(F.col("apart"), F.col("kth")) <= F.array_min("apart") + 1e-6
    return clustered.withColumn("apart", apart).select("userId", valid.alias("valid"))


@query(
    "silhouette",
    f"""WITH d AS (
      SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) ** 2) AS total,
             count(*) AS n
      FROM embeddings a, embeddings b GROUP BY ALL),
    s AS (
      SELECT vec_id, any_value(total / nullif(n - 1, 0)) FILTER (label = other) AS a,
             min(total / n) FILTER (label <> other) AS b FROM d GROUP BY vec_id)
    SELECT {sql_round("avg(coalesce((b - a) / greatest(a, b), 0))")} AS silhouette FROM s""",
)
def silhouette(spark, sf):
    """Silhouette of the given classes as clusters."""
    classes = table(spark, sf, "embeddings")
    value = models.silhouette(classes, "embedding", "label")
    return spark.range(1).select(rounded(F.lit(value)).alias("silhouette"))


SQL_VALIDATION = ctes(SQL_TRAINING) + """SELECT "userId", "itemId", label, true AS valid FROM training WHERE part >= 0.8"""


def _clustered(spark, sf):
    """The preprocessed interactions with the cluster of their user, stored."""
    _, users, _ = preprocessed(spark, sf)
    clustered, _ = models.cluster_users(users, KMeansParams())
    clusters = clustered.select(F.col("userId").cast("bigint").alias("userId"), "kth")
    return cut_lineage(lookup_join(training_pairs(spark, sf), clusters, "userId"))


@query(
    "cluster_models",
    ctes(SQL_TRAINING) + "SELECT true AS valid, 3::BIGINT AS models, count(*) AS scored FROM training WHERE part >= 0.8",
)
def cluster_models(spark, sf):
    """The classifiers of all clusters trained together; whether the metrics of each are in their range, and on how many rows."""
    train, validation = _split(_clustered(spark, sf))
    predicted = networks.predict_networks(networks.fit_networks(train, WORD_DIM, SMALL), validation)
    report = evaluate_binary_by(predicted, "kth").join(predicted.groupBy("kth").count(), "kth")
    return report.agg(F.bool_and(in_range(report)).alias("valid"), F.count(F.lit(1)).alias("models"), F.sum("count").alias("scored"))


@query("cluster_predict", ctes(SQL_TRAINING) + """SELECT "userId", "itemId", label, true AS valid FROM training""")
def cluster_predict(spark, sf):
    """Every interaction predicted by the classifier of the cluster of its user; whether cluster and class are known ones."""
    rows = _clustered(spark, sf)
    predicted = networks.predict_networks(networks.fit_networks(rows, WORD_DIM, SMALL), rows)
    return predicted.select("userId", "itemId", "label", (F.col("kth").isin(0, 1, 2) & _is_class()).alias("valid"))


@query("mlp_pairs", SQL_VALIDATION)
def mlp_pairs(spark, sf):
    """Spark's perceptron on vector pairs: fitted, saved, loaded and applied to held-out pairs, each of which gets a class."""
    path = scratch_path(spark, "classifier")
    train, test = _split(training_pairs(spark, sf))
    models.fit_pair_classifier(train, WORD_DIM, ClassifierParams(model_path=path))
    loaded = models.fit_pair_classifier(train, WORD_DIM, ClassifierParams(train=False, model_path=path))
    return models.predict_pairs(loaded, test).select(*_ids(), "label", _is_class().alias("valid"))


@query("network_pairs", SQL_VALIDATION)
def network_pairs(spark, sf):
    """The network on vector pairs: trained by batches, saved, loaded and applied to held-out pairs; its loss has to fall."""
    path = scratch_path(spark, "network")
    train, test = _split(training_pairs(spark, sf))
    model = networks.fit_or_load_networks(train, WORD_DIM, ClassifierParams(model_path=path))
    loaded = networks.fit_or_load_networks(train, WORD_DIM, ClassifierParams(train=False, model_path=path))
    fell = F.lit(bool(model.losses[-1] < model.losses[0]))
    return networks.predict_networks(loaded, test).select(*_ids(), "label", (_is_class() & fell).alias("valid"))


@query("id_embeddings", SQL_HELD_OUT)
def id_embedding_pairs(spark, sf):
    """Held-out pairs by the classifier with learned embeddings; whether class and probability are valid and the loss fell."""
    train, test = _split(stored(pairs(spark, sf), "pairs"))
    model = id_embeddings.fit_id_embeddings(train, EmbeddingParams(epochs=4))
    fell = F.lit(bool(model.losses[-1] < model.losses[0]))
    predicted = id_embeddings.predict_id_embeddings(model, test)
    agrees = (F.col("prediction") == 1.0) == (F.col("score") > 0.5)
    return predicted.select(*_ids(), "label", (_is_class() & agrees & fell).alias("valid"))


@query("fm_ids", SQL_HELD_OUT)
def fm_ids(spark, sf):
    """Held-out pairs by the classifier on factors, and whether their prediction is one of the classes.

    Ids without a positive in training have no factors; their pairs are trained on and predicted with zeros.
    """
    train, test = _split(stored(pairs(spark, sf), "pairs"))
    fitted = models.fit_factor_classifier(train, AlsParams(rank=20), SMALL, unknown=True)
    return models.predict_factor_classifier(fitted, test, unknown=True).select(*_ids(), "label", _is_class().alias("valid"))


@query(
    "factor_classifier",
    ctes(sql_free_negatives(1, 0), _DRAWN)
    + """, known AS MATERIALIZED (SELECT "userId", "itemId" FROM drawn_and_seen WHERE part < 0.8 AND label > 0)
    SELECT "userId", "itemId", label, true AS valid FROM drawn_and_seen d
    SEMI JOIN (SELECT DISTINCT "userId" FROM known) u USING ("userId")
    SEMI JOIN (SELECT DISTINCT "itemId" FROM known) i USING ("itemId") WHERE part >= 0.8""",
)
def factor_classifier(spark, sf):
    """Classifier over ALS embeddings and their products; held-out pairs and negatives of known ids all get a class."""
    positives = stored(pairs(spark, sf), "pairs")
    train, test = _split(stored(negatives_free(positives, 1).unionByName(positives), "drawn"))
    fitted = models.fit_factor_classifier(train, AlsParams(rank=20), SMALL)
    return models.predict_factor_classifier(fitted, test).select(*_ids(), "label", _is_class().alias("valid"))
