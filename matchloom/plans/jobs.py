"""Training, evaluation and reporting jobs. Each returns metrics as DataFrames."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.labels import score_to_label, to_zero_one
from matchloom.operators import id_embeddings, models, networks
from matchloom.operators.classification import (
    area_under_roc,
    evaluate_binary,
    evaluate_binary_by,
    evaluate_multiclass,
    rmse,
)
from matchloom.operators.indexing import split_number
from matchloom.operators.interactions import from_clicks
from matchloom.operators.profiling import rows_per_key_distribution
from matchloom.operators.ranking_metrics import hit_ratio_ndcg_sweep, rank_distribution
from matchloom.operators.sampling import PAIR, attach_vectors, negatives_free, negatives_per_positive, scored_with_negatives
from matchloom.operators.support import cut_lineage, lookup_join
from matchloom.operators.thresholds import precision_recall_curve, score_buckets
from matchloom.operators.vectorising import clean_and_vectorise
from matchloom.params import (
    MODE_CLASSIFIER,
    MODE_CLUSTERED,
    MODE_DATA,
    AlsParams,
    AppParams,
    ClassifierParams,
    EmbeddingParams,
)
from matchloom.plans.preprocess import golden_frame, preprocess
from matchloom.plans.stages import Stages
from matchloom.sources.tables import read_preprocessed, read_table, write_table
from matchloom.sources.word_vectors import load_word_vectors

SPLIT = [0.8, 0.2]


def _ids() -> list[Column]:
    """Both ids as whole numbers, which the split takes its digest of."""
    return [F.col(c).cast("bigint") for c in PAIR]


def ranking_report(joined: DataFrame, k: int) -> dict[str, DataFrame]:
    """Histograms and ranking metrics of cross-scored pairs with labels."""
    return {
        "applied": rows_per_key_distribution(
            joined.where(F.col("label") == 1), "userId", "applyJobCount", "count"
        ),
        "not_applied": rows_per_key_distribution(
            joined.where(F.col("label") == 0), "userId", "notApplyJobCount", "count"
        ),
        "rank_distribution": rank_distribution(joined, k),
        "precision_recall": precision_recall_curve(joined),
        "buckets": score_buckets(joined).orderBy(F.desc("bucket")),
        "sweep": hit_ratio_ndcg_sweep(joined),
    }


def als_job(indexed: DataFrame, params: AlsParams = AlsParams(), negative_k: int = 5) -> dict[str, DataFrame]:
    """Train on 80 %, score the rest with drawn negatives.

    ``held_out`` is one row: area under ROC of the scores, class metrics of scores above 0.5, and the error
    on the held-out interactions, which are scored once with the negatives.
    """
    stages = Stages(indexed.sparkSession)
    pairs = indexed.select(*PAIR, F.col("label").cast("double").alias("label"))
    part = split_number(_ids(), SPLIT)
    with stages.timed("preparation"):
        pairs = cut_lineage(stages.watched(pairs.withColumn("part", part), training=F.col("part") == 0))
    train, test = (pairs.where(F.col("part") == i).drop("part") for i in range(2))
    with stages.timed("training"):
        model = models.fit_als(train, params)
    drawn = negatives_free(test, negative_k).withColumn("drawn", F.lit(True))
    with stages.timed("prediction"):
        scored = models.als_scores(model, drawn.unionByName(test.withColumn("drawn", F.lit(False))))
        scored = cut_lineage(stages.watched(scored, prediction=None))
    with stages.timed("evaluation"):
        classes = scored.withColumn("prediction", score_to_label(F.col("prediction"), 0.5))
        report = evaluate_multiclass(classes).withColumn("auroc", F.round(F.lit(area_under_roc(scored)), 3))
        report = report.withColumn("rmse", F.round(F.lit(rmse(scored.where("not drawn"))), 6))
    return {"held_out": report, "stages": stages.table()}


def id_classifier_job(
    indexed: DataFrame, params: EmbeddingParams = EmbeddingParams(), negative_k: int = 5
) -> dict[str, DataFrame]:
    """Classifier with embeddings of the ids learned with it, trained with drawn negatives; metrics of the validation rows."""
    stages = Stages(indexed.sparkSession)
    positives = indexed.select(*PAIR, F.col("label").cast("double").alias("label"))
    data = negatives_free(positives, negative_k).unionByName(positives).withColumn("part", split_number(_ids(), SPLIT))
    with stages.timed("preparation"):
        data = cut_lineage(stages.watched(data, training=F.col("part") == 0, prediction=F.col("part") == 1))
    train, validation = (data.where(F.col("part") == i).drop("part") for i in range(2))
    with stages.timed("training"):
        model = id_embeddings.fit_id_embeddings(train, params)
    with stages.timed("prediction"):
        predicted = cut_lineage(id_embeddings.predict_id_embeddings(model, validation))
    with stages.timed("evaluation"):
        report = evaluate_multiclass(predicted)
    return {"validation": report, "stages": stages.table()}


def vector_classifier_job(
    indexed: DataFrame,
    user_dict: DataFrame,
    item_dict: DataFrame,
    dim: int,
    params: ClassifierParams = ClassifierParams(epochs=10),
    negative_k: int = 1,
    golden: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Classifier over vectors with drawn negatives; metrics of validation and golden rows.

    ``indexed`` and ``golden`` have labels 0/1.
    """
    stages = Stages(indexed.sparkSession)
    drawn = scored_with_negatives(indexed, item_dict, user_dict, negative_k)
    drawn = drawn.select(*PAIR, "label", "userVec", "itemVec").withColumn("part", split_number(_ids(), SPLIT))
    with stages.timed("preparation"):
        pairs = cut_lineage(stages.watched(drawn, training=F.col("part") == 0, prediction=F.col("part") == 1))
    train, validation = (pairs.where(F.col("part") == i).drop("part") for i in range(2))
    with stages.timed("training"):
        model = networks.fit_or_load_networks(train, dim, params)
    with stages.timed("prediction"):
        predicted = cut_lineage(networks.predict_networks(model, validation).select(*PAIR, "label", "prediction"))
    with stages.timed("evaluation"):
        reports = {"validation": evaluate_binary(predicted)}
    if golden is not None:
        with stages.timed("golden"):
            predicted = networks.predict_networks(model, golden).select("label", "prediction")
            predicted = cut_lineage(stages.watched(predicted, golden=None))
            reports["golden"] = evaluate_binary(predicted)
        reports["golden_labels"] = predicted.groupBy("label").count()
        reports["golden_predictions"] = predicted.groupBy("prediction").count()
    reports["stages"] = stages.table()
    return reports


def golden_vectors(raw: DataFrame, word_vectors: DataFrame, dim: int, label_col: str = "apply_flag") -> DataFrame:
    """Raw rows to vectorised interactions with labels 0/1, for scoring by a trained classifier."""
    vectorised = clean_and_vectorise(from_clicks(raw, label_col, complete=False), word_vectors, dim)
    return vectorised.withColumn("label", to_zero_one(F.col("label")))


def _zero_based(df: DataFrame) -> DataFrame:
    return df.withColumn("label", to_zero_one(F.col("label")))


def _with_negatives(indexed: DataFrame, params: AppParams) -> DataFrame:
    """Interactions with labels 0/1, and ``negative_k`` drawn pairs for each, which take the vectors of both ids from the interactions.

    The set that preprocessing writes has both labels, so none are drawn unless asked for.
    """
    rows = _zero_based(indexed).select(*PAIR, "label", "userVec", "itemVec")
    if not params.negative_k:
        return rows
    sides = [rows.select(c, v).dropDuplicates([c]) for c, v in zip(PAIR, ("userVec", "itemVec"))]
    drawn = negatives_per_positive(rows.select(*PAIR, "label"), params.negative_k)
    return rows.unionByName(attach_vectors(drawn, *sides).select(*rows.columns))


def _trained(
    rows: DataFrame, params: AppParams, path: str, stages: Stages
) -> tuple[networks.Networks, DataFrame, DataFrame]:
    """Networks of the training rows, saved; predicted validation rows, stored; the stored rows with their part."""
    numbered = rows.withColumn("part", split_number(_ids(), SPLIT))
    with stages.timed("preparation"):
        stored = cut_lineage(stages.watched(numbered, training=F.col("part") == 0, prediction=F.col("part") == 1))
    train, validation = (stored.where(F.col("part") == i).drop("part") for i in range(2))
    with stages.timed("training"):
        model = networks.fit_or_load_networks(train, params.word_vectors.dim, replace(params.classifier, model_path=path))
    with stages.timed("prediction"):
        predicted = networks.predict_networks(model, validation).drop("userVec", "itemVec")
        predicted = cut_lineage(predicted)
    return model, predicted, stored


def train_single(indexed: DataFrame, params: AppParams) -> dict[str, DataFrame]:
    """One classifier for all users; metrics of the validation rows. Labels are 1/2."""
    stages = Stages(indexed.sparkSession)
    _, predicted, _ = _trained(_with_negatives(indexed, params), params, params.classifier.model_path, stages)
    with stages.timed("evaluation"):
        report = evaluate_binary(predicted)
    return {"validation": report, "stages": stages.table()}


def train_clustered(indexed: DataFrame, user_dict: DataFrame, params: AppParams) -> dict[str, DataFrame]:
    """Clusters of users and one classifier per cluster; metrics, label counts and silhouette per cluster.

    The classifiers of all clusters are trained together: each step reads its batch once, whatever the number of
    clusters. A cluster keeps its row where it has no validation rows, with -1 and NULL for metrics.
    """
    stages = Stages(indexed.sparkSession)
    with stages.timed("clustering"):
        clustered, _ = models.cluster_users(user_dict, params.kmeans)
        clustered = cut_lineage(clustered)
        if params.data.model_output:
            write_table(clustered, f"{params.data.model_output}/kmeans")
        different = clustered.select("kth").distinct().count()
        silhouette = models.silhouette(clustered, params.kmeans.feature_col) if different > 1 else None
    rows = lookup_join(_with_negatives(indexed, params), clustered.select("userId", "kth"), "userId")
    _, predicted, stored = _trained(rows, params, cluster_model_path(params), stages)
    with stages.timed("evaluation"):
        counts = stored.groupBy("kth").agg(
            F.count_if(F.col("label") == 1.0).alias("positives"), F.count_if(F.col("label") == 0.0).alias("negatives")
        )
        metrics = evaluate_binary_by(predicted, "kth")
        nothing = {c: F.coalesce(c, F.lit(-1.0)) for c in ("accuracy", "precision", "recall")}
        report = counts.join(F.broadcast(metrics), "kth", "left").withColumns(nothing)  # one row for each cluster
        report = report.withColumn("silhouette", F.lit(silhouette).cast("double"))
        report = cut_lineage(report.select("kth", "positives", "negatives", "silhouette", *metrics.columns[1:]))
        if report.isEmpty():
            raise ValueError("no interaction belongs to a user of any cluster")
    return {"validation": report, "stages": stages.table()}


def cluster_model_path(params: AppParams) -> str:
    """Where the classifiers of the clusters lie, beside the one for all users."""
    return f"{params.classifier.model_path}-clusters" if params.classifier.model_path else ""


def predict_golden(golden: DataFrame, params: AppParams) -> DataFrame:
    """Predictions of golden rows (labels 0/1) by the saved models of the mode; NULL for a cluster without one."""
    spark = golden.sparkSession
    if params.mode == MODE_CLASSIFIER:
        return networks.predict_networks(networks.load_networks(spark, params.classifier.model_path), golden)
    clusters = models.KMeansModel.load(params.kmeans.model_path)
    clustered = models.assign_clusters(clusters, golden, params.kmeans.feature_col)
    return networks.predict_networks(networks.load_networks(spark, cluster_model_path(params)), clustered)


def run(spark: SparkSession, params: AppParams) -> dict[str, DataFrame]:
    """The whole job by mode: write the preprocessed set, or train and evaluate on golden rows."""
    if params.mode == MODE_DATA:
        preprocess(spark, params)
        return {}
    if params.mode not in (MODE_CLASSIFIER, MODE_CLUSTERED):
        raise ValueError(f"unknown mode {params.mode!r}")
    indexed, user_dict, _ = read_preprocessed(spark, params.data.preprocessed)
    if params.mode == MODE_CLUSTERED:
        reports = train_clustered(indexed, user_dict, params)
    else:
        reports = train_single(indexed, params)
    words = cut_lineage(load_word_vectors(spark, params.word_vectors.path))
    raw = read_table(spark, params.data.evaluate)
    golden = _zero_based(golden_frame(raw, words, params.word_vectors.dim, params.data.label_col))
    stages = Stages(spark)
    with stages.timed("golden"):
        predicted = predict_golden(golden, params).select("label", "prediction")
        predicted = cut_lineage(stages.watched(predicted, golden=None))
        reports["golden"] = evaluate_binary(predicted)
    reports["stages"] = reports["stages"].unionByName(stages.table())
    return reports
