"""Jobs: clusters of a handful of rows, drawn negatives, stages."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.operators import models
from matchloom.params import AppParams, ClassifierParams, DataParams, KMeansParams, WordVectorParams
from matchloom.plans import jobs
from matchloom.plans.stages import Stages

PARAMS = AppParams(
    word_vectors=WordVectorParams(dim=2), kmeans=KMeansParams(k=3), classifier=ClassifierParams(epochs=2, hidden_layers=(4,))
)


@pytest.fixture(scope="module")
def lopsided(spark):
    """Two crowds of users and one user far away with a handful of rows; labels are 1/2."""
    draw = np.random.default_rng(3)
    vecs = {u: [float(draw.normal() + 9 * (u % 2)), 0.0] for u in range(30)} | {30: [500.0, 500.0]}
    items = {i: draw.normal(size=2).tolist() for i in range(12)}
    rows = [(float(u), float(i), vecs[u], items[i], float(1 + (u + i) % 2)) for u in range(30) for i in range(12) if (u * 5 + i) % 3]
    rows += [(30.0, 4.0, vecs[30], items[4], 2.0), (30.0, 5.0, vecs[30], items[5], 1.0)]
    indexed = spark.createDataFrame(rows, "userId double, itemId double, userVec array<double>, itemVec array<double>, label double")
    users = spark.createDataFrame([(float(u), v) for u, v in vecs.items()], "userId double, userVec array<double>")
    return indexed.cache(), users


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_clusters_of_any_size_at_any_partitioning(spark, lopsided, partitions):
    indexed, users = lopsided
    reports = jobs.train_clustered(indexed.repartition(partitions), users.repartition(partitions), PARAMS)
    report = {r["kth"]: r for r in reports["validation"].collect()}
    assert len(report) == 3 and sum(r["positives"] + r["negatives"] for r in report.values()) == indexed.count()
    lonely = min(report.values(), key=lambda r: r["positives"] + r["negatives"])
    assert (lonely["positives"], lonely["negatives"]) == (1, 1) and lonely["auroc"] is None
    stages = {r["stage"]: r for r in reports["stages"].collect()}
    assert stages["training"]["rows"] + stages["prediction"]["rows"] == indexed.count()
    assert all(stages[s]["seconds"] > 0 for s in ("clustering", "training", "prediction", "evaluation"))


def test_clusters_do_not_hang_on_partitions(spark, lopsided):
    users = lopsided[1]
    found = [models.cluster_users(users.repartition(n), PARAMS.kmeans)[0].collect() for n in (1, 5, 11)]
    assert len({tuple(sorted((r["userId"], r["kth"]) for r in rows)) for rows in found}) == 1


def test_negatives_are_drawn_when_asked_for(spark, lopsided):
    indexed = lopsided[0]
    reports = jobs.train_single(indexed, replace(PARAMS, negative_k=2))
    rows = sum(r["rows"] for r in reports["stages"].collect() if r["rows"] is not None)
    assert rows > 1.2 * indexed.count()  # not twice as many: most pairs have been seen
    plain = jobs.train_single(indexed, PARAMS)
    assert sum(r["rows"] for r in plain["stages"].collect() if r["rows"] is not None) == indexed.count()


def test_saved_networks_score_golden_rows_of_both_modes(spark, lopsided, tmp_path):
    indexed, users = lopsided
    params = replace(
        PARAMS,
        data=DataParams(model_output=str(tmp_path / "out")),
        kmeans=replace(PARAMS.kmeans, model_path=str(tmp_path / "kmeans")),
        classifier=replace(PARAMS.classifier, model_path=str(tmp_path / "net")),
    )
    jobs.train_single(indexed, params)
    jobs.train_clustered(indexed, users, params)
    for mode in ("NCFOnly", "NCFWithKmeans"):
        predicted = jobs.predict_golden(indexed, replace(params, mode=mode))
        assert predicted.where("prediction in (0, 1)").count() == indexed.count()


def test_no_user_of_any_cluster(spark, lopsided):
    indexed, users = lopsided
    with pytest.raises(ValueError, match="no interaction"):
        jobs.train_clustered(indexed.where("userId > 99"), users, PARAMS)


def test_stages_count_on_the_way(spark):
    stages = Stages(spark)
    with stages.timed("reading"):
        df = stages.watched(spark.range(10), reading=None, even=F.col("id") % 2 == 0)
        assert len(df.collect()) == 10
    stages.watched(spark.range(3), unread=None)
    import matchloom.plans.stages as module

    module.WAIT, wait = 0.1, module.WAIT
    try:
        got = {r["stage"]: (r["rows"], r["seconds"] is not None) for r in stages.table().collect()}
    finally:
        module.WAIT = wait
    assert got == {"reading": (10, True), "even": (5, False), "unread": (None, False)}
