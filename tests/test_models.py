import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.operators import models
from matchloom.operators.classification import evaluate_binary
from matchloom.params import (
    MODE_CLASSIFIER,
    MODE_CLUSTERED,
    MODE_DATA,
    AlsParams,
    AppParams,
    ClassifierParams,
    DataParams,
    KMeansParams,
    WordVectorParams,
)
from matchloom.plans import jobs
from matchloom.sources.tables import read_preprocessed, write_table


@pytest.fixture(scope="module")
def vector_pairs(spark):
    """Label 1 when user and item point the same way."""
    draw = np.random.default_rng(1)
    rows = []
    for n in range(600):
        user, item = draw.normal(size=2), draw.normal(size=2)
        rows.append((n, n, user.tolist(), item.tolist(), float(user[0] + item[0] > 0)))
    return spark.createDataFrame(rows, "userId int, itemId int, userVec array<double>, itemVec array<double>, label double").cache()


def test_pair_classifier_learns_and_reloads(spark, vector_pairs, tmp_path):
    params = ClassifierParams(epochs=40, hidden_layers=(8,), model_path=str(tmp_path / "mlp"))
    model = models.fit_pair_classifier(vector_pairs, 2, params)
    predicted = models.predict_pairs(model, vector_pairs)
    assert set(vector_pairs.columns) | {"prediction"} == set(predicted.columns)
    assert evaluate_binary(predicted).first()["accuracy"] > 0.9
    loaded = models.fit_pair_classifier(
        vector_pairs, 2, ClassifierParams(train=False, model_path=str(tmp_path / "mlp"))
    )
    again = models.predict_pairs(loaded, vector_pairs)
    assert sorted(map(str, again.collect())) == sorted(map(str, predicted.collect()))


def test_clusters_and_cluster_models(spark, vector_pairs):
    users = vector_pairs.select("userId", "userVec")
    clustered, model = models.cluster_users(users, KMeansParams())
    assert {r["kth"] for r in clustered.collect()} == {0, 1, 2}
    again, _ = models.cluster_users(users, KMeansParams())
    assert sorted(map(str, again.collect())) == sorted(map(str, clustered.collect()))
    assert -1 <= models.silhouette(clustered) <= 1
    with pytest.raises(ValueError, match="userVec"):
        models.fit_kmeans(users.drop("userVec"), KMeansParams())

    of_one = models.in_cluster(vector_pairs, clustered, 1)
    assert of_one.columns == vector_pairs.columns
    assert of_one.count() == clustered.where("kth = 1").count()

    assigned = models.assign_clusters(model, vector_pairs)
    fitted = models.train_per_cluster(
        4,
        lambda kth: assigned.where(F.col("kth") == kth),
        lambda kth, data: models.fit_pair_classifier(data, 2, ClassifierParams(epochs=30, hidden_layers=(6,))),
    )
    assert sorted(fitted) == [0, 1, 2]  # the fourth cluster is empty
    predicted = models.predict_per_cluster(fitted, assigned)
    assert predicted.count() == 600
    assert evaluate_binary(predicted).first()["accuracy"] > 0.85
    del fitted[2]
    partly = models.predict_per_cluster(fitted, assigned)
    assert partly.count() == 600
    assert {r["kth"] for r in partly.where("prediction is null").collect()} == {2}


@pytest.fixture(scope="module")
def blocks(spark):
    """Users of a block take items of the block."""
    rows = [(u, i, 1.0) for u in range(40) for i in range(30) if u % 2 == i % 2 and (u * 7 + i) % 3]
    return spark.createDataFrame(rows, "userId int, itemId int, label double").cache()


def test_als(spark, blocks):
    model = models.fit_als(blocks)
    pairs = spark.createDataFrame([(0, 2), (0, 3), (0, 999)], "userId int, itemId int")
    scores = {r["itemId"]: r["prediction"] for r in models.als_scores(model, pairs).collect()}
    assert sorted(scores) == [2, 3]  # no prediction for an unknown item
    assert scores[2] > scores[3]
    top = models.als_top_items(model, 5).where("userId = 1").orderBy("rank").collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    assert all(r["itemId"] % 2 == 1 for r in top)


def test_id_classifiers(spark, blocks):
    others = spark.createDataFrame(
        [(u, i, 0.0) for u in range(40) for i in range(30) if u % 2 != i % 2], "userId int, itemId int, label double"
    )
    data = blocks.unionByName(others)
    fitted = models.fit_factor_classifier(data, AlsParams(rank=4), ClassifierParams(epochs=40, hidden_layers=(8,)))
    predicted = models.predict_factor_classifier(fitted, data)
    assert predicted.columns == ["userId", "itemId", "label", "prediction"]
    assert evaluate_binary(predicted).first()["accuracy"] > 0.9


def test_jobs_of_every_mode(spark, tmp_path):
    draw = np.random.default_rng(5)
    vocabulary = [f"word{n}" for n in range(40)]
    (tmp_path / "words.txt").write_text(
        "\n".join(f"{w} {draw.normal():.4f} {draw.normal():.4f}" for w in vocabulary), encoding="utf-8"
    )
    from matchloom.schemas import RAW_INTERACTIONS

    docs = [" ".join(draw.choice(vocabulary, 12)) for _ in range(60)]
    rows = [
        (f"u{u}", f"j{i}", ((docs[u],),), f"<p>{docs[30 + i]}</p>", 1.0, float(draw.integers(2)))
        for u in range(30)
        for i in draw.choice(30, 12, replace=False)
    ]
    write_table(spark.createDataFrame(rows, RAW_INTERACTIONS), str(tmp_path / "raw"))
    params = dict(
        data=DataParams(
            raw=str(tmp_path / "raw"),
            preprocessed=str(tmp_path / "pre"),
            model_output=str(tmp_path / "out"),
            evaluate=str(tmp_path / "raw"),
        ),
        word_vectors=WordVectorParams(str(tmp_path / "words.txt"), 2),
        kmeans=KMeansParams(model_path=str(tmp_path / "kmeans")),
        classifier=ClassifierParams(epochs=5, model_path=str(tmp_path / "mlp")),
    )
    assert jobs.run(spark, AppParams(mode=MODE_DATA, **params)) == {}
    indexed, users, items = read_preprocessed(spark, str(tmp_path / "pre"))
    assert (indexed.count(), users.count(), items.count()) == (360, 30, 30)
    assert {r["label"] for r in indexed.collect()} == {1.0, 2.0}
    assert sorted(r["userId"] for r in users.collect()) == list(map(float, range(30)))
    single = jobs.run(spark, AppParams(mode=MODE_CLASSIFIER, **params))
    assert 0 <= single["golden"].first()["accuracy"] <= 1
    clustered = jobs.run(spark, AppParams(mode=MODE_CLUSTERED, **params))
    report = clustered["validation"].collect()
    assert sorted(r["kth"] for r in report) == [0, 1, 2]
    assert sum(r["positives"] + r["negatives"] for r in report) == 360
    with pytest.raises(ValueError, match="unknown mode"):
        jobs.run(spark, AppParams(mode="other", **params))
