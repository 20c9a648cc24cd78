"""Rows and settings that would be lost or fail without notice."""

import pytest

from matchloom.operators import models
from matchloom.operators.classification import evaluate_binary, evaluate_multiclass, unscored_rows
from matchloom.operators.ranking import best_items
from matchloom.operators.ranking_metrics import any_hit, users_without_hit
from matchloom.operators.vectorising import doc_vectors, mean_vectors
from matchloom.params import ClassifierParams, KMeansParams
from matchloom.sources.models import model_exists, remove_model


def test_vectors_longer_than_dim_fail(spark):
    words = spark.createDataFrame([("word", [1.0, 2.0, 3.0, 4.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, "word word")], "id int, doc string")
    with pytest.raises(Exception, match="more than 2 elements"):
        doc_vectors(docs, words, 2, "id", "doc", "vec").collect()
    assert len(doc_vectors(docs, words, 4, "id", "doc", "vec").first()["vec"]) == 4
    with pytest.raises(Exception, match="more than 3 elements"):
        mean_vectors(words, "word", "vec", 3).collect()


def test_odd_vectors_leave_the_ranking(spark):
    inf = float("inf")
    users = [(1, [1.0, 0.0]), (2, [0.0, 1e-200]), (3, [float("nan"), 1.0])]
    items = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [float("nan"), 0.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, [1e200, 1e-3])]
    users = spark.createDataFrame(users, "userId int, userVec array<double>")
    items = spark.createDataFrame(items, "itemId int, itemVec array<double>")
    got = {(r["userId"], r["itemId"]): r["score"] for r in best_items(users, items, k=3).collect()}
    assert set(got) == {(u, i) for u in (1, 2) for i in (1, 2, 6)}
    assert got[1, 1] == got[1, 6] == got[2, 2] == 1.0 and got[2, 6] == got[1, 2] == 0.0


def test_rows_without_prediction_are_counted(spark):
    rows = [(1.0, 1.0), (0.0, 0.0), (1.0, 0.0), (1.0, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    assert float(evaluate_binary(df).first()["accuracy"]) == 0.667
    assert float(evaluate_multiclass(df).first()["accuracy"]) == 0.667
    assert unscored_rows(df).first()["unscored"] == 1


def test_loading_needs_a_path(spark):
    users = spark.createDataFrame([([1.0, 2.0],)], "userVec array<double>")
    with pytest.raises(ValueError, match="path"):
        models.cluster_users(users, KMeansParams(train=False, model_path=""))


def test_perceptron_takes_its_parameters(spark):
    assert models.pair_classifier(4, ClassifierParams(solver="gd", learning_rate=0.5)).getSolver() == "gd"


def test_saved_models(spark, tmp_path):
    path = str(tmp_path / "model")
    assert not model_exists(spark, "") and not model_exists(spark, path)
    models.fit_kmeans(
        spark.createDataFrame([([1.0, 2.0],), ([5.0, 2.0],), ([9.0, 9.0],)], "userVec array<double>"), KMeansParams(k=2)
    ).write().save(path)
    assert model_exists(spark, path)
    remove_model(spark, path)
    assert not model_exists(spark, path)


def test_hits(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, None), (2, 1, 0.0), (3, 9, 1.0)], "userId int, rank int, label double")
    assert {(r["userId"], r["hit"]) for r in any_hit(df, 5).collect()} >= {(1, 1), (2, 0)}
    assert 2 in {r["userId"] for r in users_without_hit(df, 5).collect()}
