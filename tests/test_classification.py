import math
import random

import pytest

from matchloom.operators import classification as metrics
from matchloom.operators import features, profiling


def frame(spark, rows):
    return spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label double, prediction double")


MIXED = [(1, 1)] * 4 + [(0, 1)] * 1 + [(0, 0)] * 3 + [(1, 0)] * 2


def test_confusion_and_ratios(spark):
    cells = metrics.confusion(frame(spark, MIXED))
    assert tuple(cells.first()) == (4, 1, 3, 2)
    assert tuple(metrics.binary_ratios(cells).first()) == pytest.approx((0.7, 0.8, 4 / 6))


@pytest.mark.parametrize(
    "rows, expected",
    [([(0, 0)] * 3, (1.0, -1.0, -1.0)), ([(0, 1)] * 3, (0.0, 0.0, -1.0)), ([(1, 0)] * 3, (0.0, -1.0, 0.0)), ([], (-1.0, -1.0, -1.0))],
)
def test_zero_denominators(spark, rows, expected):
    assert tuple(metrics.binary_ratios(metrics.confusion(frame(spark, rows))).first()) == expected


def _pairwise_auc(rows):
    positive = [p for l, p in rows if l == 1]
    negative = [p for l, p in rows if l == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def test_area_under_roc_with_ties(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(2), round(draw.random(), 1)) for _ in range(200)]
    assert metrics.area_under_roc(frame(spark, rows)) == pytest.approx(_pairwise_auc(rows))
    assert metrics.area_under_roc(frame(spark, MIXED)) == pytest.approx((4 / 6 + 3 / 4) / 2)


def test_area_under_roc_of_many_scores_is_not_binned(spark):
    draw = random.Random(2)
    rows = [(int(draw.random() < 0.3), draw.random()) for _ in range(3000)]
    assert metrics.area_under_roc(frame(spark, rows)) == pytest.approx(_pairwise_auc(rows), abs=1e-12)


def test_bundles(spark):
    df = frame(spark, MIXED)
    weighted = metrics.weighted_precision_recall(df).first()
    precision = (6 * 4 / 5 + 4 * 3 / 5) / 10
    assert tuple(weighted) == pytest.approx((0.7, precision, 0.7))
    assert metrics.evaluate_multiclass(df).first().asDict() == {
        "auroc": 0.708, "accuracy": 0.7, "weightedPrecision": 0.72, "weightedRecall": 0.7,
    }
    binary = metrics.evaluate_binary(df).first().asDict()
    assert {k: binary[k] for k in ("accuracy", "precision", "recall", "auroc")} == {
        "accuracy": 0.7, "precision": 0.8, "recall": 0.667, "auroc": 0.708,
    }
    shifted = frame(spark, [(a + 1, b + 1) for a, b in MIXED])
    assert metrics.evaluate_predictions(shifted).first().asDict() == binary


def test_rmse(spark):
    assert metrics.rmse(frame(spark, [(1, 0), (0, 0), (1, 1), (0, 2)])) == pytest.approx(math.sqrt(5 / 4))


def test_points_and_rows(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0, [1.0, 2.0], [3.0])], "userId double, itemId double, label double, userVec array<float>, itemVec array<float>"
    )
    assert features.id_points(df, 1).first()["features"].toArray().tolist() == [1.0, 2.0]
    assert features.vector_points(df, 1).first()["features"].toArray().tolist() == [1.0, 2.0, 3.0]
    row = features.pair_rows(df).first()
    assert (row["userId"], row["itemId"], row["label"]) == (1.0, 2.0, 1.0)
    assert row["features"].toArray().tolist() == [1.0, 2.0, 3.0]
    with pytest.raises(ValueError, match="label"):
        features.pair_rows(df.drop("label"))
    with pytest.raises(Exception, match="ids must not be negative"):
        features.id_points(df.withColumn("userId", -df.userId), 1).collect()


def test_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, None), (None, "z")], "u int, i string")
    assert [tuple(r) for r in profiling.count_of_counts(df, "u", "i", "items", "users").collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in profiling.rows_per_key_distribution(df.dropna(), "u", "rows", "users").collect()] == [(1, 1), (3, 1)]
    assert tuple(profiling.distinct_counts(df, {"users": ["u"], "pairs": ["u", "i"]}).first()) == (3, 3)


def test_profile_report(spark):
    from matchloom.schemas import RAW_APPLICATIONS

    rows = [
        ("j1", "j1", "t", "text one", "http://x/ab12", (("body",),), True),
        ("j1", "j1", "t", "text one", "http://x/ab12", (("body",),), False),
        ("j2", "j2", None, "text two", "http://y/zz12", (("body",),), None),
        ("j3", None, "t", "text", "http://y/zz13", ((None,),), True),
        ("j4", "j4", "t", None, None, (("body",),), True),
    ]
    raw = spark.createDataFrame(rows, RAW_APPLICATIONS)
    got = {(r["section"], r["metric"]): r["value"] for r in profiling.profile_report(raw).collect()}
    assert got == {
        ("item", "items"): 1, ("item", "ids"): 1, ("item", "ids_titles"): 1, ("item", "ids_descriptions"): 1,
        ("user", "urls"): 2, ("user", "ids"): 1, ("user", "ids_documents"): 1,
        ("application", "rows"): 5, ("application", "applications"): 4, ("application", "urls"): 3,
        ("application", "item_ids"): 3, ("application", "user_ids"): 2, ("application", "pairs"): 3,
        ("items_per_user", "1"): 1, ("items_per_user", "2"): 1,
        ("application", "complete"): 2, ("application", "complete_with_content"): 1,
    }


def _metrics(row):
    return {k: None if v is None else float(v) for k, v in row.asDict().items()}


@pytest.mark.parametrize(
    "rows, binary, multi",
    [
        ([], {"accuracy": -1, "precision": -1, "recall": -1}, {}),
        ([(None, 1.0), (1.0, None)], {"accuracy": -1, "precision": -1, "recall": -1}, {}),
        ([(1.0, 1.0)] * 3 + [(1.0, 0.0)], {"accuracy": 0.75, "precision": 1, "recall": 0.75}, {"accuracy": 0.75, "weightedPrecision": 1, "weightedRecall": 0.75}),
        ([(0.0, 0.0)] * 2, {"accuracy": 1, "precision": -1, "recall": -1}, {"accuracy": 1, "weightedPrecision": 1, "weightedRecall": 1}),
    ],
)
def test_nothing_or_one_class_to_score(spark, rows, binary, multi):
    df = spark.createDataFrame(rows, "label double, prediction double")
    assert _metrics(metrics.evaluate_binary(df).first()) == {"auroc": None, "aupr": None, **binary}
    names = ("auroc", "accuracy", "weightedPrecision", "weightedRecall")
    assert _metrics(metrics.evaluate_multiclass(df).first()) == {**dict.fromkeys(names), **multi}
    shifted = df.selectExpr("label + 1 as label", "prediction + 1 as prediction")
    assert _metrics(metrics.evaluate_predictions(shifted).first()) == {"auroc": None, "aupr": None, **binary}


def test_metrics_by_key_equal_those_of_each_key(spark):
    draw = random.Random(4)
    rows = [(k, float(draw.random() < 0.4), float(draw.random() < share)) for k, share in enumerate((0.5, 0.1, 0.9)) for _ in range(60)]
    rows += [(3, 1.0, 1.0), (3, 0.0, 1.0), (4, 1.0, 0.0), (5, None, 1.0), (6, 0.0, 0.0), (6, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "kth int, label double, prediction double").cache()
    got = {r["kth"]: _metrics(r) for r in metrics.evaluate_binary_by(df, "kth").collect()}
    assert sorted(got) == list(range(7))
    for kth in got:
        assert got[kth] == {"kth": kth, **_metrics(metrics.evaluate_binary(df.where(f"kth = {kth}")).first())}


def _by_evaluator(df):
    counts = metrics.outcome_counts(df)
    return metrics.BinaryClassificationEvaluator(rawPredictionCol="prediction", weightCol="n", numBins=0).evaluate(counts)


def test_area_under_roc_adds_up_over_ranges_of_scores(spark):
    draw = random.Random(5)
    rows = [(float(draw.random() < 0.3), round(draw.gauss(0, 1), 2)) for _ in range(3000)] + [(1.0, float("nan"))]
    df = frame(spark, rows)
    expected = _by_evaluator(df)
    assert metrics.area_under_roc(df) == pytest.approx(expected, abs=1e-12)
    for rows in ([(1.0, 0.3), (1.0, 0.2)], [(0.0, 0.3)], []):
        df = spark.createDataFrame(rows, "label double, prediction double")
        expected = _by_evaluator(df)
        assert metrics.area_under_roc(df) == expected
    with pytest.raises(Exception):
        metrics.area_under_roc(spark.createDataFrame([(1.0, None), (0.0, 0.2)], "label double, prediction double"))


def test_area_under_roc_is_added_up_by_tasks_of_sorted_scores(spark, monkeypatch):
    def evaluator(*_, **__):
        raise AssertionError("scores were handed to the evaluator of RDDs")

    monkeypatch.setattr(metrics, "BinaryClassificationEvaluator", evaluator)
    assert metrics.area_under_roc(frame(spark, [(1.0, 0.7), (0.0, 0.2), (1.0, 0.2)])) == pytest.approx(0.75)
