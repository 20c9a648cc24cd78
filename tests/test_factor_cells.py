"""The perceptron over factors is trained on cells that hold each factor once, whatever their number."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from matchloom.operators import factor_cells as cells
from matchloom.operators import models
from matchloom.params import AlsParams, ClassifierParams


@pytest.fixture(scope="module")
def given(spark):
    draw = np.random.default_rng(3)
    users, items = (spark.createDataFrame([(i, draw.normal(size=3).tolist()) for i in range(n)], "id int, vec array<float>") for n in (25, 18))
    rows = [(u, i, float((u + i) % 2)) for u in range(27) for i in range(20) if (u * 7 + i) % 3]  # two users and two items are unknown
    rows += [(4, 4, 1.0)] * 40 + [(None, 3, 0.0)]
    return spark.createDataFrame(rows, "userId bigint, itemId bigint, label double").cache(), users.cache(), items.cache()


def sums(spark, given, unknown, weights, layers):
    packed, _ = cells.pack_cells(*given, 3, unknown)
    handle = spark.sparkContext.broadcast(weights)
    found = packed.mapInArrow(cells._gradients(3, True, layers, handle), "n bigint, loss double, slope binary").collect()
    return packed.count(), sum(r["n"] for r in found), sum(r["loss"] for r in found), sum(np.frombuffer(r["slope"], "<f8") for r in found)


@pytest.mark.parametrize("unknown", [True, False])
def test_cells_give_the_sums_of_the_rows(spark, given, monkeypatch, unknown):
    layers = (9, 5, 2)
    weights = cells._start(layers, 1)
    pairs, users, items = given
    u, i = ({r["id"]: np.array(r["vec"]) for r in side.collect()} for side in (users, items))
    rows = [r for r in pairs.collect() if unknown or (r["userId"] in u and r["itemId"] in i)]
    left, right = (np.array([side.get(r[c], np.zeros(3)) for r in rows]) for side, c in ((u, "userId"), (i, "itemId")))
    labels = np.array([int(r["label"]) for r in rows])

    def loss(flat):
        held = np.concatenate([left, right, left * right], axis=1)
        held = 1 / (1 + np.exp(-(held @ flat[:45].reshape(9, 5) + flat[45:50])))
        out = held @ flat[50:60].reshape(5, 2) + flat[60:]
        return (np.log(np.exp(out).sum(axis=1)) - out[np.arange(len(labels)), labels]).sum()

    steps = [(loss(weights + 1e-5 * e) - loss(weights - 1e-5 * e)) / 2e-5 for e in np.eye(len(weights))]
    for block_bytes, cell_rows in ((1 << 20, 10_000), (80, 60)):
        monkeypatch.setattr(cells, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(cells, "CELL_ROWS", cell_rows)
        count, n, total, slope = sums(spark, given, unknown, weights, layers)
        assert n == len(rows) and (count == 1 if cell_rows > 60 else count > 8)
        assert total == pytest.approx(loss(weights), rel=1e-4) and np.allclose(slope, steps, rtol=1e-3, atol=2e-3)


def test_blocks_bound_bytes_and_cells_rows():
    by_users, by_items = cells.grid(900_000, 1_200_000, 57_600_000, 20)
    assert 80 * 900_000 / by_users <= cells.BLOCK_BYTES and 80 * 1_200_000 / by_items <= cells.BLOCK_BYTES
    assert by_users * by_items * cells.CELL_ROWS >= 57_600_000 and by_users * by_items < 40
    assert cells.grid(3, 0, 0, 20) == (1, 1)


def test_solvers_reach_the_lowest_value():
    target = np.linspace(-2, 3, 8)

    def evaluate(x):
        return float(((x - target) ** 2 * np.arange(1, 9)).sum() + ((x - target) ** 4).sum()), 2 * (x - target) * np.arange(1, 9) + 4 * (x - target) ** 3

    assert np.allclose(cells.quasi_newton(evaluate, np.zeros(8), 60), target, atol=1e-2)
    assert np.allclose(cells.descend(evaluate, target + 0.3, 200, 0.03), target, atol=0.1)


def test_pairs_do_not_carry_their_factors_into_training(spark, monkeypatch):
    monkeypatch.setattr(MultilayerPerceptronClassifier, "_fit", lambda *_: pytest.fail("Spark's perceptron keeps all widened rows"))
    data = spark.createDataFrame([(u, i, float(u % 2 == i % 2)) for u in range(20) for i in range(20)], "userId int, itemId int, label double")
    for solver in ("l-bfgs", "gd"):
        fitted = models.fit_factor_classifier(data, AlsParams(rank=3), ClassifierParams(epochs=3, hidden_layers=(4,), solver=solver), unknown=True)
        assert list(fitted[1].getLayers()) == [9, 4, 2] and models.predict_factor_classifier(fitted, data, unknown=True).where(F.col("prediction").isin(0, 1)).count() == 400
    wrong = data.withColumn("label", F.lit(2.0))
    with pytest.raises(Exception, match="label is not 0 or 1"):
        models.fit_factor_classifier(wrong, AlsParams(rank=3), ClassifierParams(epochs=1, hidden_layers=(4,)))
