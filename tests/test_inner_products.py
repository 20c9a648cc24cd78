"""Best items by inner product: brute force, ties, blocks that are ruled out."""

import numpy as np
import pytest

from matchloom.operators.inner_products import best_products
from matchloom.operators.sampling import negative_join


def tables(spark, users, items):
    return (
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(users)], "userId int, userVec array<double>"),
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in items], "itemId int, itemVec array<double>"),
    )


def brute(users, items, k):
    rows = set()
    for u, vec in enumerate(users):
        scored = sorted((-float(np.dot(vec, v)), i) for i, v in items)
        rows |= {(u, i, round(-s, 9), r + 1) for r, (s, i) in enumerate(scored[:k])}
    return rows


def found(df):
    rows = df.collect()
    got = {(r["userId"], r["itemId"], round(r["score"], 9), r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("block, part_bytes", [(512, 1 << 26), (4, 1 << 26), (4, 600), (1, 1)])
def test_equals_brute_force_with_ties(spark, block, part_bytes):
    draw = np.random.default_rng(block)
    users = draw.integers(-2, 3, size=(40, 3))
    items = [(int(i), v) for i, v in zip(draw.permutation(120), draw.integers(-3, 4, size=(120, 3)))]  # many equal products
    rows, work = best_products(*tables(spark, users, items), 7, block, part_bytes)
    assert found(rows) == brute(users, items, 7)
    row = work.first()
    assert row["users"] == 40 and row["met"] + row["skipped"] >= 40 and row["skipped"] >= 0


def test_blocks_are_ruled_out_where_lengths_differ(spark):
    draw = np.random.default_rng(1)
    users = draw.normal(size=(50, 4))
    items = [(i, draw.normal(size=4) * 0.97**i) for i in range(400)]
    rows, work = best_products(*tables(spark, users, items), 5, 10, 48 * 80)
    assert found(rows) == brute(users, items, 5)
    row = work.first()
    assert row["met"] + row["skipped"] == 50 * 40 and row["skipped"] > 0.5 * 50 * 40


def test_few_items_and_odd_vectors(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.0, 0.0])], "userId long, userVec array<double>")
    items = spark.createDataFrame([(7, [2.0, 0.0]), (5, [-1.0, 0.0]), (9, None), (8, [1.0, None]), (6, [0.0, 0.0])], "itemId int, itemVec array<float>")
    rows, _ = best_products(users, items, 10)
    assert [(r["itemId"], r["score"]) for r in rows.where("userId = 1").orderBy("rank").collect()] == [(7, 2.0), (6, 0.0), (5, -1.0)]
    assert [r["itemId"] for r in rows.where("userId = 4").orderBy("rank").collect()] == [5, 6, 7] and rows.count() == 6
    for some in (best_products(users.limit(0), items, 3), best_products(users, items.limit(0), 3)):
        assert some[0].count() == 0
    with pytest.raises(ValueError, match="size"):
        best_products(users, items.unionByName(items.selectExpr("100 as itemId", "array(1.0f) as itemVec").limit(1)), 3)


@pytest.mark.parametrize("limit", [1 << 28, 1])
def test_negative_join_is_sorted_without_vectors(spark, limit):
    draw = np.random.default_rng(2)
    indexed = spark.createDataFrame([(int(u), int(i), 1.0) for u in range(20) for i in draw.choice(30, 4, replace=False)], "userId int, itemId int, label double")
    users, items = tables(spark, draw.normal(size=(20, 3)), list(enumerate(draw.normal(size=(30, 3)))))
    joined = negative_join(indexed, items, users, 3, limit=limit)
    rows = joined.collect()
    assert joined.columns == ["userId", "itemId", "label", "userVec", "itemVec", "cosineSimilarity"]
    assert [r["cosineSimilarity"] for r in rows] == sorted((r["cosineSimilarity"] for r in rows), reverse=True)
    assert sum(r["label"] for r in rows) == 80 and len({(r["userId"], r["itemId"]) for r in rows}) == len(rows) > 80
    if limit > 1:
        assert "Exchange rangepartitioning" not in joined._jdf.queryExecution().toString()
