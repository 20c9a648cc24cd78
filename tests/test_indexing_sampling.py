import random
from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from matchloom.operators import indexing, sampling


def test_string_index_orders_by_count_then_value(spark):
    rows = [(w,) for w in "c c c a b b a d".split()] + [(None,)]
    df = spark.createDataFrame(rows, "w string")
    got = {r["w"]: r["i"] for r in indexing.string_index(df, "w", "i").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}


def test_string_index_equals_the_ml_indexer(spark):
    draw = random.Random(1)
    rows = [(f"v{min(draw.randrange(200), draw.randrange(200))}",) for _ in range(3000)]
    df = spark.createDataFrame(rows, "w string").repartition(8)
    mine = {r["w"]: r["i"] for r in indexing.string_index(df, "w", "i").collect()}
    model = StringIndexer(inputCol="w", outputCol="i").fit(df)
    assert mine == {label: float(i) for i, label in enumerate(model.labels)}


def test_string_index_over_several_partitions(spark):
    """Without coalescing the sorted values lie in many partitions."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).select(F.format_string("%04d", "id").alias("w"))
        got = {r["w"]: r["i"] for r in indexing.string_index(df, "w", "i").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert got == {f"{i:04d}": float(i) for i in range(1000)}


def test_index_interactions(spark):
    rows = [("u1", "i1", 1.0), ("u1", "i2", 0.0), ("u1", "i1", 1.0), ("u2", "i1", 1.0)]
    df = spark.createDataFrame(rows, "userId string, itemId string, label double")
    got = sorted(tuple(r) for r in indexing.index_interactions(df).collect())
    assert got == [("u1", "i1", 0.0, 0.0, 1.0), ("u1", "i2", 0.0, 1.0, 0.0), ("u2", "i1", 1.0, 0.0, 1.0)]


def test_splits_are_whole_and_disjoint(spark):
    df = spark.range(2000).select(F.col("id").alias("userId"))
    for parts in (indexing.hash_split(df, ["userId"]), indexing.random_split(df)):
        train, test = ({r["userId"] for r in p.collect()} for p in parts)
        assert train | test == set(range(2000)) and not train & test
        assert 1500 < len(train) < 1700


def test_hash_split_of_three_parts(spark):
    df = spark.range(3000).withColumn("part", indexing.split_number(["id"], [1.0, 1.0, 1.0]))
    counts = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
    assert sorted(counts) == [0, 1, 2] and min(counts.values()) > 900


@pytest.fixture
def indexed(spark):
    draw = random.Random(5)
    pairs = {(0 if draw.random() < 0.4 else draw.randrange(30), draw.randrange(40)) for _ in range(400)}
    rows = [(float(u), float(i), float(draw.randrange(2))) for u, i in sorted(pairs)]
    return spark.createDataFrame(rows, "userId double, itemId double, label double")


def observed(indexed):
    return {(r["userId"], r["itemId"]) for r in indexed.collect()}


def test_negatives_per_positive(spark, indexed):
    seen = observed(indexed)
    rows = sampling.negatives_per_positive(indexed, 3).collect()
    drawn = [(r["userId"], r["itemId"]) for r in rows]
    assert {r["label"] for r in rows} == {0.0}
    assert len(drawn) == len(set(drawn)) and not set(drawn) & seen
    assert {u for u, _ in drawn} <= {u for u, _ in seen}
    assert {i for _, i in drawn} <= set(map(float, range(40)))
    per_user, seen_per_user = Counter(u for u, _ in drawn), Counter(u for u, _ in seen)
    assert all(n <= 3 * seen_per_user[u] for u, n in per_user.items())


def test_free_negatives_cover_both_ends(spark, indexed):
    seen = observed(indexed)
    drawn = {(r["userId"], r["itemId"]) for r in sampling.negatives_free(indexed, 20).collect()}
    assert not drawn & seen and len(drawn) <= 20 * len(seen) + 1
    # independent draws of users and items reach nearly every unseen pair, both ends included
    unseen = {(float(u), float(i)) for u in range(30) for i in range(40)} - seen
    assert drawn <= unseen and len(drawn) > 0.9 * len(unseen)
    assert {i for _, i in drawn} == set(map(float, range(40)))


def test_draws_repeat(spark, indexed):
    again = [sorted(map(tuple, sampling.negatives_free(indexed.repartition(n), 2).collect())) for n in (1, 5)]
    assert again[0] == again[1]


def test_append_negatives(spark, indexed):
    df = sampling.append_negatives(indexed)
    assert df.columns == ["userId", "itemId", "label"]
    assert df.count() > indexed.count()
    assert df.join(indexed, ["userId", "itemId", "label"], "left_semi").count() == indexed.count()


def test_negative_join(spark, indexed):
    users = spark.createDataFrame([(float(u), [1.0, float(u)]) for u in range(30)], "userId double, userVec array<float>")
    items = spark.createDataFrame([(float(i), [float(i), 1.0]) for i in range(39)], "itemId double, itemVec array<float>")
    rows = sampling.negative_join(indexed, items, users, k=2).collect()
    expected = [p for p in observed(indexed) if p[1] < 39]
    positives = {(r["userId"], r["itemId"]) for r in rows} & set(expected)
    assert positives == set(expected)  # items without a vector leave
    scores = [r["cosineSimilarity"] for r in rows]
    assert scores == sorted(scores, reverse=True)
    top = rows[0]
    dot = top["userVec"][0] * top["itemVec"][0] + top["userVec"][1] * top["itemVec"][1]
    norms = sum(v * v for v in top["userVec"]) ** 0.5 * sum(v * v for v in top["itemVec"]) ** 0.5
    assert scores[0] == pytest.approx(abs(dot) / norms)


def test_index_interactions_makes_its_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(i % 7, i % 5, 1.0) for i in range(70)] + [(None, 1, 0.0), (1, None, 0.0)]
    df = spark.createDataFrame(rows, "userId long, itemId long, label double")
    counted = df.coalesce(1).mapInArrow(seen, df.schema)
    got = {tuple(r) for r in indexing.index_interactions(counted).collect()}
    assert made.value == len(rows)
    assert len(got) == 35 and got == {tuple(r) for r in indexing.index_interactions(df).collect()}


def test_pairs_without_vectors_leave_before_the_draws_are_sorted_out(spark, indexed):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    counted = indexed.coalesce(1).mapInArrow(seen, indexed.schema)
    users = spark.createDataFrame([(u, [1.0, float(u)]) for u in range(0, 30, 3)], "userId long, userVec array<float>")
    items = spark.createDataFrame([(float(i), [float(i), 1.0]) for i in range(9)] * 2, "itemId double, itemVec array<float>")
    pairs = sampling.scored_with_negatives(counted, items, users, k=2).select("userId", "itemId", "label")
    found = sorted(map(tuple, pairs.collect()))
    assert made.value == indexed.count()  # stored, and read from there
    whole = indexed.unionByName(sampling.negatives_per_positive(indexed, 2))
    assert found == sorted(2 * [tuple(r) for r in whole.where("userId % 3 = 0 and itemId < 9").select("userId", "itemId", "label").collect()])
    few = sampling.scored_with_negatives(indexed, items, users, k=2, limit=0).select("userId", "itemId", "label")
    assert sorted(map(tuple, few.collect())) == found  # dictionaries too large to be looked up in place
