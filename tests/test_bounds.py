"""What a worker or the driver holds at once stays bounded; the rows stay the same."""

import numpy as np
import pytest

from matchloom.operators import nearest
from matchloom.operators.ranking import best_items
from matchloom.operators.support import lookup_join


@pytest.mark.parametrize("most", [24 * 4 * 10, 1 << 30])
def test_results_of_a_group_are_bounded(spark, monkeypatch, most):
    draw = np.random.default_rng(5)
    users = spark.createDataFrame([(i, draw.normal(size=3).tolist()) for i in range(300)], "userId int, userVec array<double>")
    items = spark.createDataFrame([(i, draw.normal(size=3).tolist()) for i in range(90)], "itemId int, itemVec array<double>")
    asked, blocks = [], nearest._blocks
    monkeypatch.setattr(nearest, "_blocks", lambda df, own, count, *rest: asked.append((own, count)) or blocks(df, own, count, *rest))
    monkeypatch.setattr(nearest, "RESULT_BYTES", most)
    cut = {tuple(r) for r in best_items(users, items, 4, broadcast_bytes=0, block_bytes=24 * 400).collect()}
    assert cut == {tuple(r) for r in best_items(users, items, 4).collect()}
    assert dict(asked)["userBlock"] >= (30 if most < 1 << 30 else 1)  # ten users with four items each


def test_dictionaries_beyond_a_few_tiles_are_not_broadcast(spark):
    rows = spark.range(45_000).select("id")  # 45,000 vectors of 64 doubles: 23 MB
    from pyspark.sql import functions as F

    vec = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda p: (F.pmod(F.xxhash64("id", p), 1000) + 1).cast("double"))
    items = rows.select(F.col("id").alias("itemId"), vec.alias("itemVec"))
    users = items.limit(4).selectExpr("itemId AS userId", "itemVec AS userVec")
    plan = nearest.best_candidates(users, items, 3)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_lookups_the_driver_would_feel_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    lookup = spark.range(400_000).select(F.col("id").alias("key"), F.array_repeat(F.lit(0.5).cast("float"), 20).alias("vec"))
    facts = spark.range(1000).select(F.col("id").alias("key"))  # the lookup measures 48 MB
    joined = lookup_join(facts, lookup.checkpoint(), "key")
    assert "ResolvedHint (strategy=broadcast)" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 1000
