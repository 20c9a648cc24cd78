import math
import random
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.operators import nearest, ranking, ranking_metrics, thresholds
from matchloom.operators.nearest import best_candidates

SCORED = "userId int, itemId int, score double, label double"


def scored(spark, rows):
    return spark.createDataFrame(rows, SCORED)


def test_ties_share_a_rank_and_nulls_come_last(spark):
    df = scored(spark, [(1, 1, 0.9, None), (1, 2, 0.5, None), (1, 3, 0.5, None), (1, 4, None, None), (1, 5, 0.1, None)])
    got = {r["itemId"]: r["rank"] for r in ranking.rank_in_user(df, 2).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    assert {r["itemId"]: r["rank"] for r in ranking.rank_in_user(df, 9).collect()}[4] == 5


def test_best_label_row(spark):
    df = spark.createDataFrame(
        [(1, 7, 3, 1.0), (1, 6, 2, 1.0), (1, 5, 2, 1.0), (1, 4, 1, 0.0), (2, 1, 1, None), (2, 2, 2, 0.0), (3, 1, 4, None)],
        "userId int, itemId int, rank int, label double",
    )
    got = {r["userId"]: r["itemId"] for r in ranking.best_label_row(df).collect()}
    assert got == {1: 5, 2: 2, 3: 1}


def _dictionaries(spark, users, items):
    return (
        spark.createDataFrame([(n, list(map(float, v))) for n, v in enumerate(users)], "userId int, userVec array<double>"),
        spark.createDataFrame([(f"i{n}", list(map(float, v))) for n, v in enumerate(items)], "itemId string, itemVec array<double>"),
    )


def _brute(users, items, k, digits=6):
    out = {}
    for n, u in enumerate(users):
        scores = {}
        for m, i in enumerate(items):
            norms = np.linalg.norm(u) * np.linalg.norm(i)
            if norms > 0:
                scores[f"i{m}"] = round(abs(float(np.dot(u, i) / norms)), digits)
        for m, s in scores.items():
            rank = 1 + sum(t > s for t in scores.values())
            if rank <= k:
                out[(n, m)] = (pytest.approx(s, abs=2e-6), rank)
    return out


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("k", [1, 5])
def test_best_items_equal_brute_force(spark, clustered, k):
    draw = np.random.default_rng(7)
    if clustered:
        centres = draw.normal(size=(6, 5))
        users = [centres[draw.integers(6)] + 0.1 * draw.normal(size=5) for _ in range(60)]
        items = [draw.choice([-1, 1]) * (centres[draw.integers(6)] + 0.1 * draw.normal(size=5)) for _ in range(150)]
    else:
        users, items = list(draw.normal(size=(60, 5))), list(draw.normal(size=(150, 5)))
    items += [items[0]] * 40 + [2 * items[1], -items[1], np.zeros(5)]  # a crowd of equals, multiples, a zero vector
    user_dict, item_dict = _dictionaries(spark, users, items)
    expected = _brute(users, items, k)
    blocks = {"tile_rows": 16, "broadcast_bytes": 0}
    for limits in ({}, {"tile_rows": 16}, blocks, blocks | {"block_bytes": 8 * 5 * 37}):
        rows = ranking.best_items(user_dict, item_dict, k, **limits).collect()
        assert {(r["userId"], r["itemId"]): (r["score"], r["rank"]) for r in rows} == expected
        assert len(rows) == len(expected)


def test_few_rows_leave_the_tasks(spark):
    """Best items of a user leave once per item block, and vectors move once per block of the other side."""
    draw = np.random.default_rng(3)
    user_dict, item_dict = _dictionaries(spark, list(draw.normal(size=(160, 8))), list(draw.normal(size=(200, 8))))
    assert best_candidates(user_dict, item_dict, 3).count() == 160 * 3
    blocks = best_candidates(user_dict, item_dict, 3, broadcast_bytes=0, block_bytes=50 * 8 * 8)  # 4 by 4 blocks
    assert blocks.count() == 4 * 160 * 3
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_dictionaries(spark):
    user_dict, item_dict = _dictionaries(spark, [[1, 0]], [[1, 0]])
    zero = item_dict.withColumn("itemVec", F.array(F.lit(0.0), F.lit(0.0)))
    for limit in (0, 1 << 20):
        for users, items in ((user_dict.limit(0), item_dict), (user_dict, item_dict.limit(0)), (user_dict, zero)):
            assert ranking.best_items(users, items, 2, broadcast_bytes=limit).count() == 0


def test_task_functions_need_no_package():
    """A worker without this package can load what it is sent."""
    from pyspark import cloudpickle

    best = nearest._best(3, 6, 2, 16)
    tasks = [nearest._against_all(best, None), nearest._block_against_block(best)]
    load = "import pickle, sys; pickle.loads(sys.stdin.buffer.read())"
    for task in tasks:
        subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(task), cwd="/", env={}, check=True)


def test_cross_top_k_labels(spark):
    user_dict, item_dict = _dictionaries(spark, [[1, 0], [0, 1]], [[1, 0], [1, 1]])
    indexed = spark.createDataFrame([(0, "i0", 1.0), (1, "i0", 0.0)], "userId int, itemId string, label double")
    got = sorted(tuple(r) for r in ranking.cross_top_k(user_dict, item_dict, indexed, 1).collect())
    assert got == [(0, "i0", 1.0, 1, 1.0), (1, "i1", 0.707107, 1, None)]


def test_vectors_of_different_size(spark):
    user_dict, item_dict = _dictionaries(spark, [[1, 0]], [[1, 0, 1]])
    with pytest.raises(ValueError, match="differ in size"):
        ranking.best_items(user_dict, item_dict, 1)


RANKED = [
    (1, 1, 0.9, 1.0), (1, 2, 0.8, 1.0), (1, 3, 0.7, 0.0),
    (2, 1, 0.9, None), (2, 2, 0.8, 0.0), (2, 3, 0.7, 1.0),
    (3, 1, 0.9, None), (3, 2, 0.8, 0.0),
]


def test_rank_distribution(spark):
    df = scored(spark, RANKED)
    got = [tuple(r) for r in ranking_metrics.rank_distribution(df, 2).collect()]
    # user 1: mean of 1 and 2, truncated; users 2 and 3: nothing up to rank 2
    assert got == [(1, 1), (3, 2)]
    ranked = ranking.rank_in_user(df, 3)
    assert [tuple(r) for r in ranking_metrics.rank_distribution(ranked, 3).collect()] == [(1, 1), (3, 1), (4, 1)]
    assert [r["userId"] for r in ranking_metrics.users_without_hit(ranked, 3).collect()] == [3]


def test_hit_ratio_ndcg(spark):
    df = scored(spark, RANKED)
    row = ranking_metrics.hit_ratio_ndcg(df, 3).first()
    assert row["hitRatio"] == pytest.approx(2 / 3)
    assert row["ndcg"] == pytest.approx((1 + math.log(2) / math.log(4)) / 3)
    assert ranking_metrics.hit_ratio_ndcg(df, 2).first()["hitRatio"] == pytest.approx(1 / 3)


def test_sweep_equals_single_depths_and_never_falls(spark):
    draw = random.Random(2)
    rows = [(u, i, draw.random(), draw.choice([None, None, 0.0, 1.0])) for u in range(20) for i in range(25)]
    df = scored(spark, rows)
    sweep = {r["k"]: (r["hitRatio"], r["ndcg"]) for r in ranking_metrics.hit_ratio_ndcg_sweep(df).collect()}
    assert list(sweep) == [3, 5, 10, 15, 20, 30]
    for k in (3, 10, 30):
        single = ranking_metrics.hit_ratio_ndcg(df, k).first()
        assert sweep[k] == pytest.approx((single["hitRatio"], single["ndcg"]))
    ratios = [h for h, _ in sweep.values()]
    assert ratios == sorted(ratios)


def test_precision_recall_at(spark):
    df = scored(spark, [(1, 1, 0.5, 1.0), (1, 2, 0.6, 1.0), (1, 3, 0.7, 0.0), (1, 4, 0.1, 1.0)])
    assert tuple(thresholds.precision_recall_at(df, 0.5).first()) == (0.5, 0.5, pytest.approx(1 / 3))
    assert tuple(thresholds.precision_recall_at(df, 0.9).first())[1:] == (None, 0.0)
    negatives = df.where("label = 0")
    assert tuple(thresholds.precision_recall_at(negatives, 0.5).first())[1:] == (0.0, None)


def test_cut_summary_is_exact_on_the_cuts(spark):
    scores = [round(n / 100, 2) for n in range(0, 101)] + [-0.5, 1.7, None]
    df = scored(spark, [(1, n, s, 1.0) for n, s in enumerate(scores)])
    got = {r["cut"]: r["above"] for r in thresholds.cut_summary(df).collect()}
    cuts = [round(n * 0.02, 2) for n in range(1, 50)]
    assert sorted(got) == cuts
    assert got == {c: sum(s is not None and s > c for s in scores) for c in cuts}
    counts = [got[c] for c in cuts]
    assert counts == sorted(counts, reverse=True)


def test_precision_recall_curve(spark):
    draw = random.Random(4)
    rows = [(1, n, draw.random(), float(draw.randrange(2))) for n in range(300)]
    got = {r["cut"]: (r["precision"], r["recall"]) for r in thresholds.precision_recall_curve(scored(spark, rows)).collect()}
    for cut in (0.02, 0.5, 0.98):
        above = [l for _, _, s, l in rows if s > cut]
        assert got[cut] == pytest.approx((sum(above) / len(above), sum(above) / sum(l for *_, l in rows)))
    without = thresholds.precision_recall_curve(scored(spark, [(1, 1, 0.5, 0.0)])).where("cut = 0.02").first()
    assert (without["precision"], without["recall"]) == (0.0, None)


def test_score_buckets(spark):
    df = scored(spark, [(1, 1, 0.19, 1.0), (1, 2, 0.11, 1.0), (1, 3, 0.95, 1.0), (1, 4, 0.95, 0.0), (1, 5, 1.0, 1.0)])
    got = {r["bucket"]: (r["count"], r["percent"]) for r in thresholds.score_buckets(df).collect()}
    assert got == {1: (2, 0.5), 9: (1, 0.25), 10: (1, 0.25)}


def test_every_ranked_user_has_rank_one(spark):
    draw = random.Random(9)
    rows = [(u, i, round(draw.random(), 1), None) for u in range(15) for i in range(12)]
    ranks = defaultdict(set)
    for r in ranking.rank_in_user(scored(spark, rows), 4).collect():
        ranks[r["userId"]].add(r["rank"])
    assert len(ranks) == 15 and all(1 in r for r in ranks.values())


def test_score_pairs(spark):
    df = spark.createDataFrame([([1.0, 0.0], [-1.0, 0.0])], "userVec array<float>, itemVec array<float>")
    assert ranking.score_pairs(df).select(F.col("score")).first()[0] == 1.0
