"""Cross-scored top-k, ranking metrics and threshold metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    SQL_RANKED_PAIRS,
    SQL_SCORED_PAIRS,
    TOP,
    ctes,
    item_dict,
    ranked_pairs,
    scored_pairs,
    sql_round,
    user_dict,
)
from catalog.registry import query
from matchloom.functions.labels import rounded
from matchloom.operators.ranking import best_items, best_label_row, rank_in_user
from matchloom.operators.ranking_metrics import (
    SWEEP_DEPTHS,
    hit_ratio_ndcg,
    hit_ratio_ndcg_sweep,
    mean_positive_rank,
    rank_distribution,
    users_without_hit,
)
from matchloom.operators.thresholds import (
    cut_summary,
    precision_recall_at,
    precision_recall_curve,
    score_buckets,
)


def _rounded(df, *columns):
    return df.withColumns({c: rounded(F.col(c)) for c in columns})


@query("cross_topk", ctes(SQL_RANKED_PAIRS) + "SELECT * FROM ranked_pairs")
def cross_topk(spark, sf):
    return ranked_pairs(spark, sf)


@query("top_items", ctes(SQL_RANKED_PAIRS) + "SELECT * FROM best WHERE rank <= 10")
def top_items(spark, sf):
    return best_items(user_dict(spark, sf), item_dict(spark, sf), 10)


@query(
    "rank_in_user",
    ctes(SQL_SCORED_PAIRS)
    + """SELECT *, (rank() OVER (PARTITION BY "userId" ORDER BY score DESC NULLS LAST))::INT AS rank
    FROM scored_pairs QUALIFY rank <= 5""",
)
def rank_in_user_table(spark, sf):
    return rank_in_user(scored_pairs(spark, sf), 5)


_BEST_LABEL = """best_label AS (
  SELECT * FROM ranked_pairs WHERE rank <= 30
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY label DESC NULLS LAST, rank, "itemId") = 1)"""


@query("best_label_row", ctes(SQL_RANKED_PAIRS, _BEST_LABEL) + "SELECT * FROM best_label")
def best_label_rows(spark, sf):
    return best_label_row(ranked_pairs(spark, sf).where(F.col("rank") <= 30))


@query(
    "hit_ndcg",
    ctes(SQL_RANKED_PAIRS, _BEST_LABEL)
    + f"""SELECT {sql_round("avg(CASE WHEN label <> 0 THEN 1 ELSE 0 END)")} AS "hitRatio",
       {sql_round("avg(CASE WHEN label = 1 THEN ln(2) / ln(rank + 1) ELSE 0 END)")} AS ndcg FROM best_label""",
)
def hit_ndcg(spark, sf):
    return _rounded(hit_ratio_ndcg(ranked_pairs(spark, sf), 30), "hitRatio", "ndcg")


@query(
    "hit_ndcg_sweep",
    ctes(
        SQL_RANKED_PAIRS,
        'first AS (SELECT "userId", min(rank) FILTER (label = 1) AS f FROM ranked_pairs WHERE rank <= 30 GROUP BY ALL)',
    )
    + f"""SELECT k, {sql_round("avg(CASE WHEN f <= k THEN 1 ELSE 0 END)")} AS "hitRatio",
       {sql_round("avg(CASE WHEN f <= k THEN ln(2) / ln(f + 1) ELSE 0 END)")} AS ndcg
    FROM first, (SELECT unnest({SWEEP_DEPTHS}) AS k) GROUP BY k""",
)
def hit_ndcg_sweep(spark, sf):
    return _rounded(hit_ratio_ndcg_sweep(ranked_pairs(spark, sf)), "hitRatio", "ndcg")


_MEAN_RANK = f"""mean_rank AS (
  SELECT "userId", coalesce(avg(rank) FILTER (label = 1), {TOP + 1}) AS "meanRank" FROM ranked_pairs GROUP BY ALL)"""


@query(
    "mean_positive_rank",
    ctes(SQL_RANKED_PAIRS, _MEAN_RANK) + f"""SELECT "userId", {sql_round('"meanRank"')} AS "meanRank" FROM mean_rank""",
)
def mean_positive_ranks(spark, sf):
    return _rounded(mean_positive_rank(ranked_pairs(spark, sf), TOP), "meanRank")


@query(
    "rank_distribution",
    ctes(SQL_RANKED_PAIRS, _MEAN_RANK)
    + """SELECT trunc("meanRank")::INT AS "roundRank", count(*) AS count FROM mean_rank GROUP BY 1""",
)
def rank_distribution_table(spark, sf):
    return rank_distribution(ranked_pairs(spark, sf), TOP)


@query(
    "users_without_hit",
    ctes(SQL_RANKED_PAIRS)
    + """SELECT DISTINCT "userId" FROM ranked_pairs
    WHERE "userId" NOT IN (SELECT "userId" FROM ranked_pairs WHERE label = 1)""",
)
def users_without_hits(spark, sf):
    return users_without_hit(ranked_pairs(spark, sf), TOP)


@query(
    "pr_at_cut",
    ctes(SQL_SCORED_PAIRS)
    + f"""SELECT 0.1::DOUBLE AS cut,
      {sql_round("count(*) FILTER (score > 0.1 AND label = 1) / nullif(count(*) FILTER (score > 0.1), 0)")} AS precision,
      {sql_round("count(*) FILTER (score > 0.1 AND label = 1) / nullif(count(*) FILTER (label = 1), 0)")} AS recall
    FROM scored_pairs""",
)
def pr_at_cut(spark, sf):
    return _rounded(precision_recall_at(scored_pairs(spark, sf), 0.1), "precision", "recall")


_CUTS = "cuts AS (SELECT round(n / 50e0, 2) AS cut FROM range(1, 50) t(n))"


@query(
    "cut_summary",
    ctes(SQL_SCORED_PAIRS, _CUTS)
    + "SELECT cut, count(score) AS above FROM cuts LEFT JOIN scored_pairs ON score > cut GROUP BY cut",
)
def cut_summary_table(spark, sf):
    return cut_summary(scored_pairs(spark, sf))


@query(
    "pr_curve",
    ctes(SQL_SCORED_PAIRS, _CUTS)
    + f"""SELECT cut, {sql_round("count(*) FILTER (label = 1) / nullif(count(score), 0)")} AS precision,
       {sql_round("count(*) FILTER (label = 1) / nullif((SELECT count(*) FROM scored_pairs WHERE label = 1), 0)")} AS recall
    FROM cuts LEFT JOIN scored_pairs ON score > cut GROUP BY cut""",
)
def pr_curve(spark, sf):
    return _rounded(precision_recall_curve(scored_pairs(spark, sf)), "precision", "recall")


@query(
    "score_buckets",
    ctes(SQL_SCORED_PAIRS)
    + f"""SELECT trunc(score * 10)::INT AS bucket, count(*) AS count,
       {sql_round("count(*) / sum(count(*)) OVER ()")} AS percent
    FROM scored_pairs WHERE label = 1 GROUP BY 1""",
)
def score_bucket_table(spark, sf):
    return _rounded(score_buckets(scored_pairs(spark, sf)), "percent")
