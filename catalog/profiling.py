"""Profiling counts, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    SQL_LINES,
    SQL_PAIRS,
    SQL_RANKED_PAIRS,
    SQL_RAW_APPLICATIONS,
    SQL_RAW_CLICKS,
    SQL_SCORED_PAIRS,
    ctes,
    order_lines,
    pairs,
    ranked_pairs,
    raw_applications,
    raw_clicks,
    scored_pairs,
    sql_id_from_url,
    table,
)
from catalog.registry import query
from matchloom.operators import profiling
from matchloom.operators.models import in_cluster
from matchloom.operators.ranking_metrics import any_hit


def _sql_tidy(section: str, source: str, metrics: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{section}' AS section, '{m}' AS metric, {m} AS value FROM {source}" for m in metrics)
    return rows


_ITEMS = """item_counts AS (
  SELECT count(DISTINCT (jobs_job_id, jobs_title, jobs_description)) AS items, count(DISTINCT jobs_job_id) AS ids,
         count(DISTINCT (jobs_job_id, jobs_title)) AS ids_titles,
         count(DISTINCT (jobs_job_id, jobs_description)) AS ids_descriptions
  FROM raw_applications WHERE jobs_job_id IS NOT NULL AND jobs_title IS NOT NULL AND jobs_description IS NOT NULL)"""
_WITH_ID = f"""with_id AS (SELECT *, {sql_id_from_url("resume_url")} AS resume_id,
  CASE WHEN new_application IS NOT NULL THEN 1e0 END AS label FROM raw_applications)"""
_USERS = """user_counts AS (
  SELECT count(DISTINCT resume_url) AS urls, count(DISTINCT resume_id) AS ids,
         count(DISTINCT (resume_id, body)) AS ids_documents
  FROM with_id WHERE body IS NOT NULL AND resume_id IS NOT NULL)"""
_APPLICATIONS = """app_counts AS (
  SELECT (SELECT count(*) FROM with_id) AS rows, count(*) AS applications, count(DISTINCT resume_url) AS urls,
         count(DISTINCT jobs_job_id) AS item_ids, count(DISTINCT resume_id) AS user_ids,
         count(DISTINCT (resume_id, jobs_job_id)) AS pairs,
         count(*) FILTER (jobs_job_id IS NOT NULL AND label IS NOT NULL) AS complete,
         count(DISTINCT (resume_id, jobs_job_id, label, body, jobs_description))
           FILTER (jobs_job_id IS NOT NULL AND label IS NOT NULL AND body IS NOT NULL AND jobs_description IS NOT NULL)
           AS complete_with_content
  FROM with_id WHERE resume_id IS NOT NULL)"""
_ITEM_ROWS = _sql_tidy("item", "item_counts", ["items", "ids", "ids_titles", "ids_descriptions"])
_USER_ROWS = _sql_tidy("user", "user_counts", ["urls", "ids", "ids_documents"])
_APPLICATION_ROWS = _sql_tidy(
    "application",
    "app_counts",
    ["rows", "applications", "urls", "item_ids", "user_ids", "pairs", "complete", "complete_with_content"],
)
_ITEMS_PER_USER = """SELECT 'items_per_user' AS section, items::VARCHAR AS metric, count(*) AS value
  FROM (SELECT resume_id, count(*) AS items
    FROM (SELECT DISTINCT resume_id, jobs_job_id FROM with_id WHERE resume_id IS NOT NULL) GROUP BY resume_id)
  GROUP BY items"""


@query(
    "profile_report",
    ctes(SQL_RAW_APPLICATIONS, _WITH_ID, _ITEMS, _USERS, _APPLICATIONS)
    + f"{_ITEM_ROWS} UNION ALL {_USER_ROWS} UNION ALL {_APPLICATION_ROWS} UNION ALL {_ITEMS_PER_USER}",
)
def profile_report(spark, sf):
    return profiling.profile_report(raw_applications(spark, sf))


@query("profile_items", ctes(SQL_RAW_APPLICATIONS, _ITEMS) + _ITEM_ROWS)
def profile_items(spark, sf):
    return profiling.profile_items(raw_applications(spark, sf))


@query("profile_users", ctes(SQL_RAW_APPLICATIONS, _WITH_ID, _USERS) + _USER_ROWS)
def profile_users(spark, sf):
    return profiling.profile_users(raw_applications(spark, sf))


@query("profile_applications", ctes(SQL_RAW_APPLICATIONS, _WITH_ID, _APPLICATIONS) + _APPLICATION_ROWS)
def profile_applications(spark, sf):
    return profiling.profile_applications(raw_applications(spark, sf))


@query(
    "distinct_profile",
    ctes(SQL_LINES)
    + """SELECT count(DISTINCT "userId") AS users, count(DISTINCT "itemId") AS items,
       count(DISTINCT ("userId", "itemId")) AS pairs,
       count(DISTINCT ("userId", "itemId", l_returnflag, l_linestatus)) AS rows FROM lines""",
)
def distinct_profile(spark, sf):
    groups = {
        "users": ["userId"],
        "items": ["itemId"],
        "pairs": ["userId", "itemId"],
        "rows": ["userId", "itemId", "l_returnflag", "l_linestatus"],
    }
    return profiling.distinct_counts(order_lines(spark, sf), groups)


@query(
    "count_of_counts",
    ctes(SQL_LINES)
    + """SELECT job_count, count(*) AS resume_count
    FROM (SELECT "userId", count(DISTINCT "itemId") AS job_count FROM lines GROUP BY "userId") GROUP BY job_count""",
)
def count_of_counts(spark, sf):
    return profiling.count_of_counts(order_lines(spark, sf), "userId", "itemId", "job_count", "resume_count")


@query(
    "label_histogram",
    ctes(SQL_PAIRS)
    + """SELECT apply_count, count(*) AS count
    FROM (SELECT "userId", count(*) AS apply_count FROM pairs WHERE label = 1 GROUP BY "userId") GROUP BY apply_count""",
)
def label_histogram(spark, sf):
    positives = pairs(spark, sf).where(F.col("label") == 1)
    return profiling.rows_per_key_distribution(positives, "userId", "apply_count", "count")


@query("group_counts", "SELECT event_type, user_id, count(*) AS count FROM events GROUP BY ALL")
def group_counts(spark, sf):
    return profiling.group_counts(table(spark, sf, "events"), "event_type", "user_id")


@query("click_outcomes", ctes(SQL_RAW_CLICKS) + "SELECT apply_flag, is_clicked, count(*) AS count FROM raw_clicks GROUP BY ALL")
def click_outcomes(spark, sf):
    return profiling.group_counts(raw_clicks(spark, sf), "apply_flag", "is_clicked")


@query(
    "greatest_ids",
    ctes(SQL_PAIRS) + 'SELECT max("userId") AS users, max("itemId") AS items, count(*) AS rows FROM pairs',
)
def greatest_ids(spark, sf):
    return pairs(spark, sf).agg(
        F.max("userId").alias("users"), F.max("itemId").alias("items"), F.count(F.lit(1)).alias("rows")
    )


@query("distinct_rows", 'SELECT DISTINCT user_id, event_type FROM events')
def distinct_rows(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@query(
    "collected_classes",
    "SELECT label, count(*)::INT AS n, sum(vec_id)::BIGINT AS ids FROM embeddings GROUP BY label",
)
def collected_classes(spark, sf):
    """What a collected list per key would serve for: its size and fold, without collecting."""
    return table(spark, sf, "embeddings").groupBy("label").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.sum("vec_id").alias("ids")
    )


@query(
    "cluster_semi_join",
    ctes(SQL_PAIRS)
    + """SELECT * FROM pairs WHERE "userId" IN (SELECT vec_id FROM embeddings WHERE label = 3)""",
)
def cluster_semi_join(spark, sf):
    users = table(spark, sf, "embeddings").select(F.col("vec_id").alias("userId"), F.col("label").alias("kth"))
    return in_cluster(pairs(spark, sf), users, 3)


@query(
    "hit_and_other_users",
    ctes(SQL_RANKED_PAIRS)
    + """SELECT "userId", max(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS hit FROM ranked_pairs GROUP BY "userId" """,
)
def hit_and_other_users(spark, sf):
    """Users with a hit and users without, from one aggregate."""
    return any_hit(ranked_pairs(spark, sf), 50)


@query(
    "sorted_scores",
    ctes(SQL_SCORED_PAIRS) + 'SELECT * FROM scored_pairs ORDER BY score DESC NULLS LAST, "userId", "itemId"',
)
def sorted_scores(spark, sf):
    return scored_pairs(spark, sf).orderBy(F.desc_nulls_last("score"), "userId", "itemId")


@query(
    "first_rows",
    ctes(SQL_SCORED_PAIRS) + 'SELECT * FROM scored_pairs ORDER BY score DESC NULLS LAST, "userId", "itemId" LIMIT 20',
)
def first_rows(spark, sf):
    """The report of the best-scored pairs."""
    return sorted_scores(spark, sf).limit(20)
