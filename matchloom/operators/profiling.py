"""Counts that describe a data set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import labels, text
from matchloom.operators.interactions import digest_pairs


def distinct_counts(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One row with the number of distinct values of each column group, in one pass.

    A group counts its rows without NULLs.
    """
    return df.agg(*[F.count_distinct(*[F.col(c) for c in cols]).alias(name) for name, cols in groups.items()])


def count_of_counts(df: DataFrame, key: str, value: str, count: str, keys: str) -> DataFrame:
    """How many keys have how many distinct values, ordered."""
    per_key = df.select(key, value).dropna(subset=[key]).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return per_key.groupBy(count).agg(F.count(F.lit(1)).alias(keys)).orderBy(count)


def rows_per_key_distribution(df: DataFrame, key: str, count: str, keys: str) -> DataFrame:
    """How many keys have how many rows, ordered."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return per_key.groupBy(count).agg(F.count(F.lit(1)).alias(keys)).orderBy(count)


def group_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).count()


def _tidy(counts: DataFrame, section: str) -> DataFrame:
    """One row of counts to (section, metric, value) rows."""
    metrics = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in counts.columns]
    )
    return counts.select(F.inline(metrics)).select(F.lit(section).alias("section"), "metric", "value")


def _present(*columns: str) -> Column:
    out = F.lit(True)
    for column in columns:
        out = out & F.col(column).isNotNull()
    return out


def profile_items(raw: DataFrame) -> DataFrame:
    """Distinct items, ids, titles and descriptions of complete rows."""
    items = raw.where(_present("jobs_job_id", "jobs_title", "jobs_description")).select(
        "jobs_job_id", "jobs_title", text.doc_key(F.col("jobs_description")).alias("description")
    )
    groups = {
        "items": ["jobs_job_id", "jobs_title", "description"],
        "ids": ["jobs_job_id"],
        "ids_titles": ["jobs_job_id", "jobs_title"],
        "ids_descriptions": ["jobs_job_id", "description"],
    }
    return _tidy(distinct_counts(items, groups), "item")


def profile_users(raw: DataFrame) -> DataFrame:
    """Distinct URLs, ids and documents of rows with a user document."""
    users = raw.select(
        "resume_url",
        text.id_from_url(F.col("resume_url")).alias("resume_id"),
        text.doc_key(F.col("resume.resume.normalizedBody")).alias("body"),
    ).where(_present("body", "resume_id"))
    groups = {"urls": ["resume_url"], "ids": ["resume_id"], "ids_documents": ["resume_id", "body"]}
    return _tidy(distinct_counts(users, groups), "user")


def profile_applications(raw: DataFrame) -> DataFrame:
    """Rows, distinct ids and complete rows of the applications with a user id.

    Only the rows with content need documents, and they are counted by digests of one document at a time.
    """
    rows = raw.select(
        "resume_url",
        "jobs_job_id",
        text.id_from_url(F.col("resume_url")).alias("resume_id"),
        labels.application_status(F.col("new_application")).alias("label"),
        F.col("resume.resume.normalizedBody").alias("body"),
        F.col("jobs_description").alias("description"),
    )
    known = F.col("resume_id").isNotNull()
    complete = known & F.col("jobs_job_id").isNotNull() & F.col("label").isNotNull()
    content = digest_pairs(rows, ["resume_id", "jobs_job_id", "label"], "body", "description")
    # structs count as values even when an item id in them is NULL
    item_id, id_pair = F.struct("jobs_job_id"), F.struct("resume_id", "jobs_job_id")
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(known).alias("applications"),
        F.count_distinct(F.when(known, F.col("resume_url"))).alias("urls"),
        F.count_distinct(F.when(known, item_id)).alias("item_ids"),
        F.count_distinct(F.col("resume_id")).alias("user_ids"),
        F.count_distinct(F.when(known, id_pair)).alias("pairs"),
        F.count_if(complete).alias("complete"),
    )
    whole = content.agg(F.count(F.lit(1)).alias("complete_with_content"))
    return _tidy(counts.crossJoin(F.broadcast(whole)), "application")


def items_per_user(raw: DataFrame) -> DataFrame:
    """How many users have how many different items, by user ids from URLs."""
    rows = raw.select(text.id_from_url(F.col("resume_url")).alias("resume_id"), "jobs_job_id")
    counts = count_of_counts(rows, "resume_id", "jobs_job_id", "items", "value")
    return counts.select(F.lit("items_per_user").alias("section"), F.col("items").cast("string").alias("metric"), "value")


def profile_report(raw: DataFrame) -> DataFrame:
    """All sections as (section, metric, value)."""
    sections = (profile_items(raw), profile_users(raw), profile_applications(raw), items_per_user(raw))
    return reduce(DataFrame.unionByName, sections)
