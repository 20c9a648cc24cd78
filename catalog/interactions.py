"""Reading, projecting and filtering interactions; labels and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    EMBEDDING_DIM,
    SQL_PAIRS,
    SQL_RAW_APPLICATIONS,
    SQL_RAW_CLICKS,
    SQL_SCORED_PAIRS,
    ctes,
    pairs,
    raw_applications,
    raw_clicks,
    scored_pairs,
    scratch_path,
    sql_id_from_url,
    table,
    user_dict,
    item_dict,
    vector_pairs,
)
from catalog.registry import query
from matchloom.functions import labels, text
from matchloom.operators.interactions import (
    distinct_values,
    drop_nulls,
    from_applications,
    from_clicks,
    keep_long_vectors,
)
from matchloom.sources.tables import read_preprocessed, read_table, write_preprocessed


def _digests(df):
    return df.withColumns({c: text.doc_key(F.col(c)) for c in ("userDoc", "itemDoc")})


@query(
    "parquet_glob_scan",
    "SELECT vec_id, label, len(embedding)::INT AS width FROM embeddings",
)
def parquet_glob_scan(spark, sf):
    df = read_table(spark, f"{sf}/embedding*.parquet", table(spark, sf, "embeddings").schema)
    return df.select("vec_id", "label", F.size("embedding").alias("width"))


@query(
    "preprocessed_roundtrip",
    ctes(SQL_PAIRS)
    + """SELECT p.*, u.label AS user_class, i.label AS item_class FROM pairs p
    JOIN embeddings u ON u.vec_id = p."userId" JOIN embeddings i ON i.vec_id = p."itemId" """,
)
def preprocessed_roundtrip(spark, sf):
    """The three tables written over and read back, original ids dropped on the way."""
    path = scratch_path(spark, "preprocessed")
    ids = {"userIdOrg": F.col("userId").cast("string"), "itemIdOrg": F.col("itemId").cast("string")}
    classes = table(spark, sf, "embeddings").select("vec_id", "label")
    users = user_dict(spark, sf).join(
        classes.select(F.col("vec_id").alias("userId"), F.col("label").alias("user_class")), "userId"
    )
    items = item_dict(spark, sf).join(
        classes.select(F.col("vec_id").alias("itemId"), F.col("label").alias("item_class")), "itemId"
    )
    for _ in range(2):  # the second write replaces the first
        write_preprocessed(pairs(spark, sf).withColumns(ids), users, items, path, files=16)
    indexed, users, items = read_preprocessed(spark, path)
    return indexed.join(users.drop("userVec"), "userId").join(items.drop("itemVec"), "itemId")


@query(
    "canonical_clicks",
    ctes(SQL_RAW_CLICKS)
    + """SELECT resume_id AS "userId", job_id AS "itemId", md5(body) AS "userDoc", md5(description) AS "itemDoc",
       is_clicked + 1 AS label FROM raw_clicks WHERE body IS NOT NULL AND description IS NOT NULL""",
)
def canonical_clicks(spark, sf):
    return _digests(from_clicks(raw_clicks(spark, sf)))


@query(
    "canonical_applications",
    ctes(SQL_RAW_APPLICATIONS)
    + f"""SELECT {sql_id_from_url("resume_url")} AS "userId", job_id AS "itemId", md5(body) AS "userDoc",
       md5(jobs_description) AS "itemDoc", CASE WHEN new_application IS NOT NULL THEN 1e0 END AS label
    FROM raw_applications""",
)
def canonical_applications(spark, sf):
    return _digests(from_applications(raw_applications(spark, sf)))


@query(
    "not_null_guard",
    ctes(SQL_RAW_APPLICATIONS)
    + """SELECT count(*) AS rows, count(DISTINCT resume_url) AS urls FROM raw_applications
    WHERE resume_url IS NOT NULL AND body IS NOT NULL AND jobs_description IS NOT NULL
      AND new_application IS NOT NULL""",
)
def not_null_guard(spark, sf):
    raw = raw_applications(spark, sf).withColumn("body", F.col("resume.resume.normalizedBody"))
    complete = drop_nulls(raw, ["resume_url", "body", "jobs_description", "new_application"])
    return complete.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("resume_url").alias("urls"))


@query("distinct_values", "SELECT DISTINCT l_partkey::VARCHAR AS l_partkey FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_value_table(spark, sf):
    return distinct_values(table(spark, sf, "lineitem"), "l_partkey")


@query(
    "size_filter",
    "SELECT vec_id, len(embedding)::INT AS width FROM embeddings WHERE len(embedding) > 1",
)
def size_filter(spark, sf):
    kept = keep_long_vectors(table(spark, sf, "embeddings"), "embedding")
    return kept.select("vec_id", F.size("embedding").alias("width"))


@query(
    "label_functions",
    ctes(SQL_SCORED_PAIRS)
    + """SELECT "userId", "itemId", label + 1 AS one_based, CASE WHEN label + 1 > 1 THEN 1e0 ELSE 0e0 END AS zero_based,
       CASE WHEN score > 0.1 THEN 1e0 ELSE 0e0 END AS predicted, trunc(score * 10)::INT AS bucket,
       round(score, 3) AS score3, 1e0 AS status, CASE WHEN label = 1 THEN 1e0 ELSE 0e0 END AS click FROM scored_pairs""",
)
def label_functions(spark, sf):
    label, score = F.col("label"), F.col("score")
    return scored_pairs(spark, sf).select(
        "userId",
        "itemId",
        labels.add_one(label).alias("one_based"),
        labels.to_zero_one(labels.add_one(label)).alias("zero_based"),
        labels.score_to_label(score, 0.1).alias("predicted"),
        labels.score_to_bucket(score).alias("bucket"),
        labels.to_decimal(score, 3).alias("score3"),
        labels.application_status(label == 1).alias("status"),
        labels.click_label(F.lit(True), label == 1).alias("click"),
    )


@query(
    "attach_vectors",
    ctes(SQL_PAIRS)
    + """SELECT "userId", "itemId", p.label, len(u.embedding)::INT AS user_width, len(i.embedding)::INT AS item_width
    FROM pairs p JOIN embeddings u ON u.vec_id = "userId" JOIN embeddings i ON i.vec_id = "itemId" """,
)
def attach_vector_columns(spark, sf):
    return vector_pairs(spark, sf).select(
        "userId", "itemId", "label", F.size("userVec").alias("user_width"), F.size("itemVec").alias("item_width")
    )


@query(
    "predictions_with_features",
    ctes(SQL_SCORED_PAIRS)
    + f"""SELECT "userId", "itemId", s.label, score, {2 * EMBEDDING_DIM} AS width FROM scored_pairs s""",
)
def predictions_with_features(spark, sf):
    """Predictions joined back to their features on user and item."""
    features = vector_pairs(spark, sf).select(
        "userId", "itemId", (F.size("userVec") + F.size("itemVec")).alias("width")
    )
    return scored_pairs(spark, sf).join(features, ["userId", "itemId"])
