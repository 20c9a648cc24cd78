"""Vector functions, mean vectors and pair features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    EMBEDDING_DIM,
    SHIFT,
    SQL_COSINE,
    SQL_GOLDEN,
    SQL_PAIRS,
    WORD_DIM,
    ctes,
    pairs,
    raw_clicks,
    sql_round,
    spread,
    table,
    vector_pairs,
    word_vectors,
)
from catalog.registry import query
from matchloom.functions import vectors
from matchloom.functions.labels import rounded
from matchloom.operators.features import id_points, pair_rows, random_order, vector_points, with_pair_features
from matchloom.operators.vectorising import dictionary, mean_vectors
from matchloom.plans.preprocess import golden_frame


@query(
    "vector_stats",
    f"""SELECT vec_id, len(embedding)::INT AS width,
      {sql_round("list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])")} AS dot,
      {sql_round("sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))")} AS magnitude FROM embeddings""",
)
def vector_stats(spark, sf):
    vec = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id",
        vectors.array_length(vec).alias("width"),
        rounded(vectors.dot_product(vec, vec)).alias("dot"),
        rounded(vectors.magnitude(vec)).alias("magnitude"),
    )


_PAIR_VECTORS = """ FROM pairs p JOIN embeddings u ON u.vec_id = "userId" JOIN embeddings i ON i.vec_id = "itemId" """


@query(
    "cosine_pairs",
    ctes(SQL_PAIRS)
    + f"""SELECT "userId", "itemId", {sql_round(SQL_COSINE)} AS cosine, {sql_round(f"abs({SQL_COSINE})")} AS score"""
    + _PAIR_VECTORS,
)
def cosine_pairs(spark, sf):
    user, item = F.col("userVec"), F.col("itemVec")
    return vector_pairs(spark, sf).select(
        "userId",
        "itemId",
        rounded(vectors.cosine_similarity(user, item)).alias("cosine"),
        rounded(vectors.abs_cosine(user, item)).alias("score"),
    )


_POSITIONS = [0, EMBEDDING_DIM - 1, EMBEDDING_DIM, 2 * EMBEDDING_DIM - 1]
_BOTH = "list_concat(u.embedding, i.embedding)::DOUBLE[]"
_SQL_FEATURES = f"""len({_BOTH})::INT AS width, {sql_round(f"list_sum({_BOTH})")} AS total, """ + ", ".join(
    f"{sql_round(f'({_BOTH})[{p + 1}]')} AS f{p}" for p in _POSITIONS
)


def _feature_columns(features: str):
    total = F.aggregate(features, F.lit(0.0), lambda s, v: s + v)
    picked = [rounded(F.get(F.col(features), F.lit(p))).alias(f"f{p}") for p in _POSITIONS]
    return [F.size(features).alias("width"), rounded(total).alias("total"), *picked]


@query("pair_features", ctes(SQL_PAIRS) + f'SELECT "userId", "itemId", {_SQL_FEATURES}' + _PAIR_VECTORS)
def pair_features(spark, sf):
    return with_pair_features(vector_pairs(spark, sf)).select("userId", "itemId", *_feature_columns("features"))


@query("pair_rows", ctes(SQL_PAIRS) + f'SELECT "userId", "itemId", p.label, {_SQL_FEATURES}' + _PAIR_VECTORS)
def pair_row_table(spark, sf):
    rows = pair_rows(vector_pairs(spark, sf)).withColumn("f", vectors.ml_vector_to_array(F.col("features")))
    return rows.select("userId", "itemId", "label", *_feature_columns("f"))


@query("vector_points", ctes(SQL_PAIRS) + f"SELECT p.label, {_SQL_FEATURES}" + _PAIR_VECTORS)
def vector_point_table(spark, sf):
    points = vector_points(vector_pairs(spark, sf), seed=1)
    return points.withColumn("f", vectors.ml_vector_to_array(F.col("features"))).select(
        "label", *_feature_columns("f")
    )


@query(
    "id_points",
    ctes(SQL_PAIRS) + 'SELECT "userId"::DOUBLE AS user_feature, "itemId"::DOUBLE AS item_feature, label FROM pairs',
)
def id_point_table(spark, sf):
    points = id_points(pairs(spark, sf), seed=1).withColumn("f", vectors.ml_vector_to_array(F.col("features")))
    return points.select(F.col("f")[0].alias("user_feature"), F.col("f")[1].alias("item_feature"), "label")


@query("random_order", "SELECT * FROM labels")
def rows_in_random_order(spark, sf):
    return random_order(table(spark, sf, "labels"), seed=1)


@query(
    "vector_conversion",
    f"""SELECT vec_id, {sql_round("list_sum(embedding::DOUBLE[])")} AS total, len(embedding)::INT AS width
    FROM embeddings""",
)
def vector_conversion(spark, sf):
    """Arrays to ML vectors and back."""
    vec = vectors.ml_vector_to_array(vectors.array_to_ml_vector(F.col("embedding")))
    df = table(spark, sf, "embeddings").select("vec_id", vec.alias("vec"))
    total = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v)
    return df.select("vec_id", rounded(total).alias("total"), F.size("vec").alias("width"))


@query(
    "mean_vectors",
    f"""SELECT label, pos, {sql_round("avg(value)")} AS value FROM (
      SELECT label, unnest(embedding::DOUBLE[]) AS value, generate_subscripts(embedding, 1)::INT - 1 AS pos
      FROM embeddings) GROUP BY label, pos""",
)
def mean_vector_table(spark, sf):
    means = mean_vectors(table(spark, sf, "embeddings"), "label", "embedding", EMBEDDING_DIM)
    return means.select("label", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", rounded(F.col("value"))
    )


_MEANS = ", ".join(f"{sql_round(f'avg(e{i}) + {SHIFT}')} AS v{i}" for i in range(WORD_DIM))


def _sql_dictionary(id_col: str, key: str) -> str:
    return ctes(SQL_GOLDEN) + (
        f'SELECT "{id_col}", {_MEANS} FROM ('
        + f'SELECT DISTINCT "{id_col}", COLUMNS(\'^e[0-9]+$\') FROM golden JOIN doc_vec ON k = "{key}"'
        + f') GROUP BY "{id_col}"'
    )


@query("user_dictionary", _sql_dictionary("userId", "userKey"))
def user_dictionary(spark, sf):
    golden = golden_frame(raw_clicks(spark, sf), word_vectors(spark, sf), WORD_DIM)
    return dictionary(golden, "userId", "userVec", WORD_DIM).select("userId", *spread("userVec", "v", WORD_DIM))


@query("item_dictionary", _sql_dictionary("itemId", "itemKey"))
def item_dictionary(spark, sf):
    golden = golden_frame(raw_clicks(spark, sf), word_vectors(spark, sf), WORD_DIM)
    return dictionary(golden, "itemId", "itemVec", WORD_DIM).select("itemId", *spread("itemVec", "v", WORD_DIM))
