"""Declared schemas of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T

_body = T.StructType([T.StructField("normalizedBody", T.StringType())])
_resume = T.StructType([T.StructField("resume", _body)])

RAW_APPLICATIONS = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("jobs_job_id", T.StringType()),
        T.StructField("jobs_title", T.StringType()),
        T.StructField("jobs_description", T.StringType()),
        T.StructField("resume_url", T.StringType()),
        T.StructField("resume", _resume),
        T.StructField("new_application", T.BooleanType()),
    ]
)

RAW_INTERACTIONS = T.StructType(
    [
        T.StructField("resume_id", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("resume", _resume),
        T.StructField("description", T.StringType()),
        T.StructField("apply_flag", T.DoubleType()),
        T.StructField("is_clicked", T.DoubleType()),
    ]
)

WORD_VECTORS = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("vec", T.ArrayType(T.FloatType()))]
)

INDEXED = T.StructType(
    [
        T.StructField("userId", T.DoubleType()),
        T.StructField("itemId", T.DoubleType()),
        T.StructField("label", T.DoubleType()),
    ]
)

USER_DICT = T.StructType(
    [T.StructField("userId", T.DoubleType()), T.StructField("userVec", T.ArrayType(T.FloatType()))]
)

ITEM_DICT = T.StructType(
    [T.StructField("itemId", T.DoubleType()), T.StructField("itemVec", T.ArrayType(T.FloatType()))]
)
