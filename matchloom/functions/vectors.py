"""Array and vector columns. All arithmetic is done in double."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def array_length(vec: Column) -> Column:
    return F.size(vec)


def _same_size(x: Column, y: Column, value: Column) -> Column:
    # assert_true yields NULL when it holds and fails the job when it does not
    check = F.assert_true(F.size(x) == F.size(y), F.lit("vectors differ in size"))
    return F.when(x.isNotNull() & y.isNotNull(), F.when(check.isNull(), value))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_doubles(x), as_doubles(y), lambda a, b: a * b),
        F.lit(0.0),
        lambda total, v: total + v,
    )


def dot_product(x: Column, y: Column) -> Column:
    """Sum of products; vectors of different size fail the job."""
    return _same_size(x, y, _dot(x, y))


def magnitude(vec: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vec), F.lit(0.0), lambda total, v: total + v * v))


def cosine_similarity(x: Column, y: Column) -> Column:
    """Cosine; NULL when a vector is zero, fails on vectors of different size."""
    return _same_size(x, y, F.try_divide(_dot(x, y), magnitude(x) * magnitude(y)))


def abs_cosine(x: Column, y: Column) -> Column:
    """|cosine|, the score of every ranking."""
    return F.abs(cosine_similarity(x, y))


def concat_features(user_vec: Column, item_vec: Column) -> Column:
    return as_doubles(F.concat(user_vec, item_vec))


def array_to_ml_vector(vec: Column) -> Column:
    return array_to_vector(as_doubles(vec))


def ml_vector_to_array(vec: Column) -> Column:
    return vector_to_array(vec)


def longer_than_one(vec: Column) -> Column:
    """Filter that drops empty and one-element vectors (documents without a known word)."""
    return F.size(vec) > 1
