import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions import labels, text, vectors


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_strip_html_leaves_tags_over_two_lines(spark):
    rows = [("<p>a</p> b",), ("a <b\nc> d",), ("1 < 2",), (None,)]
    assert values(spark, rows, "d string", text.strip_html(F.col("d"))) == [("a b",), ("a <b\nc> d",), ("1 < 2",), (None,)]


def test_doc_length_counts_utf16_units(spark):
    rows = [("abc",), ("a\U0001f600",), ("",), (None,)]
    assert values(spark, rows, "d string", text.doc_length(F.col("d"))) == [(3,), (3,), (0,), (None,)]


def test_documents_of_ten_and_eleven_characters(spark):
    rows = [("a" * 10,), ("a" * 11,), ("a" * 9 + "\U0001f600",), (None,)]
    assert values(spark, rows, "d string", text.is_long_enough(F.col("d"))) == [(False,), (True,), (True,), (None,)]


def test_tokens(spark):
    rows = [("ab a  cd\nef\tgh I x.",), ("a b",), ("",), ("\U0001f600 b",), (None,)]
    assert values(spark, rows, "d string", text.tokens(F.col("d"))) == [
        (["ab", "cd", "ef\tgh", "x."],),
        ([],),
        ([],),
        (["\U0001f600"],),
        (None,),
    ]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://x/ab12345.pdf", "12345."),
        ("docxfile", "xfile"),
        ("a/b", "b"),
        ("x", "x"),
        ("", None),
        ("  \t", None),
        (None, None),
        ("h/abpdfdocxdoctxt9", "9"),
        ("http://x/ab/", "/"),
    ],
)
def test_id_from_url(spark, url, expected):
    assert values(spark, [(url,)], "u string", text.id_from_url(F.col("u"))) == [(expected,)]


def test_id_from_url_removes_suffixes_in_order(spark):
    # pdf goes first, which may join the letters of another suffix
    assert values(spark, [("x/ab" + "dopdfc1",)], "u string", text.id_from_url(F.col("u"))) == [("1",)]


def test_application_status_and_click_label(spark):
    rows = [(True, True), (False, False), (None, None)]
    got = values(
        spark, rows, "a boolean, c boolean", labels.application_status(F.col("a")), labels.click_label(F.col("a"), F.col("c"))
    )
    assert got == [(1.0, 1.0), (1.0, 0.0), (None, 0.0)]


def test_label_shifts(spark):
    rows = [(0.0,), (1.0,), (2.0,), (None,)]
    got = values(spark, rows, "x double", labels.add_one(F.col("x")), labels.to_zero_one(F.col("x")))
    assert got == [(1.0, 0.0), (2.0, 0.0), (3.0, 1.0), (None, None)]


def test_score_functions(spark):
    rows = [(0.5,), (0.50001,), (0.99,), (None,)]
    got = values(
        spark,
        rows,
        "s double",
        labels.score_to_label(F.col("s"), 0.5),
        labels.score_to_bucket(F.col("s")),
        labels.to_decimal(F.col("s"), 1),
    )
    assert got == [(0.0, 5, 0.5), (1.0, 5, 0.5), (1.0, 9, 1.0), (None, None, None)]


def test_round_half_up(spark):
    assert one(spark, labels.to_decimal(F.lit(0.0125), 3)) == 0.013
    assert math.copysign(1, one(spark, labels.rounded(F.lit(-1e-9)))) == 1


VECTORS = T.StructType([T.StructField(c, T.ArrayType(T.FloatType())) for c in "xy"])


def test_vector_functions(spark):
    rows = [([3.0, 4.0], [4.0, 3.0]), ([1.0, 0.0], [-2.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])]
    x, y = F.col("x"), F.col("y")
    got = values(
        spark, rows, VECTORS, vectors.dot_product(x, y), vectors.magnitude(x), vectors.cosine_similarity(x, y), vectors.abs_cosine(x, y)
    )
    assert got[0] == (24.0, 5.0, 0.96, 0.96)
    assert got[1] == (-2.0, 1.0, -1.0, 1.0)
    assert got[2] == (0.0, 0.0, None, None)  # a zero vector has no cosine
    assert got[3] == (None, None, None, None)


@pytest.mark.parametrize("function", [vectors.dot_product, vectors.cosine_similarity, vectors.abs_cosine])
def test_vectors_of_different_size_fail(spark, function):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], VECTORS).select(function(F.col("x"), F.col("y")))
    with pytest.raises(Exception, match="vectors differ in size"):
        df.collect()


def test_concat_and_conversion(spark):
    rows = [([1.0, 2.0], [3.0])]
    both = vectors.concat_features(F.col("x"), F.col("y"))
    got = values(spark, rows, VECTORS, both, vectors.ml_vector_to_array(vectors.array_to_ml_vector(F.col("x"))))
    assert got == [([1.0, 2.0, 3.0], [1.0, 2.0])]


def test_longer_than_one(spark):
    rows = [([], [1.0]), ([1.0, 2.0], [1.0])]
    assert values(spark, rows, VECTORS, vectors.longer_than_one(F.col("x")), vectors.longer_than_one(F.col("y"))) == [
        (False, False),
        (True, False),
    ]
