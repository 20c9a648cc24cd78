import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import interactions as ops
from matchloom.operators import vectorising
from matchloom.operators.support import lookup_join, spread_hot_keys
from matchloom.sources.word_vectors import STOP_WORDS, load_word_vectors, parse_word_vectors

WORDS = [("red", [1.0, 0.0]), ("blue", [0.0, 2.0]), ("sky", [4.0, 4.0])]


@pytest.fixture
def words(spark):
    return spark.createDataFrame(WORDS, "word string, vec array<float>")


def vecs(df, key, vec):
    return {r[key]: r[vec] for r in df.collect()}


def test_stop_words():
    assert len(STOP_WORDS) == 153 + 2 and len(set(STOP_WORDS)) == 155
    assert {"he’d", "I", ",", "."} <= set(STOP_WORDS) and "The" not in STOP_WORDS


def test_word_vector_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text("red 1 0.5\nthe 1 1\nThe 2 2\n, 1 1\nred 3 0\nblue  1 2 \n", encoding="utf-8")
    got = vecs(load_word_vectors(spark, str(tmp_path / "words.txt")), "word", "vec")
    assert got == {"red": [3.0, 0.0], "The": [2.0, 2.0], "blue": [1.0, 2.0]}


def test_unknown_words_dilute(spark, words):
    docs = spark.createDataFrame(
        [(1, "red red blue zzz"), (2, "zzz yyy"), (3, "a b"), (4, "red x"), (5, "red\nsky")], "id int, d string"
    )
    got = vecs(vectorising.doc_vectors(docs, words, 2, "id", "d", "v"), "id", "v")
    assert got == {1: [0.5, 0.5], 2: [], 3: [], 4: [1.0, 0.0], 5: [2.5, 2.0]}
    kept = vecs(vectorising.doc_vectors(docs, words, 2, "id", "d", "v", keep_empty=False), "id", "v")
    assert kept == {k: v for k, v in got.items() if v}


def test_doc_vectors_are_linear_in_the_dictionary(spark, words):
    docs = spark.createDataFrame([(1, "red sky zzz"), (2, "blue blue sky")], "id int, d string")
    double = words.withColumn("vec", F.transform("vec", lambda v: v * 2))
    once = vecs(vectorising.doc_vectors(docs, words, 2, "id", "d", "v"), "id", "v")
    twice = vecs(vectorising.doc_vectors(docs, double, 2, "id", "d", "v"), "id", "v")
    assert twice == {k: [2 * x for x in v] for k, v in once.items()}


def test_ragged_word_vectors(spark):
    words = spark.createDataFrame([("ab", [1.0]), ("cd", [1.0, 2.0, 3.0])], "word string, vec array<float>")
    docs = spark.createDataFrame([(1, "ab cd"), (2, "ab")], "id int, d string")
    assert vecs(vectorising.doc_vectors(docs, words, 3, "id", "d", "v"), "id", "v") == {1: [1.0, 1.0, 1.5], 2: [1.0]}


def test_mean_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0]), (3, [1.0, 1.0]), (3, [3.0]), (4, [])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    # the divisor is the number of vectors, also where only some reach
    assert vecs(vectorising.mean_vectors(df, "id", "v"), "id", "v") == {1: [2.0, 3.0], 2: [5.0, 6.0], 3: [2.0, 0.5], 4: []}


def test_dictionary_counts_distinct_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [4.0, 4.0])], "userId int, userVec array<float>")
    assert vecs(vectorising.dictionary(df, "userId", "userVec"), "userId", "userVec") == {1: [2.5, 2.5]}


RAW = [
    ("u1", "i1", "red red red red", "<p>blue</p> blue blue", 1.0),
    ("u1", "i1", "red red red red", "<p>blue</p> blue blue", 1.0),  # twice
    ("u2", "i1", "red red red red", "<b>blue</b> blue blue", 0.0),
    ("u3", "i1", "zzzzz yyyyy xxxxx", "blue blue blue", 1.0),  # no known word
    ("u4", "i1", "red red re", "blue blue blue", 1.0),  # ten characters
    ("u5", "i1", "red red red", "<aaaaaaaaaaaa>blue blue", 1.0),  # too short without the tag
    (None, "i1", "red red red", "blue blue blue", 1.0),
    ("u6", "i1", None, "blue blue blue", 1.0),
    ("u7", "i1", "red red red", "blue blue blue", None),
]


def raw(spark):
    return spark.createDataFrame(RAW, "userId string, itemId string, userDoc string, itemDoc string, label double")


def test_clean_interactions(spark, words):
    got = sorted(tuple(r) for r in ops.clean_interactions(raw(spark), words).collect())
    assert got == [
        ("u1", "i1", "red red red red", "blue blue blue", 1.0),
        ("u2", "i1", "red red red red", "blue blue blue", 0.0),
    ]


def test_both_doc_vectors(spark, words):
    df = ops.drop_nulls(raw(spark))
    got = sorted((r["userId"], r["label"], r["userVec"], r["itemVec"]) for r in vectorising.both_doc_vectors(df, words, 2).collect())
    # rows are kept as often as they come; u3 has no known word; tags count as words here
    third = pytest.approx([0.0, 4 / 3])
    assert got == [
        ("u1", 1.0, [1.0, 0.0], third),
        ("u1", 1.0, [1.0, 0.0], third),
        ("u2", 0.0, [1.0, 0.0], third),
        ("u4", 1.0, pytest.approx([2 / 3, 0.0]), [0.0, 2.0]),
        ("u5", 1.0, [1.0, 0.0], [0.0, 1.0]),
    ]


def test_clean_and_vectorise(spark, words):
    twins = [("u8", "i1", "red red red", f"<{t}>blue blue blue", 1.0) for t in "ab"]  # equal without tags
    df = raw(spark).unionByName(spark.createDataFrame(twins, raw(spark).schema))
    got = sorted(tuple(r) for r in vectorising.clean_and_vectorise(df, words, 2).select("userId", "itemId", "label", "userVec", "itemVec").collect())
    row = ([1.0, 0.0], [0.0, 2.0])
    assert got == [("u1", "i1", 1.0, *row), ("u2", "i1", 0.0, *row), ("u8", "i1", 1.0, *row)]
    clean = [tuple(r) for r in ops.clean_interactions(df, words).collect()]
    assert len(clean) == 3 and ("u8", "i1", "red red red", "blue blue blue", 1.0) in clean


def test_layouts(spark):
    from matchloom.schemas import RAW_APPLICATIONS, RAW_INTERACTIONS

    clicks = spark.createDataFrame(
        [("r", "j", (("body",),), "text", 1.0, 0.0), ("r", "j", ((None,),), "text", 1.0, 0.0)], RAW_INTERACTIONS
    )
    assert [tuple(r) for r in ops.from_clicks(clicks).collect()] == [("r", "j", "body", "text", 1.0)]
    assert [r["label"] for r in ops.from_clicks(clicks, "apply_flag").collect()] == [2.0]
    applications = spark.createDataFrame(
        [("j", "jj", "t", "text", "http://x/ab12.pdf", (("body",),), False), ("j", "jj", "t", "text", " ", None, None)],
        RAW_APPLICATIONS,
    )
    assert [tuple(r) for r in ops.from_applications(applications).collect()] == [
        ("12.", "j", "body", "text", 1.0),
        (None, "j", None, "text", None),
    ]


def test_distinct_values(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    assert sorted(r["x"] for r in ops.distinct_values(df, "x").collect()) == ["1", "2"]


@pytest.mark.parametrize("hot_rows", [20, 1000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_join_is_the_same_broadcast_or_spread(spark, how, hot_rows):
    draw = random.Random(3)
    facts = spark.createDataFrame(
        [(i, "hot" if draw.random() < 0.4 else f"k{draw.randrange(30)}") for i in range(500)], "n int, key string"
    )
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(20)] + [("hot", -1)], "key string, v int")
    facts = facts.union(spark.createDataFrame([(-1, None), (-2, None)], facts.schema))

    def rows(df):
        return sorted(str(r.asDict()) for r in df.collect())

    small = rows(lookup_join(facts, lookup, "key", how))
    large = rows(lookup_join(facts, lookup, "key", how, limit=10, hot_rows=hot_rows))
    assert small == large and len(small) > 0


def test_lookup_join_copies_hot_keys_only(spark):
    """A key on 90 % of the rows is spread; the lookup is not multiplied."""
    facts = spark.range(20_000).selectExpr("id AS n", "CASE WHEN id % 10 < 9 THEN 0 ELSE id END AS key")
    lookup = spark.range(20_000).selectExpr("id AS key", "id * 2 AS v")
    joined = lookup_join(facts, lookup, "key", limit=10, hot_rows=1000)
    assert joined.count() == 20_000 and joined.where("v <> key * 2").isEmpty()
    hot = spark.createDataFrame([(0, 18)], "key bigint, _copies bigint")
    spread, copied = spread_hot_keys(facts, lookup, "key", hot)
    assert copied.count() == 20_000 + 17
    assert spread.count() == 20_000 and spread.groupBy("key", "_salt").count().agg(F.max("count")).first()[0] < 1300


def test_parse_word_vectors_keeps_one_row_per_word(spark):
    lines = spark.createDataFrame([("w 1 2",), ("w 1 3",), ("w 0 9",)], "value string")
    assert [tuple(r) for r in parse_word_vectors(lines).collect()] == [("w", [1.0, 3.0])]
