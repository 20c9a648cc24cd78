"""Digests of both documents of an interaction, without a row that moves with both texts."""

import hashlib

import pytest

from catalog import base
from matchloom.operators import interactions as ops
from matchloom.operators.profiling import profile_applications

CANONICAL = "userId string, itemId string, userDoc string, itemDoc string, label double"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_digests_are_those_of_the_rows(spark):
    rows = [
        ("u", "i", "a", "x", 1.0), ("u", "i", "a", "x", 1.0), ("u", "i", "b", "x", 1.0),  # one item document
        ("u", "j", "a", "x", 1.0), ("u", "j", "b", "y", 1.0), ("u", "j", "b", "y", 1.0),  # which belongs to which
        ("v", "i", "a", "x", 1.0), ("v", "i", None, "y", 1.0),  # the second one has no user document
        ("v", "j", "a", None, 1.0), ("v", "k", None, "x", 1.0), (None, "i", "a", "x", 1.0), ("w", "i", "a", "x", float("nan")),
        ("w", "i", "a", "x", 2.0), ("w", "i", "a", "y", 1.0),
    ]
    whole = {(u, i, md5(a), md5(x), n) for u, i, a, x, n in rows if None not in (u, i, a, x) and n == n}
    found = ops.digest_pairs(spark.createDataFrame(rows, CANONICAL)).select("userId", "itemId", "userKey", "itemKey", "label").collect()
    assert len(found) == len(whole) == 7 and {tuple(r) for r in found} == whole


def test_nulls_are_checked_where_a_column_is_read(spark):
    rows = spark.createDataFrame([("u", "i", "a", "x", 1.0), ("u", "i", "a", None, 1.0), ("u", "i", "a", "x", float("nan"))], CANONICAL)
    kept = ops.drop_nulls(rows)
    assert [r["label"] for r in kept.collect()] == [1.0] and kept.collect() == rows.dropna().collect()
    assert "atleastnnonnulls" not in optimized(kept).lower()


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("given"))
    tables = {
        "orders": ([(1, 7), (1, 8), (2, 9), (None, 7), (3, None)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(1, 5, "A", "O"), (1, 6, "R", "F"), (1, None, "N", "O"), (2, 5, None, "O"), (2, 7, "A", None), (3, 5, "R", "F"), (None, 5, "A", "O")],
            "l_orderkey long, l_partkey long, l_returnflag string, l_linestatus string",
        ),
        "part": ([(5, "five"), (5, "cinq"), (6, None)], "p_partkey long, p_name string"),
        "documents": ([(7, "seven"), (7, "seven"), (7, "sept"), (7, None), (8, None), (8, ""), (None, "none")], "doc_id long, text string"),
        "pages": ([(5, "u/ab5.pdf", "<p>5</p>"), (5, "u/ab5.pdf", "<p>5</p>"), (6, "u", "6"), (6, "u", "VI"), (7, None, None)], "page_id long, url string, html string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{sf}/{name}.parquet")
    return sf


@pytest.mark.parametrize("limit", [base.BROADCAST_BYTES, 0])
def test_repeated_keys_and_nulls_give_every_raw_row(spark, given, monkeypatch, limit):
    monkeypatch.setattr(base, "BROADCAST_BYTES", limit)
    read = {name: base.table(spark, given, name) for name in ("orders", "lineitem", "documents", "pages")}
    lines = read["lineitem"].join(read["orders"], read["lineitem"].l_orderkey == read["orders"].o_orderkey)
    lines = lines.join(read["documents"], lines.o_custkey == read["documents"].doc_id, "left")
    lines = lines.join(read["pages"], lines.l_partkey == read["pages"].page_id, "left")
    expected = lines.selectExpr("cast(o_custkey as string)", "cast(l_partkey as string)", "text", "html")
    columns = ["resume_id", "job_id", "resume.resume.normalizedBody", "description"]
    found = base.build_raw_clicks(spark, given).select(*columns)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, expected.collect())))
    olds = base.build_raw_applications(spark, given)
    parts = base.table(spark, given, "part")
    urls = read["pages"].selectExpr("page_id as url_id", "url as user_url")
    wide = lines.join(parts, lines.l_partkey == parts.p_partkey, "left").join(urls, lines.o_custkey == urls.url_id, "left")
    wide = wide.selectExpr("cast(l_partkey as string)", "p_name", "html", "user_url", "text")
    found = olds.select("job_id", "jobs_title", "jobs_description", "resume_url", "resume.resume.normalizedBody")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, wide.collect())))


def test_one_document_of_raw_rows_is_read_without_the_other(spark, given):
    raw = base.raw_clicks(spark, given)
    rows = ops.drop_nulls(ops.from_clicks(raw, complete=False), ["userId", "itemId", "label", "itemDoc"])
    assert "max(text" not in optimized(rows.select("userId", "itemId", "itemDoc"))
    users = optimized(ops.drop_nulls(ops.from_clicks(raw, complete=False)).select("userId", "itemId", "userDoc"))
    moved = [line for line in users.splitlines() if "Join" not in line and "max(text" not in line and "text#" in line and "html#" in line]
    assert "Union" not in users and not moved
    olds = base.raw_applications(spark, given).where("jobs_description is not null").select("job_id", "jobs_description")
    assert "max(text" not in optimized(olds)


def test_applications_with_content_are_counted_by_pairs_of_documents(spark):
    schema = "resume_url string, jobs_job_id string, new_application boolean, resume struct<resume: struct<normalizedBody: string>>, jobs_description string"
    rows = [("x/ab1.pdf", "j", True, ((b,),), d) for b, d in (("a", "x"), ("a", "x"), ("b", "y"), (None, "z"), ("c", None))]
    rows += [("x/ab2.pdf", None, True, (("a",),), "x"), ("x/ab2.pdf", "j", None, (("a",),), "x"), (None, "j", True, (("a",),), "x"), ("x/ab3.pdf", "j", False, None, "x")]
    found = {r["metric"]: r["value"] for r in profile_applications(spark.createDataFrame(rows, schema)).collect()}
    assert found == {"rows": 9, "applications": 8, "urls": 3, "item_ids": 2, "user_ids": 3, "pairs": 4, "complete": 6, "complete_with_content": 2}


def test_rows_meet_vectors_by_digests_of_one_document_at_a_time(spark, monkeypatch):
    rows = [
        ("u", "i", "a", "x", 1.0), ("u", "i", "a", "x", 1.0), ("u", "i", "b", "x", 1.0), (None, "i", "a", "x", None), (None, "i", "a", "x", None),
        ("v", "i", None, "x", 1.0), ("v", "j", "a", None, 1.0), ("w", "i", "a", "x", float("nan")),
    ]
    more = [("u", "j", "a", "x", 1.0), ("u", "j", "b", "y", 1.0), ("u", "j", "b", "y", 1.0)]  # which belongs to which
    whole, calls = ops.with_doc_keys, []
    monkeypatch.setattr(ops, "with_doc_keys", lambda df: calls.append(df) or whole(df))
    for given, read in ((rows, 0), (rows + more, 1)):
        df = spark.createDataFrame(given, CANONICAL)
        calls.clear()
        found = ops.keyed_rows(df).select("userId", "itemId", "userKey", "itemKey", "label")
        expected = whole(ops.drop_nulls(df, ["userDoc", "itemDoc"])).select(*found.columns)
        assert len(calls) == read and sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert sorted(ops.keyed_rows(df.select("userDoc", "itemDoc")).collect()) == sorted(expected.select("userKey", "itemKey").collect())
