"""Dictionary lookups in two tiers and vector-valued sums."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.functions import text
from matchloom.operators import words as w
from matchloom.operators.interactions import docs_with_known_word
from matchloom.operators.vector_sums import sum_vectors
from matchloom.operators.vectorising import doc_vectors, mean_vectors

DIM = 3


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    vocabulary = [f"wörd{i}" for i in range(300)]
    known = {v: [float(np.float32(rng.uniform(-1, 1))) for _ in range(rng.choice((DIM, DIM, 2)))] for v in vocabulary[::2]}
    docs = {i: " ".join(rng.choices(vocabulary + ["x"], k=rng.randint(0, 60), weights=[300 - j for j in range(301)])) for i in range(80)}
    docs |= {100: None, 101: "", 102: "never seen before", 103: "wörd298", 104: "wörd298 wörd298 other", 105: "wörd1 wörd299"}
    table = spark.createDataFrame(list(docs.items()), "id int, doc string").repartition(3).cache()
    return docs, known, table, spark.createDataFrame(list(known.items()), "word string, vec array<float>").cache()


def expected(docs, known):
    result = {}
    for i, doc in docs.items():
        tokens = [t for t in (doc or "").replace("\n", " ").split(" ") if len(t) > 1]
        hits = [known[t] for t in tokens if t in known]
        width = max(map(len, hits), default=0)
        result[i] = [sum(h[p] for h in hits if p < len(h)) / len(tokens) for p in range(width)]
    return result


@pytest.mark.parametrize("limit", [w.HEAD_BYTES, 3000, 1])
def test_document_vectors_at_any_head(spark, corpus, limit):
    docs, known, table, dictionary = corpus
    want = expected(docs, known)
    got = {r["id"]: r["v"] for r in doc_vectors(table, dictionary, DIM, "id", "doc", "v", head_bytes=limit).collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[i], want[i], atol=1e-9) and len(got[i]) == len(want[i]) for i in want)
    kept = doc_vectors(table, dictionary, DIM, "id", "doc", "v", keep_empty=False, head_bytes=limit)
    assert {r["id"] for r in kept.collect()} == {i for i, v in want.items() if v}
    found = docs_with_known_word(table, dictionary, "id", "doc", head_bytes=limit)
    assert sorted(r["id"] for r in found.collect()) == sorted(i for i, v in want.items() if v)


def test_only_distinct_tail_words_are_moved(spark, corpus):
    docs, known, table, dictionary = corpus
    tokens = table.select("id", text.tokens(F.col("doc")).alias(w.TOKENS))
    tiers = w.word_tiers(tokens, dictionary, 3000)
    head, tail = set(tiers.words.to_pylist()), {r["word"] for r in tiers.tail.collect()}
    uses = {}
    for doc in docs.values():
        for t in (doc or "").split(" "):
            uses[t] = uses.get(t, 0) + 1
    assert 0 < len(head) < len(known) and tail == {k for k in known if k in uses} - head
    assert min(uses[h] for h in head) >= max(uses[t] for t in tail)
    moved = w.scan_words(tokens, tiers, DIM).select("id", F.inline("rest")).collect()
    pairs = {(i, t): (doc or "").split(" ").count(t) for i, doc in docs.items() for t in set((doc or "").split(" ")) if t in tail}
    sent = {(r["id"], r["word"]): r["uses"] for r in moved}
    assert pairs.items() <= sent.items() and len(moved) == len(sent) <= len(pairs) * 1.1 + 2  # a filter lets few others through


def test_a_filter_holds_all_its_words(spark):
    table = spark.createDataFrame([(f"word {i} é",) for i in range(5000)], "word string")
    bits = w._filter(table, 5000)
    positions = w._positions()

    def held(words):
        inside = np.ones(len(words), bool)
        for place in positions(words, 8 * len(bits), w.FILTER_PROBES):
            inside &= (bits[place // 8] >> (place % 8).astype(np.uint8)) & 1 > 0
        return inside

    assert held([f"word {i} é" for i in range(5000)]).all() and held([f"other {i}" for i in range(5000)]).mean() < 0.02


def test_sums_by_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.5, None]), [rng.random() for _ in range(rng.randint(0, 4))] if rng.random() < 0.9 else None, rng.randint(0, 9)) for _ in range(400)]
    rows += [("one", 0.0, [1.0, None, 2.0], 3), ("none", 0.0, None, None)]
    table = spark.createDataFrame(rows, "k string, d double, v array<double>, m int").repartition(7)
    got = {(r["k"], r["d"]): r for r in sum_vectors(table, ["k", "d"], "v", 4, most="m").collect()}
    assert len(got) == len({(k, d) for k, d, _, _ in rows})
    for (k, d), r in got.items():
        mine = [x for x in rows if x[:2] == (k, d)]
        vectors = [x[2] for x in mine if x[2] is not None]
        want = [sum((v[p] or 0) for v in vectors if p < len(v)) for p in range(4)]
        assert np.allclose(r["_sum"], want) and r["_count"] == len(vectors)
        assert (r["_width"], r["_most"]) == (max(map(len, vectors), default=0), max(x[3] or 0 for x in mine))
    many = spark.range(0, 60_000, 1, 3).select(F.lit("side").alias("side"), (F.col("id") % 25_000).alias("k"), F.array(F.lit(1.0)).alias("v"))
    spread = sum_vectors(many, ["side", "k"], "v", 1)  # several batches on both sides of the shuffle, a key that is never null
    assert spread.agg(F.sum(F.col("_sum")[0]), F.count("k"), F.max("_count")).first()[:] == (60_000, 25_000, 3)
    with pytest.raises(Exception, match="more than 3 elements"):
        sum_vectors(table, ["k"], "v", 3).collect()
    assert sum_vectors(table.limit(0), ["k"], "v", 3).count() == 0


def test_wide_vectors_cost_what_their_numbers_cost(spark):
    def seconds(dim):
        element = [F.rand(i) for i in range(4)]
        vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda p: element[0] + p)
        table = spark.range(0, 40_000, 1, 4).select((F.col("id") % 500).alias("k"), vec.alias("v")).cache()
        table.count()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            mean_vectors(table, "k", "v", dim).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        table.unpersist()
        return min(best)

    narrow, wide = seconds(50), seconds(300)
    assert wide < 3 * narrow + 1.0, (narrow, wide)
