"""Components, SimHash, line dedup."""

import random

from matchloom.llm import line_dedup, simhash
from matchloom.llm.components import connected_components
from tests.llm.brute import components, deduped, deduped_passages, docs, fingerprint, roots


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(70)]
    pairs += [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 400)] + [(5, 5), (None, 3)]
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    got = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    want = roots({n for p in real for n in p}, real)
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprint():
    for text in ("", " \n ", "One", "one two", "A b c", "Ünï A b C " * 50, "x\x0by\x0cz w", "a\x1cb c d e"):
        assert simhash.fingerprint(text) == fingerprint(text)


def near_copies():
    """A chain of texts whose neighbours differ little, copies, and texts of their own."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    base = [rng.choice(words) for _ in range(3000)]
    texts = {}
    for i in range(60):
        base = list(base)
        base[rng.randrange(len(base))] = f"new{i}"
        texts[1000 - i] = " ".join(base)
    for i in range(40):
        texts[i] = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
    for i in range(40, 60):
        texts[i] = texts[i - 40] if i % 2 else ""
    return texts


def test_near_duplicates(spark):
    texts = near_copies()
    rows = simhash.near_duplicates(docs(spark, texts.items(), extra=("fp", "component_id"))).collect()
    assert {r["doc_id"]: r["fp"] % 2**64 for r in rows} == {i: fingerprint(t) for i, t in texts.items()}
    want = components(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert len(set(want.values())) < len(texts) - 40
    kept = simhash.keep_first(docs(spark, texts.items(), extra=("row", "fp")))
    assert kept.columns[-2:] == ["row", "fp"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_without_ids_and_rows(spark):
    rows = [(None, "only here and nowhere else at all"), (None, "only here and nowhere else at all"), (None, "b b b b"), (3, "b b b b")]
    rows += [(4, None), (5, ""), (6, "x y z"), (6, "x y z"), (6, "quite another text of its own")]
    found = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    assert {r["component_id"] for r in found if r["doc_id"] in (4, 5)} == {4}
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_first(docs(spark, rows)).collect()]
    assert sorted(i for i, _ in kept if i) == [3, 4, 6]
    assert [t for i, t in kept if i is None] == [rows[0][1]]
    assert simhash.keep_first(docs(spark, [])).count() == 0


def test_line_dedup(spark):
    rng = random.Random(6)
    lines = [f"line {i}" for i in range(12)] + ["", "  "]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25))) for i in range(80)}
    texts |= {100: "a\nb\nc", 101: " a \n\nb\t\nc\nd", 102: "a\nb", 103: "", 104: "q\nq\nq\nq\nq\nq"}
    rows = line_dedup.remove_repeated_lines(docs(spark, texts.items(), extra=("doc", "left", "lines")), removed="gone")
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "doc", "left", "lines", "gone"]
    got = {r["doc_id"]: r for r in rows.collect()}
    want = deduped(texts)
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[101]["gone"] == 3 and got[101]["text"] == "\nd" and got[104]["gone"] == 5


def test_line_dedup_of_odd_rows(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc"), (2, None), (2, "x\ny\nz"), (2, "w\nx\ny\nz")]
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in line_dedup.remove_repeated_lines(docs(spark, rows)).collect())
    assert got[0] == (0, "a\nb\nc")  # a null id comes first, so its lines stay
    assert got[1:3] == [(1, ""), (1, "")]  # equal rows get the same result
    assert sorted(t for i, t in got if i == 2) in (["", "", "w\nx\ny\nz"], ["", "w", "x\ny\nz"])
    assert line_dedup.remove_repeated_lines(docs(spark, [])).count() == 0
    assert "Python" not in line_dedup.remove_repeated_lines(docs(spark, rows))._jdf.queryExecution().toString()


def test_passages_in_long_lines(spark):
    rng = random.Random(8)
    said = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(1, 9))) + rng.choice(".!?,") for _ in range(25)]
    joints = [" ", " ", "  ", "\t", "\n", "\n\n", " \n"]
    texts = {i: "".join(rng.choice(said) + rng.choice(joints) for _ in range(rng.randint(0, 30))) for i in range(150)}
    texts |= {200: "", 201: "x", 202: "a. b. c.", 203: "a. b. c.", 204: "q\nq\nq\nq", 205: "One more word " * 9}
    shared = "The mill by the river was built of stone. It stood for many hundred years! Who knows what it saw?"
    texts |= {300: f"Own words at the start here. {shared} And an end of its own.", 301: f"{shared}", 302: f"first\nOther words: {shared}\nlast one. {shared}"}
    table = docs(spark, texts.items(), extra=("doc", "left", "units", "covered"))
    result = line_dedup.remove_repeated_passages(table)
    got = {r["doc_id"]: r for r in result.collect()}
    want = deduped_passages(texts)
    assert result.columns == table.columns and {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert want[300] == texts[300] and want[301] == "" and want[302] == texts[302].replace(f"\nlast one. {shared}", "\nlast one.")
    assert sum(len(t) for t in want.values()) < sum(len(t) for t in deduped(texts).values())
    assert want[202] == texts[202] and want[203] == texts[203] and want[205] == texts[205]


def test_passages_of_odd_rows(spark):
    long = "The mill by the river was built of stone. It stood for many hundred years! Who knows what it saw?"
    rows = [(1, long), (1, long), (None, long), (2, None), (3, ""), (4, "\n \n")]
    got = [(r["doc_id"], r["text"]) for r in line_dedup.remove_repeated_passages(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, long), (1, ""), (1, ""), (2, None), (3, ""), (4, "\n \n")], key=str)
    assert line_dedup.remove_repeated_passages(docs(spark, [])).count() == 0
    assert "Python" not in line_dedup.remove_repeated_passages(docs(spark, rows))._jdf.queryExecution().toString()
