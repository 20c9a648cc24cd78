"""The stages one after another on odd rows."""

import corpus_pipeline
from matchloom.llm.common import stored
from tests.llm.brute import LABELS, docs


def chain(spark, table, folder):
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "Who was the first to row over the wide green lake? It was the miller of the old town."), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, folder)
        assert out.schema.simpleString() == table.schema.simpleString()
        table = stored(out, "stage")
    return corpus_pipeline.STAGES[-1][1](spark, table, folder)


def test_odd_rows_through_all_stages(spark, tmp_path):
    clean = " ".join(f"word{i} is number {i}" for i in range(20))
    other = "\n".join(f"line {i} says {i * i} and {i * 7} and so on" for i in range(12))
    rows = [(1, clean), (1, clean), (2, clean.upper()), (3, None), (4, ""), (5, other), (6, other + "\nand an end of its own that is not there before"), (None, clean)]
    rows += [(7, "Now: who was the first to row over the wide green lake? It was the miller of the old town, they say, and so it goes on"), (8, "x" * 200_000 + " " + clean[::-1])]
    table = docs(spark, rows, extra=("stats", "kept", "fp", "ids", "row"))
    got = chain(spark, table, str(tmp_path)).collect()
    # copies, short and contaminated ones go; 6 has its own line left
    assert sorted(r["doc_id"] for r in got) == [1, 5, 6, 8]
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in got)
    assert set(got[0].asDict()) == {"doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"}


def test_no_rows(spark, tmp_path):
    assert chain(spark, docs(spark, []), str(tmp_path)).count() == 0
