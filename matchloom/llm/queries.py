"""The operators as queries on the given tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import byte_bpe, compression_classifier, conversation_trie, decontaminate, fill_middle, line_dedup, pii
from matchloom.llm import quality_rules, sharding, simhash, token_counts, token_files, url_filters
from matchloom.llm.common import shared_path, stored, table
from matchloom.llm.sql import CONVERSATION_TRIE, FILL_MIDDLE, LINE_DEDUP, QUALITY_RULES, URL_FILTERS

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_classifier.fit_quality(docs, table(spark, sf_dir, "labels"))
    return compression_classifier.quality_scores(docs, model)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(ids, ["doc_id"], sharding.shard_names(sharding.SHARDS))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit_field(docs))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents")))
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(spelled.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    judged, stats, kept = quality_rules.quality_rules(docs.select("doc_id", "lang", "text"), labels, keep=("doc_id", "lang"))
    s = F.col(stats)
    counts = [s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, quality_rules.base_failed(s).alias("base_failed"), F.col(kept).alias("kept"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs, removed="n_removed")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, url_filters.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turn_digests(table(spark, sf_dir, "conversations"))
    return conversation_trie.conversation_trie(conversation_trie.share_heads(turns))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = stored(fill_middle.text_frames(table(spark, sf_dir, "documents")), "text-frames")
    return fill_middle.fill_in_middle(framed, digests=True)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_sharding,
        op3_token_files,
        op4_pii,
        op5_token_counts,
        op6_simhash,
        op7_byte_bpe,
        op8_decontamination,
        op9_quality_rules,
        op10_line_dedup,
        op11_url_filters,
        op12_conversation_trie,
        op13_fill_in_middle,
    )
}

SQL: dict[str, str] = {
    "op9_quality_rules": QUALITY_RULES,
    "op10_line_dedup": LINE_DEDUP,
    "op11_url_filters": URL_FILTERS,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_fill_in_middle": FILL_MIDDLE,
}
