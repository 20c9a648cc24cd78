"""From raw documents to token ids: five stages, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import byte_bpe, decontaminate, line_dedup, quality_rules, simhash
from matchloom.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Null and short texts fail the base rule; repeated rows are judged each."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated passages of three lines, or three sentences within long lines, leave their texts.

    Rows equal in id and text get the same text; a null text stays null.
    """
    return line_dedup.remove_repeated_passages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest ``doc_id``.

    Shingles of three words and at most two differing bits, as the operator's own query has them.
    """
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Items without words are in no document; without items all stay."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, with the digest of what they decode to.

    Of the other columns ``doc_id``, ``lang`` and ``source`` come along where they exist; a null text has no ids.
    """
    keep = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    decoded = byte_bpe.encode(docs, keep=keep, decoded=True)
    return decoded.select(*keep, F.size("ids").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]

# Fingerprints, search scores and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder and read back as the next one's input.

    An empty table gives no rows. Columns beside those of ``documents`` pass through all stages but the last. Rows that
    share a ``doc_id`` count as one document from the near-duplicate stage on.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
