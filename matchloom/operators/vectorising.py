"""Documents and ids to averaged vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import text
from matchloom.operators.interactions import (
    clean_documents,
    clean_pairs,
    complete_documents,
    keep_long_vectors,
    keyed_rows,
)
from matchloom.operators.support import cut_lineage, lookup_join
from matchloom.operators.vector_sums import COUNT, MOST, SUM, WIDTH, sum_vectors
from matchloom.operators.words import HEAD_BYTES, TOKENS, scan_words, tail_words, word_tiers


def vector_width(df: DataFrame, vec: str) -> int:
    """Length of the longest vector."""
    return df.agg(F.max(F.size(vec)).alias("width")).first()["width"] or 0


def _divided(divisor: Column) -> Column:
    """Sums over the divisor, cut to the longest vector seen; empty when none was seen."""
    whole = F.transform(SUM, lambda x: F.try_divide(x, divisor))
    return F.slice(whole, 1, F.coalesce(F.col(WIDTH), F.lit(0)))


def doc_vectors(
    docs: DataFrame,
    word_vectors: DataFrame,
    dim: int,
    key: str | list[str],
    doc: str,
    out: str,
    keep_empty: bool = True,
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """Frequency-weighted mean of the word vectors of each document, one row per key.

    The divisor counts every token, also those without a vector, so unknown words dilute.
    A document without a known word has an empty vector, or leaves when ``keep_empty`` is off.
    Documents look up the most used words where they lie; only rarer ones are joined, and only if the dictionary
    may have them. One shuffle of one row per document follows; a vector longer than ``dim`` fails the job.
    """
    keys = [key] if isinstance(key, str) else key
    words = docs.select(*keys, text.tokens(F.col(doc)).alias(TOKENS))
    tiers = word_tiers(words, word_vectors.select("word", "vec"), head_bytes)
    scanned = scan_words(words, tiers, dim)
    part = [*keys, "vec", "n", "width"]
    if tiers.tail is not None:
        scanned = cut_lineage(scanned)
        scaled = F.transform("vec", lambda x: x.cast("double") * F.col("uses")).alias("vec")
        tail = tail_words(scanned, keys, tiers).select(*keys, scaled, F.lit(0).cast("bigint").alias("n"), F.size("vec").alias("width"))
        scanned = scanned.select(*part).unionByName(tail)
    elif not keep_empty:
        scanned = scanned.where("hits > 0")
    totals = sum_vectors(scanned.select(*part), keys, "vec", dim, most="n", width="width")
    if not keep_empty:
        totals = totals.where(F.col(COUNT) > 0)
    return totals.select(*keys, _divided(F.col(MOST)).alias(out))


def both_doc_vectors(df: DataFrame, word_vectors: DataFrame, dim: int) -> DataFrame:
    """Replace ``userDoc`` and ``itemDoc`` by ``userVec`` and ``itemVec``.

    Only rows where both vectors have more than one element stay. Vectors are computed once
    per distinct text; rows meet them by digest, so no text moves with a row.
    """
    docs = complete_documents(df, ["userDoc", "itemDoc"]).select("docKey", "doc").distinct()
    vecs = doc_vectors(docs, word_vectors, dim, "docKey", "doc", "vec", keep_empty=False)
    vecs = cut_lineage(keep_long_vectors(vecs, "vec"))
    return attach_doc_vectors(keyed_rows(df), vecs, "docKey")


def clean_and_keyed(df: DataFrame, word_vectors: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Clean canonical interactions with digests in place of the documents, and the vector of each digest.

    A document vector of more than one element implies a known word, so the vector join is
    also the vocabulary check of the cleaning. Texts are shuffled once, and both tables are
    stored; everything after that joins digests, and vectors are attached when they are wanted.
    """
    docs = clean_documents(complete_documents(df))
    vecs = doc_vectors(docs, word_vectors, dim, ["side", "docKey", "cleanKey"], "doc", "vec", keep_empty=False)
    vecs = cut_lineage(keep_long_vectors(vecs, "vec"))
    by_text = cut_lineage(vecs.select("cleanKey", "vec").distinct())
    return cut_lineage(clean_pairs(df, vecs)), by_text


def clean_and_vectorise(df: DataFrame, word_vectors: DataFrame, dim: int) -> DataFrame:
    """Clean canonical interactions, with both document vectors in place of the documents."""
    return attach_doc_vectors(*clean_and_keyed(df, word_vectors, dim), "cleanKey")


def attach_doc_vectors(pairs: DataFrame, vecs: DataFrame, key: str) -> DataFrame:
    """Vectors of both documents by digest; the interactions of a document many share are spread."""
    for side in ("user", "item"):
        one_side = vecs.select(F.col(key).alias(f"{side}Key"), F.col("vec").alias(f"{side}Vec"))
        pairs = lookup_join(pairs, one_side, f"{side}Key")
    return pairs.drop("userKey", "itemKey")


def document_dictionary(pairs: DataFrame, vecs: DataFrame, side: str, dim: int, id_col: str | None = None) -> DataFrame:
    """One row per id of a side: the mean of the different vectors of its documents.

    Ids meet digests before vectors, so a vector moves once per id and document, not once per interaction.
    """
    id_col, key, vec = id_col or f"{side}Id", f"{side}Key", f"{side}Vec"
    documents = pairs.select(id_col, key).distinct()
    named = vecs.select(F.col("cleanKey").alias(key), F.col("vec").alias(vec))
    return dictionary(lookup_join(documents, named, key), id_col, vec, dim)


def mean_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int | None = None) -> DataFrame:
    """Element-wise mean of all vectors of an id; the divisor is the number of its vectors."""
    totals = sum_vectors(df, [id_col], vec_col, dim or vector_width(df, vec_col))
    return totals.select(id_col, _divided(F.col(COUNT)).alias(vec_col))


def dictionary(indexed: DataFrame, id_col: str, vec_col: str, dim: int | None = None) -> DataFrame:
    """One row per id: mean of its distinct vectors."""
    return mean_vectors(indexed.select(id_col, vec_col).distinct(), id_col, vec_col, dim)
