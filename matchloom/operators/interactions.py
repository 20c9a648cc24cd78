"""Raw tables to clean user-item interactions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions import labels, text, vectors
from matchloom.operators.support import cut_lineage, lookup_join
from matchloom.operators.words import HEAD_BYTES, TOKENS, scan_words, tail_words, word_tiers

CANONICAL = ["userId", "itemId", "userDoc", "itemDoc", "label"]
PAIR = ["userId", "itemId", "label"]

# Column names of the two raw layouts.
CLICK_LAYOUT = {
    "userId": "resume_id",
    "itemId": "job_id",
    "userDoc": "resume.resume.normalizedBody",
    "itemDoc": "description",
}
APPLICATION_LAYOUT = {
    "userId": "resume_url",
    "itemId": "job_id",
    "userDoc": "resume.resume.normalizedBody",
    "itemDoc": "jobs_description",
    "label": "new_application",
}


def canonical_interactions(raw: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Project a raw table, nested fields included, to the canonical columns."""
    picked = [
        (F.col(source) if isinstance(source, str) else source).alias(name)
        for name, source in ((name, columns[name]) for name in CANONICAL)
    ]
    return raw.select(*picked)


def from_clicks(raw: DataFrame, label_col: str = "is_clicked", complete: bool = True) -> DataFrame:
    """Click layout to canonical interactions with labels 1/2; rows with NULLs leave.

    With ``complete`` off they stay, for steps that drop them themselves and read one document at a time.
    """
    columns = {**CLICK_LAYOUT, "label": labels.add_one(F.col(label_col))}
    rows = canonical_interactions(raw, columns)
    return drop_nulls(rows) if complete else rows


def from_applications(raw: DataFrame) -> DataFrame:
    """Application layout to canonical interactions: user ids come from document URLs."""
    columns = {
        **APPLICATION_LAYOUT,
        "userId": text.id_from_url(F.col(APPLICATION_LAYOUT["userId"])),
        "label": labels.application_status(F.col(APPLICATION_LAYOUT["label"])),
    }
    return canonical_interactions(raw, columns)


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a NULL or NaN in the columns, by one condition a column, which Spark checks where the column is read."""
    for column in columns or CANONICAL:
        df = df.where(F.col(column).isNotNull())
        if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
            df = df.where(~F.isnan(column))
    return df


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column as strings, kept as a table."""
    return df.select(F.col(column).cast("string").alias(column)).dropna().distinct()


def keep_long_vectors(df: DataFrame, column: str) -> DataFrame:
    return df.where(vectors.longer_than_one(F.col(column)))


def with_doc_keys(df: DataFrame) -> DataFrame:
    """Digests ``userKey`` and ``itemKey`` in place of the documents."""
    keys = {"userKey": text.doc_key(F.col("userDoc")), "itemKey": text.doc_key(F.col("itemDoc"))}
    return df.withColumns(keys).drop("userDoc", "itemDoc")


def distinct_documents(df: DataFrame) -> DataFrame:
    """``side, docKey, doc, uses``: the distinct user and item documents and how often they come.

    Texts are grouped once by hash aggregation, however many interactions repeat them; every
    later join moves digests instead of texts. Each side is read by itself, so no row holds both texts.
    """
    return _side_documents(df, "user").unionByName(_side_documents(df, "item"))


def _side_documents(df: DataFrame, side: str) -> DataFrame:
    doc = F.col(f"{side}Doc")
    docs = df.select(F.lit(side).alias("side"), text.doc_key(doc).alias("docKey"), doc.alias("doc"))
    return docs.groupBy("side", "docKey", "doc").agg(F.count(F.lit(1)).alias("uses"))


def complete_documents(df: DataFrame, columns: list[str] = CANONICAL) -> DataFrame:
    """:func:`distinct_documents` of the rows complete in ``columns``, and item documents of rows that lack nothing but a user document.

    The item side asks for no user document, so a source that joins the texts on need not move one along with the other;
    the documents it has too many belong to no complete row.
    """
    items = drop_nulls(df, [c for c in columns if c != "userDoc"])
    return _side_documents(drop_nulls(df, columns), "user").unionByName(_side_documents(items, "item"))


def digest_pairs(df: DataFrame, ids: list[str] = PAIR, first: str = "userDoc", second: str = "itemDoc") -> DataFrame:
    """Distinct ``ids`` of the complete rows with the digests ``userKey`` and ``itemKey`` of their first and second document.

    Each document is read by itself and only ids and digests are joined. Where a combination of ids comes with several
    second documents, which of them belong to which first one is read from its rows, with both texts.
    """
    complete = drop_nulls(df, [*ids, first, second])
    users = complete.select(*ids, text.doc_key(F.col(first)).alias("userKey")).distinct()
    items = drop_nulls(df, [*ids, second]).select(*ids, text.doc_key(F.col(second)).alias("itemKey"))
    items = items.groupBy(*ids).agg(F.min("itemKey").alias("itemKey"), F.max("itemKey").alias("_other"))
    joined = cut_lineage(users.join(items, ids))
    one, several = joined.where("itemKey = _other").drop("_other"), joined.where("itemKey <> _other").select(*ids).distinct()
    if several.isEmpty():
        return one
    rows = complete.join(several, ids, "left_semi")
    keys = {"userKey": text.doc_key(F.col(first)), "itemKey": text.doc_key(F.col(second))}
    return one.unionByName(rows.select(*ids, *[key.alias(name) for name, key in keys.items()]).distinct())


def keyed_rows(df: DataFrame) -> DataFrame:
    """All rows with both documents, as often as they come, with the digests ``userKey`` and ``itemKey`` in place of the documents.

    Each document is read by itself, as in :func:`digest_pairs`; rows equal in all other columns are counted, and only
    where they come with several item documents are their digests read from rows with both texts. NULLs of other
    columns are values like any other.
    """
    others = [c for c in df.columns if c not in ("userDoc", "itemDoc")]
    complete = drop_nulls(df, ["userDoc", "itemDoc"])
    if not others or any("map<" in kind or "variant" in kind for _, kind in df.select(*others).dtypes):  # no equality for these
        return with_doc_keys(complete)
    users = complete.select(*others, text.doc_key(F.col("userDoc")).alias("userKey"))
    users = users.groupBy(*others, "userKey").agg(F.count(F.lit(1)).alias("_n"))
    items = drop_nulls(df, ["itemDoc"]).select(*[F.col(c).alias(f"_of_{c}") for c in others], text.doc_key(F.col("itemDoc")).alias("itemKey"))
    items = items.groupBy(*[f"_of_{c}" for c in others]).agg(F.min("itemKey").alias("itemKey"), F.max("itemKey").alias("_other"))

    def same(prefix: str) -> Column:
        return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in others])

    joined = cut_lineage(users.join(items, same("_of_")).select(*others, "userKey", "itemKey", "_other", "_n"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))
    one = joined.where("itemKey = _other").withColumn("_copy", copies).select(*others, "userKey", "itemKey")
    several = joined.where("itemKey <> _other").select(*[F.col(c).alias(f"_in_{c}") for c in others]).distinct()
    if several.isEmpty():
        return one
    return one.unionByName(with_doc_keys(complete.join(several, same("_in_"), "left_semi")))


def clean_documents(docs: DataFrame) -> DataFrame:
    """Strip HTML from item documents, once per distinct text, and keep documents that are long enough.

    ``cleanKey`` is the digest of the clean text.
    """
    doc = F.col("doc")
    clean = docs.withColumn("doc", F.when(F.col("side") == "item", text.strip_html(doc)).otherwise(doc))
    # a condition on the count stays behind the grouping, so Spark strips no repeated text
    return clean.where(F.when(F.col("uses") > 0, text.is_long_enough(doc))).withColumn("cleanKey", text.doc_key(doc))


def clean_pairs(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct complete interactions with the digests of their clean documents.

    ``docs`` is a stored table with side, docKey and cleanKey; interactions of other documents
    leave, and those of a hot document are spread.
    """
    pairs = digest_pairs(rows)
    for side in ("user", "item"):
        key = f"{side}Key"
        keys = docs.where(F.col("side") == side).select(F.col("docKey").alias(key), "cleanKey")
        pairs = lookup_join(pairs, keys, key).drop(key).withColumnRenamed("cleanKey", key)
    return pairs.distinct()


def docs_with_known_word(
    docs: DataFrame, word_vectors: DataFrame, key: str, doc: str, head_bytes: int = HEAD_BYTES
) -> DataFrame:
    """Keys of the documents that hold at least one word of the dictionary.

    Only documents without a word of the dictionary's head look further, with their words that its tail may have.
    """
    words = docs.select(key, text.tokens(F.col(doc)).alias(TOKENS))
    tiers = word_tiers(words, word_vectors.select("word", F.array().cast("array<float>").alias("vec")), head_bytes)
    scanned = scan_words(words, tiers, 0)
    if tiers.tail is None:
        return scanned.where("hits > 0").select(key).distinct()
    scanned = cut_lineage(scanned)
    rare = tail_words(scanned.where("hits = 0"), [key], tiers).select(key)
    return scanned.where("hits > 0").select(key).union(rare).distinct()


def clean_interactions(df: DataFrame, word_vectors: DataFrame) -> DataFrame:
    """Distinct complete interactions whose documents are long enough and hold a known word.

    HTML is stripped from item documents. All work on texts is done once per distinct
    document, which is stored; interactions are filtered by digest and get their texts back
    at the end, those of the side with less text first, as they move with the rows to the other side's.
    """
    docs = cut_lineage(clean_documents(complete_documents(df)))
    texts = docs.select("cleanKey", "doc").distinct()
    known = cut_lineage(texts.join(docs_with_known_word(texts, word_vectors, "cleanKey", "doc"), "cleanKey", "left_semi"))
    users = known.select(F.col("cleanKey").alias("userKey"), F.col("doc").alias("userDoc"))
    items = known.select(F.col("cleanKey").alias("itemKey"), F.col("doc").alias("itemDoc"))
    pairs = cut_lineage(clean_pairs(df, docs))
    sides = sorted((("userKey", users, "userDoc"), ("itemKey", items, "itemDoc")), key=lambda side: _attached_bytes(pairs, *side))
    for key, texts, _ in sides:
        pairs = lookup_join(pairs, texts, key)
    return pairs.select(*CANONICAL)


def _attached_bytes(pairs: DataFrame, key: str, texts: DataFrame, doc: str) -> int:
    """Bytes of the texts of a side with every pair that has them."""
    uses = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    sized = uses.join(texts.select(key, F.octet_length(doc).cast("bigint").alias("_bytes")), key)
    return sized.agg(F.sum(F.col("_n") * F.col("_bytes"))).first()[0] or 0
