"""Text columns: HTML removal, lengths, tokens, ids cut from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on exactly these.
HTML_TAG = r"<.*?>"  # "." stops at a line end, so a tag over two lines stays
TOKEN_BREAK = "[\n ]"  # tabs and punctuation stay inside tokens
MIN_TOKEN_LENGTH = 1  # tokens must be longer than this
MIN_DOC_LENGTH = 10  # documents must be longer than this
URL_SKIP = 3  # an id starts this many characters after the last slash position
URL_SUFFIXES = ["pdf", "docx", "doc", "txt"]  # removed in this order, anywhere


def strip_html(doc: Column) -> Column:
    """Remove HTML tags. NULL stays NULL."""
    return F.regexp_replace(doc, HTML_TAG, "")


def doc_length(doc: Column) -> Column:
    """Length in UTF-16 units: a character outside the basic plane counts as two."""
    return (F.octet_length(F.encode(doc, "UTF-16BE")) / 2).cast("int")


def is_long_enough(doc: Column, longer_than: int = MIN_DOC_LENGTH) -> Column:
    """True when :func:`doc_length` exceeds the bound; re-encodes only borderline documents."""
    return (F.length(doc) > longer_than) | (doc_length(doc) > longer_than)


def tokens(doc: Column) -> Column:
    """Split at blanks and line feeds and keep tokens of more than one UTF-16 unit.

    No lower-casing and no punctuation stripping. A single character of four UTF-8
    bytes is two UTF-16 units long and therefore stays.
    """
    return F.filter(
        F.split(doc, TOKEN_BREAK),
        lambda word: (F.length(word) > MIN_TOKEN_LENGTH) | (F.octet_length(word) > 3),
    )


def id_from_url(url: Column) -> Column:
    """Id of a document from its URL; NULL for NULL and blank URLs.

    Takes the text that starts three places after the last slash (two characters of the
    file name are lost), but at least the last character, and removes the file suffixes
    wherever they stand. ``http://x/ab12345.pdf`` gives ``12345.``.
    """
    last_slash = F.length(url) - F.length(F.substring_index(url, "/", -1)) - F.lit(1)
    start = F.least(F.greatest(last_slash, F.lit(0)) + URL_SKIP, F.length(url) - 1)
    out = F.substring(url, start + 1, F.length(url))
    for suffix in URL_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    blank = url.rlike(r"^[\x00-\x20]*$")
    return F.when(url.isNotNull() & ~blank, out)


def doc_key(doc: Column) -> Column:
    """128-bit digest standing in for a text in joins and distinct counts."""
    return F.md5(doc.cast("binary"))
