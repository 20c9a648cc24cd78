"""SimHash near-duplicates by meet in the middle.

Two fingerprints that differ in at most ``radius`` bits have a common variant within half the
radius of each. Every different fingerprint sends out all its variants; fingerprints that meet
at a variant are at most a ball's size in number, and next ones in order are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import free_names, stored, text_slices
from matchloom.llm.components import connected_components

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
_CHUNK = 1 << 16  # shingles whose bits are unpacked at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' digests; 0 for a text without words.

    A-Z count as a-z, words are runs without ASCII white space, shingles count as often as they
    occur, and a text of fewer words is one shingle.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    space, digest = b" ", xxhash.xxh64_intdigest
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter((digest(space.join(g), SEED) for g in grams), "<u8")
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start : start + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a signed long) of every row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _flips(most: int) -> list[int]:
    """Masks of at most so many bits, as signed longs."""
    masks = [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(range(BITS), n)]
    return [_signed(m) for m in masks]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a`` < ``b`` of different values of ``fp`` whose graph has the components of all pairs within ``radius`` bits.

    Fingerprints at one variant are each within half the radius of it, so within the radius of one
    another: sorted, each is tied to the one before it, and no pair of a ball's many is needed.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius is even: both sides of a pair reach half of it")
    masks = F.array(*[F.lit(m).cast("bigint") for m in _flips(radius // 2)])
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    different = prints.select("fp").distinct().repartition(tasks, "fp")  # a row becomes a ball: not few tasks
    variants = different.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    before = F.expr("lag(fp) over (partition by variant order by fp)")
    pairs = variants.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` of every different fingerprint."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(prints, radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest ``doc_id`` reachable over links) of every row.

    Equal fingerprints are one node, so a group of copies of any size is one row before anything is
    linked. Texts without words have fingerprint zero and are linked like others. A null ``doc_id``
    is never the smallest: a component without any other has none. Repeated rows each come out.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    return prints.join(_rooted(prints, radius), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the one with the smallest ``doc_id``.

    Rows that share a ``doc_id`` count as one document: if it stays, the row whose text has the
    smallest digest stays. Of a component without any ``doc_id`` the row with the smallest digest stays.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    rooted = stored(_rooted(prints, radius), "components")
    members = prints.join(rooted.drop("root"), "fp")
    first = members.where("doc_id = component_id").select("doc_id").distinct()
    row, fp, root = free_names(docs.columns, "row", "fp", "root")

    def smallest(df: DataFrame, key: str) -> DataFrame:
        order = Window.partitionBy(key).orderBy(F.xxhash64("text"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        return df.withColumn(row, F.row_number().over(order)).where(F.col(row) == 1)

    named = docs.join(first, "doc_id", "left_semi")
    value = F.pandas_udf(lambda texts: texts.map(lambda t: _signed(fingerprint(t or "", shingle))).astype("int64"), "bigint")
    alone = rooted.where("component_id is null").select(F.col("fp").alias(fp), F.col("root").alias(root))
    nameless = docs.where("doc_id is null").withColumn(fp, value("text")).join(alone, fp)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return smallest(named, "doc_id").select(*columns).union(smallest(nameless, root).select(*columns))
