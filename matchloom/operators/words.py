"""Words of documents looked up in a dictionary in two tiers.

The head of the dictionary, its words that the documents use most, goes to every worker within a bound of bytes;
documents look it up where they lie. Words beyond it are joined: of those a document moves each different one
once, with its count, and only if a membership filter of bounded size does not rule out that the dictionary has it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators.support import ROW_BYTES, cut_lineage, lookup_join, measured_bytes

TOKENS = "_tokens"
HEAD_BYTES = 64 * 1024 * 1024  # of words and vectors that each worker holds
FILTER_BYTES = 32 * 1024 * 1024
FILTER_BITS_PER_WORD, FILTER_PROBES = 16, 4
BITMAP_BITS = 32768  # of one bitmap of Spark's bitmap functions
SLICE_NUMBERS = 1 << 22  # vector elements gathered at once


@dataclass
class Tiers:
    """Words and vectors of the head as Arrow columns; the rest as a table with its filter, if there is a rest."""

    words: Any
    vectors: Any
    tail: DataFrame | None = None
    bits: Any = None


def _positions() -> Callable:
    """Places of words in a filter of so many bits; made here so that it travels to tasks by value."""
    import numpy as np
    from pandas.util import hash_array

    def positions(words, bits, probes):
        whole = hash_array(np.asarray(words, dtype=object), categorize=False)
        step = (whole >> np.uint64(32)) | np.uint64(1)
        return [(((whole & np.uint64(0xFFFFFFFF)) + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64) for i in range(probes)]

    return positions


def _filter(words: DataFrame, count: int):
    """Bits of the words, put together from Spark's bitmaps: at most ``FILTER_BYTES``."""
    import numpy as np

    positions, probes = _positions(), FILTER_PROBES
    bits = min(8 * FILTER_BYTES, FILTER_BITS_PER_WORD * count)
    bits = -(-bits // BITMAP_BITS) * BITMAP_BITS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = positions(batch.column("word").to_pylist(), bits, probes) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64())], ["place"])

    places = words.select("word").mapInArrow(run, "place bigint").select((F.col("place") + 1).alias("place"))  # bitmaps count from 1
    maps = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map"))
    whole = np.zeros(bits // 8, np.uint8)
    for row in maps.toLocalIterator():
        start = (row["bucket"] - 1) * BITMAP_BITS // 8
        whole[start : start + BITMAP_BITS // 8] = np.frombuffer(row["map"], np.uint8)
    return whole


def word_tiers(tokens: DataFrame, dictionary: DataFrame, limit: int = HEAD_BYTES) -> Tiers:
    """Cut a dictionary (``word``, ``vec``; one row for each word) by how often ``_tokens`` have its words.

    A dictionary measured to be within the limit is all head, and nothing is counted. The dictionary should be
    stored, as it is read more than once.
    """
    dictionary = dictionary.where(F.col("word").isNotNull())
    size = measured_bytes(dictionary)
    if size <= limit:
        held = dictionary.toArrow().combine_chunks()
        return Tiers(*(held.column(c).combine_chunks() for c in ("word", "vec")))
    total = dictionary.count()
    counts = tokens.select(F.explode(TOKENS).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    ranked = cut_lineage(dictionary.join(counts, "word", "left").select("word", "vec", F.coalesce("uses", F.lit(0)).alias("uses")))
    most = max(1, int(limit / (size / total + ROW_BYTES)))
    top = ranked.select("word", "uses").orderBy(F.desc("uses"), "word").limit(most)
    head = cut_lineage(ranked.join(F.broadcast(top.select("word")), "word", "left_semi").select("word", "vec"))
    tail = cut_lineage(ranked.where("uses > 0").join(F.broadcast(head.select("word")), "word", "left_anti").select("word", "vec"))
    held = head.toArrow().combine_chunks()
    return Tiers(*(held.column(c).combine_chunks() for c in ("word", "vec")), tail, _filter(tail, max(1, tail.count())))


def scan_words(docs: DataFrame, tiers: Tiers, dim: int) -> DataFrame:
    """For each row of ``docs``, which has ``_tokens``, what the head says, and the words that the tail may have.

    In place of the tokens come ``vec`` (sum over tokens of the vectors of the head; NULL if it has none of
    them), ``n`` (tokens), ``hits`` (tokens that the head has) and ``rest`` (``word``, ``uses``). A vector longer than
    ``dim`` fails the job, a shorter one is filled up and tells so by ``width``.
    """
    keys = [c for c in docs.columns if c != TOKENS]
    handle = docs.sparkSession.sparkContext.broadcast((tiers.words, tiers.vectors, tiers.bits))
    positions, probes, at_once = _positions(), FILTER_PROBES, SLICE_NUMBERS
    names = [*keys, "vec", "n", "hits", "width", "rest"]
    prepared: list = []

    def prepare():
        import numpy as np

        words, vectors, bits = handle.value
        sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        if dim and len(sizes) and sizes.max() > dim:
            raise ValueError(f"a vector has more than {dim} elements")
        matrix = np.zeros((len(sizes), dim), np.float32)
        if dim:
            values = vectors.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
        return words, matrix, sizes, bits

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not prepared:
                prepared.append(prepare())
            words, matrix, sizes, bits = prepared[0]
            lists = batch.column("_tokens")
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            coded = flat.dictionary_encode()
            known = pc.index_in(coded.dictionary, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            found = known[codes] if len(codes) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(n)), n)
            hit = np.flatnonzero(found >= 0)
            hits = np.bincount(owner[hit], minlength=len(n))
            width = np.zeros(len(n), np.int32)
            np.maximum.at(width, owner[hit], sizes[found[hit]].astype(np.int32))
            sums = np.zeros((len(n), dim))
            step = max(1, at_once // max(1, dim))
            for start in range(0, len(hit), step):
                some = hit[start : start + step]
                starts = np.flatnonzero(np.diff(owner[some], prepend=-1))
                sums[owner[some[starts]]] += np.add.reduceat(matrix[found[some]], starts, axis=0, dtype=np.float64)
            offsets = np.concatenate([[0], np.cumsum(np.where(hits > 0, dim, 0))]).astype(np.int32)
            vec = pa.ListArray.from_arrays(offsets, pa.array(sums[hits > 0].ravel(), pa.float64()), mask=pa.array(hits == 0))
            columns = [*[batch.column(k) for k in keys], vec, pa.array(n), pa.array(hits.astype(np.int64)), pa.array(width)]
            yield pa.RecordBatch.from_arrays([*columns, rest_of(coded, known, codes, owner, len(n), bits, np, pa)], names)

    def rest_of(coded, known, codes, owner, rows, bits, np, pa):
        """Each row's words that are not in the head and may be in the tail, with their counts."""
        kind = pa.struct([("word", pa.string()), ("uses", pa.int64())])
        if bits is None or not len(codes):
            return pa.ListArray.from_arrays(pa.array(np.zeros(rows + 1, np.int32)), pa.array([], kind))
        unknown = np.flatnonzero(known < 0)
        may = np.ones(len(unknown), bool)
        for place in positions(coded.dictionary.take(pa.array(unknown)).to_pylist(), 8 * len(bits), probes):
            may &= (bits[place // 8] >> (place % 8).astype(np.uint8)) & 1 > 0
        wanted = np.zeros(len(known), bool)
        wanted[unknown[may]] = True
        at = np.flatnonzero(wanted[codes])
        both, uses = np.unique(owner[at] * len(known) + codes[at], return_counts=True)
        row, code = both // len(known), both % len(known)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
        values = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(code)), pa.array(uses.astype(np.int64))], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    rest = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("uses", T.LongType())]))
    given = [("vec", T.ArrayType(T.DoubleType())), ("n", T.LongType()), ("hits", T.LongType()), ("width", T.IntegerType()), ("rest", rest)]
    return docs.select(*keys, TOKENS).mapInArrow(run, T.StructType([*[docs.schema[k] for k in keys], *[T.StructField(*g) for g in given]]))


def tail_words(scanned: DataFrame, keys: list[str], tiers: Tiers) -> DataFrame:
    """The keys with ``word``, ``uses`` and ``vec`` of the words that the tail has."""
    words = scanned.select(*keys, F.inline("rest"))
    return lookup_join(words, tiers.tail, "word")
