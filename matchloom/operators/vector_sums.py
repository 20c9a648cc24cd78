"""Sums of vectors by key as one vector-valued aggregate, whatever their width."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUM, COUNT, WIDTH, MOST = "_sum", "_count", "_width", "_most"


def _groups() -> Callable:
    """Adds up the rows of equal keys of a batch; made here so that it travels to tasks by value."""
    import numpy as np
    import pyarrow as pa

    def matrix(lists, dim):
        """Vectors side by side, short and missing ones filled up with zeros, and their lengths."""
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        values = lists.flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
        if len(sizes) and sizes.min() == sizes.max() == dim:
            return values.reshape(-1, dim), sizes
        if len(sizes) and sizes.max() > dim:
            raise ValueError(f"a vector has more than {dim} elements")
        rows = np.zeros((len(sizes), dim))
        ends = np.cumsum(sizes)
        rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
        return rows, sizes

    def codes(columns, n):
        """One number for each different combination of keys; a null is a key of its own."""
        found = np.zeros(n, np.int64)
        for column in columns:
            coded = column.dictionary_encode(null_encoding="encode")
            found = found * max(1, len(coded.dictionary)) + coded.indices.to_numpy(zero_copy_only=False)
            found = np.unique(found, return_inverse=True)[1]
        return found

    def add(keys, vectors, counts, widths, most):
        """First row of each group, and sums, counts, widths and greatest values of the groups."""
        group = codes(keys, len(counts))
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        sums = np.add.reduceat(vectors[order], starts, axis=0) if len(starts) else vectors
        parts = [np.add.reduceat(counts[order], starts), np.maximum.reduceat(widths[order], starts), np.maximum.reduceat(most[order], starts)]
        return pa.array(order[starts]), sums, *parts

    def lists(rows):
        offsets = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32) if rows.shape[1] else np.zeros(len(rows) + 1, np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), pa.float64()))

    return matrix, add, lists


def _partial(keys: list[str], dim: int) -> Callable:
    """Task function: one row for each key of a batch."""
    matrix, add, lists = _groups()
    names = [*keys, SUM, COUNT, WIDTH, MOST]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, _ = matrix(batch.column(SUM), dim)
            given = batch.column(SUM).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = [batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in (WIDTH, MOST)]
            first, sums, *parts = add([batch.column(k) for k in keys], vectors, given, *numbers)
            columns = [batch.column(k).take(first) for k in keys] + [lists(sums)]
            columns += [pa.array(p, t) for p, t in zip(parts, (pa.int64(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _merged(keys: list[str], dim: int) -> Callable:
    """Task function: partial rows in the order of their keys; the last key of a batch waits for the next one."""
    matrix, add, lists = _groups()
    names = [*keys, SUM, COUNT, WIDTH, MOST]

    def run(batches):
        import pyarrow as pa

        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            arrived = pa.Table.from_arrays([batch.column(n) for n in names], names)
            table = arrived if waiting is None else pa.concat_tables([waiting, arrived])
            columns = {n: table.column(n).combine_chunks() for n in names}
            vectors, _ = matrix(columns[SUM], dim)
            numbers = [columns[n].to_numpy(zero_copy_only=False) for n in (COUNT, WIDTH, MOST)]
            first, sums, *parts = add([columns[k] for k in keys], vectors, *numbers)
            order = first.to_numpy().argsort()  # keys in the order in which they came
            arrays = [columns[k].take(first.take(pa.array(order))) for k in keys] + [lists(sums[order])]
            arrays += [pa.array(p[order], t) for p, t in zip(parts, (pa.int64(), pa.int32(), pa.int64()))]
            done = pa.Table.from_arrays(arrays, names)
            waiting = done.slice(done.num_rows - 1)
            yield from done.slice(0, done.num_rows - 1).to_batches()
        if waiting is not None:
            yield from waiting.to_batches()

    return run


def sum_vectors(
    df: DataFrame, keys: list[str], vec: str, dim: int, most: str | None = None, width: str | None = None
) -> DataFrame:
    """The keys with ``_sum`` (array of ``dim`` doubles), ``_count`` (vectors added), ``_width`` (of the longest one) and ``_most``.

    ``_most`` is the greatest value of another column; another column may give the widths as well. A NULL vector counts for nothing, NULL elements and
    those that a short vector lacks add nothing; a vector longer than ``dim`` fails the job. Rows of a key are added
    up in each batch before the shuffle, and partial sums after it as they stream by in key order, so no group is
    ever held: a key with a third of all rows moves one row for each batch that has it.
    """
    greatest = F.lit(0).cast("bigint") if most is None else F.col(most).cast("bigint")
    size = F.when(F.col(vec).isNotNull(), F.size(vec)) if width is None else F.col(width).cast("int")
    rows = df.select(*keys, F.col(vec).cast("array<double>").alias(SUM), size.alias(WIDTH), greatest.alias(MOST))
    fields = [df.schema[k] for k in keys]
    fields += [T.StructField(SUM, T.ArrayType(T.DoubleType())), T.StructField(COUNT, T.LongType())]
    schema = T.StructType([*fields, T.StructField(WIDTH, T.IntegerType()), T.StructField(MOST, T.LongType())])
    partial = rows.mapInArrow(_partial(keys, dim), schema)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merged(keys, dim), schema)
