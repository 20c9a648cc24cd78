"""Lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024  # the driver builds a broadcast, and several times these bytes pass through its memory
ROW_BYTES = 32  # what a row of a broadcast takes beside its values
HOT_ROWS = 1_000_000  # rows of one key that a task may take whole


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session: ``spark.checkpoint.dir`` or one set before.

    Only a local session without a folder gets a temporary one; on a cluster the folder
    has to be shared, so a missing setting is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="matchloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps read the stored rows, also after losing executors."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written below the checkpoint folder column by column, which takes far less disk than a checkpoint of narrow rows."""
    path = f"{use_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True when the table holds at most ``limit / row_bytes`` rows; counts no further than that."""
    most = max(1, limit // row_bytes)
    return df.limit(most + 1).count() <= most


def _column_bytes(field: T.StructField) -> Column:
    """Bytes of a value as joins hold it."""
    kind, value = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(value)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.size(value) * (4 if isinstance(kind.elementType, (T.FloatType, T.IntegerType)) else 8)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(value)))
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows by the lengths of their values; one aggregate, combined within the tasks."""
    row = reduce(Column.__add__, [F.coalesce(_column_bytes(f), F.lit(0)) for f in df.schema.fields], F.lit(ROW_BYTES))
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join a large table with a one-row-per-key lookup on a key that may be hot.

    A lookup measured to be small is broadcast. Otherwise the keys of the facts are counted, and only a key
    with over ``hot_rows`` rows has its lookup row copied, once per ``hot_rows``, with its facts spread over
    the copies by their other columns; all other keys are joined as they are. Facts and lookup are read
    twice, so costly ones should be stored before; or keys are counted in ``counted``, with no fewer rows of a key.
    """
    if measured_bytes(lookup) <= limit:
        return facts.join(F.broadcast(lookup), key, how)
    counted = facts if counted is None else counted
    counts = counted.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = cut_lineage(counts.select(key, F.ceil(F.col("_n") / hot_rows).alias("_copies")))
    if hot.isEmpty():
        return facts.join(lookup.hint("merge"), key, how)  # Spark's estimate may be far below what was measured
    hot = F.broadcast(hot) if measured_bytes(hot) <= limit else hot
    spread, copied = spread_hot_keys(facts, lookup, key, hot)
    return spread.join(copied.hint("merge"), [key, "_salt"], how).drop("_salt")


def spread_hot_keys(facts: DataFrame, lookup: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: lookup rows of the hot keys in ``_copies`` copies, their facts spread over them."""
    copies = F.coalesce(F.col("_copies"), F.lit(1).cast("bigint"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns if c != key] or [F.col(key)]), copies)
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))
    return tuple(
        side.join(hot, key, "left").withColumn("_salt", number).drop("_copies") for side, number in ((facts, salt), (lookup, salts))
    )


def hash_number(*keys: Column, hex_digits: int = 15) -> Column:
    """Whole number from the MD5 digest of the keys: the same draw on every recomputation."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]).cast("binary"))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def hash_fraction(*keys: Column) -> Column:
    """Number in [0, 1) from the MD5 digest of the keys."""
    return hash_number(*keys, hex_digits=8) / F.lit(4294967296.0)
