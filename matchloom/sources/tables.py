"""Parquet tables and the preprocessed set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

INDEXED = "indexed"
USER_DICT = "userDict"
ITEM_DICT = "itemDict"


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; ``path`` may hold globs. A declared schema spares reading the footers.

    A temporary view of the session may be named in place of a path, for rows too many to be stored.
    """
    if path.isidentifier() and spark.catalog.tableExists(path):
        return spark.table(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a Parquet table.

    ``files`` bounds the number of files by a shuffle, so that the stage before keeps its
    parallelism; unset, every task writes its own file.
    """
    out = df if files is None else df.repartition(files)
    out.write.mode("overwrite").parquet(path)


def write_preprocessed(
    indexed: DataFrame, user_dict: DataFrame, item_dict: DataFrame, base: str, files: int | None = None
) -> None:
    write_table(indexed, f"{base}/{INDEXED}", files)
    write_table(user_dict, f"{base}/{USER_DICT}")
    write_table(item_dict, f"{base}/{ITEM_DICT}")


def read_preprocessed(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexed interactions (without the original ids), user vectors and item vectors."""
    indexed = read_table(spark, f"{base}/{INDEXED}").drop("userIdOrg", "itemIdOrg")
    return indexed, read_table(spark, f"{base}/{USER_DICT}"), read_table(spark, f"{base}/{ITEM_DICT}")
