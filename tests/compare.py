"""Compare a registered query with its SQL: row count, columns, types and values.

``python -m tests.compare [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(rows, order):
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=_key)


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    mine = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if sorted(mine) != sorted(theirs):
        return f"columns {sorted(mine)} / {sorted(theirs)}"
    types = {c: (mine[c], theirs[c]) for c in mine if mine[c] != theirs[c]}
    if types:
        return f"types {types}"
    names = sorted(mine)
    got = _rows([tuple(r) for r in df.collect()], [df.columns.index(c) for c in names])
    want = _rows(expected, [list(theirs).index(c) for c in names])
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, e.g. {wrong[0]}" if wrong else None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf), oracle_sql()
    names = sys.argv[2:] or list(queries())
    bad = 0
    for name in names:
        start = time.perf_counter()
        try:
            df = queries()[name](spark, sf)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                found = "same" if problem is None else problem
            else:
                problem, found = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report every query
            problem = found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {name:28s} {time.perf_counter() - start:6.1f}s  {found}", flush=True)
    print(f"{bad} of {len(names)} differ")


if __name__ == "__main__":
    main()
