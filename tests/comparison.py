"""Compare a Spark result with DuckDB: columns, types, rows and values, in any order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], int]:
    """Differences found (none if equal) and the number of rows."""
    expected = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(expected.columns):
        return [f"columns {names} vs {sorted(expected.columns)}"], 0
    problems = []
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(expected.columns, [str(t) for t in expected.types]))
    for n in names:
        if TYPES.get(spark_types[n]) != duck_types[n]:
            problems.append(f"type of {n}: {spark_types[n]} vs {duck_types[n]}")
    got = Counter(tuple(_value(r[n]) for n in names) for r in df.collect())
    order = [expected.columns.index(n) for n in names]
    want = Counter(tuple(_value(r[i]) for i in order) for r in expected.fetchall())
    if got != want:
        problems.append(f"{sum(got.values())} vs {sum(want.values())} rows; extra {list((got - want).items())[:3]}; "
                        f"missing {list((want - got).items())[:3]}")
    return problems, sum(want.values())
