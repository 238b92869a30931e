"""Runs a query on Spark and its oracle on DuckDB and compares schema names and all rows."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import SparkSession

from testbed.queries import ORACLES, QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> int:
    """Number of rows if both engines agree; AssertionError with the first differences otherwise."""
    df = QUERIES[name](spark, sf_dir)
    got = _normal(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns), f"{name}: columns {sorted(df.columns)} vs oracle {sorted(columns)}"
    want = _normal(columns, result.fetchall())
    if got != want:
        only_got, only_want = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
        raise AssertionError(
            f"{name}: {len(got)} rows vs {len(want)}; columns {sorted(columns)}\n spark only {len(only_got)}: "
            f"{only_got[:3]}\n oracle only {len(only_want)}: {only_want[:3]}"
        )
    return len(got)
