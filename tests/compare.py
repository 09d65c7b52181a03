"""Side-by-side run of the registered queries and their SQL: python tests/compare.py FOLDER [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def database(folder: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, one type per kind of value, rows in order."""
    out = {}
    for name in sorted(df.columns):
        column = df[name]
        if pd.api.types.is_bool_dtype(column):
            out[name] = column.astype(object)
        elif pd.api.types.is_numeric_dtype(column):
            out[name] = column.astype("float64").round(6) + 0.0
        else:
            out[name] = column.astype(object).where(column.notna(), None)
    frame = pd.DataFrame(out)
    return frame.sort_values(list(frame.columns), kind="stable", key=lambda c: c if c.dtype != object else c.map(repr)).reset_index(drop=True)


def difference(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} and {sorted(wanted.columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} and {len(wanted)}"
    got, wanted = plain(got), plain(wanted)
    for name in got.columns:
        a, b = got[name], wanted[name]
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            at = int(np.flatnonzero(~same)[0])
            return f"{(~same).sum()} values of {name}, first {a[at]!r} and {b[at]!r}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    oracle = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            got = query(spark, folder).toPandas()
            took = time.time() - start
            start = time.time()
            verdict = "rows only"
            if name in oracle:
                verdict = difference(got, connection.execute(oracle[name]).df()) or "equal"
        except Exception as problem:  # noqa: BLE001
            verdict, got, took = f"FAILED {type(problem).__name__}: {str(problem)[:600]}", [], 0
        print(f"{name:20s} {len(got):8d} rows  {took:6.2f} s  sql {time.time() - start:6.2f} s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
