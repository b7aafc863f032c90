"""Runs registered queries beside their SQL: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normalised(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    # whole numbers with nulls arrive as doubles from one side and as nullable integers from the other
    frame = frame.astype({c: "float64" for c in frame.columns if str(frame[c].dtype) == "Int64"})
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    left, right = normalised(ours), normalised(theirs)
    for name in left.columns:
        if left[name].dtype != right[name].dtype:
            return f"{name}: {left[name].dtype} != {right[name].dtype}"
        same = (left[name] == right[name]) | (left[name].isna() & right[name].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{name}[{i}]: {left[name][i]!r} != {right[name][i]!r} ({(~same).sum()} rows differ)"
    return ""


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    wanted = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            ours = entry.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in oracles:
                result = differences(ours, con.sql(oracles[name]).df()) or "ok"
            else:
                result = "rows only"
        except Exception as error:  # noqa: BLE001
            took, ours, result = time.time() - start, [], f"{type(error).__name__}: {str(error)[:600]}"
        bad += result not in ("ok", "rows only")
        print(f"{name:28s} {len(ours):8d} rows {took:7.2f}s  {result}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
