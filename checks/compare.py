"""Run registered queries against their SQL: ``python -m checks.compare SF [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.catalog import all_queries
from checks.oracle import all_sql

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def local_session(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docwatch-checks-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA / sf / name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.map(lambda v: "NULL" if v is None or v is pd.NA or v != v else _plain(v))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def _plain(value) -> str:
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return str(value)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = {c: (ours[c].dtype.kind, theirs[c].dtype.kind) for c in ours.columns if len(ours)}
    unlike = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if unlike:
        return f"types {unlike}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    unlike = (a != b).any(axis=1)
    if not unlike.any():
        return None
    place = unlike.idxmax()
    columns = [c for c in a.columns if a.at[place, c] != b.at[place, c]]
    shown = [(c, a.at[place, c][:300], b.at[place, c][:300]) for c in columns]
    return f"{int(unlike.sum())} rows differ, first: {dict(a.loc[place].str[:40])} {shown}"


def main(sf: str, names: list[str]) -> int:
    spark, con = local_session(int(os.environ.get("CHECK_CPUS", "8"))), database(sf)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    sql = all_sql()
    for name, fn in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = fn(spark, str(DATA / sf)).toPandas()
            took = time.time() - start
            found = "rows only" if name not in sql else difference(ours, con.execute(sql[name]).df())
            verdict = "ok" if found is None else found
        except Exception as error:  # report and go on with the next query
            took, verdict, ours = time.time() - start, f"ERROR {str(error)[:1500]}", []
        failed += verdict not in ("ok", "rows only")
        print(f"{name:28s} {took:6.1f}s {len(ours):7d} {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
