"""Compares registered queries with their SQL, value by value.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(directory: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _kind(series: pd.Series) -> str:
    kind = str(series.dtype)
    if kind.startswith("datetime64"):
        return "time" if "UTC" not in kind else "time-utc"
    if kind.startswith(("int", "uint", "Int")):
        return "int"
    return kind


def _canonical(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value
    if isinstance(value, pd.Timestamp):
        return value.to_datetime64().astype("datetime64[us]").astype("int64")
    return value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(_canonical(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None where both frames hold the same rows, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for c in got.columns:
        a, b = _kind(got[c]), _kind(want[c])
        if a != b and not {a, b} <= {"object", "str", "bool", "boolean"}:
            if len(got) and not got[c].isna().any():
                return f"type of {c}: {a} != {b}"
    for a, b in zip(_rows(got), _rows(want)):
        if a != b:
            return f"{sorted(got.columns)}: {a} != {b}"
    return None


TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, con, sql: str) -> str | None:
    """Columns whose declared types differ."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want = {row[0]: row[1] for row in described}
    got = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    off = {c: (got[c], want.get(c)) for c in got if got[c] != want.get(c)}
    return f"types {off}" if off else None


def check(spark, con, directory: str, name: str, query, sql: str | None) -> tuple[str | None, int, float]:
    start = time.time()
    df = query(spark, directory)
    got = df.toPandas()
    seconds = time.time() - start
    if sql is None:
        return (None if len(got) else "no rows"), len(got), seconds
    want = con.execute(sql).fetchdf()
    return difference(got, want) or type_difference(df, con, sql), len(got), seconds


def main() -> int:
    from gridlake.queries import ORACLE, QUERIES
    from gridlake.session import build_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "oracle", "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    bad = 0
    for name in chosen:
        try:
            problem, rows, seconds = check(spark, con, directory, name, QUERIES[name], ORACLE.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:700]}", 0, 0.0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:28} {rows:8d} rows {seconds:6.2f}s"
              f"{'' if name in ORACLE else ' (rows only)'} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
