"""Compares a Spark result with the SQL oracle: names, types and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in glob.glob(f"{path}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    def text(v: object) -> str:
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "∅"
        if isinstance(v, float):
            return f"{v:.6f}"
        if isinstance(v, bool):
            return str(v)
        return str(int(v)) if hasattr(v, "dtype") and v.dtype.kind in "iu" else str(v)

    return sorted(tuple(text(v) for v in row) for row in df.astype(object).itertuples(index=False))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty where both sides agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    types = dict(
        (r[0], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()
    )
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        want = _KINDS.get(kind, kind)
        if types[name] != want:
            found.append(f"type of {name}: {kind} vs {types[name]}")
    order = sorted(names)
    ours = _rows(pd.DataFrame([tuple(r) for r in spark_df.select(*order).collect()], columns=order, dtype=object))
    at = [names.index(n) for n in order]
    theirs = _rows(pd.DataFrame([tuple(r[i] for i in at) for r in expected], columns=order, dtype=object))
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} vs {len(theirs)}")
    if ours != theirs:
        only_us = [r for r in ours if r not in set(theirs)][:3]
        only_them = [r for r in theirs if r not in set(ours)][:3]
        found.append(f"values: ours {only_us} theirs {only_them} ({order})")
    return found
