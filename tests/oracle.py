"""Side-by-side comparison of a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

SAME_TYPE = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).tz_localize(None).isoformat()
    return value


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in records), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """Human-readable mismatches of names, types, row counts and values; empty when equal."""
    relation = con.sql(sql)
    names, kinds = relation.columns, [str(t) for t in relation.types]
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: spark {sorted(spark_df.columns)} sql {sorted(names)}"]
    mine = dict(spark_df.dtypes)
    for name, kind in zip(names, kinds):
        if SAME_TYPE.get(kind) != mine[name]:
            found.append(f"type of {name}: spark {mine[name]} sql {kind}")
    left = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    right = _rows(names, relation.fetchall())
    if len(left) != len(right):
        found.append(f"rows: spark {len(left)} sql {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    if bad:
        found.append(f"{len(bad)} rows differ, first: spark {bad[0][0]} sql {bad[0][1]}")
    return found
