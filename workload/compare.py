"""Run a query and its SQL side by side and report the first difference."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from workload.registry import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, bool):
        return str(value).lower()
    return value if value is None else f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(named, key=lambda r: tuple("" if v is None else "~" + str(v) for v in r))


def difference(spark: SparkSession, db: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    frame = QUERIES[name](spark, sf_dir)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(SQL[name])
    theirs = _rows([c[0] for c in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    if not ours[1]:
        return "no rows"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(ours[0], a, b) if x != y]
            return f"first differing cells {cells[:4]} in {a}"
    return None
