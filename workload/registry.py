"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 1, 1)
RUN_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Run], Run]:
    """Register a query, by its function name if no other, with the SQL that must give the same
    rows."""

    def add(run: Run) -> Run:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key], SQL[key] = run, sql
        return run

    return add


# Declared, so that opening a table reads no file footers ahead of the query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns given as name and SQL expression; the expressions are valid in both engines."""
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])


def select_sql(columns: dict[str, str], relation: str) -> str:
    body = ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"SELECT {body} FROM {relation}"
