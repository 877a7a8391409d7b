"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import NO_PREFIX, OTHER_PRODUCTS_LABEL, PRODUCT_TYPE_LABELS
from tidemark.functions import dates, defaults, text
from workload.catalogue_queries import _CODE, _labels
from workload.registry import project, query, table


@query(
    f"""
    SELECT p_partkey, CASE WHEN POSITION('.' IN c) > 1 THEN LEFT(c, POSITION('.' IN c) - 1) ELSE 'BPR' END AS prefix_a,
           SPLIT_PART(c, '.', 1) AS prefix_b, {_labels("UPPER(SPLIT_PART(c, '.', 1))")} AS label_b
    FROM (SELECT p_partkey, {_CODE} AS c FROM part)
    """
)
def code_functions(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("c")
    return project(table(spark, sf, "part"), {"p_partkey": "p_partkey", "c": _CODE}).select(
        "p_partkey",
        text.prefix_or_fallback(code, NO_PREFIX).alias("prefix_a"),
        text.prefix(code).alias("prefix_b"),
        defaults.label(F.upper(text.prefix(code)), PRODUCT_TYPE_LABELS, OTHER_PRODUCTS_LABEL).alias("label_b"),
    )


@query(
    """
    SELECT c_custkey, NULLIF(c_nationkey, 0) AS code, COALESCE(n, 'none') AS name,
           CASE WHEN c_nationkey <> 0 THEN n END AS guarded,
           CONCAT(n, '/', c_nationkey) AS joined, n || '/' || c_nationkey AS strict_joined
    FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS n FROM customer)
    """
)
def null_functions(spark: SparkSession, sf: str) -> DataFrame:
    named = project(
        table(spark, sf, "customer"),
        {"c_custkey": "c_custkey", "code": "c_nationkey", "n": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END"},
    )
    code, name = F.col("code"), F.col("n")
    parts = (name, F.lit("/"), code.cast("string"))
    return named.select(
        "c_custkey",
        defaults.zero_to_null(code).alias("code"),
        defaults.or_default(name, "none").alias("name"),
        defaults.name_of_code(code, name).alias("guarded"),
        text.join_nulls_empty(*parts).alias("joined"),
        text.join_nulls_win(*parts).alias("strict_joined"),
    )


# The whitespace of SPACE_RUN, spelled out for an engine whose \s is ASCII only.
_SPACES = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|\\n"
)


@query(
    f"""
    SELECT doc_id, LENGTH(REGEXP_REPLACE(text, '{_SPACES}', ' ', 'g')) AS n,
           MD5(REPLACE(REGEXP_REPLACE(text, '{_SPACES}', ' ', 'g'), '"', '\\"')) AS digest,
           SUBSTR(source, 1, 4) AS head
    FROM documents
    """
)
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Blanks collapsed and quotes escaped over whole texts; sources cut to a width the caller gives."""
    clean = text.collapse_space(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.length(clean).cast("bigint").alias("n"),
        F.md5(text.escape_quotes(clean).cast("binary")).alias("digest"),
        text.cut(F.col("source"), 4).alias("head"),
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE CAST(user_id AS INT) END AS code,
           CASE WHEN event_type = 'error' THEN 'null'
                ELSE REPLACE(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ',', '.') END AS number,
           DATE_TRUNC('minute', ts) AS minute,
           CASE WHEN event_type = 'view' THEN 'soon' ELSE STRFTIME(ts, '%Y-%m-%d') END AS iso
    FROM events
    """
)
def value_functions(spark: SparkSession, sf: str) -> DataFrame:
    rows = project(
        table(spark, sf, "events"),
        {
            "event_id": "event_id",
            "code": "CASE WHEN event_type = 'view' THEN 'None' ELSE CAST(user_id AS STRING) END",
            "number": "CASE WHEN event_type <> 'error' THEN replace(CAST(CAST(value AS DECIMAL(18,2)) AS STRING), '.', ',') END",
            "ts": "ts",
            "day": "CASE WHEN event_type = 'view' THEN 'soon' ELSE date_format(ts, 'd.MM.yyyy') END",
        },
    )
    return rows.select(
        "event_id",
        text.none_text_to_int(F.col("code")).alias("code"),
        text.number_text(F.col("number")).alias("number"),
        dates.to_minute(F.col("ts")).alias("minute"),
        dates.day_first_to_iso(F.col("day")).alias("iso"),
    )
