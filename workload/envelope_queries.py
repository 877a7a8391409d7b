"""JSON envelopes, landed pages, and the merges fed by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_with_actions
from tidemark.plans import org_units
from tidemark.plans.hours import load_pages
from tidemark.plans.product_model import refresh
from tidemark.plans.systems import SYSTEM_FIELDS, SYSTEM_MERGE, SYSTEM_PATHS, SYSTEM_RESPONSE, SYSTEMS
from tidemark.sources.envelope import (
    Field,
    append_envelopes,
    pack_records,
    read_envelopes,
    records,
    replace_entities,
)
from tidemark.sources.extracts import flatten, read_records
from tidemark.sources.tables import read_relation, read_snapshot, shared_folder
from workload.merge_queries import both
from workload.merge_sql import any_differs, merge_sql
from workload.registry import RUN_TS, project, query, select_sql, table

_ACCOUNT_FIELDS = (
    Field("c_custkey", "bigint", strict=True),
    Field("c_name", "string"),
    Field("c_acctbal", "decimal(19,4)"),
    Field("c_mktsegment", "string"),
)
_ACCOUNT = {
    "c_custkey": "c_custkey",
    "c_name": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END",
    "c_acctbal": "CAST(c_acctbal AS DECIMAL(19,4))",
    "c_mktsegment": "CONCAT('\"', c_mktsegment, '\" \\\\ ')",
}


def _nation() -> Column:
    return F.concat(F.lit("nation "), F.col("c_nationkey"))


@query(
    """
    SELECT 'nation ' || c_nationkey AS entity, c_custkey,
           CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END AS c_name,
           CAST(c_acctbal AS DECIMAL(19,4)) AS c_acctbal, '"' || c_mktsegment || '" \\ ' AS c_mktsegment
    FROM customer
    """
)
def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    accounts = project(table(spark, sf, "customer"), {**_ACCOUNT, "c_nationkey": "c_nationkey"})
    packed = pack_records(accounts, _nation(), list(_ACCOUNT), max_bytes=20_000)
    return records(packed, None, _ACCOUNT_FIELDS)


@query(
    """
    SELECT 'nation ' || c_nationkey AS entity, c_custkey,
           CASE WHEN c_nationkey = 7 THEN 2 ELSE 1 END * CAST(c_acctbal AS DECIMAL(18,4)) AS c_acctbal
    FROM customer WHERE c_nationkey <> 8
    """
)
def entity_replace(spark: SparkSession, sf: str) -> DataFrame:
    """All nations staged, then one replaced by new records and one by an empty extract."""
    accounts = project(
        table(spark, sf, "customer"),
        {"c_nationkey": "c_nationkey", "c_custkey": "c_custkey", "c_acctbal": "CAST(c_acctbal AS DECIMAL(18,4))"},
    )
    path = shared_folder(spark, "envelopes")
    append_envelopes(pack_records(accounts, _nation(), ["c_custkey", "c_acctbal"]), path)
    changed = accounts.filter("c_nationkey = 7").withColumn("c_acctbal", F.expr("CAST(2 * c_acctbal AS DECIMAL(18,4))"))
    replace_entities(
        pack_records(changed, _nation(), ["c_custkey", "c_acctbal"]), path, ["nation 7", "nation 8"]
    )
    fields = (Field("c_custkey", "bigint", strict=True), Field("c_acctbal", "decimal(18,4)"))
    return records(read_envelopes(spark, path), None, fields)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_path_extract(spark: SparkSession, sf: str) -> DataFrame:
    parsed = table(spark, sf, "events").select("event_id", F.from_json("props", "k string").alias("p"))
    return flatten(parsed, {"event_id": "event_id", "k": F.col("p.k").cast("int")})


# --- landed pages --------------------------------------------------------------------------------


@query(
    """
    SELECT c_custkey AS id, c_mktsegment AS kind,
           CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS hours
    FROM customer
    """
)
def json_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers landed as pages with one array each, and one page with an empty array; staging is
    emptied and loaded from them."""
    rows = project(
        table(spark, sf, "customer"),
        {
            "id": "c_custkey",
            "kind": "c_mktsegment",
            "hours": "CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END",
        },
    )
    packed = pack_records(rows, F.lit("hours"), rows.columns, max_bytes=20_000)
    page = F.concat(F.lit('{"timeAllocations": '), F.col("json_text"), F.lit("}"))
    empty = spark.range(1).select(F.lit('{"timeAllocations": []}').alias("value"))
    landed, staging = shared_folder(spark, "pages"), shared_folder(spark, "hours")
    packed.select(page.alias("value")).unionByName(empty).write.text(landed)
    load_pages(spark, landed, "id bigint, kind string, hours decimal(18,2)", staging)
    return read_relation(spark, staging)


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS id,
           CASE WHEN s_acctbal < 0 THEN s_name || ' new' ELSE s_name END AS title,
           CASE WHEN s_acctbal < 0 THEN NULL ELSE 'nation' END AS description,
           CAST(s_nationkey AS VARCHAR) AS org_code, 'S' AS short_name
    FROM supplier
    UNION ALL SELECT 'x' || s_suppkey, s_name || ' new', NULL, CAST(s_nationkey AS VARCHAR), 'S'
    FROM supplier WHERE s_acctbal >= 0
    """
)
def org_units_load(spark: SparkSession, sf: str) -> DataFrame:
    """Units landed as JSON arrays, picked by name, loaded into staging by id: a first load, and
    one that changes some units and brings new ones, run twice."""
    unit = {
        "title": "s_name",
        "unused": "s_acctbal",
        "id": "CAST(s_suppkey AS STRING)",
        "org_code": "CAST(s_nationkey AS STRING)",
        "short_name": "'S'",
    }
    supplier = table(spark, sf, "supplier")
    first = project(supplier, {**unit, "description": "'nation'"})
    changed_id = "CASE WHEN s_acctbal < 0 THEN CAST(s_suppkey AS STRING) ELSE CONCAT('x', s_suppkey) END"
    second = project(supplier, {**unit, "id": changed_id, "title": "CONCAT(s_name, ' new')"})
    root, landings = shared_folder(spark, "units"), []
    for units in (first, second):
        landings.append(shared_folder(spark, "landed-units"))
        pages = pack_records(units, F.lit("units"), units.columns)
        pages.select(F.col("json_text").alias("value")).write.text(landings[-1])
    for landed in (*landings, landings[1]):
        org_units.load_units(spark, landed, root)
    return read_snapshot(spark, root)


# --- systems: responses to envelopes to merge ------------------------------------------------------

_RESPONSE = {
    "objectId": "c_custkey",
    "systemId": "c_nationkey",
    "name": "CASE WHEN c_nationkey = 2 THEN NULL ELSE c_name END",
    "className": "c_mktsegment",
    "owner": "CASE WHEN c_nationkey = 5 THEN NULL ELSE named_struct('login', c_mktsegment, 'userName', c_name) END",
    "status": "c_mktsegment",
    "realServers": "c_nationkey",
    "virtualServers": "CASE WHEN c_nationkey = 6 THEN NULL ELSE 1 END",
    "url": "c_name",
    "isTest": "c_acctbal < 0",
}
_STORED = {
    "ObjectId": "CAST(c_custkey AS INT)",
    "SystemId": "c_nationkey",
    "Name": "c_name",
    "ClassName": "c_mktsegment",
    "Owner": "c_name",
    "OwnerLogin": "c_mktsegment",
    "Status": "CASE WHEN c_nationkey = 8 THEN 'old' ELSE c_mktsegment END",
    "RealServers": "c_nationkey",
    "VirtualServers": "1",
    "Person": "CAST(NULL AS STRING)",
    "PersonLogin": "''",
    "Url": "c_name",
    "IsTest": "CASE WHEN c_acctbal < 0 THEN TRUE END",
    "IS_DELETED": "CASE WHEN c_nationkey = 10 THEN 1 ELSE 0 END",
    "DELETED_AT": "CAST(NULL AS TIMESTAMP_NTZ)",
}
_SENT = {
    "ObjectId": "CAST(c_custkey AS INT)",
    "SystemId": "c_nationkey",
    "Name": "CASE WHEN c_nationkey = 2 THEN '' ELSE c_name END",
    "ClassName": "c_mktsegment",
    "Owner": "CASE WHEN c_nationkey = 5 THEN '' ELSE c_name END",
    "OwnerLogin": "CASE WHEN c_nationkey = 5 THEN '' ELSE c_mktsegment END",
    "Status": "c_mktsegment",
    "RealServers": "c_nationkey",
    "VirtualServers": "CASE WHEN c_nationkey = 6 THEN 0 ELSE 1 END",
    "Person": "''",
    "PersonLogin": "''",
    "Url": "c_name",
    "IsTest": "c_acctbal < 0",
}
_SENT_COLUMNS = [c for c in _SENT if c not in ("ObjectId", "SystemId")]
_DEFAULTED = {"Person": "''", "PersonLogin": "''", "OwnerLogin": "''", "IsTest": "FALSE"}


@query(
    merge_sql(
        select_sql({n: both(e) for n, e in _STORED.items()}, "customer WHERE c_mktsegment <> 'BUILDING'"),
        select_sql(_SENT, "customer WHERE c_mktsegment <> 'MACHINERY'"),
        ["ObjectId", "SystemId"],
        {c: f's."{c}"' for c in _SENT_COLUMNS},
        "(t.IS_DELETED = 1 OR t.DELETED_AT IS NOT NULL OR "
        + any_differs(
            [
                (f's."{c}"', f'COALESCE(t."{c}", {_DEFAULTED[c]})' if c in _DEFAULTED else f't."{c}"')
                for c in _SENT_COLUMNS
            ]
        )
        + ")",
        list(_STORED),
        absent="soft",
        flag="IS_DELETED",
        deleted_at="DELETED_AT",
    )
)
def envelope_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Nested responses landed as JSON, flattened by path, packed, staged, parsed and merged."""
    customer = table(spark, sf, "customer")
    landed, staging = shared_folder(spark, "responses"), shared_folder(spark, "envelopes")
    project(customer.filter("c_mktsegment <> 'MACHINERY'"), _RESPONSE).write.json(landed)
    flat = read_records(spark, landed, SYSTEM_RESPONSE, SYSTEM_PATHS)
    replace_entities(pack_records(flat, F.lit(SYSTEMS), list(SYSTEM_PATHS)), staging, [SYSTEMS])
    target = project(customer.filter("c_mktsegment <> 'BUILDING'"), _STORED)
    source = records(read_envelopes(spark, staging), SYSTEMS, SYSTEM_FIELDS)
    return merge_with_actions(target, source, SYSTEM_MERGE, RUN_TS)


# --- flat table ------------------------------------------------------------------------------------


@query("SELECT * FROM lineitem")
def flat_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The whole table but its load time, written as the next snapshot and read back."""
    root = shared_folder(spark, "flat")
    lineitem = table(spark, sf, "lineitem")
    refresh(lineitem.withColumn("loaded_at", F.lit(RUN_TS)), root)
    return read_snapshot(spark, root)


