"""The merge family over orders, lineitem, events, customers, parts.

Target and source are two states of one table: the target lacks the newest rows, the source
lacks the oldest, and values differ or are NULL by attributes of the row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import keyed_upsert, merge_with_actions, soft_delete_absent
from tidemark.plans import issues
from tidemark.plans.catalogue import PRODUCT_MERGE
from tidemark.plans.corrections import ADDED_FACT_MERGE, TRANSFER_MERGE
from tidemark.plans.issues import STATUS_UPDATE, returned_statuses
from tidemark.plans.systems import CONSUMPTION_MERGE, SYSTEM_MERGE, SYSTEM_UPSERT
from tidemark.sources.tables import read_relation, read_snapshot, shared_folder, write_snapshot
from workload.merge_sql import any_differs, merge_sql
from workload.registry import RUN_TS, RUN_TS_SQL, project, query, select_sql, table

OLD = "TIMESTAMP_NTZ '2023-05-05 00:00:00'"
OLD_SQL = "TIMESTAMP '2023-05-05 00:00:00'"
NO_TIME = "CAST(NULL AS TIMESTAMP_NTZ)"
NO_TIME_SQL = "CAST(NULL AS TIMESTAMP)"


def both(text: str) -> str:
    """An expression as DuckDB spells its types."""
    return text.replace("TIMESTAMP_NTZ", "TIMESTAMP").replace(" STRING)", " VARCHAR)")


def sql_of(columns: dict[str, str], relation: str) -> str:
    return select_sql({n: both(e) for n, e in columns.items()}, relation)


# --- added facts: both sides compared as they are ---------------------------------------------

_ADDED = {
    "AddedFactId": "CAST(o_orderkey AS STRING)",
    "ConversionPeriodId": "o_orderpriority",
    "PersonId": "CAST(o_custkey AS STRING)",
    "CreatedAt": "o_orderdate",
    "ConversionTimeAllocationId": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
}
_ADDED_TARGET = {
    **_ADDED,
    "ProjectTo": "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END",
    "AllocationDuration": "CAST(o_totalprice AS DECIMAL(10,2))",
    "IS_DELETED": "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 1 ELSE 0 END",
    "DELETED_AT": f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN {OLD} END",
    "UPDATED_AT": NO_TIME,
}
_ADDED_SOURCE = {
    **_ADDED,
    "ProjectTo": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN NULL "
    "WHEN o_orderpriority = '3-MEDIUM' THEN 'N' ELSE o_orderstatus END",
    "AllocationDuration": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' "
    "THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(o_totalprice AS DECIMAL(10,2)) END",
}
_BEFORE_2000 = "o_orderdate < TIMESTAMP '2000-01-01'"
_SINCE_1996 = "o_orderdate >= TIMESTAMP '1996-01-01'"


def _spark_time(condition: str) -> str:
    return condition.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")


_ADDED_COLUMNS = ["ConversionPeriodId", "PersonId", "ProjectTo", "AllocationDuration", "CreatedAt", "ConversionTimeAllocationId"]


@query(
    merge_sql(
        sql_of(_ADDED_TARGET, f"orders WHERE {_BEFORE_2000}"),
        sql_of(_ADDED_SOURCE, f"orders WHERE {_SINCE_1996}"),
        ["AddedFactId"],
        {c: f's."{c}"' for c in _ADDED_COLUMNS},
        "(t.IS_DELETED = 1 OR t.DELETED_AT IS NOT NULL OR "
        + any_differs([(f's."{c}"', f't."{c}"') for c in _ADDED_COLUMNS])
        + ")",
        list(_ADDED_TARGET),
        absent="soft",
        flag="IS_DELETED",
        deleted_at="DELETED_AT",
        updated_at="UPDATED_AT",
    )
)
def merge_soft_delete_raw(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    target = project(orders.filter(_spark_time(_BEFORE_2000)), _ADDED_TARGET)
    source = project(orders.filter(_spark_time(_SINCE_1996)), _ADDED_SOURCE)
    return merge_with_actions(target, source, ADDED_FACT_MERGE, RUN_TS)


# --- fact transfers: as above, but a missing legal entity reads as 0 ----------------------------

_TRANSFER = {
    "FactTransferId": "CAST(c_custkey AS STRING)",
    "ConversionPeriodId": "c_name",
    "ProjectFrom": "c_mktsegment",
    "CreatedAt": f"CASE WHEN c_nationkey > 5 THEN {OLD} END",
}
_TRANSFER_TARGET = {
    **_TRANSFER,
    "ProjectTo": "CASE WHEN c_nationkey = 9 THEN 'old' ELSE c_mktsegment END",
    "Coefficient": "CAST(c_acctbal AS DECIMAL(10,2))",
    "RmsLegalEntityId": "CASE WHEN c_nationkey < 3 THEN NULL WHEN c_nationkey < 6 THEN 7 ELSE 0 END",
    "IS_DELETED": "CASE WHEN c_nationkey = 20 THEN 1 ELSE 0 END",
    "DELETED_AT": f"CASE WHEN c_nationkey = 20 OR c_nationkey = 21 THEN {OLD} END",
    "UPDATED_AT": OLD,
}
_TRANSFER_SOURCE = {
    **_TRANSFER,
    "ProjectTo": "c_mktsegment",
    "Coefficient": "CASE WHEN c_acctbal < 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(c_acctbal AS DECIMAL(10,2)) END",
    "RmsLegalEntityId": "CASE WHEN c_nationkey > 1 THEN NULL ELSE 4 END",
}
_TRANSFER_WRITES = {
    "ConversionPeriodId": 's."ConversionPeriodId"',
    "ProjectFrom": 's."ProjectFrom"',
    "ProjectTo": 's."ProjectTo"',
    "Coefficient": 's."Coefficient"',
    "CreatedAt": 's."CreatedAt"',
    "RmsLegalEntityId": 'COALESCE(s."RmsLegalEntityId", 0)',
}


@query(
    merge_sql(
        sql_of(_TRANSFER_TARGET, "customer WHERE c_mktsegment <> 'BUILDING'"),
        sql_of(_TRANSFER_SOURCE, "customer WHERE c_mktsegment <> 'MACHINERY'"),
        ["FactTransferId"],
        _TRANSFER_WRITES,
        "(t.IS_DELETED = 1 OR t.DELETED_AT IS NOT NULL OR "
        + any_differs([(e, f't."{c}"') for c, e in _TRANSFER_WRITES.items()])
        + ")",
        list(_TRANSFER_TARGET),
        absent="soft",
        flag="IS_DELETED",
        deleted_at="DELETED_AT",
        updated_at="UPDATED_AT",
    )
)
def merge_fact_transfers(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    target = project(customer.filter("c_mktsegment <> 'BUILDING'"), _TRANSFER_TARGET)
    source = project(customer.filter("c_mktsegment <> 'MACHINERY'"), _TRANSFER_SOURCE)
    return merge_with_actions(target, source, TRANSFER_MERGE, RUN_TS)


# --- systems: two-column key, source defaulted, four columns defaulted on both sides ------------
#
# (l_orderkey, l_linenumber) repeats, so the lines are reduced to one row per pair first.  The
# two flags are single letters and compared by their code: on numbers alone the reduction is a
# hash aggregate and needs no sort.

_LINES = {
    "ObjectId": "CAST(l_orderkey AS INT)",
    "SystemId": "l_linenumber",
    "flag": "CHR(MAX(ASCII(l_returnflag)))",
    "status": "CHR(MAX(ASCII(l_linestatus)))",
    "quantity": "CAST(MAX(l_quantity) AS INT)",
    "part": "CAST(MAX(l_partkey) AS INT)",
    "shipped": "MAX(l_shipdate)",
}
_LINES_SQL = f"({select_sql(_LINES, 'lineitem GROUP BY l_orderkey, l_linenumber')})"
_SYSTEM = {
    "ObjectId": "ObjectId",
    "SystemId": "SystemId",
    "ClassName": "status",
    "OwnerLogin": "CASE WHEN flag = 'N' THEN NULL ELSE flag END",
    "RealServers": "quantity",
    "PersonLogin": "CASE WHEN status = 'O' THEN '' ELSE status END",
    "Url": "CONCAT('u/', CAST(part AS STRING))",
}
_SYSTEM_TARGET = {
    **_SYSTEM,
    "Name": "CASE WHEN quantity = 1 THEN NULL ELSE flag END",
    "Owner": "flag",
    "Status": "CASE WHEN quantity < 5 THEN 'old' ELSE status END",
    "VirtualServers": "CASE WHEN quantity = 10 THEN NULL ELSE SystemId END",
    "Person": "CASE WHEN flag = 'R' THEN NULL ELSE status END",
    "IsTest": "CASE WHEN quantity > 45 THEN TRUE WHEN quantity > 40 THEN NULL ELSE FALSE END",
    "IS_DELETED": "CASE WHEN quantity = 20 THEN 1 ELSE 0 END",
    "DELETED_AT": f"CASE WHEN quantity = 20 THEN {OLD} END",
}
_SYSTEM_SOURCE = {
    **_SYSTEM,
    "Name": "CASE WHEN quantity = 2 THEN NULL ELSE flag END",
    "Owner": "CASE WHEN quantity = 30 THEN NULL ELSE flag END",
    "Status": "status",
    "VirtualServers": "CASE WHEN quantity = 11 THEN NULL ELSE SystemId END",
    "Person": "CASE WHEN flag = 'R' AND status = 'F' THEN '' WHEN flag = 'R' THEN 'x' ELSE status END",
    "IsTest": "CASE WHEN quantity > 42 THEN TRUE ELSE NULL END",
}
_SYSTEM_FILLS = {
    "Name": "''",
    "ClassName": "''",
    "Owner": "''",
    "OwnerLogin": "''",
    "Status": "''",
    "RealServers": "0",
    "VirtualServers": "0",
    "Person": "''",
    "PersonLogin": "''",
    "Url": "''",
    "IsTest": "FALSE",
}
_SYSTEM_BOTH = {"Person", "PersonLogin", "OwnerLogin", "IsTest"}
_SYSTEM_WRITES = {c: f'COALESCE(s."{c}", {v})' for c, v in _SYSTEM_FILLS.items()}
_SHIPPED_OLD = "shipped < TIMESTAMP '2000-06-01'"
_SHIPPED_NEW = "shipped >= TIMESTAMP '1996-06-01'"


@query(
    merge_sql(
        sql_of(_SYSTEM_TARGET, f"{_LINES_SQL} WHERE {_SHIPPED_OLD}"),
        sql_of(_SYSTEM_SOURCE, f"{_LINES_SQL} WHERE {_SHIPPED_NEW}"),
        ["ObjectId", "SystemId"],
        _SYSTEM_WRITES,
        "(t.IS_DELETED = 1 OR t.DELETED_AT IS NOT NULL OR "
        + any_differs(
            [
                (e, f'COALESCE(t."{c}", {_SYSTEM_FILLS[c]})' if c in _SYSTEM_BOTH else f't."{c}"')
                for c, e in _SYSTEM_WRITES.items()
            ]
        )
        + ")",
        list(_SYSTEM_TARGET),
        absent="soft",
        flag="IS_DELETED",
        deleted_at="DELETED_AT",
    )
)
def merge_soft_delete_defaulted(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        *[F.expr(e).alias(n) for n, e in _LINES.items() if "MAX(" in e]
    )
    lines = lines.withColumns({"ObjectId": F.col("l_orderkey").cast("int"), "SystemId": F.col("l_linenumber")})
    target = project(lines.filter(_spark_time(_SHIPPED_OLD)), _SYSTEM_TARGET)
    source = project(lines.filter(_spark_time(_SHIPPED_NEW)), _SYSTEM_SOURCE)
    return merge_with_actions(target, source, SYSTEM_MERGE, RUN_TS)


# --- consumptions: source defaulted, target as it is ----------------------------------------------

_CONSUMPTION = {
    "SOURCE_SYSTEM_ID": "CAST(event_id AS INT)",
    "TYPE": "CASE WHEN event_type = 'error' THEN NULL ELSE event_type END",
    "CONSUMER_OBJECT_ID": "user_id",
    "FOOD_PRODUCT_OBJECT_ID": "CASE WHEN event_type = 'view' THEN NULL ELSE user_id END",
    "LINK_TYPE": "event_type",
    "INTEGRATION_STAGE": "event_type",
    "CONFIRMED_IN_OBS": "CASE WHEN user_id < 10 THEN NULL ELSE user_id > 50 END",
    "COMMENT": "props",
}
_CONSUMPTION_TARGET = {
    **_CONSUMPTION,
    "LINK_WEIGHT": "CASE WHEN user_id = 7 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END",
    "CREATION_DATE": "ts",
    "LAST_CHANGE_DATE": f"CASE WHEN user_id = 13 THEN {OLD} ELSE ts END",
    "STATUS": "CASE WHEN event_type = 'signup' THEN 'new' ELSE event_type END",
    "IS_DELETED": "CASE WHEN user_id = 20 THEN 1 ELSE 0 END",
    "DELETED_AT": f"CASE WHEN user_id = 20 THEN {OLD} END",
}
_CONSUMPTION_SOURCE = {
    **_CONSUMPTION,
    "LINK_WEIGHT": "CASE WHEN user_id = 8 THEN NULL ELSE CAST(value AS DECIMAL(19,4)) END",
    "CREATION_DATE": "CASE WHEN user_id = 14 THEN NULL ELSE ts END",
    "LAST_CHANGE_DATE": "ts",
    "STATUS": "CASE WHEN user_id = 30 THEN 'done' WHEN event_type = 'signup' THEN 'new' ELSE event_type END",
}
_CONSUMPTION_FILLS = {
    "TYPE": "''",
    "CONSUMER_OBJECT_ID": "0",
    "FOOD_PRODUCT_OBJECT_ID": "0",
    "LINK_TYPE": "''",
    "LINK_WEIGHT": "CAST(0 AS DECIMAL(19,4))",
    "INTEGRATION_STAGE": "''",
    "CONFIRMED_IN_OBS": "FALSE",
    "CREATION_DATE": "TIMESTAMP '0001-01-01 00:00:00'",
    "LAST_CHANGE_DATE": "TIMESTAMP '0001-01-01 00:00:00'",
    "STATUS": "''",
    "COMMENT": "''",
}
_CONSUMPTION_WRITES = {c: f'COALESCE(s."{c}", {v})' for c, v in _CONSUMPTION_FILLS.items()}
_EARLY = "ts < TIMESTAMP '2024-01-25'"
_LATE = "ts >= TIMESTAMP '2024-01-05'"


@query(
    merge_sql(
        sql_of(_CONSUMPTION_TARGET, f"events WHERE {_EARLY}"),
        sql_of(_CONSUMPTION_SOURCE, f"events WHERE {_LATE}"),
        ["SOURCE_SYSTEM_ID"],
        _CONSUMPTION_WRITES,
        "(t.IS_DELETED = 1 OR t.DELETED_AT IS NOT NULL OR "
        + any_differs([(e, f't."{c}"') for c, e in _CONSUMPTION_WRITES.items()])
        + ")",
        list(_CONSUMPTION_TARGET),
        absent="soft",
        flag="IS_DELETED",
        deleted_at="DELETED_AT",
    )
)
def merge_consumptions(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    target = project(events.filter(_spark_time(_EARLY)), _CONSUMPTION_TARGET)
    source = project(events.filter(_spark_time(_LATE)), _CONSUMPTION_SOURCE)
    return merge_with_actions(target, source, CONSUMPTION_MERGE, RUN_TS)


# --- products: absent rows deleted for good ------------------------------------------------------

_PRODUCT = {
    "ObjectId": "CAST(p_partkey AS INT)",
    "Name": "CASE WHEN p_size = 3 THEN NULL ELSE p_name END",
    "Type": "p_type",
    "FINGroup": "p_brand",
    "FINDetailed": "CASE WHEN p_size > 40 THEN NULL ELSE p_brand END",
    "ProductTypeSol": "p_type",
    "ProductTypeSolName": "p_type",
    "SolUrl": "p_name",
    "Description": "p_name",
}
_PRODUCT_TARGET = {
    **_PRODUCT,
    "ParentObjectId": "CASE WHEN p_size = 1 THEN NULL ELSE p_size END",
    "Code": "CASE WHEN p_size = 4 THEN NULL ELSE p_brand END",
    "TribeCode": "CASE WHEN p_size = 10 THEN 99 ELSE p_size END",
    "OwnerPersonCode": "p_brand",
    "TechOwnerPersonCode": "p_brand",
    "FINDirectionGeneral": "p_type",
    "FINDirectionDetailed": "p_type",
    "Status": "CASE WHEN p_size = 12 THEN 'old' ELSE p_type END",
    "ShortDescription": "CASE WHEN p_size < 20 THEN NULL ELSE p_name END",
    "itObjectStatus": "CASE WHEN p_size = 25 THEN '' ELSE p_type END",
    "UpdatedAt": f"CASE WHEN p_size = 30 THEN {OLD} END",
}
_PRODUCT_SOURCE = {
    **_PRODUCT,
    "ParentObjectId": "CASE WHEN p_size = 2 THEN NULL ELSE p_size END",
    "Code": "CASE WHEN p_size = 5 THEN NULL ELSE p_brand END",
    "TribeCode": "p_size",
    "OwnerPersonCode": "CASE WHEN p_size = 15 THEN NULL ELSE p_brand END",
    "TechOwnerPersonCode": "p_brand",
    "FINDirectionGeneral": "p_type",
    "FINDirectionDetailed": "CASE WHEN p_size = 16 THEN 'other' ELSE p_type END",
    "Status": "p_type",
    "ShortDescription": "CASE WHEN p_size < 18 THEN '' ELSE p_name END",
    "itObjectStatus": "CASE WHEN p_size = 25 THEN NULL ELSE p_type END",
}
_PRODUCT_FILLS = {
    "ParentObjectId": "0",
    "Code": None,
    "Name": None,
    "TribeCode": "0",
    "Type": None,
    "OwnerPersonCode": "''",
    "TechOwnerPersonCode": "''",
    "FINDirectionGeneral": "''",
    "FINDirectionDetailed": "''",
    "FINGroup": "''",
    "FINDetailed": "''",
    "ProductTypeSol": None,
    "ProductTypeSolName": None,
    "Status": None,
    "Description": "''",
    "SolUrl": None,
    "ShortDescription": "''",
    "itObjectStatus": "''",
}
_PRODUCT_BOTH = {"ShortDescription", "itObjectStatus"}
_PRODUCT_WRITES = {
    c: f's."{c}"' if v is None else f'COALESCE(s."{c}", {v})' for c, v in _PRODUCT_FILLS.items()
}


@query(
    merge_sql(
        sql_of(_PRODUCT_TARGET, "part WHERE p_type <> 'PROMO'"),
        sql_of(_PRODUCT_SOURCE, "part WHERE p_type <> 'LARGE'"),
        ["ObjectId"],
        _PRODUCT_WRITES,
        any_differs(
            [
                (e, f"COALESCE(t.\"{c}\", '')" if c in _PRODUCT_BOTH else f't."{c}"')
                for c, e in _PRODUCT_WRITES.items()
            ]
        ),
        list(_PRODUCT_TARGET),
        absent="hard",
        updated_at="UpdatedAt",
    )
)
def merge_hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    target = project(part.filter("p_type <> 'PROMO'"), _PRODUCT_TARGET)
    source = project(part.filter("p_type <> 'LARGE'"), _PRODUCT_SOURCE)
    return merge_with_actions(target, source, PRODUCT_MERGE, RUN_TS)


# --- systems, second dialect: NULL, empty and zero are equal ---------------------------------------

_ROW = {
    "object_id": "CAST(c_custkey AS INT)",
    "system_id": "c_nationkey",
    "classname": "c_mktsegment",
    "url": "c_name",
    "owner_login": "c_mktsegment",
    "person_login": "c_name",
}
_ROW_TARGET = {
    **_ROW,
    "name": "CASE WHEN c_nationkey < 3 THEN NULL WHEN c_nationkey < 6 THEN '' ELSE c_name END",
    "status": "CASE WHEN c_nationkey = 8 THEN 'old' ELSE c_mktsegment END",
    "istest": "CASE WHEN c_nationkey > 20 THEN NULL ELSE FALSE END",
    "owner": "c_name",
    "person": "c_name",
    "real_servers": "CASE WHEN c_nationkey = 9 THEN NULL ELSE c_nationkey END",
    "virtual_servers": "CASE WHEN c_nationkey = 10 THEN 0 ELSE c_nationkey END",
    "deleted_at": f"CASE WHEN c_nationkey = 12 THEN {OLD} END",
    "updated_at": f"CASE WHEN c_nationkey = 12 THEN {OLD} END",
}
_ROW_SOURCE = {
    **_ROW,
    "name": "CASE WHEN c_nationkey < 2 THEN '' WHEN c_nationkey < 5 THEN NULL ELSE c_name END",
    "status": "c_mktsegment",
    "istest": "CASE WHEN c_nationkey > 22 THEN TRUE ELSE FALSE END",
    "owner": "CASE WHEN c_nationkey = 15 THEN NULL ELSE c_name END",
    "person": "c_name",
    "real_servers": "CASE WHEN c_nationkey = 9 THEN 0 ELSE c_nationkey END",
    "virtual_servers": "CASE WHEN c_nationkey = 10 THEN NULL ELSE c_nationkey END",
}
_ROW_EQUAL = {
    "name": "''",
    "classname": "''",
    "status": "''",
    "url": "''",
    "istest": "FALSE",
    "owner": "''",
    "owner_login": "''",
    "person": "''",
    "person_login": "''",
    "real_servers": "0",
    "virtual_servers": "0",
}


@query(
    merge_sql(
        sql_of(_ROW_TARGET, "customer WHERE c_mktsegment <> 'BUILDING'"),
        sql_of(_ROW_SOURCE, "customer WHERE c_mktsegment <> 'MACHINERY'"),
        ["object_id", "system_id"],
        {c: f's."{c}"' for c in _ROW_EQUAL},
        "(t.deleted_at IS NOT NULL OR "
        + any_differs([(f'COALESCE(s."{c}", {v})', f'COALESCE(t."{c}", {v})') for c, v in _ROW_EQUAL.items()])
        + ")",
        list(_ROW_TARGET),
        absent="soft",
        deleted_at="deleted_at",
        updated_at="updated_at",
    )
)
def upsert_null_equal(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    target = project(customer.filter("c_mktsegment <> 'BUILDING'"), _ROW_TARGET)
    source = project(customer.filter("c_mktsegment <> 'MACHINERY'"), _ROW_SOURCE)
    return merge_with_actions(target, source, SYSTEM_UPSERT, RUN_TS)


# --- soft delete on its own: customers without an order ----------------------------------------------

_ACCOUNT = {
    "c_custkey": "c_custkey",
    "c_name": "c_name",
    "deleted_at": f"CASE WHEN c_nationkey = 4 THEN {OLD} END",
    "updated_at": f"CASE WHEN c_nationkey < 6 THEN {OLD} END",
}


@query(
    f"""
    WITH account AS ({sql_of(_ACCOUNT, "customer")})
    SELECT c_custkey, c_name,
           CASE WHEN gone THEN {RUN_TS_SQL} ELSE deleted_at END AS deleted_at,
           CASE WHEN gone THEN {RUN_TS_SQL} ELSE updated_at END AS updated_at
    FROM (SELECT a.*, deleted_at IS NULL
                      AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = a.c_custkey
                                      AND o.o_orderdate >= TIMESTAMP '2001-01-01') AS gone
          FROM account a)
    """,
    name="soft_delete_absent",
)
def soft_delete_absent_accounts(spark: SparkSession, sf: str) -> DataFrame:
    seen = project(
        table(spark, sf, "orders"),
        {"c_custkey": "CASE WHEN o_orderdate >= TIMESTAMP_NTZ '2001-01-01' THEN o_custkey ELSE -1 - o_custkey END"},
    )
    return soft_delete_absent(project(table(spark, sf, "customer"), _ACCOUNT), seen, ["c_custkey"], RUN_TS)


# --- plain upsert ---------------------------------------------------------------------------------


@query(
    """
    WITH fresh AS (SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer
                   WHERE c_mktsegment <> 'MACHINERY')
    SELECT * FROM fresh
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal FROM customer t
    WHERE c_mktsegment <> 'BUILDING' AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.c_custkey = t.c_custkey)
    """,
    name="keyed_upsert",
)
def keyed_upsert_accounts(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    target = customer.filter("c_mktsegment <> 'BUILDING'").select(*columns)
    source = customer.filter("c_mktsegment <> 'MACHINERY'").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return keyed_upsert(target, source.select(*columns), ["c_custkey"])


@query(
    """
    SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT -1 - o_custkey, o_orderkey, 0 FROM orders WHERE o_orderstatus <> 'F'
    """,
    name="keyed_upsert_two_columns",
)
def keyed_upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by customer and number; those that are not finished come under customers nobody knows."""
    orders = table(spark, sf, "orders")
    source = project(
        orders,
        {
            "o_custkey": "CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 - o_custkey END",
            "o_orderkey": "o_orderkey",
            "o_totalprice": "CAST(0 AS DOUBLE)",
        },
    )
    return keyed_upsert(orders.select(*source.columns), source, ["o_custkey", "o_orderkey"])


# --- update of existing rows, on change only ---------------------------------------------------------

_ISSUE = {
    "issue_id": "CAST(o_orderkey AS INT)",
    "gitlab_status_id": "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE NULL END",
    "gitlab_status_name": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
    "updated_at": NO_TIME,
}
_RETURNED = {
    # Orders before 1996 come back under ids nobody has.
    "issue_id": f"CAST(CASE WHEN {_SINCE_1996} THEN o_orderkey ELSE -1 - o_orderkey END AS INT)",
    "gitlab_status_id": "CASE WHEN o_orderpriority = '1-URGENT' THEN 2 WHEN o_orderstatus = 'F' THEN 1 "
    "WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END",
    "gitlab_status_name": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'O' WHEN o_orderstatus = 'P' THEN '' "
    "ELSE o_orderstatus END",
}
_STATUS_CHANGED = any_differs(
    [
        ("COALESCE(s.gitlab_status_name, '')", "COALESCE(t.gitlab_status_name, '')"),
        ("COALESCE(s.gitlab_status_id, 0)", "COALESCE(t.gitlab_status_id, 0)"),
    ]
)
_STATUS_WRITES = {c: f"s.{c}" for c in ("gitlab_status_id", "gitlab_status_name")}


@query(
    merge_sql(
        sql_of(_ISSUE, "orders"),
        sql_of(_RETURNED, "orders"),
        ["issue_id"],
        _STATUS_WRITES,
        _STATUS_CHANGED,
        list(_ISSUE),
        insert=False,
        updated_at="updated_at",
    )
)
def update_from_changed(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    source = project(orders, {n: _spark_time(e) for n, e in _RETURNED.items()})
    return merge_with_actions(project(orders, _ISSUE), source, STATUS_UPDATE, RUN_TS)


# --- issue status sync: statuses looked up by name, then the update -------------------------------------

_STATUS_KEY = "CASE WHEN o_totalprice > 400000 OR o_orderstatus = 'F' THEN -1 ELSE c_nationkey END"


@query(
    merge_sql(
        sql_of(_ISSUE, "orders"),
        f"""SELECT CAST(o_orderkey AS INT) AS issue_id, n_nationkey AS gitlab_status_id,
                   n_name AS gitlab_status_name
            FROM orders JOIN customer ON c_custkey = o_custkey
                 JOIN nation ON n_nationkey = {_STATUS_KEY}""",
        ["issue_id"],
        _STATUS_WRITES,
        _STATUS_CHANGED,
        list(_ISSUE),
        insert=False,
        updated_at="updated_at",
    )
)
def issue_status_sync(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    returned = returned_statuses(*_sent_back(spark, sf))
    return merge_with_actions(project(orders, _ISSUE), returned, STATUS_UPDATE, RUN_TS)


def _sent_back(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Issue statuses and the names of statuses."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    issue_statuses = project(joined, {"IssueId": "CAST(o_orderkey AS INT)", "StatusGitLabId": _STATUS_KEY})
    return issue_statuses, project(table(spark, sf, "nation"), {"Id": "n_nationkey", "Name": "n_name"})


@query(
    f"""
    SELECT CAST(o_orderkey AS INT) AS issue_id,
           CASE WHEN differs THEN new_id ELSE old_id END AS gitlab_status_id,
           CASE WHEN differs THEN new_name ELSE old_name END AS gitlab_status_name,
           CASE WHEN differs THEN {RUN_TS_SQL} END AS updated_at, sent
    FROM (SELECT *, COALESCE(new_id IS NOT NULL AND (new_id <> COALESCE(old_id, 0)
                             OR new_name <> COALESCE(old_name, '')), FALSE) AS differs
          FROM (SELECT o_orderkey, n_nationkey AS new_id, n_name AS new_name,
                       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS old_id,
                       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS old_name,
                       (SELECT COUNT(*) FROM customer i WHERE i.c_custkey = o_orderkey) AS sent
                FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey
                     LEFT JOIN nation ON n_nationkey = {_STATUS_KEY}))
    """
)
def issue_sync_job(spark: SparkSession, sf: str) -> DataFrame:
    """Issues copied out, statuses copied back, and the stored issues updated; a second run of either
    way changes nothing."""
    orders = table(spark, sf, "orders")
    root, staging, outgoing = (shared_folder(spark, n) for n in ("issues", "statuses", "outgoing"))
    write_snapshot(project(orders, _ISSUE), root)
    custom = project(orders, {"issue_id": "o_orderkey", "product_code_sol": "o_orderpriority", "cluster_name": "o_orderstatus"})
    names = project(table(spark, sf, "customer"), {"issue_id": "c_custkey", "issue_name": "c_name"})
    for _ in range(2):
        issues.send_issues(custom, names, outgoing, run="2024-01-01")
    for run_ts in (RUN_TS, datetime(2024, 2, 2)):
        issues.load_statuses(spark, *_sent_back(spark, sf), staging, root, run_ts)
    sent = read_relation(spark, outgoing).groupBy(F.col("IssueId").cast("int").alias("issue_id")).agg(F.count("*").alias("n"))
    stored = read_snapshot(spark, root).join(sent, "issue_id", "left")
    return stored.select(*_ISSUE, F.coalesce("n", F.lit(0)).alias("sent"))
