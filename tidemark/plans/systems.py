"""Systems and product consumptions: envelope records to merges, in both target dialects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import MergeSpec, filled, filled_null_equal, merge, null_equal
from tidemark.sources.envelope import Field, read_envelopes, records, stage_records, table_schema
from tidemark.sources.extracts import read_records
from tidemark.sources.tables import merge_snapshot

SYSTEMS, CONSUMPTIONS = "ims_systems", "consumptions"

# Output name to path in one landed systems response.
SYSTEM_PATHS = {
    "object_id": "objectId",
    "system_id": "systemId",
    "name": "name",
    "class_name": "className",
    "owner_login": "owner.login",
    "owner_name": "owner.userName",
    "status": "status",
    "real_servers": "realServers",
    "virtual_servers": "virtualServers",
    "person_login": "person.login",
    "person_name": "person.userName",
    "url": "url",
    "is_test": "isTest",
}
SYSTEM_RESPONSE = (
    "objectId string, systemId string, name string, className string, "
    "owner struct<login: string, userName: string>, status string, realServers string, "
    "virtualServers string, person struct<login: string, userName: string>, url string, isTest string"
)
CONSUMPTION_PATHS = {
    "id": "id",
    "type": "type",
    "consumer_product_id": "consumerProductId",
    "food_product_module_object_id": "foodProductModuleObjectId",
    "link_type": "linkType",
    "link_weight": "linkWeight",
    "integration_stage": "integrationStage",
    "confirmed_in_obs": "confirmedInOBS",
    "creation_date": "creationDate",
    "last_change_date": "lastChangeDate",
    "status": "status",
    "comment": "comment",
}
CONSUMPTION_RESPONSE = ", ".join(
    f"{p} {'decimal(19,4)' if p == 'linkWeight' else 'string'}" for p in CONSUMPTION_PATHS.values()
)

SYSTEM_FIELDS = (
    Field("ObjectId", "int", "object_id", strict=True),
    Field("SystemId", "int", "system_id", strict=True),
    Field("Name", "string", "name"),
    Field("ClassName", "string", "class_name"),
    Field("Owner", "string", "owner_name"),
    Field("OwnerLogin", "string", "owner_login"),
    Field("Status", "string", "status"),
    Field("RealServers", "int", "real_servers"),
    Field("VirtualServers", "int", "virtual_servers"),
    Field("Person", "string", "person_name"),
    Field("PersonLogin", "string", "person_login"),
    Field("Url", "string", "url"),
    Field("IsTest", "boolean", "is_test"),
)
SYSTEM_MERGE = MergeSpec(
    keys=("ObjectId", "SystemId"),
    columns={
        "Name": filled(""),
        "ClassName": filled(""),
        "Owner": filled(""),
        "OwnerLogin": filled_null_equal(""),
        "Status": filled(""),
        "RealServers": filled(0),
        "VirtualServers": filled(0),
        "Person": filled_null_equal(""),
        "PersonLogin": filled_null_equal(""),
        "Url": filled(""),
        "IsTest": filled_null_equal(False),
    },
    absent="soft",
    deleted_flag="IS_DELETED",
    deleted_at="DELETED_AT",
)

SYSTEM_ROW_FIELDS = (
    Field("object_id", "int"),
    Field("system_id", "int"),
    Field("name", "string"),
    Field("classname", "string", "class_name"),
    Field("status", "string"),
    Field("url", "string"),
    Field("istest", "boolean", "is_test"),
    Field("owner", "string", "owner_name"),
    Field("owner_login", "string"),
    Field("person", "string", "person_name"),
    Field("person_login", "string"),
    Field("real_servers", "int"),
    Field("virtual_servers", "int"),
)
SYSTEM_UPSERT = MergeSpec(
    keys=("object_id", "system_id"),
    columns={
        "name": null_equal(""),
        "classname": null_equal(""),
        "status": null_equal(""),
        "url": null_equal(""),
        "istest": null_equal(False),
        "owner": null_equal(""),
        "owner_login": null_equal(""),
        "person": null_equal(""),
        "person_login": null_equal(""),
        "real_servers": null_equal(0),
        "virtual_servers": null_equal(0),
    },
    absent="soft",
    deleted_at="deleted_at",
    updated_at="updated_at",
)

CONSUMPTION_FIELDS = (
    Field("SOURCE_SYSTEM_ID", "int", "id", strict=True),
    Field("TYPE", "string", "type"),
    Field("CONSUMER_OBJECT_ID", "bigint", "consumer_product_id"),
    Field("FOOD_PRODUCT_OBJECT_ID", "bigint", "food_product_module_object_id"),
    Field("LINK_TYPE", "string", "link_type"),
    Field("LINK_WEIGHT", "decimal(19,4)", "link_weight"),
    Field("INTEGRATION_STAGE", "string", "integration_stage"),
    Field("CONFIRMED_IN_OBS", "boolean", "confirmed_in_obs"),
    Field("CREATION_DATE", "timestamp_ntz", "creation_date"),
    Field("LAST_CHANGE_DATE", "timestamp_ntz", "last_change_date"),
    Field("STATUS", "string", "status"),
    Field("COMMENT", "string", "comment"),
)
CONSUMPTION_MERGE = MergeSpec(
    keys=("SOURCE_SYSTEM_ID",),
    columns={
        "TYPE": filled(""),
        "CONSUMER_OBJECT_ID": filled(0),
        "FOOD_PRODUCT_OBJECT_ID": filled(0),
        "LINK_TYPE": filled(""),
        "LINK_WEIGHT": filled(0),
        "INTEGRATION_STAGE": filled(""),
        "CONFIRMED_IN_OBS": filled(False),
        "CREATION_DATE": filled("0001-01-01 00:00:00"),
        "LAST_CHANGE_DATE": filled("0001-01-01 00:00:00"),
        "STATUS": filled(""),
        "COMMENT": filled(""),
    },
    absent="soft",
    deleted_flag="IS_DELETED",
    deleted_at="DELETED_AT",
)


_AUDIT_SCHEMA = ("IS_DELETED int", "DELETED_AT timestamp_ntz")
SYSTEM_TABLE = table_schema(SYSTEM_FIELDS, *_AUDIT_SCHEMA)
SYSTEM_ROW_TABLE = table_schema(SYSTEM_ROW_FIELDS, "deleted_at timestamp_ntz", "updated_at timestamp_ntz")
CONSUMPTION_TABLE = table_schema(CONSUMPTION_FIELDS, *_AUDIT_SCHEMA)


def system_records(envelopes: DataFrame) -> DataFrame:
    return records(envelopes, SYSTEMS, SYSTEM_FIELDS)


def system_row_records(envelopes: DataFrame) -> DataFrame:
    return records(envelopes, SYSTEMS, SYSTEM_ROW_FIELDS)


def consumption_records(envelopes: DataFrame) -> DataFrame:
    return records(envelopes, CONSUMPTIONS, CONSUMPTION_FIELDS)


def merge_systems(target: DataFrame, envelopes: DataFrame, run_ts: datetime) -> DataFrame:
    return merge(target, system_records(envelopes), SYSTEM_MERGE, run_ts)


def upsert_systems(target: DataFrame, envelopes: DataFrame, run_ts: datetime) -> DataFrame:
    """Second dialect: NULL, empty and zero are equal.  The soft delete of absent rows runs in
    the same join."""
    return merge(target, system_row_records(envelopes), SYSTEM_UPSERT, run_ts)


def merge_consumptions(target: DataFrame, envelopes: DataFrame, run_ts: datetime) -> DataFrame:
    return merge(target, consumption_records(envelopes), CONSUMPTION_MERGE, run_ts)


def load_systems(
    spark: SparkSession, landed: str, staging: str, root: str, row_root: str, run_ts: datetime
) -> None:
    """Landed responses to staging, and what they change into both targets."""
    stage_records(read_records(spark, landed, SYSTEM_RESPONSE, SYSTEM_PATHS), SYSTEMS, staging)
    envelopes = read_envelopes(spark, staging)
    merge_snapshot(spark, row_root, system_row_records(envelopes), SYSTEM_UPSERT, run_ts)
    merge_snapshot(spark, root, system_records(envelopes), SYSTEM_MERGE, run_ts)


def load_consumptions(spark: SparkSession, landed: str, staging: str, root: str, run_ts: datetime) -> None:
    """Landed responses to staging, and what they change into the target."""
    extract = read_records(spark, landed, CONSUMPTION_RESPONSE, CONSUMPTION_PATHS)
    stage_records(extract, CONSUMPTIONS, staging)
    merge_snapshot(spark, root, consumption_records(read_envelopes(spark, staging)), CONSUMPTION_MERGE, run_ts)
