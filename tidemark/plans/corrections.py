"""Fact corrections: transfers and added facts, from landed JSON to soft-deleting merges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import MergeSpec, filled, merge, raw
from tidemark.sources.envelope import Field, raw_schema, read_envelopes, records, stage_records, table_schema
from tidemark.sources.extracts import read_pages, require_pages
from tidemark.sources.tables import merge_snapshot

TRANSFERS, ADDED_FACTS = "ts_fact_transfers", "ts_added_facts"

TRANSFER_FIELDS = (
    Field("FactTransferId", "string", "factTransferId", strict=True),
    Field("ConversionPeriodId", "string", "conversionPeriodId"),
    Field("ProjectFrom", "string", "projectFrom"),
    Field("ProjectTo", "string", "projectTo"),
    Field("Coefficient", "decimal(10,2)", "coefficient"),
    Field("CreatedAt", "timestamp_ntz", "createdAt"),
    Field("RmsLegalEntityId", "int", "rmsLegalEntityId"),
)
ADDED_FACT_FIELDS = (
    Field("AddedFactId", "string", "addedFactId", strict=True),
    Field("ConversionPeriodId", "string", "conversionPeriodId"),
    Field("PersonId", "string", "personId"),
    Field("ProjectTo", "string", "projectTo"),
    Field("AllocationDuration", "decimal(10,2)", "allocationDuration"),
    Field("CreatedAt", "timestamp_ntz", "createdAt"),
    Field("ConversionTimeAllocationId", "string", "conversionTimeAllocationId"),
)

_AUDIT = {"deleted_flag": "IS_DELETED", "deleted_at": "DELETED_AT", "updated_at": "UPDATED_AT"}

TRANSFER_MERGE = MergeSpec(
    keys=("FactTransferId",),
    columns={
        "ConversionPeriodId": raw(),
        "ProjectFrom": raw(),
        "ProjectTo": raw(),
        "Coefficient": raw(),
        "CreatedAt": raw(),
        "RmsLegalEntityId": filled(0),
    },
    absent="soft",
    **_AUDIT,
)
ADDED_FACT_MERGE = MergeSpec(
    keys=("AddedFactId",),
    columns={
        "ConversionPeriodId": raw(),
        "PersonId": raw(),
        "ProjectTo": raw(),
        "AllocationDuration": raw(),
        "CreatedAt": raw(),
        "ConversionTimeAllocationId": raw(),
    },
    absent="soft",
    **_AUDIT,
)

_AUDIT_SCHEMA = ("IS_DELETED int", "DELETED_AT timestamp_ntz", "UPDATED_AT timestamp_ntz")
TRANSFER_TABLE = table_schema(TRANSFER_FIELDS, *_AUDIT_SCHEMA)
ADDED_FACT_TABLE = table_schema(ADDED_FACT_FIELDS, *_AUDIT_SCHEMA)

TRANSFER_ARRAY, ADDED_FACT_ARRAY = "factTransfers", "addedFacts"
_GUIDS = ("FactTransferId", "AddedFactId", "ConversionPeriodId", "ConversionTimeAllocationId")
_PADDED = ("PersonId", "ProjectFrom", "ProjectTo")


def normalize(df: DataFrame) -> DataFrame:
    """GUIDs compare without case and padded codes without trailing blanks: store them so.

    A target taken over from elsewhere goes through this once as well.
    """
    changes = {c: F.lower(F.col(c)) for c in _GUIDS if c in df.columns}
    changes |= {c: F.rtrim(F.col(c)) for c in _PADDED if c in df.columns}
    return df.withColumns(changes)


def read_transfers(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses ``{"factTransfers": [...]}`` as raw records for the envelope."""
    return read_pages(spark, path, TRANSFER_ARRAY, raw_schema(TRANSFER_FIELDS))


def read_added_facts(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses ``{"addedFacts": [...]}`` as raw records for the envelope."""
    return read_pages(spark, path, ADDED_FACT_ARRAY, raw_schema(ADDED_FACT_FIELDS))


def transfer_records(envelopes: DataFrame) -> DataFrame:
    return normalize(records(envelopes, TRANSFERS, TRANSFER_FIELDS))


def added_fact_records(envelopes: DataFrame) -> DataFrame:
    return normalize(records(envelopes, ADDED_FACTS, ADDED_FACT_FIELDS))


def merge_transfers(target: DataFrame, envelopes: DataFrame, run_ts: datetime) -> DataFrame:
    return merge(target, transfer_records(envelopes), TRANSFER_MERGE, run_ts)


def merge_added_facts(target: DataFrame, envelopes: DataFrame, run_ts: datetime) -> DataFrame:
    return merge(target, added_fact_records(envelopes), ADDED_FACT_MERGE, run_ts)


def load_transfers(
    spark: SparkSession, landed: str, staging: str, root: str, run_ts: datetime, manifest: DataFrame | None = None
) -> None:
    """Landed responses to staging, and what they change into the target.

    Rows that no page holds are marked as deleted; with a ``manifest``, only if all pages are there.
    """
    if manifest is not None:
        require_pages(spark, landed, TRANSFER_ARRAY, manifest)
    stage_records(read_transfers(spark, landed), TRANSFERS, staging)
    merge_snapshot(spark, root, transfer_records(read_envelopes(spark, staging)), TRANSFER_MERGE, run_ts)


def load_added_facts(
    spark: SparkSession, landed: str, staging: str, root: str, run_ts: datetime, manifest: DataFrame | None = None
) -> None:
    """Landed responses to staging, and what they change into the target, as ``load_transfers``."""
    if manifest is not None:
        require_pages(spark, landed, ADDED_FACT_ARRAY, manifest)
    stage_records(read_added_facts(spark, landed), ADDED_FACTS, staging)
    merge_snapshot(spark, root, added_fact_records(read_envelopes(spark, staging)), ADDED_FACT_MERGE, run_ts)
