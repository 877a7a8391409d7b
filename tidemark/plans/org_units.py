"""Organisation units: landed JSON pages to a keyed staging table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import keyed_upsert, upsert_spec
from tidemark.sources.extracts import read_records
from tidemark.sources.tables import current_snapshot, merge_snapshot, write_snapshot

UNIT_RESPONSE = "id string, description string, org_code string, short_name string, title string"
UNIT_COLUMNS = ("id", "description", "org_code", "short_name", "title")


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """The five unit columns, picked by name out of every landed page."""
    return read_records(spark, path, UNIT_RESPONSE, {c: c for c in UNIT_COLUMNS})


def load_units(spark: SparkSession, landed: str, root: str) -> None:
    """All landed pages into staging, a snapshot table, by id; units without a page keep their row."""
    units = read_units(spark, landed)
    if current_snapshot(spark, root):
        merge_snapshot(spark, root, units, upsert_spec(UNIT_COLUMNS, ["id"]), datetime.min)
    else:
        write_snapshot(upsert_units(units.limit(0), units), root)


def upsert_units(staging: DataFrame, units: DataFrame) -> DataFrame:
    return keyed_upsert(staging, units, ["id"])
