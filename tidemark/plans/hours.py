"""Hours: which period to load, and the landed pages of its months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.periods import month_spine, open_period, widen_period
from tidemark.sources.extracts import read_pages, require_pages
from tidemark.sources.tables import truncate_load

ALLOCATIONS = "timeAllocations"


def period_to_load(period_status: DataFrame) -> DataFrame:
    """The open month: the one after the last closed month in the period status table."""
    closed = period_status.filter(F.col("TS_PERIOD_IS_CLOSED") == 1)
    return open_period(closed, "PERIOD_DATE")


def months_to_load(period: DataFrame) -> DataFrame:
    return month_spine(widen_period(period))


def load_pages(spark: SparkSession, pages: str, record_schema: str, staging: str, manifest: DataFrame | None = None) -> None:
    """Replace staging with the records of all landed pages; any number of months at once.

    With a ``manifest`` of the pages, a missing or cut one fails the load.
    """
    if manifest is not None:
        require_pages(spark, pages, ALLOCATIONS, manifest)
    truncate_load(read_pages(spark, pages, ALLOCATIONS, record_schema), staging)
