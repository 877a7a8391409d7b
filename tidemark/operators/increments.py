"""High-water marks: which slice of a history a run loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import at, to_minute

FULL_LOAD_START = datetime(1900, 1, 1)


def slice_start(mark: Column, full_load: Column | bool = False) -> Column:
    """The mark cut to its minute; 1900-01-01 for a full load or when there is no mark."""
    full = F.lit(full_load) if isinstance(full_load, bool) else full_load
    return F.when(full | mark.isNull(), at(FULL_LOAD_START)).otherwise(to_minute(mark))


def read_mark(marks: DataFrame, table: str, full_load: bool = False) -> datetime:
    """Lower bound of the next slice of one table.  ``marks`` has one row per table."""
    row = (
        marks.filter(F.col("TableName") == table)
        .select(slice_start(F.col("LastUpdateDate"), full_load).alias("low"))
        .first()
    )
    return row.low if row else FULL_LOAD_START


def advance_mark(marks: DataFrame, table: str, high: datetime) -> DataFrame:
    """The marks after a slice ending at ``high`` was stored; a table without a mark gets one.

    Write them after the slice.
    """
    moved = F.when(F.col("TableName") == table, at(high)).otherwise(F.col("LastUpdateDate"))
    known = marks.withColumn("LastUpdateDate", moved)
    if not marks.filter(F.col("TableName") == table).isEmpty():
        return known
    fresh = marks.sparkSession.range(1).select(F.lit(table).alias("TableName"), at(high).alias("LastUpdateDate"))
    return known.unionByName(fresh, allowMissingColumns=True)


def time_slice(df: DataFrame, moment: str, low: datetime, high: datetime) -> DataFrame:
    """Rows with low <= moment < high; the bounds reach the file scan."""
    return df.filter((F.col(moment) >= at(low)) & (F.col(moment) < at(high)))
