"""Month spines, month slices and the open period."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import first_of_month, first_of_year, last_of_month, plus_months


def widen_period(period: DataFrame, start: str = "date_from", end: str = "date_to") -> DataFrame:
    """Stretch a period to whole months."""
    return period.withColumns({start: first_of_month(F.col(start)), end: last_of_month(F.col(end))})


def month_spine(period: DataFrame, start: str = "date_from", end: str = "date_to") -> DataFrame:
    """Every month touched by the period, as first and last day."""
    step = F.expr("interval 1 month")
    months = F.sequence(first_of_month(F.col(start)), first_of_month(F.col(end)), step)
    return period.select(F.explode(months).alias("date_from")).select(
        "date_from", last_of_month(F.col("date_from")).alias("date_to")
    )


def month_slices(df: DataFrame, day: Column, first: datetime, last: datetime) -> DataFrame:
    """All months of a period in one scan: a single range filter, and the month as a column.

    ``first`` and ``last`` are inclusive days.  Written with ``partitionBy("month")`` each month
    is a folder of its own.
    """
    low = first_of_month(F.lit(first.date()))
    high = F.date_add(last_of_month(F.lit(last.date())), 1)
    in_period = (day >= low.cast("timestamp_ntz")) & (day < high.cast("timestamp_ntz"))
    return df.filter(in_period).withColumn("month", first_of_month(day.cast("date")))


def open_period(closed_months: DataFrame, month: str) -> DataFrame:
    """The month after the last closed one: its first day, last day and first day of its year."""
    latest = closed_months.agg(F.max(F.col(month).cast("date")).alias("m"))
    start = plus_months(F.col("m"), 1)
    return latest.select(
        start.alias("date_from"),
        F.date_sub(plus_months(F.col("m"), 2), 1).alias("date_to"),
        first_of_year(start).alias("year"),
    )
