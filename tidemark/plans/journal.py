"""Journal entries: XML to typed, default-filled staging rows, month by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.fixed_values import (
    JOURNAL_COLUMNS,
    JOURNAL_DATES,
    JOURNAL_DROPPED,
    JOURNAL_MONEY,
    JOURNAL_TEXT_DEFAULT,
)
from tidemark.functions.dates import parse_or_epoch
from tidemark.functions.defaults import or_default
from tidemark.sources.extracts import escaped_xml, read_xml
from tidemark.sources.tables import append, truncate_load

ENTRY_SCHEMA = StructType([StructField(c, StringType()) for c in (*JOURNAL_COLUMNS, JOURNAL_DROPPED)])


def read_entries(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """All landed months at once; every value as text, the unused second reference dropped."""
    return read_xml(spark, path, row_tag, ENTRY_SCHEMA, drop=[JOURNAL_DROPPED])


def typed_value(name: str, money: tuple[str, ...] = JOURNAL_MONEY, dates: tuple[str, ...] = JOURNAL_DATES) -> Column:
    """The default rule of the column's class: money 0, dates 1970-01-01, other text '1'.

    The class is declared by name.  Text codes stay text, so leading zeros survive.  Money and
    rates are floating point, as the extract gives them, so no digit is cut.
    """
    column = F.col(name)
    if name in money:
        value = or_default(column.cast("double"), 0.0)
    elif name in dates:
        value = parse_or_epoch(column.cast("string"))
    else:
        value = or_default(column.cast("string"), JOURNAL_TEXT_DEFAULT)
    return value.alias(name)


def type_entries(entries: DataFrame) -> DataFrame:
    return entries.select(*[typed_value(c) for c in JOURNAL_COLUMNS])


def load(responses: DataFrame, column: str, row_tag: str, staging: str, root_tag: str = "JournalEntries") -> None:
    """Landed responses, each with its escaped list, into emptied staging.

    A repeated month replaces what was staged; a response without its list, or a value that does not
    fit, fails the load and leaves the old rows, as the new ones are written before they take their place.
    """
    fields = ", ".join(f"`{c}` string" for c in (*JOURNAL_COLUMNS, JOURNAL_DROPPED))
    entries = escaped_xml(responses, column, root_tag, row_tag, fields, drop=[JOURNAL_DROPPED])
    typed = type_entries(entries)
    truncate_load(typed.select(F.expr("X'00'").alias("ETL_LOG_ID"), *typed.columns), staging)


def stage(entries: DataFrame, path: str, run: str | None = None) -> None:
    """Append typed entries behind the constant log id; one call may hold any number of months.

    A second call for the same ``run`` takes the place of the first.
    """
    append(type_entries(entries), path, {"ETL_LOG_ID": F.expr("X'00'")}, run=run)
