"""Act drafts: filtered aggregate, packed rows, export documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidemark.fixed_values import ACT_EXPORT
from tidemark.functions.text import key_uuid
from tidemark.operators.aggregates import keys_where, restrict, summarize
from tidemark.operators.packing import (
    attribute_text,
    pack_attributes,
    pack_measures,
    quoted,
    split_columns,
)
from tidemark.sources.envelope import pack_records
from tidemark.sources.tables import read_relation, truncate_load

NO_LOG_ID = "X'00'"
# Nulls kept, times to the second.
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}


def realization_projects(projects: DataFrame, key: str, customer_code: int = 3) -> DataFrame:
    """Keys of the donor projects that may appear in acts."""
    return projects.filter(
        (F.col("ProjectStatus") == "Realization")
        & F.col("WIPFrameworkId").isNotNull()
        & F.col("WIPActsProjectFilter")
        & (F.col("CustomerCode") == customer_code)
    ).select(key)


def act_rows(
    facts: DataFrame,
    in_period: Column,
    projects: DataFrame,
    project_key: str,
    flag: Column,
    amount: Column,
    attributes: Sequence[str],
    measures: Mapping[str, Column],
) -> DataFrame:
    """Measures by attributes, for the period, the given projects, and those projects whose
    flag over the period is not 1 and whose amount is positive.

    ``flag`` and ``amount`` are aggregates over all facts of a project; a flag of the period
    carries the period in its own condition.  Facts are always aggregated on the map side before
    they meet a key set by shuffle, so a project that holds much of the data does no harm.  Only
    where the project is no attribute must the facts be restricted first; there the aggregate has
    a shuffle of its own, and the join before it can be split.
    """
    chosen = restrict(
        keys_where(
            facts,
            project_key,
            {"flag": flag, "amount": amount},
            (F.coalesce(F.col("flag"), F.lit(0)) != 1) & (F.col("amount") > 0),
        ),
        projects,
    )
    in_period_facts = facts.filter(in_period)
    if project_key in attributes:
        return restrict(summarize(in_period_facts, attributes, measures), chosen)
    return summarize(restrict(in_period_facts, chosen), attributes, measures)


def wide_acts(
    facts: DataFrame, keys: Sequence[str], attributes: Mapping[str, Column], measures: Mapping[str, Column]
) -> DataFrame:
    """Acts of many columns: facts are grouped by the few keys that the attributes are made of."""
    grouped = summarize(facts, keys, measures)
    return grouped.select(*[v.alias(n) for n, v in attributes.items()], *[F.col(quoted(n)) for n in measures])


def packed_drafts(
    acts: DataFrame, code: str, year: int, month: int, calculated: date, dates: Sequence[str] = ()
) -> DataFrame:
    """One staged row per act row: id, packed attributes, packed measures, period.

    Everything is computed within the row, so there is no unpivot, no shuffle and no join.
    """
    attributes, measures = split_columns(acts.columns)
    return acts.filter(F.col(quoted(code)).isNotNull()).select(
        key_uuid(attribute_text(F.col(quoted(code)), code in dates)).alias("ActId"),
        pack_attributes(attributes, dates).alias("Attributes"),
        pack_measures(acts, measures).alias("Measures"),
        F.lit(year).alias("YearNumber"),
        F.lit(month).alias("MonthNumber"),
        F.lit(calculated).alias("CalculationDate"),
    )


def run_drafts(
    spark: SparkSession,
    acts: DataFrame,
    code: str,
    year: int,
    month: int,
    calculated: date,
    staging: str,
    dates: Sequence[str] = (),
) -> DataFrame:
    """The job from act rows to the month's staged drafts, read back for the export."""
    stage_drafts(packed_drafts(acts, code, year, month, calculated, dates), staging)
    staged = read_relation(spark, staging)
    return staged.filter((F.col("YearNumber") == year) & (F.col("MonthNumber") == month))


def stage_drafts(drafts: DataFrame, path: str) -> None:
    """Replace the staged drafts, with the constant log id in front; a failed run leaves the old ones."""
    staged = drafts.select(F.expr(NO_LOG_ID).alias("ETL_LOG_ID"), *drafts.columns)
    truncate_load(staged, path, partition_by=["YearNumber", "MonthNumber"])


def export_rows(view: DataFrame, year: int, month: int) -> DataFrame:
    """The drafts of one month under the receiver's field names."""
    rows = view.filter((F.col("MonthNumber") == month) & (F.col("Year") == year))
    return rows.select(
        *[(F.col(c).cast("int") if c == "ProjectId" else F.col(c)).alias(n) for c, n in ACT_EXPORT.items()]
    )


def dates_as_times(df: DataFrame) -> DataFrame:
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, DateType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in days}) if days else df


def export_documents(rows: DataFrame, group: Column, root: str = "WipActs", max_bytes: int = 64 << 20) -> DataFrame:
    """Documents ``{"WipActs": [...]}``, one per group, or more of at most ``max_bytes`` each."""
    opening, closing = f'{{"{root}": ', "}"
    room = max_bytes - len((opening + closing).encode())
    packed = pack_records(dates_as_times(rows), group, rows.columns, room, JSON_OPTIONS)
    document = F.concat(F.lit(opening), F.col("json_text"), F.lit(closing))
    return packed.select(F.col("entity").alias("group"), document.alias("document"))


def export_lines(rows: DataFrame, path: str) -> None:
    """The same rows as JSON lines, for receivers that take them one by one."""
    dates_as_times(rows).write.mode("overwrite").options(**JSON_OPTIONS).json(path)
