"""Plan-hours history: the changes of one time slice, appended behind a high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import PLAN_HOURS_COLUMNS, PLAN_HOURS_SOURCE
from tidemark.functions.dates import at
from tidemark.functions.defaults import or_default
from tidemark.operators.increments import advance_mark, read_mark, time_slice
from tidemark.sources.tables import read_snapshot, stored_mark, write_slice, write_snapshot

# Columns by which a reader of the history can skip slices.
PLAN_HOURS_RANGES = ("ChangeDate", "Period")

_CHANGE = ("Period", "Increment", "Date", "User", "Comment")
_PATH = ("ProjectCode", "LegalEntityId", "TribeId", "RoleId")


def changes(tables: dict[str, DataFrame], low: datetime, high: datetime, source_system: str = PLAN_HOURS_SOURCE) -> DataFrame:
    """Changes with low <= Date < high, on roles and on competences.

    The way from a role to its project is joined up among the structure tables first.  Each
    history then meets it in one join, so the changes, which are the bulk of the data, are
    shuffled once for the whole chain instead of once per table.
    """
    t = tables
    role_path = _role_path(t)
    competence_path = (
        t["HoursCompetences"]
        .select(F.col("Id").alias("HoursCompetenceId"), "HoursRoleId", F.col("CompetenceId").cast("int"))
        .join(role_path, "HoursRoleId")
    )

    def walked(history: str, path: DataFrame, key: str, subtype: str) -> DataFrame:
        sliced = time_slice(t[history], "Date", low, high).filter(F.col("Increment") != 0)
        return sliced.select(key, *_CHANGE).join(path, key).select(
            *_PATH, "CompetenceId", F.lit(subtype).alias("SubType"), *_CHANGE
        )

    no_competence = role_path.withColumn("CompetenceId", F.lit(None).cast("int"))
    both = walked("HoursRoleHistories", no_competence, "HoursRoleId", "Direct on Role").unionByName(
        walked("HoursCompetenceHistories", competence_path, "HoursCompetenceId", "Direct on Competence")
    )
    employees = t["Employee"].select(F.col("Id").alias("User"), F.col("Id").alias("ChangedBy_EmployeeCode"))
    return both.join(employees, "User", "left").select(
        "ProjectCode",
        "LegalEntityId",
        "TribeId",
        "RoleId",
        or_default(F.col("CompetenceId"), -1).alias("CompetenceId"),
        F.col("Period").cast("date").alias("Period"),
        F.lit("Direct").alias("Type"),
        "SubType",
        F.col("Date").alias("ChangeDate"),
        "ChangedBy_EmployeeCode",
        "Comment",
        "Increment",
        F.lit(source_system).alias("SourceSystem"),
    )


def _role_path(t: dict[str, DataFrame]) -> DataFrame:
    """Role id to role, tribe, legal entity and project code."""
    projects = (
        t["HoursProjects"]
        .select(F.col("Id").alias("HoursProjectId"), "ProjectId")
        .join(t["Projects"].select(F.col("Id").alias("ProjectId"), "ProjectCode"), "ProjectId")
    )
    entities = (
        t["HoursLegalEntities"]
        .select(F.col("Id").alias("HoursLegalEntityId"), "HoursProjectId", "LegalEntityId")
        .join(projects, "HoursProjectId")
    )
    tribes = (
        t["HoursTribes"]
        .select(F.col("Id").alias("HoursTribeId"), "HoursLegalEntityId", "TribeId")
        .join(entities, "HoursLegalEntityId")
    )
    roles = t["HoursRoles"].select(F.col("Id").alias("HoursRoleId"), "HoursTribeId", "RoleId")
    return roles.join(tribes, "HoursTribeId").select("HoursRoleId", *_PATH)


def load(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    history_root: str,
    marks_root: str,
    run_ts: datetime,
    table: str = "plan_hours_history",
    full_load: bool = False,
) -> None:
    """One run: slice since the mark; the slice and the new mark become known together.

    The history's own mark counts; the table of marks begins it, and shows it to others afterwards.
    A run that failed between the two is caught up by the next one.
    """
    high = run_ts.replace(second=0, microsecond=0)
    marks = read_snapshot(spark, marks_root)
    mark = None if full_load else stored_mark(spark, history_root, table)
    low = mark or read_mark(marks, table, full_load)
    stamped = changes(tables, low, high).withColumn("LoadDateTime", at(run_ts))
    write_slice(
        stamped.select(*PLAN_HOURS_COLUMNS), history_root, low, full_load, ranges=PLAN_HOURS_RANGES, marks={table: high}
    )
    write_snapshot(advance_mark(marks, table, high), marks_root)
