"""Organisation and person dimensions.

Lookups carry no broadcast hint: Spark broadcasts a side by its measured size and shuffles it
otherwise.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import at, timestamp_text
from tidemark.functions.defaults import name_of_code, zero_to_null
from tidemark.sources.tables import truncate_load

NO_DATE = datetime(1900, 1, 1)


def _with_leader(units: DataFrame, leader_id: str, person: DataFrame) -> DataFrame:
    people = person.select(
        F.col("PersonCode").alias(leader_id), F.col("PersonCode").alias("leader"), F.col("NameLocal").alias("leader_name")
    )
    return units.join(people, leader_id, "left")


def cluster_dimension(clusters: DataFrame, person: DataFrame) -> DataFrame:
    return _with_leader(clusters, "ClusterLeaderId", person).select(
        F.col("ClusterCode").alias("id"),
        F.col("Name").alias("name"),
        F.col("Description").alias("description"),
        F.col("leader").alias("cluster_leader_id"),
        F.col("leader_name").alias("cluster_leader_name"),
    )


def tribe_dimension(tribes: DataFrame, person: DataFrame) -> DataFrame:
    return _with_leader(tribes.filter("IS_DELETED = 0"), "TribeLeaderId", person).select(
        F.col("TribeCode").alias("id"),
        F.col("Name").alias("name"),
        F.col("Description").alias("description"),
        F.col("leader").alias("tribe_owner_id"),
        F.col("leader_name").alias("tribe_owner_name"),
        F.col("ClusterId").alias("cluster_id"),
    )


def unit_dimension(
    units: DataFrame, structure: DataFrame, tribes: DataFrame, clusters: DataFrame, chapters: DataFrame
) -> DataFrame:
    """Units with their tribe, cluster and chapter.

    The deleted rows of a lookup are filtered before the join, so a unit that points at one
    keeps its row and gets no name.  Lookups of lookups are joined first, so the units are
    shuffled once.
    """
    live = F.col("IS_DELETED") == 0
    tribe = tribes.filter(live).select(
        "TribeCode", F.col("Name").alias("tribe_name"), F.col("ClusterId").alias("cluster_id")
    )
    cluster = clusters.filter(live).select(
        F.col("ClusterCode").alias("cluster_id"), F.col("Name").alias("cluster_name")
    )
    chapter = chapters.filter(live).select(
        "ChapterCode", F.col("ChapterCode").alias("known_chapter"), F.col("Name").alias("chapter_name")
    )
    placed = (
        structure.select("UnitId", "TribeCode", "ChapterCode")
        .join(tribe.join(cluster, "cluster_id", "left"), "TribeCode", "left")
        .join(chapter, "ChapterCode", "left")
    )
    return units.join(placed, "UnitId", "left").select(
        F.col("UnitId").alias("id"),
        F.col("Title").alias("title"),
        F.col("Description").alias("description"),
        F.col("OrgCode").alias("org_code"),
        zero_to_null(F.col("cluster_id")).alias("cluster_id"),
        name_of_code(F.col("cluster_id"), F.col("cluster_name")).alias("cluster_name_rms"),
        zero_to_null(F.col("TribeCode")).alias("tribe_id"),
        name_of_code(F.col("TribeCode"), F.col("tribe_name")).alias("tribe_name_rms"),
        zero_to_null(F.col("ChapterCode")).alias("chapter_id"),
        name_of_code(F.col("known_chapter"), F.col("chapter_name")).alias("chapter_name_rms"),
    )


def valid_at(now: datetime, hired: Column, fired: Column) -> Column:
    """Hired by ``now`` and not fired before it; a missing date or 1900-01-01 sets no bound."""
    no_end = fired.isNull() | (fired == at(NO_DATE))
    no_start = hired.isNull() | (hired == at(NO_DATE))
    return ((fired >= at(now)) | no_end) & ((hired <= at(now)) | no_start)


def person_snapshot(tables: dict[str, DataFrame], now: datetime) -> DataFrame:
    """Every person's assignments valid at ``now``, with position and organisation.

    Lookups of lookups (organisation of the employee, cluster, tribe, role and legal entity of
    the position) are joined first, so the assignments pass one join for each key.  With one join
    per shuffle, adaptive execution can split a person or unit that holds much of the data.

    ``tables``: employee_codes (EmployeeCode), assignment_mapping (PersonCode, AssignmentId,
    EmployeeId, Login, FIO, HireDate, FireDate), person_mapping (PersonCode,
    SourceSystemPersonId), persons (PersonId), assignments (AssignmentId, HireDate, StaffUnitId),
    employees (EmployeeId, OrganizationId), organizations (OrganizationId, UnitTitle),
    staff_units (SourceSystemStaffUnitId, PositionName, BusinessUnitCode, ClusterCode, TribeCode,
    RoleId, LegalEntityCode), clusters (ClusterCode, Name), tribes (TribeCode, Name), roles (Code,
    Name), legal_entities (LegalEntityCode, LegalEntityName).
    """
    t = tables
    mapping = t["assignment_mapping"].filter(valid_at(now, F.col("HireDate"), F.col("FireDate")))
    people = (
        t["person_mapping"]
        .select("PersonCode", F.col("SourceSystemPersonId").alias("PersonId"))
        .join(t["persons"].select("PersonId"), "PersonId")
        .join(t["employee_codes"].select(F.col("EmployeeCode").alias("PersonCode")), "PersonCode")
    )
    employers = (
        t["employees"]
        .select("EmployeeId", "OrganizationId")
        .join(t["organizations"].select("OrganizationId", "UnitTitle"), "OrganizationId")
        .select("EmployeeId", "UnitTitle")
    )
    positions = (
        t["staff_units"]
        .withColumnRenamed("SourceSystemStaffUnitId", "StaffUnitKey")
        .join(t["clusters"].select("ClusterCode", F.col("Name").alias("cluster")), "ClusterCode", "left")
        .join(t["tribes"].select("TribeCode", F.col("Name").alias("tribe")), "TribeCode", "left")
        .join(t["roles"].select(F.col("Code").alias("RoleId"), F.col("Name").alias("role")), "RoleId", "left")
        .join(t["legal_entities"].select("LegalEntityCode", "LegalEntityName"), "LegalEntityCode", "left")
        .select("StaffUnitKey", "PositionName", "BusinessUnitCode", "cluster", "tribe", "role", "LegalEntityName")
    )
    joined = (
        mapping.select("PersonCode", "AssignmentId", "EmployeeId", "Login", "FIO")
        .join(people, "PersonCode")
        .join(employers, "EmployeeId")
        .join(t["assignments"].select("AssignmentId", "StaffUnitId", "HireDate"), "AssignmentId")
        .withColumn("StaffUnitKey", F.col("StaffUnitId").cast("string"))
        .join(positions, "StaffUnitKey", "left")
    )
    return joined.select(
        F.col("PersonId").alias("hrgate_person_id"),
        F.col("AssignmentId").alias("hrgate_assignment_id"),
        F.col("Login").alias("login"),
        timestamp_text(F.col("HireDate")).alias("assignment_hire_date"),
        "role",
        F.col("PositionName").alias("position"),
        F.col("FIO").alias("fio"),
        F.col("BusinessUnitCode").alias("business_unit"),
        "cluster",
        "tribe",
        F.coalesce("LegalEntityName", "UnitTitle").alias("legal_entity"),
    ).distinct()


# --- loads: staging is emptied and filled by key; a repeated or missing key fails the load -----------


def load_clusters(clusters: DataFrame, person: DataFrame, staging: str) -> None:
    truncate_load(cluster_dimension(clusters, person), staging, keys=["id"])


def load_tribes(tribes: DataFrame, person: DataFrame, staging: str) -> None:
    truncate_load(tribe_dimension(tribes, person), staging, keys=["id"])


def load_units(
    units: DataFrame, structure: DataFrame, tribes: DataFrame, clusters: DataFrame, chapters: DataFrame, staging: str
) -> None:
    truncate_load(unit_dimension(units, structure, tribes, clusters, chapters), staging, keys=["id"])


def load_persons(tables: dict[str, DataFrame], now: datetime, staging: str) -> None:
    truncate_load(person_snapshot(tables, now), staging, keys=["hrgate_person_id", "hrgate_assignment_id"])
