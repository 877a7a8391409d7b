"""Versions of tables: what a failed, repeated or concurrent run leaves."""

import json
import random
from dataclasses import asdict
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.increments import time_slice
from tidemark.operators.merge import MergeSpec, filled_null_equal, merge, null_equal, raw
from tidemark.plans import dimensions, drafts, hours, issues, journal, plan_hours
from tidemark.sources import tables, versions
from tidemark.sources.files import Folder
from tidemark.sources.tables import (
    append,
    compact_history,
    merge_snapshot,
    read_history,
    read_relation,
    read_snapshot,
    stored_mark,
    truncate_load,
    write_relation,
    write_slice,
    write_snapshot,
)
from tidemark.sources.versions import Conflict, Part, State, Versions
from tests.test_jobs import hours_tables

NOW = datetime(2024, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def folder_bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*") if f.is_file())


# --- staging survives a failed load -------------------------------------------------------------------


def _journal(spark, tmp_path, good):
    entry = "<Entry><SEGMENT1>01</SEGMENT1><SUM_RUB>{}</SUM_RUB></Entry>"
    listed = f"<JournalEntries>{entry.format('1.5')}</JournalEntries>".replace("<", "&lt;").replace(">", "&gt;")
    responses = [listed] if good else [listed, "<soap><fault/></soap>"]
    frame = spark.createDataFrame([(r,) for r in responses], "response string")
    journal.load(frame, "response", "Entry", str(tmp_path / "stg"))


def _journal_value(spark, tmp_path, good):
    entry = f"<Entry><SEGMENT1>01</SEGMENT1><SUM_RUB>{'1.5' if good else 'much'}</SUM_RUB></Entry>"
    listed = f"<JournalEntries>{entry}</JournalEntries>".replace("<", "&lt;").replace(">", "&gt;")
    journal.load(spark.createDataFrame([(listed,)], "response string"), "response", "Entry", str(tmp_path / "stg"))


def _pages(spark, tmp_path, good):
    folder = tmp_path / f"pages-{good}"
    folder.mkdir()
    (folder / "1.json").write_text('{"timeAllocations": [{"id": 1}]}')
    if not good:
        (folder / "2.json").write_text('{"message": "unauthorized"}')
    hours.load_pages(spark, str(folder), "id int", str(tmp_path / "stg"))


def _leaders(spark):
    return spark.createDataFrame([(1, "a")], "PersonCode int, NameLocal string")


def _clusters(spark, tmp_path, good):
    rows = [(1, "c", "d", 1)] + ([] if good else [(1, "again", "d", 1)])
    frame = spark.createDataFrame(rows, "ClusterCode int, Name string, Description string, ClusterLeaderId int")
    dimensions.load_clusters(frame, _leaders(spark), str(tmp_path / "stg"))


def _tribes(spark, tmp_path, good):
    rows = [(1, "t", "d", 1, 9, 0)] + ([] if good else [(None, "no key", "d", 1, 9, 0)])
    schema = "TribeCode int, Name string, Description string, TribeLeaderId int, ClusterId int, IS_DELETED int"
    dimensions.load_tribes(spark.createDataFrame(rows, schema), _leaders(spark), str(tmp_path / "stg"))


def _units(spark, tmp_path, good):
    frame = spark.createDataFrame
    placed = [(1, 5, 7)] + ([] if good else [(1, 6, 7)])
    dimensions.load_units(
        frame([(1, "T", "D", "O")], "UnitId int, Title string, Description string, OrgCode string"),
        frame(placed, "UnitId int, TribeCode int, ChapterCode int"),
        frame([(5, "t", 9, 0)], "TribeCode int, Name string, ClusterId int, IS_DELETED int"),
        frame([(9, "c", 0)], "ClusterCode int, Name string, IS_DELETED int"),
        frame([(7, "h", 0)], "ChapterCode int, Name string, IS_DELETED int"),
        str(tmp_path / "stg"),
    )


def _persons(spark, tmp_path, good):
    frame = spark.createDataFrame
    logins = ["ann"] + ([] if good else ["anna"])
    tables = {
        "employee_codes": frame([(1,)], "EmployeeCode int"),
        "assignment_mapping": frame(
            [(1, 10, 100, login, "A", datetime(2020, 1, 1), None) for login in logins],
            "PersonCode int, AssignmentId int, EmployeeId int, Login string, FIO string, HireDate timestamp_ntz, FireDate timestamp_ntz",
        ),
        "person_mapping": frame([(1, 1000)], "PersonCode int, SourceSystemPersonId int"),
        "persons": frame([(1000,)], "PersonId int"),
        "assignments": frame([(10, datetime(2020, 1, 1), 5)], "AssignmentId int, HireDate timestamp_ntz, StaffUnitId int"),
        "employees": frame([(100, 7)], "EmployeeId int, OrganizationId int"),
        "organizations": frame([(7, "org")], "OrganizationId int, UnitTitle string"),
        "staff_units": frame(
            [], "SourceSystemStaffUnitId string, PositionName string, BusinessUnitCode string, ClusterCode int, TribeCode int, "
            "RoleId int, LegalEntityCode int",
        ),
        "clusters": frame([], "ClusterCode int, Name string"), "tribes": frame([], "TribeCode int, Name string"),
        "roles": frame([], "Code int, Name string"), "legal_entities": frame([], "LegalEntityCode int, LegalEntityName string"),
    }
    dimensions.load_persons(tables, NOW, str(tmp_path / "stg"))


def _statuses(spark, tmp_path, good):
    frame = spark.createDataFrame
    root = str(tmp_path / "issues")
    write_snapshot(frame([(1, 4, "old", None)], "issue_id int, gitlab_status_id int, gitlab_status_name string, updated_at timestamp_ntz"), root)
    name = "CAST(raise_error('broken status') AS string)" if not good else "'open'"
    names = frame([(4,)], "Id int").withColumn("Name", F.expr(name))
    issues.load_statuses(spark, frame([(1, 4)], "IssueId int, StatusGitLabId int"), names, str(tmp_path / "stg"), root, NOW)


def _drafts(spark, tmp_path, good):
    value = "CAST(raise_error('broken draft') AS string)" if not good else "'a'"
    frame = spark.range(2).selectExpr("id AS ActId", f"{value} AS Attributes", "2023 AS YearNumber", "11 AS MonthNumber")
    drafts.stage_drafts(frame, str(tmp_path / "stg"))


def _relation(spark, tmp_path, good):
    value = "CAST(raise_error('broken row') AS string)" if not good else "'a'"
    write_relation(spark.range(3).selectExpr("id", f"{value} AS v"), str(tmp_path / "stg"))


LOADS = {
    "journal": (_journal, "response without the list"), "journal value": (_journal_value, "CAST_INVALID_INPUT"),
    "pages": (_pages, "without its array"), "clusters": (_clusters, "duplicate merge key"), "tribes": (_tribes, "NULL merge key"),
    "units": (_units, "duplicate merge key"), "persons": (_persons, "duplicate merge key"), "statuses": (_statuses, "broken status"),
    "drafts": (_drafts, "broken draft"), "relation": (_relation, "broken row"),
}


@pytest.mark.parametrize("name", LOADS)
def test_a_failed_load_leaves_the_old_rows(spark, tmp_path, name):
    load, error = LOADS[name]
    staging = str(tmp_path / "stg")
    load(spark, tmp_path, True)
    before = rows_of(read_relation(spark, staging))
    assert before
    with pytest.raises(Exception, match=error):
        load(spark, tmp_path, False)
    assert rows_of(read_relation(spark, staging)) == before
    if name != "pages":
        load(spark, tmp_path, True)
        assert rows_of(read_relation(spark, staging)) == before


def test_staging_can_be_loaded_from_itself(spark, tmp_path):
    path = str(tmp_path / "stg")
    truncate_load(spark.range(3).toDF("id"), path)
    truncate_load(read_relation(spark, path).filter("id > 0"), path)
    assert rows_of(read_relation(spark, path)) == [(1,), (2,)]


def test_partitions_of_staging_are_pruned(spark, tmp_path):
    path = str(tmp_path / "stg")
    for n in (50, 100):
        truncate_load(spark.range(n).selectExpr("id", "int(id % 4) AS m"), path, partition_by=["m"])
    one = read_relation(spark, path).filter("m = 3")
    assert one.count() == 25 and one.columns == ["id", "m"]
    assert "PartitionFilters: [isnotnull(m" in one._jdf.queryExecution().executedPlan().toString()


# --- concurrent writers -----------------------------------------------------------------------------------


def test_of_two_snapshots_one_fails_and_the_table_stays(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(1).toDF("id"), root)
    table = Versions(spark, root)
    seen = table.state()
    part = table.write(spark.range(7).toDF("id"), seen)
    write_snapshot(spark.range(2).toDF("id"), root)
    with pytest.raises(Conflict):
        table.commit(part, seen, all=True, depends=True)
    assert read_snapshot(spark, root).count() == 2
    write_snapshot(spark.range(3).toDF("id"), root)
    assert read_snapshot(spark, root).count() == 3


def test_slices_of_two_writers_are_both_kept(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "h")
    write_slice(spark.range(1).toDF("id"), root, datetime(2024, 1, 1))
    plain, calls = Folder.create, []

    def late(self, name, text):
        if not calls:
            # Between this writer's look at the log and its record, another one is faster.
            calls.append(name)
            write_slice(spark.range(10, 12).toDF("id"), root, datetime(2024, 2, 1))
        return plain(self, name, text)

    monkeypatch.setattr(Folder, "create", late)
    write_slice(spark.range(20, 23).toDF("id"), root, datetime(2024, 3, 1))
    assert rows_of(read_history(spark, root)) == [(0,), (10,), (11,), (20,), (21,), (22,)]


def test_a_record_is_whole_or_missing(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "log"))
    assert folder.names() == [] and folder.create("a", "я\n") and not folder.create("a", "other")
    assert folder.read("a") == "я\n" and folder.names() == ["a"]


# --- appends that know their run ------------------------------------------------------------------------------


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "app")
    append(spark.range(2).toDF("id"), path, {"log": F.lit("x")}, run="monday")
    append(spark.range(5, 7).toDF("id"), path, {"log": F.lit("x")}, run="tuesday")
    append(spark.range(3).toDF("id"), path, {"log": F.lit("x")}, run="monday")
    got = read_relation(spark, path)
    assert got.columns == ["log", "id"] and rows_of(got) == [("x", 0), ("x", 1), ("x", 2), ("x", 5), ("x", 6)]
    append(spark.range(0).toDF("id"), path, {"log": F.lit("x")}, run="tuesday")
    assert rows_of(read_relation(spark, path)) == [("x", 0), ("x", 1), ("x", 2)]
    with pytest.raises(Exception, match="broken"):
        append(spark.range(1).selectExpr("CAST(raise_error('broken') AS BIGINT) AS id"), path, {"log": F.lit("x")}, run="monday")
    assert read_relation(spark, path).count() == 3


def test_appends_with_partitions(spark, tmp_path):
    path = str(tmp_path / "app")
    for run in ("a", "b", "a"):
        append(spark.range(6).selectExpr("id", "int(id % 2) AS m"), path, partition_by=["m"], run=run)
    got = read_relation(spark, path)
    assert got.count() == 12 and got.filter("m = 1").count() == 6


def test_sending_issues_again_changes_nothing(spark, tmp_path):
    custom = spark.createDataFrame([(1, "p", "c")], "issue_id int, product_code_sol string, cluster_name string")
    names = spark.createDataFrame([(1, "n")], "issue_id int, issue_name string")
    for run in ("1", "1", "2"):
        issues.send_issues(custom, names, str(tmp_path / "out"), run=run)
    assert read_relation(spark, str(tmp_path / "out")).count() == 2


# --- change sets --------------------------------------------------------------------------------------------------

SOFT = MergeSpec(
    keys=("k", "g"), columns={"v": filled_null_equal(""), "n": raw()}, absent="soft", deleted_flag="IS_DELETED",
    deleted_at="DELETED_AT", updated_at="UPDATED_AT",
)
HARD = MergeSpec(keys=("k", "g"), columns={"v": null_equal(""), "n": raw()}, absent="hard", updated_at="UPDATED_AT")
UPDATE = MergeSpec(keys=("k", "g"), columns={"v": null_equal("")}, insert=False, updated_at="UPDATED_AT")
TARGET = "k int, g string, v string, n int, IS_DELETED int, DELETED_AT timestamp_ntz, UPDATED_AT timestamp_ntz"


@pytest.mark.parametrize("spec", [SOFT, HARD, UPDATE], ids=["soft", "hard", "update"])
@pytest.mark.parametrize("layers", [1, 3, 100])
def test_layers_of_changes_equal_whole_merges(spark, tmp_path, spec, layers):
    """Rows come, change, go and come back, over several runs."""
    rng = random.Random(layers)
    root = str(tmp_path / "t")
    first = [(k, "g", "a", 1, 0, None, None) for k in range(30)]
    write_snapshot(spark.createDataFrame(first, TARGET), root)
    want = spark.createDataFrame(first, TARGET)
    for run in range(5):
        ts = NOW + timedelta(days=run)
        keys = rng.sample(range(40), 30)
        source = spark.createDataFrame([(k, "g", rng.choice(["a", "b", None]), rng.choice([1, 1, 1, 2])) for k in keys], "k int, g string, v string, n int")
        want = spark.createDataFrame(merge(want, source, spec, ts).collect(), TARGET)
        merge_snapshot(spark, root, source, spec, ts, share=1e9, layers=layers)
        assert rows_of(read_snapshot(spark, root)) == rows_of(want), run
        parts = Versions(spark, root).state().parts
        assert len([p for p in parts if p.keys]) <= layers and len([p for p in parts if not p.keys]) == 1


def test_a_load_writes_what_it_changes(spark, tmp_path):
    """One row in a hundred changes, comes or goes: about a hundredth is written, and then folded."""
    root = str(tmp_path / "t")
    values = ["int(id) AS k", "'g' AS g", "sha2(string(id), 512) AS v", "int(id) AS n"]
    audit = ["0 AS IS_DELETED", "CAST(NULL AS timestamp_ntz) AS DELETED_AT", "CAST(NULL AS timestamp_ntz) AS UPDATED_AT"]
    n = 200_000
    whole = write_snapshot(spark.range(n).selectExpr(*values, *audit), root)
    for run in range(3):
        source = spark.range(n).selectExpr(*values).withColumn("n", F.expr(f"IF(k % 100 = {run}, -{run + 1}, n)"))
        layer = merge_snapshot(spark, root, source, SOFT, NOW + timedelta(days=run))
        # A later run also takes back what the one before changed.
        assert folder_bytes(layer) < (0.013 if run == 0 else 0.026) * folder_bytes(whole)
    assert merge_snapshot(spark, root, source, SOFT, NOW) is None
    assert read_snapshot(spark, root).filter("n < 0").count() == n // 100
    folded = merge_snapshot(spark, root, source, SOFT, NOW, share=0.0)
    assert folder_bytes(folded) > 0.9 * folder_bytes(whole)
    assert [p.keys for p in Versions(spark, root).state().parts] == [()]


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(1, "g", "a", 1, 0, None, None)], TARGET), root)
    source = spark.createDataFrame([(1, "g", "b", 1)], "k int, g string, v string, n int")
    merge_snapshot(spark, root, source, SOFT, NOW)
    before = rows_of(read_snapshot(spark, root))
    with pytest.raises(Exception, match="duplicate merge key: 1, g"):
        merge_snapshot(spark, root, source.union(source), SOFT, NOW)
    assert rows_of(read_snapshot(spark, root)) == before


def test_a_repeated_target_key_fails_the_load(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(1, "g", "a", 1, 0, None, None)] * 2, TARGET), root)
    with pytest.raises(Exception, match="duplicate merge key: 1, g"):
        merge_snapshot(spark, root, spark.createDataFrame([(2, "g", "b", 1)], "k int, g string, v string, n int"), SOFT, NOW)


# --- histories ------------------------------------------------------------------------------------------------------


def dated(spark):
    return spark.range(100).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, int(id)) AS t")


def test_a_slice_repeated_after_compaction(spark, tmp_path):
    root = str(tmp_path / "h")
    a, b = datetime(2024, 1, 1), datetime(2024, 2, 1)
    write_slice(spark.range(2).toDF("id"), root, a)
    write_slice(spark.range(10, 13).toDF("id"), root, b)
    compact_history(spark, root)
    assert len(Versions(spark, root).state().parts) == 1
    write_slice(spark.range(10, 13).toDF("id"), root, b)
    assert rows_of(read_history(spark, root)) == [(0,), (1,), (10,), (11,), (12,)]
    write_slice(spark.range(0).toDF("id"), root, a)
    compact_history(spark, root)
    assert rows_of(read_history(spark, root)) == [(10,), (11,), (12,)]
    compact_history(spark, root)
    write_slice(spark.range(17, 18).toDF("id"), root, a)
    assert rows_of(read_history(spark, root)) == [(10,), (11,), (12,), (17,)]


def test_compaction_keeps_to_its_size_and_to_ranges(spark, tmp_path):
    root, rows = str(tmp_path / "h"), dated(spark)
    days = [datetime(2024, 1, 1) + timedelta(days=10 * k) for k in range(6)]
    for low, high in zip(days, days[1:]):
        write_slice(time_slice(rows, "t", low, high), root, low, ranges=["t"])
    size = max(p.bytes for p in Versions(spark, root).state().parts)
    compact_history(spark, root, target_bytes=2 * size)
    parts = Versions(spark, root).state().parts
    assert sorted(len(p.names) for p in parts) == [1, 2, 2] and all(p.ranges["t"] for p in parts)
    got = read_history(spark, root, {"t": (datetime(2024, 1, 25), datetime(2024, 2, 3))})
    assert sorted(r.id for r in got.collect()) == list(range(24, 33))


def test_a_reader_with_bounds_opens_what_overlaps(spark, tmp_path):
    """One month of 1,000 weekly slices; those outside do not even exist here."""
    root = str(tmp_path / "h")
    table = Versions(spark, root)
    real, parts = [], []
    for week in range(1000):
        low = date(2004, 1, 1) + timedelta(weeks=week)
        ends = [low.isoformat(), (low + timedelta(days=6)).isoformat()]
        if not date(2010, 2, 20) < low < date(2010, 4, 10):
            parts.append(Part(f"__version={week:08d}-none", 1, names=(str(week),), ranges={"d": ends}))
    record = {"state": asdict(State(versions.EVERY, tuple(parts)))}
    table.log.create(f"{versions.EVERY:012d}.json", json.dumps(record))
    for week in range(1000 - len(parts)):
        low = date(2010, 2, 25) + timedelta(weeks=week)
        frame = spark.range(7).selectExpr("id", f"date_add(DATE '{low}', int(id)) AS d")
        write_slice(frame, root, datetime.combine(low, datetime.min.time()), ranges=["d"])
        real.append(table.state().parts[-1].folder)
    got = read_history(spark, root, {"d": (date(2010, 3, 1), date(2010, 4, 1))})
    assert sorted(r.d for r in got.select("d").collect()) == [date(2010, 3, d) for d in range(1, 32)]
    opened = {f.split("/")[-2] for f in got.inputFiles()}
    assert len(opened) == 5 or len(opened) == 6
    assert opened <= set(real)
    assert read_history(spark, root, {"d": (date(2050, 1, 1), None)}).count() == 0
    # The log is read from the last whole state on.
    reads = []
    plain = Folder.read

    def counted(self, name):
        reads.append(name)
        return plain(self, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Folder, "read", counted)
        assert len(table.state().parts) == 1000
    assert len(reads) <= versions.EVERY


def test_rows_without_a_date_are_in_no_bounds(spark, tmp_path):
    root = str(tmp_path / "h")
    write_slice(spark.sql("SELECT 1 AS id, CAST(NULL AS DATE) AS d"), root, datetime(2024, 1, 1), ranges=["d"])
    write_slice(spark.sql("SELECT 2 AS id, DATE '2024-02-05' AS d UNION ALL SELECT 3, NULL"), root, datetime(2024, 2, 1), ranges=["d"])
    assert read_history(spark, root).count() == 3
    assert [r.id for r in read_history(spark, root, {"d": (date(2024, 1, 1), None)}).collect()] == [2]
    assert read_history(spark, root, {"d": (None, date(2024, 1, 1))}).count() == 0


# --- slice and mark ---------------------------------------------------------------------------------------------------


def test_slice_and_mark_are_one_commit(spark, tmp_path, monkeypatch):
    history, marks = str(tmp_path / "h"), str(tmp_path / "m")
    moments = [datetime(2024, 1, d) for d in (1, 2, 3)]
    tables = hours_tables(spark, moments)
    write_snapshot(spark.createDataFrame([], "TableName string, LastUpdateDate timestamp_ntz"), marks)

    def run(day):
        plan_hours.load(spark, tables, history, marks, datetime(2024, 1, day))

    run(2)
    plain = Versions.commit
    with monkeypatch.context() as patch:
        # The rows are written, their record is not: neither is known.
        patch.setattr(Versions, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(3)
    assert read_history(spark, history).count() == 2
    assert stored_mark(spark, history, "plan_hours_history") == datetime(2024, 1, 2)
    with monkeypatch.context() as patch:
        # The record is written, the table that shows marks to others is not: both are known.
        patch.setattr(plan_hours, "write_snapshot", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run(3)
    assert plain is Versions.commit
    assert read_history(spark, history).count() == 3
    assert stored_mark(spark, history, "plan_hours_history") == datetime(2024, 1, 3)
    run(4)
    assert read_history(spark, history).count() == 5
    assert read_snapshot(spark, marks).first().LastUpdateDate == datetime(2024, 1, 4)
    bounded = read_history(spark, history, {"ChangeDate": (datetime(2024, 1, 3), datetime(2024, 1, 4))})
    assert bounded.count() == 2 and len({f.split("/")[-2] for f in bounded.inputFiles()}) == 1


# --- upkeep -------------------------------------------------------------------------------------------------------------


def test_old_versions_are_removed(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(40):
        if n % 13 == 0:
            write_snapshot(spark.range(n + 1).toDF("id"), root)
        else:
            table = Versions(spark, root)
            table.commit(None, table.state(), marks={"t": str(n)})
    table = Versions(spark, root)
    assert table.clean(timedelta(days=1)) == [] and read_snapshot(spark, root).count() == 40
    assert len(table.clean(timedelta(0))) == 3
    assert read_snapshot(spark, root).count() == 40 and table.state().marks == {"t": "38"}
    assert len(table.log.names()) == 40 - versions.EVERY + 1


def test_intermediate_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}-1")
    path = tables.shared_folder(spark, "step")
    spark.range(1).write.parquet(path)
    assert tables.clean_shared(spark, timedelta(days=1)) == []
    assert tables.clean_shared(spark, timedelta(0)) == ["step-1"] and not Path(path).exists()
