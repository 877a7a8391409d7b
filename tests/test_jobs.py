"""Whole jobs on small invented data."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalogue, corrections, dimensions, drafts, hours, issues, journal, org_units, plan_hours
from tidemark.plans import product_model, systems
from tidemark.sources.envelope import pack_records, read_envelopes, replace_entities
from tidemark.sources.extracts import read_records
from tidemark.sources.tables import read_history, read_relation, read_snapshot, write_snapshot

NOW = datetime(2024, 1, 1)
OLD = datetime(2020, 1, 1)


# --- plan hours ------------------------------------------------------------------------------------


def hours_tables(spark, moments):
    frame = spark.createDataFrame
    change = "int, Period timestamp_ntz, Increment int, Date timestamp_ntz, User int, Comment string"
    return {
        "HoursProjects": frame([(1, 11)], "Id int, ProjectId int"),
        "Projects": frame([(11, "P-11")], "Id int, ProjectCode string"),
        "HoursLegalEntities": frame([(2, 1, 22)], "Id int, HoursProjectId int, LegalEntityId int"),
        "HoursTribes": frame([(3, 2, 33)], "Id int, HoursLegalEntityId int, TribeId int"),
        "HoursRoles": frame([(4, 3, 44)], "Id int, HoursTribeId int, RoleId int"),
        "HoursCompetences": frame([(5, 4, 55)], "Id int, HoursRoleId int, CompetenceId int"),
        "HoursRoleHistories": frame(
            [(4, OLD, i - 1, m, i, f"c{i}") for i, m in enumerate(moments)], f"HoursRoleId {change}"
        ),
        "HoursCompetenceHistories": frame(
            [(5, OLD, 7, m, 99, None) for m in moments] + [(6, OLD, 7, moments[0], 99, "orphan")],
            f"HoursCompetenceId {change}",
        ),
        "Employee": frame([(0,), (2,)], "Id int"),
    }


def test_changes_of_a_slice(spark):
    moments = [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)]
    got = plan_hours.changes(hours_tables(spark, moments), moments[0], moments[2])
    rows = {(r.SubType, r.ChangeDate): r for r in got.collect()}
    assert len(rows) == 3  # the role change of 2 January adds nothing and is left out
    role = rows[("Direct on Role", moments[0])]
    assert (role.ProjectCode, role.LegalEntityId, role.TribeId, role.RoleId) == ("P-11", 22, 33, 44)
    assert (role.CompetenceId, role.ChangedBy_EmployeeCode, role.Increment, role.SourceSystem) == (-1, 0, -1, "RMS")
    competence = rows[("Direct on Competence", moments[1])]
    assert (competence.CompetenceId, competence.ChangedBy_EmployeeCode, competence.Period) == (55, None, OLD.date())


def test_plan_hours_runs(spark, tmp_path):
    history, marks = str(tmp_path / "h"), str(tmp_path / "m")
    moments = [datetime(2024, 1, d) for d in (1, 2, 3)]
    tables = hours_tables(spark, moments)
    write_snapshot(
        spark.createDataFrame([("plan_hours_history", datetime(2024, 1, 1))], "TableName string, LastUpdateDate timestamp_ntz"),
        marks,
    )

    def run(ts, **more):
        plan_hours.load(spark, tables, history, marks, ts, **more)
        return read_history(spark, history)

    first = run(datetime(2024, 1, 2, 0, 0, 30))
    assert first.count() == 2 and first.columns[-1] == "LoadDateTime"
    assert read_snapshot(spark, marks).first().LastUpdateDate == datetime(2024, 1, 2)
    assert run(datetime(2024, 1, 3, 0, 0, 1)).count() == 3
    assert run(datetime(2024, 1, 4)).count() == 5
    assert run(datetime(2024, 1, 4)).count() == 5
    assert run(datetime(2024, 1, 5), full_load=True).count() == 5
    assert read_history(spark, history).select("LoadDateTime").distinct().count() == 1


def test_a_run_that_failed_before_the_mark_is_repeated_later(spark, tmp_path):
    history, marks = str(tmp_path / "h"), str(tmp_path / "m")
    tables = hours_tables(spark, [datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)])
    empty = spark.createDataFrame([], "TableName string, LastUpdateDate timestamp_ntz")
    write_snapshot(empty, marks)  # no row for the table: its mark does not move
    for day, rows in ((2, 2), (3, 3), (4, 5)):
        plan_hours.load(spark, tables, history, marks, datetime(2024, 1, day))
        assert read_history(spark, history).count() == rows


# --- corrections and systems -----------------------------------------------------------------------


def test_transfers_from_page_to_target(spark, tmp_path):
    page = {"factTransfers": [
        {"factTransferId": "AB-1", "projectFrom": "P1    ", "coefficient": 1.005, "createdAt": "2024-01-01T10:00:00"},
        {"factTransferId": "AB-2", "coefficient": 2, "rmsLegalEntityId": 5},
    ]}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps(page))
    stage = str(tmp_path / "stage")
    rows = corrections.read_transfers(spark, str(tmp_path / "pages"))
    replace_entities(pack_records(rows, F.lit(corrections.TRANSFERS), rows.columns), stage, [corrections.TRANSFERS])
    target = spark.createDataFrame(
        [("ab-2", None, None, None, Decimal("2.00"), None, 5, 0, None, None), ("ab-3", None, None, None, None, None, 0, 0, None, None)],
        "FactTransferId string, ConversionPeriodId string, ProjectFrom string, ProjectTo string, "
        "Coefficient decimal(10,2), CreatedAt timestamp_ntz, RmsLegalEntityId int, IS_DELETED int, "
        "DELETED_AT timestamp_ntz, UPDATED_AT timestamp_ntz",
    )
    out = {r.FactTransferId: r for r in corrections.merge_transfers(target, read_envelopes(spark, stage), NOW).collect()}
    assert (out["ab-1"].ProjectFrom, out["ab-1"].Coefficient, out["ab-1"].RmsLegalEntityId) == ("P1", Decimal("1.01"), 0)
    assert out["ab-2"].UPDATED_AT is None
    assert (out["ab-3"].IS_DELETED, out["ab-3"].DELETED_AT, out["ab-3"].UPDATED_AT) == (1, NOW, NOW)


def test_added_facts_hide_null_changes(spark):
    target = spark.createDataFrame(
        [("a", None, "p1", None, Decimal("1.00"), None, None, 0, None, None)],
        "AddedFactId string, ConversionPeriodId string, PersonId string, ProjectTo string, "
        "AllocationDuration decimal(10,2), CreatedAt timestamp_ntz, ConversionTimeAllocationId string, "
        "IS_DELETED int, DELETED_AT timestamp_ntz, UPDATED_AT timestamp_ntz",
    )

    def after(**fields):
        text = json.dumps([{"addedFactId": "A", **fields}])
        envelopes = spark.createDataFrame([(corrections.ADDED_FACTS, text)], "entity string, json_text string")
        return corrections.merge_added_facts(target, envelopes, NOW).first()

    assert after(projectTo="new", allocationDuration=1).UPDATED_AT is None
    changed = after(personId="p2", projectTo="new")
    assert (changed.UPDATED_AT, changed.ProjectTo, changed.AllocationDuration) == (NOW, "new", None)


def test_consumptions_from_response(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"id": 1, "type": "T", "linkWeight": 0.12345, "confirmedInOBS": true}, {"id": 2}]')
    flat = read_records(spark, str(tmp_path), systems.CONSUMPTION_RESPONSE, systems.CONSUMPTION_PATHS)
    target = spark.createDataFrame(
        [],
        "SOURCE_SYSTEM_ID int, TYPE string, CONSUMER_OBJECT_ID bigint, FOOD_PRODUCT_OBJECT_ID bigint, "
        "LINK_TYPE string, LINK_WEIGHT decimal(19,4), INTEGRATION_STAGE string, CONFIRMED_IN_OBS boolean, "
        "CREATION_DATE timestamp_ntz, LAST_CHANGE_DATE timestamp_ntz, STATUS string, COMMENT string, "
        "IS_DELETED int, DELETED_AT timestamp_ntz",
    )
    packed = pack_records(flat, F.lit(systems.CONSUMPTIONS), flat.columns)
    out = {r.SOURCE_SYSTEM_ID: r for r in systems.merge_consumptions(target, packed, NOW).collect()}
    assert (out[1].TYPE, out[1].LINK_WEIGHT, out[1].CONFIRMED_IN_OBS, out[1].IS_DELETED) == ("T", Decimal("0.1235"), True, 0)
    assert (out[2].TYPE, out[2].LINK_WEIGHT, out[2].CREATION_DATE) == ("", Decimal("0.0000"), datetime(1, 1, 1))


def test_systems_in_both_dialects(spark):
    text = json.dumps([{"object_id": 1, "system_id": 1, "name": None, "real_servers": 0}, {"object_id": 1, "system_id": 2}])
    envelopes = spark.createDataFrame([(systems.SYSTEMS, text)], "entity string, json_text string")
    names = [f.name for f in systems.SYSTEM_ROW_FIELDS]
    types = ", ".join(f"{f.name} {f.type}" for f in systems.SYSTEM_ROW_FIELDS)
    row = {"object_id": 1, "system_id": 1, "name": "", "real_servers": None}
    target = spark.createDataFrame(
        [(*[row.get(n) for n in names], None, OLD), (9, 9, *[None] * 11, None, OLD)],
        f"{types}, deleted_at timestamp_ntz, updated_at timestamp_ntz",
    )
    out = {(r.object_id, r.system_id): r for r in systems.upsert_systems(target, envelopes, NOW).collect()}
    assert (out[1, 1].name, out[1, 1].updated_at) == ("", OLD)
    assert (out[1, 2].name, out[1, 2].updated_at) == (None, None)
    assert (out[9, 9].deleted_at, out[9, 9].updated_at) == (NOW, NOW)

    types = ", ".join(f"{f.name} {f.type}" for f in systems.SYSTEM_FIELDS)
    target = spark.createDataFrame([(1, 1, *[None] * 11, 0, None)], f"{types}, IS_DELETED int, DELETED_AT timestamp_ntz")
    out = {r.SystemId: r for r in systems.merge_systems(target, envelopes, NOW).collect()}
    assert out[1].Name is None  # a NULL in the target hides the default
    assert (out[2].Name, out[2].IsTest, out[2].IS_DELETED) == ("", False, 0)


# --- catalogue ---------------------------------------------------------------------------------------


def product_envelopes(spark, products, classifiers):
    return spark.createDataFrame(
        [(catalogue.PRODUCT, json.dumps(products)), (catalogue.CLASSIFIER, json.dumps(classifiers))],
        "entity string, json_text string",
    )


def test_products_first_dialect(spark):
    envelopes = product_envelopes(
        spark,
        [
            {"id": 1, "objectId": 101, "code": "TEC.1", "name": "a", "rmsContour": "ABC", "owner": "x", "sol_url": "u"},
            {"id": 2, "objectId": 102, "parentId": 1, "code": "zzz", "owner": "gone"},
        ],
        [{"id": 1, "clf_id": 8, "classifier_value_name": "g"}, {"id": 1, "clf_id": 28, "classifier_value_name": "d"}],
    )
    units = spark.createDataFrame([("abc", 7)], "UnitId string, TribeCode int")
    employees = spark.createDataFrame(
        [("x", 1, datetime(1, 1, 1), 0), ("gone", 2, datetime(1, 1, 1), 1)],
        "Login string, PersonId int, DeletedAtSource timestamp_ntz, IS_DELETED int",
    )
    persons = spark.createDataFrame([(1, "P1"), (2, "P2")], "PersonId int, PersonCode string")
    texts = [c for c in catalogue.PRODUCT_MERGE.columns if c not in ("ParentObjectId", "TribeCode")]
    target = spark.createDataFrame(
        [],
        "ObjectId int, ParentObjectId int, TribeCode int, "
        + ", ".join(f"{c} string" for c in texts)
        + ", UpdatedAt timestamp_ntz",
    )
    out = {r.ObjectId: r for r in catalogue.merge_products(target, envelopes, units, employees, persons, NOW).collect()}
    one, two = out[101], out[102]
    assert (one.TribeCode, one.OwnerPersonCode, one.TechOwnerPersonCode, one.ParentObjectId) == (7, "P1", "", 0)
    assert (one.FINDirectionGeneral, one.FINGroup, one.FINDetailed) == ("g", "", "d")
    assert (one.ProductTypeSol, one.ProductTypeSolName, one.SolUrl) == ("TEC", "Технопродукты", "u/modules/1")
    assert (two.ParentObjectId, two.OwnerPersonCode, two.ProductTypeSol, two.SolUrl) == (101, "", "BPR", "/modules/2")
    assert two.Name is None


def test_products_second_dialect(spark):
    envelopes = product_envelopes(spark, [{"id": 2, "objectId": 102, "code": "tec.1", "rmsContour": "5"}], [])
    units = spark.createDataFrame([(5, "None")], "id int, tribe_id string")
    fields = [c for c in catalogue.PRODUCT_UPSERT.columns if c != "tribe_id"]
    schema = (
        "id int, object_id int, tribe_id int, " + ", ".join(f"{c} string" for c in fields)
        + ", deleted_at timestamp_ntz, updated_at timestamp_ntz"
    )
    stored = {"code": "tec.1", "customer_unit_id": "5", "product_type_sol": "tec", "product_type_sol_name": "Технопродукты"}
    target = spark.createDataFrame(
        [(1, 102, None, *[stored.get(c, "") for c in fields], None, OLD), (7, 107, None, *[None] * len(fields), None, None)],
        schema,
    )
    out = {r.object_id: r for r in catalogue.upsert_products(target, envelopes, units, NOW).collect()}
    assert (out[102].id, out[102].updated_at, out[102].sol_url) == (1, OLD, "")
    assert (out[107].deleted_at, out[107].updated_at) == (NOW, NOW)


def test_classifier_responses_are_reduced(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '[{"entityId": 1, "classifier": {"id": 8}, "classifierValue": {"name": "v"}}, '
        '{"entityId": 1, "classifier": {"id": 3}}, {"entityId": 2}]'
    )
    raw = spark.read.schema(catalogue.CLASSIFIER_RESPONSE).json(str(tmp_path))
    assert [tuple(r) for r in catalogue.kept_classifiers(raw).collect()] == [("1", 8, "v")]


def test_product_response_is_flattened(spark, tmp_path):
    long = "d" * 5000
    (tmp_path / "p.json").write_text(
        json.dumps([{"id": 1, "objectId": 2, "rmsContour": {"unitId": "u"}, "ownerDetails": None, "description": long}, {"id": 3}])
    )
    got = read_records(spark, str(tmp_path), catalogue.PRODUCT_RESPONSE, catalogue.product_paths("Module", "url"))
    one, three = sorted(got.collect(), key=lambda r: r.id)
    assert (one.rmsContour, one.owner, len(one.description), one.sol_type) == ("u", None, 5000, "Module")
    narrow = read_records(spark, str(tmp_path), catalogue.PRODUCT_RESPONSE, catalogue.product_paths("Module", "url", 4000))
    assert max(len(r.description) for r in narrow.collect()) == 4000
    assert three.description == ""


# --- dimensions ------------------------------------------------------------------------------------------


def test_units_keep_their_row_when_a_lookup_is_deleted(spark):
    frame = spark.createDataFrame
    got = dimensions.unit_dimension(
        frame([(1, "t", "d", "o"), (2, "t", "d", "o"), (3, "t", "d", "o")], "UnitId int, Title string, Description string, OrgCode string"),
        frame([(1, 5, 0), (2, 6, 8)], "UnitId int, TribeCode int, ChapterCode int"),
        frame([(5, "T5", 9, 0), (6, "T6", 9, 1)], "TribeCode int, Name string, ClusterId int, IS_DELETED int"),
        frame([(9, "C9", 0)], "ClusterCode int, Name string, IS_DELETED int"),
        frame([(0, "none", 0), (8, "H8", 0)], "ChapterCode int, Name string, IS_DELETED int"),
    )
    rows = {r.id: tuple(r)[4:] for r in got.collect()}
    assert rows == {
        1: (9, "C9", 5, "T5", None, None),
        2: (None, None, 6, None, 8, "H8"),
        3: (None, None, None, None, None, None),
    }


def test_issue_sync(spark):
    custom = spark.createDataFrame([(1, "p", "c"), (2, "p", "c")], "issue_id int, product_code_sol string, cluster_name string")
    names = spark.createDataFrame([(1, "n")], "issue_id int, issue_name string")
    assert [tuple(r) for r in issues.issues_to_send(custom, names).collect()] == [(1, "n", "p", "c")]
    sent = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "IssueId int, StatusGitLabId int")
    statuses = spark.createDataFrame([(4, "open"), (5, None)], "Id int, Name string")
    target = spark.createDataFrame(
        [(1, 4, "old", None), (2, 5, "", None), (3, 1, "x", None)],
        "issue_id int, gitlab_status_id int, gitlab_status_name string, updated_at timestamp_ntz",
    )
    got = issues.update_statuses(target, issues.returned_statuses(sent, statuses), NOW)
    assert sorted(map(tuple, got.collect())) == [(1, 4, "open", NOW), (2, 5, "", None), (3, 1, "x", None)]


# --- journal, hours, units, drafts, product model ------------------------------------------------------------


def test_journal_appends_months(spark, tmp_path):
    xml, staged = tmp_path / "xml", str(tmp_path / "stg")
    xml.mkdir()
    for month in ("01", "02"):
        (xml / f"{month}.xml").write_text(
            f"<JournalEntries><Entry><SEGMENT1>00{month}</SEGMENT1><SUM_RUB>1.5</SUM_RUB>"
            f"<DOC_DATE>2023-{month}-01T00:00:00</DOC_DATE><REFERENCE2GUID>g</REFERENCE2GUID></Entry></JournalEntries>"
        )
    journal.stage(journal.read_entries(spark, str(xml), "Entry"), staged)
    got = read_relation(spark, staged).orderBy("SEGMENT1").collect()
    assert [r.SEGMENT1 for r in got] == ["0001", "0002"]
    assert (got[0].SUM_RUB, got[0].SUM_OPER, got[0].BI_PL_ITEM) == (1.5, 0.0, "1")
    assert (got[0].DOC_DATE, got[0].PERIOD) == (datetime(2023, 1, 1), datetime(1970, 1, 1))
    assert len(got[0]) == 37 and got[0].__fields__[0] == "ETL_LOG_ID"


def test_hours_pages_and_period(spark, tmp_path):
    status = spark.createDataFrame([(date(2023, 10, 1), 1), (date(2023, 11, 1), 0)], "PERIOD_DATE date, TS_PERIOD_IS_CLOSED int")
    period = hours.period_to_load(status)
    assert period.first() == (date(2023, 11, 1), date(2023, 11, 30), date(2023, 1, 1))
    assert hours.months_to_load(period).count() == 1
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "1.json").write_text('{"timeAllocations": [{"id": 1}, {"id": 2}]}')
    for _ in range(2):
        hours.load_pages(spark, str(pages), "id int", str(tmp_path / "stg"))
    assert read_relation(spark, str(tmp_path / "stg")).count() == 2


def test_org_units_by_name(spark, tmp_path):
    (tmp_path / "u.json").write_text('[{"title": "T", "x": {"y": 1}, "id": "u1", "org_code": "o", "short_name": "s"}]')
    units = org_units.read_units(spark, str(tmp_path))
    staged = spark.createDataFrame([("u1",) + (None,) * 4, ("u2",) + (None,) * 4], org_units.UNIT_RESPONSE)
    got = org_units.upsert_units(staged, units)
    assert sorted(map(tuple, got.collect())) == [("u1", None, "o", "s", "T"), ("u2", None, None, None, None)]


def test_drafts_are_staged_by_month(spark, tmp_path):
    acts = spark.createDataFrame([("P1", 1), (None, 2), ("P1", 3)], "`D[Code]` string, `[m]` int")
    packed = drafts.packed_drafts(acts, "D[Code]", 2023, 11, date(2023, 11, 30))
    drafts.stage_drafts(packed, str(tmp_path / "stg"))
    rows = read_relation(spark, str(tmp_path / "stg")).collect()
    assert len(rows) == 2 and len({r.ActId for r in rows}) == 1
    assert {r.Measures for r in rows} == {'[{"Measure": "[m]", "value": 1}]', '[{"Measure": "[m]", "value": 3}]'}
    assert all((r.YearNumber, r.MonthNumber) == (2023, 11) for r in rows)


def test_realization_projects(spark):
    projects = spark.createDataFrame(
        [(1, "Realization", "f", True, 3), (2, "Closed", "f", True, 3), (3, "Realization", None, True, 3),
         (4, "Realization", "f", False, 3), (5, "Realization", "f", True, 4), (6, "Realization", "f", None, 3)],
        "k int, ProjectStatus string, WIPFrameworkId string, WIPActsProjectFilter boolean, CustomerCode int",
    )
    assert [r.k for r in drafts.realization_projects(projects, "k").collect()] == [1]


def test_export_documents_and_lines(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, date(2023, 11, 5), "я", None), (2, None, 'q"', Decimal("1.50"))],
        "id int, Date date, CurrenrId string, Amount decimal(10,2)",
    ).coalesce(1)
    (document,) = drafts.export_documents(rows, F.lit("all")).collect()
    assert document.document == (
        '{"WipActs": [{"id":1,"Date":"2023-11-05T00:00:00","CurrenrId":"я","Amount":null},'
        '{"id":2,"Date":null,"CurrenrId":"q\\"","Amount":1.50}]}'
    )
    assert len(json.loads(document.document)["WipActs"]) == 2
    drafts.export_lines(rows, str(tmp_path / "lines"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect())
    assert lines[0] == '{"id":1,"Date":"2023-11-05T00:00:00","CurrenrId":"я","Amount":null}'


def test_product_model_refresh(spark, tmp_path):
    root = str(tmp_path / "flat")
    wide = spark.createDataFrame([(1, "a", OLD)], "id int, v string, loaded_at timestamp_ntz")
    product_model.refresh(wide, root)
    product_model.refresh(wide.withColumn("v", F.lit("b")), root)
    assert [tuple(r) for r in read_snapshot(spark, root).collect()] == [(1, "b")]


# --- whole loads, from landed responses to the next snapshots ------------------------------------------------


def empty(spark, schema, root):
    write_snapshot(spark.createDataFrame([], schema), root)


def land(folder, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "1.json").write_text(json.dumps(content))
    return str(folder)


def test_load_systems_then_an_empty_response(spark, tmp_path):
    root, row_root, staging = (str(tmp_path / n) for n in ("a", "b", "stage"))
    empty(spark, systems.SYSTEM_TABLE, root)
    empty(spark, systems.SYSTEM_ROW_TABLE, row_root)
    response = [{"objectId": 1, "systemId": 2, "owner": {"login": "x"}, "person": None, "isTest": True}]
    systems.load_systems(spark, land(tmp_path / "one", response), staging, root, row_root, NOW)
    (a,), (b,) = read_snapshot(spark, root).collect(), read_snapshot(spark, row_root).collect()
    assert (a.OwnerLogin, a.Person, a.IsTest, a.IS_DELETED) == ("x", "", True, 0)
    assert (b.owner_login, b.person, b.istest, b.deleted_at) == ("x", None, True, None)
    later = datetime(2024, 2, 1)
    systems.load_systems(spark, land(tmp_path / "two", []), staging, root, row_root, later)
    (a,), (b,) = read_snapshot(spark, root).collect(), read_snapshot(spark, row_root).collect()
    assert (a.IS_DELETED, a.DELETED_AT) == (1, later)
    assert (b.deleted_at, b.updated_at) == (later, later)


def test_load_corrections_and_consumptions_share_staging(spark, tmp_path):
    staging = str(tmp_path / "stage")
    roots = {n: str(tmp_path / n) for n in ("transfers", "facts", "consumptions")}
    empty(spark, corrections.TRANSFER_TABLE, roots["transfers"])
    empty(spark, corrections.ADDED_FACT_TABLE, roots["facts"])
    empty(spark, systems.CONSUMPTION_TABLE, roots["consumptions"])
    corrections.load_transfers(
        spark, land(tmp_path / "t", {"factTransfers": [{"factTransferId": "T"}]}), staging, roots["transfers"], NOW
    )
    corrections.load_added_facts(
        spark, land(tmp_path / "f", {"addedFacts": [{"addedFactId": "F"}]}), staging, roots["facts"], NOW
    )
    systems.load_consumptions(spark, land(tmp_path / "c", [{"id": 3}]), staging, roots["consumptions"], NOW)
    assert read_snapshot(spark, roots["transfers"]).first().FactTransferId == "t"
    assert read_snapshot(spark, roots["facts"]).first().AddedFactId == "f"
    assert read_snapshot(spark, roots["consumptions"]).first().SOURCE_SYSTEM_ID == 3
    assert {r.entity for r in read_envelopes(spark, staging).collect()} == {
        corrections.TRANSFERS, corrections.ADDED_FACTS, systems.CONSUMPTIONS,
    }


def test_an_error_page_leaves_the_corrections_alone(spark, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "stage")
    empty(spark, corrections.TRANSFER_TABLE, root)
    corrections.load_transfers(spark, land(tmp_path / "one", {"factTransfers": [{"factTransferId": "T"}]}), staging, root, NOW)
    with pytest.raises(Exception, match="without its array factTransfers"):
        corrections.load_transfers(spark, land(tmp_path / "two", {"message": "unauthorized"}), staging, root, NOW)
    (row,) = read_snapshot(spark, root).collect()
    assert (row.FactTransferId, row.IS_DELETED) == ("t", 0)


def test_load_products_of_several_types(spark, tmp_path):
    root, row_root, staging = (str(tmp_path / n) for n in ("a", "b", "stage"))
    empty(spark, catalogue.PRODUCT_TABLE, root)
    empty(spark, catalogue.PRODUCT_ROW_TABLE, row_root)
    products = {
        "Module": land(tmp_path / "m", [{"id": 1, "objectId": 11, "code": "TEC.1"}]),
        "Service": land(tmp_path / "s", [{"id": 2, "objectId": 12, "parentId": 1}]),
    }
    classifiers = land(
        tmp_path / "c", [{"entityId": 1, "classifier": {"id": 27}, "classifierValue": {"name": "g"}}]
    )
    catalogue.stage_extracts(spark, products, classifiers, "u", staging)
    lookups = {
        "units": spark.createDataFrame([], "UnitId string, TribeCode int"),
        "employees": spark.createDataFrame(
            [], "Login string, PersonId int, DeletedAtSource timestamp_ntz, IS_DELETED int"
        ),
        "persons": spark.createDataFrame([], "PersonId int, PersonCode string"),
        "tribe_units": spark.createDataFrame([], "id string, tribe_id string"),
    }
    catalogue.load_products(spark, staging, lookups, root, row_root, NOW)
    got = {r.ObjectId: r for r in read_snapshot(spark, root).collect()}
    assert (got[11].Type, got[11].FINGroup, got[12].Type, got[12].ParentObjectId) == ("Module", "g", "Service", 11)
    rows = {r.object_id: r for r in read_snapshot(spark, row_root).collect()}
    assert (rows[11].id, rows[11].product_type_sol, rows[12].type, rows[12].sol_url) == (1, "TEC", "Service", "u/modules/2")
