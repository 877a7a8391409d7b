"""Page sets that must be whole, and responses taken apart by entry."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import corrections, hours, journal
from tidemark.sources.extracts import IncompletePages, MANIFEST, escaped_xml, page_faults, read_manifest, require_pages
from tidemark.sources.tables import read_relation, read_snapshot, write_snapshot
from workload import history_queries
from workload.registry import QUERIES

NOW = datetime(2024, 1, 1)


def land(folder, pages, array="timeAllocations", top=2, leave_out=(), cut=()):
    """Pages of ids as files, and what the fetcher noted of them."""
    folder.mkdir()
    noted = []
    for number, ids in enumerate(pages, 1):
        name = f"p{number}.json"
        noted.append({"extract": "2024-01", "page": number, "top": top, "records": len(ids), "file": name})
        if number not in leave_out:
            kept = ids[:-1] if number in cut else ids
            (folder / name).write_text(json.dumps({array: [{"id": i} if isinstance(i, int) else i for i in kept]}))
    manifest = folder.parent / f"{folder.name}-manifest.json"
    manifest.write_text("\n".join(map(json.dumps, noted)))
    return str(folder), str(manifest)


PAGES = [[1, 2], [3, 4], [5], []]


def test_whole_pages_are_loaded(spark, tmp_path):
    pages, manifest = land(tmp_path / "a", PAGES)
    hours.load_pages(spark, pages, "id int", str(tmp_path / "stg"), read_manifest(spark, manifest))
    assert sorted(r.id for r in read_relation(spark, str(tmp_path / "stg")).collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("damage", [{"leave_out": [2]}, {"leave_out": [4]}, {"cut": [1]}])
def test_a_missing_or_cut_page_fails_the_load(spark, tmp_path, damage):
    staging = str(tmp_path / "stg")
    hours.load_pages(spark, land(tmp_path / "a", PAGES)[0], "id int", staging)
    pages, manifest = land(tmp_path / "b", [[7, 8], [9, 10], [11], []], **damage)
    with pytest.raises(IncompletePages, match="noted"):
        hours.load_pages(spark, pages, "id int", staging, read_manifest(spark, manifest))
    assert sorted(r.id for r in read_relation(spark, staging).collect()) == [1, 2, 3, 4, 5]


def test_a_missing_page_deletes_no_row(spark, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "stage")
    write_snapshot(spark.createDataFrame([], corrections.TRANSFER_TABLE), root)
    facts = [[{"factTransferId": "A"}, {"factTransferId": "B"}], [{"factTransferId": "C"}]]
    landed, manifest = land(tmp_path / "one", facts, "factTransfers")
    corrections.load_transfers(spark, landed, staging, root, NOW, read_manifest(spark, manifest))
    for number, damage in enumerate([{"leave_out": [1]}, {"cut": [1]}]):
        landed, manifest = land(tmp_path / f"two{number}", facts, "factTransfers", **damage)
        with pytest.raises(IncompletePages):
            corrections.load_transfers(spark, landed, staging, root, datetime(2024, 2, 1), read_manifest(spark, manifest))
    rows = read_snapshot(spark, root).collect()
    assert sorted((r.FactTransferId, r.IS_DELETED) for r in rows) == [("a", 0), ("b", 0), ("c", 0)]
    landed, manifest = land(tmp_path / "three", [[{"factTransferId": "A"}]], "factTransfers")
    corrections.load_transfers(spark, landed, staging, root, datetime(2024, 3, 1), read_manifest(spark, manifest))
    assert sorted((r.FactTransferId, r.IS_DELETED) for r in read_snapshot(spark, root).collect()) == [("a", 0), ("b", 1), ("c", 1)]


@pytest.mark.parametrize(
    "notes, fault",
    [
        ([(1, 2, 2), (3, 2, 0)], "a page is missing"),
        ([(2, 2, 2), (3, 2, 0)], "a page is missing"),
        ([(1, 2, 2), (2, 2, 2)], "the last page is missing"),
        ([(1, 2, 2), (2, 2, 1), (2, 2, 1)], "a page is noted twice"),
        ([(1, 2, 1), (2, 2, 2), (3, 2, 0)], "records come after a page that is not full"),
        ([(1, 2, None)], "a page is not described"),
        ([(1, 2, 2), (2, 2, 0), (3, 2, 0)], None),
        ([(1, 2, 0)], None),
    ],
)
def test_page_faults(spark, notes, fault):
    rows = [("x", p, t, n, f"f{k}") for k, (p, t, n) in enumerate(notes)] + [("fine", 1, 5, 3, "g")]
    got = page_faults(spark.createDataFrame(rows, MANIFEST)).collect()
    assert [(r.extract, r.fault) for r in got] == ([("x", fault)] if fault else [])


def test_files_nobody_noted_fail(spark, tmp_path):
    pages, manifest = land(tmp_path / "a", PAGES)
    (tmp_path / "a" / "extra.json").write_text('{"timeAllocations": [{"id": 9}]}')
    with pytest.raises(IncompletePages, match="extra.json: 1 records landed, None noted"):
        require_pages(spark, pages, "timeAllocations", read_manifest(spark, manifest))
    with pytest.raises(IncompletePages, match="no page"):
        (tmp_path / "none").mkdir()
        require_pages(spark, str(tmp_path / "none"), "timeAllocations", spark.createDataFrame([], MANIFEST))


def escaped(body):
    return body.replace("<", "&lt;").replace(">", "&gt;")


def entries(spark, *bodies):
    responses = spark.createDataFrame([(f"<soap>{escaped(b)}</soap>",) for b in bodies], "response string")
    return escaped_xml(responses, "response", "L", "E", "A string, B int, _x string")


def test_entries_of_many_shapes(spark):
    got = entries(spark, "<L>\n <E><A>1 &amp; 2</A></E>\t<E/><E ><A> x </A><B>3</B></E>\n<E x=\"q\"><Ex>u</Ex></E></L>", "<L></L>", "<L> \n</L>")
    assert sorted(map(tuple, got.collect()), key=str) == [("1 & 2", None, None), ("x", 3, None), (None, None, "q"), (None, None, None)]


@pytest.mark.parametrize(
    "body", ["<L><E><A>1</A></E>rest</L>", "<L><E><A>1</A></L>", "<L><E><E><A>1</A></E></E></L>", "<L><X/><E></E></L>", "<L>fault</L>", "<L><E>"]
)
def test_a_broken_list_fails(spark, body):
    with pytest.raises(Exception, match="something else than entries|without the list"):
        entries(spark, "<L><E/></L>", body).collect()


def test_a_broken_entry_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|CAST_INVALID"):
        entries(spark, "<L><E><A>1</B></E></L>").collect()


def test_one_large_response_is_parsed_by_many_tasks(spark):
    """200,000 entries, a third of them equal."""
    entry = F.expr("concat('&lt;E&gt;&lt;A&gt;', IF(id % 3 = 0, 'same', md5(string(id))), '&lt;/A&gt;&lt;B&gt;', IF(id % 3 = 0, 7, id), '&lt;/B&gt;&lt;/E&gt;')")
    listed = spark.range(200_000).select(entry.alias("e")).agg(F.array_join(F.collect_list("e"), "").alias("all"))
    responses = listed.select(F.concat(F.lit("<soap>&lt;L&gt;"), "all", F.lit("&lt;/L&gt;</soap>")).alias("response"))
    got = escaped_xml(responses, "response", "L", "E", "A string, B int")
    tasks = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_if(F.col("A") == "same").alias("same"))
    counts = tasks.collect()
    assert sum(r.n for r in counts) == 200_000 and sum(r.same for r in counts) == 66_667
    assert len(counts) > 2 and max(r.n for r in counts) < 80_000


def test_responses_of_one_partition_are_taken_apart_by_many_tasks(spark):
    """200,000 responses that one task reads; they move before they are taken apart."""
    body = "concat('<soap>&lt;L&gt;&lt;E&gt;&lt;A&gt;', md5(string(id)), '&lt;/A&gt;&lt;/E&gt;&lt;/L&gt;</soap>') AS response"
    got = escaped_xml(spark.range(0, 200_000, 1, 1).selectExpr(body), "response", "L", "E", "A string")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(xxhash64(response" in plan[plan.index("Generate") :]
    assert tuple(got.agg(F.count("A"), F.countDistinct("A")).first()) == (200_000, 200_000)


def test_xml_files_hold_a_bounded_number_of_entries(spark, tmp_path, monkeypatch):
    """110,000 customers of one partition: each file of entries is one task's to read, so none may hold them all."""
    columns = ["id AS c_custkey", "concat('c', id) AS c_name", "int(id % 25) AS c_nationkey", "id / 4 AS c_acctbal", "'m' AS c_mktsegment"]
    spark.range(0, 110_000, 1, 1).selectExpr(*columns).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(history_queries, "shared_folder", lambda _, purpose: f"{tmp_path}/{purpose}")
    staged = QUERIES["xml_entries"](spark, str(tmp_path))
    assert tuple(staged.agg(F.count("*"), F.countDistinct("BI_PL_ITEM")).first()) == (110_000, 110_000)
    counts = [f.read_text().count("<JournalEntry>") for f in (tmp_path / "entries").glob("*.xml")]
    assert sum(counts) == 110_000 and max(counts) <= 50_000
    assert journal.read_entries(spark, f"{tmp_path}/entries", "JournalEntry").select(F.spark_partition_id()).distinct().count() == 3
