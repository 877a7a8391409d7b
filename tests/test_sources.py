"""Envelopes, pages, XML, snapshots, increments."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.increments import FULL_LOAD_START, advance_mark, read_mark, time_slice
from tidemark.sources.envelope import (
    Field,
    append_envelopes,
    pack_records,
    read_envelopes,
    records,
    replace_entities,
)
from tidemark.sources.extracts import escaped_xml, read_pages, read_records, read_xml
from tidemark.sources.tables import (
    append,
    compact_history,
    current_snapshot,
    read_history,
    read_relation,
    read_snapshot,
    shared_folder,
    truncate_load,
    write_relation,
    write_slice,
    write_snapshot,
)

FIELDS = (Field("Id", "int", "id", strict=True), Field("w", "decimal(19,4)"), Field("at", "timestamp_ntz"), Field("ok", "boolean"))


def envelope(spark, *texts, entity="e"):
    return spark.createDataFrame([(entity, t) for t in texts], "entity string, json_text string")


def parsed(spark, *texts):
    return [tuple(r) for r in records(envelope(spark, *texts), "e", FIELDS).orderBy("Id").collect()]


def test_records_are_typed(spark):
    text = '[{"id": 1, "w": 1.23456, "at": "2024-01-02T03:04:05.1234567", "ok": true}, {"id": "2", "w": null, "extra": {}}]'
    assert parsed(spark, text, "[]") == [
        (1, Decimal("1.2346"), datetime(2024, 1, 2, 3, 4, 5, 123456), True),
        (2, None, None, None),
    ]


def test_long_decimals_keep_their_digits(spark):
    assert parsed(spark, '[{"id": 1, "w": 123456789012345.6789}]')[0][1] == Decimal("123456789012345.6789")


@pytest.mark.parametrize("text", ['[{"w": 1}]', '[{"id": null}]'])
def test_a_missing_strict_key_fails(spark, text):
    with pytest.raises(Exception, match="strict key missing: id"):
        parsed(spark, text)


@pytest.mark.parametrize("text", ['[{"id": "x"}]', '[{"id": 1, "w": "many"}]', '[{"id": 1, "at": "soon"}]'])
def test_a_mistyped_value_fails(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|MALFORMED_RECORD"):
        parsed(spark, text)


def test_text_that_is_no_json_fails(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        parsed(spark, '[{"id": 1}')


def test_pack_and_unpack(spark):
    rows = spark.range(2500).selectExpr(
        "id", "IF(id < 2000, 'hot', 'cold') AS kind", "IF(id % 3 = 0, NULL, concat('\"q\" \\\\ я ', id)) AS w"
    )
    packed = pack_records(rows, F.col("kind"), ["id", "w"], max_bytes=2000)
    sizes = packed.selectExpr("entity", "size(from_json(json_text, 'array<string>')) AS n", "length(json_text) AS l").collect()
    assert max(r.l for r in sizes) <= 4000 and len(sizes) > 20
    assert sum(r.n for r in sizes if r.entity == "hot") == 2000
    for r in packed.limit(3).collect():
        assert all(set(x) == {"id", "w"} for x in json.loads(r.json_text))
    back = records(packed, None, (Field("id", "bigint", strict=True), Field("w", "string")))
    expected = rows.select(F.col("kind").alias("entity"), "id", "w")
    assert back.exceptAll(expected).count() == 0 and back.count() == 2500


def test_envelopes_do_not_depend_on_partitions(spark):
    rows = spark.range(3000).selectExpr("id", "concat('e', id % 300) AS kind")
    packed = [
        sorted(map(tuple, pack_records(rows.repartition(n), F.col("kind"), ["id"], max_bytes=60).collect())) for n in (1, 4, 16)
    ]
    assert packed[0] == packed[1] == packed[2] and len(packed[0]) > 300
    one = pack_records(rows, F.lit(None).cast("string"), ["id"]).collect()
    assert len(one) == 1 and one[0].entity is None and len(json.loads(one[0].json_text)) == 3000


def test_packing_stays_in_the_jvm(spark):
    plan = pack_records(spark.range(10).toDF("id"), F.lit("e"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_packing_nothing(spark):
    assert pack_records(spark.range(0).toDF("id"), F.lit("e"), ["id"]).count() == 0


def test_replace_entities_clears_an_empty_extract(spark, tmp_path):
    path = str(tmp_path / "stage")
    for entity in ("a", "b", "c"):
        append_envelopes(envelope(spark, '[{"id": 1}]', entity=entity), path)
    replace_entities(envelope(spark, '[{"id": 2}]', '[{"id": 3}]', entity="a"), path, ["a", "b"])
    got = records(read_envelopes(spark, path), None, (Field("id", "int"),)).collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("a", 3), ("c", 1)]


def test_entity_filter_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "stage")
    for entity in ("a", "b"):
        append_envelopes(envelope(spark, "[]", entity=entity), path)
    plan = records(read_envelopes(spark, path), "a", FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(entity" in plan


def test_nested_response_with_null_object(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"id": 1, "owner": {"login": "x"}}, {"id": 2, "owner": null}, {"id": 3}]')
    got = read_records(spark, str(tmp_path), "id int, owner struct<login: string>", {"id": "id", "login": "owner.login"})
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x"), (2, None), (3, None)]


def test_broken_and_pretty_responses(spark, tmp_path):
    (tmp_path / "p.json").write_text('{\n "rows": [\n  {"id": 1}\n ]\n}')
    assert read_pages(spark, str(tmp_path), "rows", "id int", multi_line=True).first().id == 1
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        read_pages(spark, str(tmp_path), "rows", "id int").collect()


def test_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"timeAllocations": [{"id": 1}, {"id": 2, "h": 1.5}]}')
    (tmp_path / "2.json").write_text('{"timeAllocations": []}')
    got = read_pages(spark, str(tmp_path), "timeAllocations", "id int, h decimal(4,1)")
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, Decimal("1.5"))]


@pytest.mark.parametrize("page", ['{"message": "unauthorized"}', '{"rows": null}', "{}"])
def test_a_page_without_its_array_fails(spark, tmp_path, page):
    (tmp_path / "1.json").write_text('{"rows": [{"id": 1}]}')
    (tmp_path / "2.json").write_text(page)
    with pytest.raises(Exception, match="landed page without its array rows"):
        read_pages(spark, str(tmp_path), "rows", "id int").collect()


ENTRIES = "<JournalEntries><Entry><A>007</A><B>x</B><R>r</R></Entry><Entry><A>8</A></Entry></JournalEntries>"


def test_xml_entries(spark, tmp_path):
    (tmp_path / "e.xml").write_text(ENTRIES)
    got = read_xml(spark, str(tmp_path), "Entry", "A string, B string, R string", drop=["R"])
    assert sorted(map(tuple, got.collect()), key=str) == [("007", "x"), ("8", None)]


def test_escaped_xml(spark):
    body = ENTRIES.replace("<", "&lt;").replace(">", "&gt;")
    none = "<soap>&lt;JournalEntries&gt;&lt;/JournalEntries&gt;</soap>"
    responses = spark.createDataFrame([(f"<soap><body>{body}</body></soap>",), (none,)], "response string")
    got = escaped_xml(responses, "response", "JournalEntries", "Entry", "A string, B string, R string", drop=["R"])
    assert sorted(map(tuple, got.collect()), key=str) == [("007", "x"), ("8", None)]


@pytest.mark.parametrize("response", ["<soap><fault/></soap>", "<soap>&lt;JournalEntries&gt;&lt;Entry&gt;", None])
def test_a_response_without_its_list_fails(spark, response):
    body = ENTRIES.replace("<", "&lt;").replace(">", "&gt;")
    responses = spark.createDataFrame([(body,), (response,)], "response string")
    with pytest.raises(Exception, match="response without the list JournalEntries"):
        escaped_xml(responses, "response", "JournalEntries", "Entry", "A string").collect()


def test_snapshot_can_be_built_from_itself(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert current_snapshot(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    write_snapshot(spark.range(3).toDF("id"), root)
    first = read_snapshot(spark, root)
    write_snapshot(first.union(first), root)
    assert read_snapshot(spark, root).count() == 6 and first.count() == 3


def test_a_failed_write_leaves_the_snapshot(spark, tmp_path):
    root = str(tmp_path / "snap")
    write_snapshot(spark.range(3).toDF("id"), root)
    with pytest.raises(Exception, match="broken"):
        write_snapshot(spark.range(3).selectExpr("IF(id = 2, CAST(raise_error('broken') AS BIGINT), id) AS id"), root)
    assert read_snapshot(spark, root).count() == 3


def test_staging_load_and_append(spark, tmp_path):
    path = str(tmp_path / "stg")
    truncate_load(spark.range(5).toDF("id"), path)
    truncate_load(spark.range(2).toDF("id"), path)
    assert read_relation(spark, path).count() == 2
    truncate_load(spark.range(3).toDF("id"), path, keys=["id"])
    with pytest.raises(Exception, match="duplicate merge key: 1"):
        truncate_load(spark.sql("SELECT 1 AS id UNION ALL SELECT 1"), str(tmp_path / "dup"), keys=["id"])
    write_relation(read_relation(spark, path), str(tmp_path / "out"), fmt="orc")
    assert read_relation(spark, str(tmp_path / "out"), fmt="orc").count() == 3
    other = str(tmp_path / "app")
    for _ in range(2):
        append(spark.range(2).toDF("id"), other, {"ETL_LOG_ID": F.expr("X'00'")})
    got = read_relation(spark, other)
    assert got.columns == ["ETL_LOG_ID", "id"] and got.count() == 4
    assert bytes(got.first().ETL_LOG_ID) == b"\x00"


def test_slices_add_up_and_repeat_harmlessly(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, int(id)) AS t")
    a, b, c = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 5, 1)
    root = str(tmp_path / "h")
    for low, high in ((a, b), (b, c), (b, c)):
        write_slice(time_slice(rows, "t", low, high), root, low)
    assert read_history(spark, root).exceptAll(rows).count() == 0
    assert read_history(spark, root).count() == time_slice(rows, "t", a, c).count() == 100
    write_slice(rows.limit(0), root, b)
    assert read_history(spark, root).count() == 31
    write_slice(time_slice(rows, "t", b, c), root, b)
    compact_history(spark, root)
    assert read_history(spark, root).count() == 100
    with pytest.raises(Exception, match="broken"):
        write_slice(rows.selectExpr("CAST(raise_error('broken') AS BIGINT) AS id", "t"), root, a, full_load=True)
    assert read_history(spark, root).count() == 100
    write_slice(time_slice(rows, "t", a, b), root, a, full_load=True)
    assert read_history(spark, root).count() == 31


def test_marks(spark):
    marks = spark.createDataFrame([("h", datetime(2024, 1, 2, 3, 4, 5)), ("n", None)], "TableName string, LastUpdateDate timestamp_ntz")
    assert read_mark(marks, "h") == datetime(2024, 1, 2, 3, 4)
    assert read_mark(marks, "h", full_load=True) == FULL_LOAD_START
    assert read_mark(marks, "n") == read_mark(marks, "missing") == FULL_LOAD_START
    moved = advance_mark(marks, "h", datetime(2024, 6, 1))
    assert {tuple(r) for r in moved.collect()} == {("h", datetime(2024, 6, 1)), ("n", None)}
    fresh = advance_mark(marks, "missing", datetime(2024, 6, 1))
    assert read_mark(fresh, "missing") == datetime(2024, 6, 1) and fresh.count() == 3


def test_time_slice_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' AS t").write.parquet(f"{tmp_path}/t")
    sliced = time_slice(spark.read.parquet(f"{tmp_path}/t"), "t", datetime(2024, 1, 1), datetime(2024, 2, 1))
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


class _Session:
    def __init__(self, master, **settings):
        self.conf, self.sparkContext, self.master = settings, self, master


def test_shared_folder_follows_the_session():
    named = _Session("spark://cluster", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    one, two = shared_folder(named, "x"), shared_folder(named, "x")
    assert one.startswith("hdfs:///shared/x-") and one != two
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://cluster"), "x")
