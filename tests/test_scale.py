"""Plans: what must hold at any size of the data."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import workload.all_queries  # noqa: F401
from tidemark.operators.merge import MergeSpec, merge_with_actions, raw
from tidemark.plans import drafts, plan_hours
from tidemark.session import cluster_settings
from workload.registry import QUERIES

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_needs_a_broadcast_or_a_cross_join(spark, sf_dir, name, no_broadcast):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "SinglePartition"):
        if operator == "SinglePartition" and name in ("month_spine", "open_period"):
            continue  # a global aggregate: one row per task meets in one task
        assert operator not in plan, operator
    assert not re.findall(r"MapInArrow|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan)


def test_no_write_leaves_the_jvm(spark, sf_dir, monkeypatch):
    """Also the steps a query writes before its last plan."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans = []
    for method in ("parquet", "json", "text", "save"):
        plain = getattr(DataFrameWriter, method)

        def noted(self, *args, plain=plain, **kwargs):
            plans.append(plan_of(self._df))
            return plain(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, method, noted)
    for name in ("entity_replace", "json_pages", "org_units_load", "envelope_merge", "act_job", "journal_load"):
        QUERIES[name](spark, sf_dir)
    assert len(plans) > 10 and not [p for p in plans if "InArrow" in p or "Python" in p]


def test_an_upsert_reads_each_side_once(spark, tmp_path, no_broadcast):
    from tidemark.operators.merge import keyed_upsert

    for name in ("t", "s"):
        spark.range(10).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/{name}")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    plan = plan_of(keyed_upsert(target, source, ["k"]))
    assert len(re.findall(r"FileScan", plan)) == 2 and len(re.findall(r"Exchange hash", plan)) == 2


@pytest.fixture
def small_skew(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_role_with_a_third_of_all_changes_is_split(spark, tmp_path, small_skew):
    rows = 300_000
    hot = spark.range(rows).selectExpr(
        "IF(id % 3 = 0, 7, id % 500) AS HoursRoleId",
        "TIMESTAMP_NTZ '2024-01-01' AS Period",
        "int(id % 5) AS Increment",
        "TIMESTAMP_NTZ '2024-01-01' AS Date",
        "int(id % 11) AS User",
        "md5(string(id)) AS Comment",
    )
    hot.repartition(8).write.parquet(f"{tmp_path}/h")
    ids = spark.range(500)
    tables = {
        "HoursRoleHistories": spark.read.parquet(f"{tmp_path}/h"),
        "HoursCompetenceHistories": spark.read.parquet(f"{tmp_path}/h")
        .withColumnRenamed("HoursRoleId", "HoursCompetenceId")
        .limit(0),
        "HoursRoles": ids.selectExpr("id AS Id", "id % 10 AS HoursTribeId", "id AS RoleId"),
        "HoursTribes": spark.range(10).selectExpr("id AS Id", "id AS HoursLegalEntityId", "id AS TribeId"),
        "HoursLegalEntities": spark.range(10).selectExpr("id AS Id", "id AS HoursProjectId", "id AS LegalEntityId"),
        "HoursProjects": spark.range(10).selectExpr("id AS Id", "id AS ProjectId"),
        "Projects": spark.range(10).selectExpr("id AS Id", "concat('P', id) AS ProjectCode"),
        "HoursCompetences": ids.selectExpr("id AS Id", "id AS HoursRoleId", "id AS CompetenceId"),
        "Employee": spark.range(11).selectExpr("int(id) AS Id"),
    }
    changes = plan_hours.changes(tables, datetime(2024, 1, 1), datetime(2024, 1, 2))
    count = changes.agg(F.count("Comment"), F.countDistinct("Comment"))
    assert tuple(count.collect()[0]) == (rows * 4 // 5, rows * 4 // 5)
    assert "SortMergeJoin(skew=true)" in plan_of(count)


def _hot_target(spark, tmp_path, rows=300_000):
    """A third of the target's rows have one key; the source has that key, others and new ones."""
    spark.range(rows).selectExpr(
        "IF(id % 3 = 0, 7, 1000 + id) AS k", "md5(string(id)) AS v", "CAST(NULL AS timestamp_ntz) AS deleted_at",
        "CAST(NULL AS timestamp_ntz) AS updated_at",
    ).repartition(8).write.parquet(f"{tmp_path}/t")
    spark.range(rows).selectExpr("IF(id = 0, 7, 1000 + id + 100000) AS k", "'new' AS v").write.parquet(f"{tmp_path}/s")
    return spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")


@pytest.mark.parametrize("absent", ["soft", "hard"])
def test_a_target_key_with_a_third_of_the_rows_is_split(spark, tmp_path, small_skew, absent):
    target, source = _hot_target(spark, tmp_path)
    spec = MergeSpec(
        keys=("k",), columns={"v": raw()}, absent=absent, deleted_at="deleted_at", updated_at="updated_at", unique_target=False
    )
    merged = merge_with_actions(target, source, spec, datetime(2024, 1, 1))
    count = merged.groupBy("merge_action").agg(F.count("v").alias("n"))
    t, s = target.select("k").toPandas().k, set(source.select("k").toPandas().k)
    matched = int(t.isin(s).sum())
    want = {"update": matched, "insert": len(s - set(t))} | ({"delete": len(t) - matched} if absent == "soft" else {})
    assert {r.merge_action: r.n for r in count.collect()} == want
    assert "SortMergeJoin(skew=true)" in plan_of(count)


def test_a_target_key_with_a_third_of_the_rows_fails_where_keys_are_unique(spark, tmp_path, small_skew):
    target, source = _hot_target(spark, tmp_path)
    spec = MergeSpec(keys=("k",), columns={"v": raw()}, absent="soft", deleted_at="deleted_at", updated_at="updated_at")
    merged = merge_with_actions(target, source, spec, datetime(2024, 1, 1))
    # What reaches the check after the shuffle is cut down to two rows a key and task.
    assert plan_of(merged).count("WindowGroupLimit") >= 4
    with pytest.raises(Exception, match="duplicate merge key: 7"):
        merged.agg(F.count("v")).collect()


def test_act_facts_are_aggregated_before_they_meet_a_key_set(spark, tmp_path, no_broadcast):
    spark.range(1000).selectExpr("id % 10 AS project", "id % 3 AS kind", "id AS amount").write.parquet(f"{tmp_path}/f")
    facts = spark.read.parquet(f"{tmp_path}/f")
    projects = spark.range(8).selectExpr("id AS project")

    def rows(attributes):
        return drafts.act_rows(
            facts, F.col("kind") < 2, projects, "project", F.max(F.when(F.col("project") == 3, 1)), F.sum("amount"),
            attributes, {"[m]": F.sum("amount")},
        )

    by_project = rows(["project", "kind"])
    expected = {
        (p, k): sum(i for i in range(1000) if i % 10 == p and i % 3 == k) for p in range(8) if p != 3 for k in (0, 1)
    }
    assert {(r.project, r.kind): r[2] for r in by_project.collect()} == expected
    scans = [line for line in plan_of(rows(["project", "kind"])).split("\n") if "FileScan" in line]
    assert len(scans) == 2
    for block in re.findall(r"Exchange hashpartitioning.*?FileScan", plan_of(rows(["project", "kind"])), re.S):
        assert "HashAggregate" in block
    by_kind = {r.kind: r[1] for r in rows(["kind"]).collect()}
    assert by_kind == {k: sum(v for (_, kind), v in expected.items() if kind == k) for k in (0, 1)}


def test_cluster_settings_follow_the_data():
    assert cluster_settings(100 << 40, 4000)["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
    assert cluster_settings(1 << 30, 4000)["spark.sql.shuffle.partitions"] == "12000"


def test_a_wide_product_row_is_shuffled_twice_at_most(spark, sf_dir, no_broadcast):
    plan = plan_of(QUERIES["product_catalogue"](spark, sf_dir))
    wide = [line for line in plan.split("\n") if re.search(r"^\W*Project \[.*Description.*ShortDescription", line)]
    assert wide
    lines = plan.split("\n")
    moved = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line and "shortDescription" in " ".join(lines[k : k + 2]).replace("ShortDescription", "shortDescription")]
    # Once to meet its resolved lookups and once to meet the target; the target's own row is the third.
    assert len(moved) <= 3
