"""Every registered query against its SQL."""

import pytest

import workload.all_queries  # noqa: F401
from workload.compare import connect, difference
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, sf_dir, name):
    assert difference(spark, db, name, sf_dir) is None


def test_merge_queries_take_every_action(spark, sf_dir):
    """The comparison is only worth something if rows go down each branch."""
    for name, actions in {
        "merge_soft_delete_raw": {"insert", "update", "delete", "keep"},
        "merge_soft_delete_defaulted": {"insert", "update", "delete", "keep"},
        "merge_consumptions": {"insert", "update", "delete", "keep"},
        "merge_fact_transfers": {"insert", "update", "delete", "keep"},
        "merge_hard_delete": {"insert", "update", "keep"},
        "upsert_null_equal": {"insert", "update", "delete", "keep"},
        "update_from_changed": {"update", "keep"},
        "issue_status_sync": {"update", "keep"},
        "envelope_merge": {"insert", "update", "delete", "keep"},
        "product_catalogue": {"insert", "update", "keep"},
        "product_upsert_dialect": {"insert", "update", "delete", "keep"},
    }.items():
        rows = QUERIES[name](spark, sf_dir).select("merge_action").distinct().collect()
        assert {r.merge_action for r in rows} == actions, name


def test_append_staging_takes_orders_of_any_status(spark, tmp_path):
    rows = [("F", 1, 1.0), ("O", 2, 2.0), ("P", 3, 3.0), ("X", 4, 4.0), (None, 5, 5.0)]
    orders = spark.createDataFrame(rows, "o_orderstatus string, o_orderkey long, o_totalprice double")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = QUERIES["append_staging"](spark, str(tmp_path)).collect()
    assert sorted(r.o_orderkey for r in found) == [1, 2, 3, 4, 5]
