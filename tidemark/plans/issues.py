"""Issue status sync: what is sent out, what comes back, and the change-only update."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import MergeSpec, merge, null_equal
from tidemark.sources.tables import append, merge_snapshot, read_relation, truncate_load

STATUS_UPDATE = MergeSpec(
    keys=("issue_id",),
    columns={"gitlab_status_id": null_equal(0), "gitlab_status_name": null_equal("")},
    insert=False,
    updated_at="updated_at",
)


def issues_to_send(custom_status: DataFrame, issues: DataFrame) -> DataFrame:
    names = issues.select("issue_id", F.col("issue_name").alias("Title"))
    return custom_status.join(names, "issue_id").select(
        F.col("issue_id").alias("IssueId"),
        "Title",
        F.col("product_code_sol").alias("CustomSolSoftware"),
        F.col("cluster_name").alias("ClusterName"),
    )


def returned_statuses(issue_statuses: DataFrame, statuses: DataFrame) -> DataFrame:
    named = statuses.select(F.col("Id").alias("StatusGitLabId"), F.col("Name").alias("gitlab_status_name"))
    return issue_statuses.join(named, "StatusGitLabId").select(
        F.col("IssueId").alias("issue_id"),
        F.col("StatusGitLabId").alias("gitlab_status_id"),
        "gitlab_status_name",
    )


def update_statuses(target: DataFrame, returned: DataFrame, run_ts: datetime) -> DataFrame:
    return merge(target, returned, STATUS_UPDATE, run_ts)


def send_issues(custom_status: DataFrame, issues: DataFrame, outgoing: str, run: str | None = None) -> None:
    """The copy out: the other side's staging gets the issues behind those it holds; those of a run
    that is repeated take the place of its earlier ones."""
    append(issues_to_send(custom_status, issues), outgoing, run=run)


def load_statuses(
    spark: SparkSession, issue_statuses: DataFrame, statuses: DataFrame, staging: str, root: str, run_ts: datetime
) -> None:
    """The copy back: staging is replaced, then issues whose status differs are updated."""
    truncate_load(returned_statuses(issue_statuses, statuses), staging)
    merge_snapshot(spark, root, read_relation(spark, staging), STATUS_UPDATE, run_ts)
