"""Relations in, snapshots and increments out."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.merge import ACTION, KEEP, MergeSpec, REMOVE, merge_with_actions, require_unique
from tidemark.sources.files import Folder
from tidemark.sources.versions import NAME, VERSION, Versions, within


def read_relation(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """A relation with its columns in catalogue order; of a folder with versions, the current rows.

    A database takes the same call: ``fmt="jdbc"`` with url, dbtable, partitionColumn,
    lowerBound, upperBound and numPartitions, so that the extract is split over tasks.
    """
    if path and fmt == "parquet":
        versions = Versions(spark, path)
        if versions.exists():
            return versions.current()
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def write_relation(df: DataFrame, path: str | None = None, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """A relation out.  For a database: ``fmt="jdbc"`` with url, dbtable, truncate="true" to keep
    the table's definition, and batchsize for the rows per insert.

    A Parquet folder is replaced as ``write_snapshot`` does it; other formats are deleted first.
    """
    if path and fmt == "parquet" and mode == "overwrite" and not options:
        write_snapshot(df, path)
        return
    writer = df.write.format(fmt).mode(mode).options(**options)
    writer.save(path) if path else writer.save()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may lack that setting; its folders are below its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def clean_shared(spark: SparkSession, older_than: timedelta) -> list[str]:
    """Remove the folders of ``shared_folder`` that have not changed for that long; their names."""
    base = shared_folder(spark, "x").rpartition("/")[0]
    return Folder(spark, base).remove_old(older_than)


def truncate_load(df: DataFrame, path: str, keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Replace what is staged; with ``keys``, a repeated key fails the load.

    The old rows stay until the new ones are written and checked, so a failed load leaves them, and
    the frame may read from ``path``.  Read the rows back with ``read_relation``.
    """
    write_snapshot(require_unique(df, keys) if keys else df, path, partition_by)


def append(
    df: DataFrame, path: str, constants: Mapping[str, Column] | None = None, partition_by: Sequence[str] = (), run: str | None = None
) -> None:
    """Append rows, with constant columns in front.

    ``run`` names what is appended: a second call with the same name takes the place of the first, so
    a repeated run doubles nothing.  Without it every call adds.
    """
    versions = Versions(df.sparkSession, path)
    extra = [value.alias(name) for name, value in (constants or {}).items()]
    _put(versions, df.select(*extra, *df.columns), run or uuid.uuid4().hex, partition_by)


def _put(versions: Versions, df: DataFrame, name: str, partition_by: Sequence[str] = (), ranges: Sequence[str] = (), **commit: Any) -> None:
    state = versions.state()
    part = versions.write(df.withColumn(NAME, F.lit(name)), state, partition_by, ranges, names=(name,))
    versions.commit(part, state, df.schema, **commit)


# --- snapshots ------------------------------------------------------------------------------
#
# The next snapshot of a target is computed from the current one, and a folder cannot be read
# and overwritten by one plan.


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """The folder of the current snapshot, without the changes since; None before the first one."""
    state = Versions(spark, root).state()
    return f"{root}/{state.parts[0].folder}" if state.parts else None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return Versions(spark, root).current()


def write_snapshot(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next snapshot and make it current; a failed write changes nothing."""
    versions = Versions(df.sparkSession, root)
    before = versions.state()
    part = versions.write(df, before, partition_by)
    versions.commit(part, before, df.schema, all=True, depends=True)
    return f"{root}/{part.folder}"


def merge_snapshot(
    spark: SparkSession, root: str, source: DataFrame, spec: MergeSpec, run_ts: datetime, share: float = 0.2, layers: int = 8
) -> str | None:
    """Merge a source into a snapshot and write what changed; the folder written, None if nothing was.

    The changed rows, with what happened to them, become a layer over the snapshot; a reader takes
    the newest row of each key.  Once the layers hold more than ``share`` of the snapshot's bytes, or
    are as many as ``layers``, a run writes the whole next snapshot instead.  Either way the merge
    reads the target once, and its keys must be unique.
    """
    versions = Versions(spark, root)
    before = versions.state()
    target = versions.current(before)
    changes = [p for p in before.parts if p.keys]
    base = sum(p.bytes for p in before.parts if not p.keys)
    merged = merge_with_actions(target, source, replace(spec, unique_target=True), run_ts, removed=True)
    if len(changes) >= layers or sum(p.bytes for p in changes) > share * base:
        part = versions.write(merged.filter(F.col(ACTION) != REMOVE).drop(ACTION), before)
        versions.commit(part, before, all=True, depends=True)
    else:
        part = versions.write(merged.filter(F.col(ACTION) != KEEP), before, keys=tuple(spec.keys))
        if versions.rows([part], before.schema).isEmpty():
            return None
        versions.commit(part, before, depends=True)
    return f"{root}/{part.folder}"


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A snapshot laid out by merge key: the next merge need not shuffle it.

    Read it back by table name; with ``spark.sql.shuffle.partitions`` equal to ``buckets``, a
    merge on ``keys`` then shuffles its source only.  Rows are brought together by key before
    writing, so the number of files is the number of buckets.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


# --- increments --------------------------------------------------------------------------


def write_slice(
    df: DataFrame, root: str, low: datetime, full_load: bool = False, ranges: Sequence[str] = (), marks: Mapping[str, datetime] | None = None
) -> None:
    """Add the slice that starts at ``low`` to a history, or replace the whole history by it.

    A slice takes the place of an earlier one with the same start, also when it has no rows, and
    after the earlier one was compacted with others.  What is replaced, by a full load too, stays
    readable until the new rows are written.

    ``ranges`` are columns of dates or times whose bounds let a reader skip the slice.  ``marks`` are
    high-water marks that move by the same record as the slice becomes known: both or neither.
    """
    moved = {table: high.isoformat() for table, high in (marks or {}).items()}
    _put(Versions(df.sparkSession, root), df, f"{low:%Y%m%dT%H%M%S}", ranges=ranges, all=full_load, marks=moved)


def stored_mark(spark: SparkSession, root: str, table: str) -> datetime | None:
    """The mark that the last slice of a history left for a table."""
    mark = Versions(spark, root).state().marks.get(table)
    return datetime.fromisoformat(mark) if mark else None


def read_history(spark: SparkSession, root: str, bounds: Mapping[str, tuple[Any, Any]] | None = None) -> DataFrame:
    """The latest full load and the latest write of each slice since.

    ``bounds`` maps columns to (low, high), either of which may be None, and keeps rows with
    low <= column < high; slices whose ranges lie outside are not opened.
    """
    versions = Versions(spark, root)
    state = versions.state()
    if not state.parts:
        raise FileNotFoundError(f"no history below {root}")
    if not bounds:
        return versions.rows(state.parts, state.schema)
    parts = versions.overlapping(bounds, state)
    if not parts:
        return spark.createDataFrame([], StructType.fromJson(state.schema))
    return versions.rows(parts, state.schema).filter(within(bounds))


def compact_history(spark: SparkSession, root: str, target_bytes: int = 1 << 30) -> None:
    """Write neighbouring slices into common folders of about ``target_bytes``.

    Rows keep the name of their slice, so a slice can be replaced later, and folders keep bounds.
    A writer that adds a slice meanwhile makes the compaction fail, not itself.
    """
    versions = Versions(spark, root)
    state = versions.state()
    groups, size = [[]], 0
    for part in sorted(state.parts, key=lambda p: p.names):
        if groups[-1] and size + part.bytes > target_bytes:
            groups.append([])
            size = 0
        groups[-1].append(part)
        size += part.bytes
    for group in groups:
        if len(group) > 1 or any(p.gone for p in group):
            names = tuple(sorted({n for p in group for n in set(p.names) - set(p.gone)}))
            ranges = [c for c in group[0].ranges if all(c in p.ranges for p in group)]
            rows = versions.rows(group, state.schema, named=True).drop(VERSION)
            part = versions.write(rows, state, ranges=ranges, names=names)
            state = versions.commit(part, state, folds=[p.folder for p in group], depends=True)
