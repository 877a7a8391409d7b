"""Product model: full refresh of one wide flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.tables import write_snapshot


def refresh(source: DataFrame, root: str, load_time: str = "loaded_at") -> str:
    """All columns but the load time, as the next snapshot."""
    return write_snapshot(source.drop(load_time), root)
