"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.tables import shared_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to a fresh shared folder and read back.

    It cuts the lineage: a lost executor costs the tasks of the running step only.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
