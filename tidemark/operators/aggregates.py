"""Pivot and filtered group-by."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, keys: Sequence[str], category: str, value: str, categories: Sequence[Any]) -> DataFrame:
    """One column per category with the greatest value; the fixed list makes it one pass."""
    return df.groupBy(*keys).pivot(category, list(categories)).agg(F.max(value))


def restrict(df: DataFrame, *key_sets: DataFrame) -> DataFrame:
    """Rows whose keys are in every key set; each set joins on the columns it has."""
    for keys in key_sets:
        df = df.join(keys, keys.columns, "left_semi")
    return df


def keys_where(df: DataFrame, key: str, measures: Mapping[str, Column], condition: Column) -> DataFrame:
    """The keys whose measures meet the condition."""
    sums = df.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    return sums.filter(condition).select(key)


def summarize(df: DataFrame, attributes: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Measures per combination of attributes; a group with only blank measures is dropped."""
    grouped = df.groupBy(*attributes).agg(*[m.alias(n) for n, m in measures.items()])
    return grouped.filter(F.coalesce(*[F.col(f"`{n}`").cast("string") for n in measures]).isNotNull())
