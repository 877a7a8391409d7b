"""NULL handling and code lookups as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def or_default(column: Column, default: Any) -> Column:
    """The column, with NULL replaced by its per-type default."""
    return F.coalesce(column, as_column(default))


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace NULLs in the named columns; column types stay as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.coalesce(F.col(c), as_column(v).cast(types[c])) for c, v in defaults.items()}
    )


def zero_to_null(code: Column) -> Column:
    """A zero code means "no value"."""
    return F.nullif(code, F.lit(0))


def name_of_code(code: Column, name: Column) -> Column:
    """The name, but only where its code is a real (non-NULL, non-zero) code."""
    return F.when(F.coalesce(code, F.lit(0)) != 0, name)


def label(code: Column, labels: Mapping[Any, str], otherwise: str | None = None) -> Column:
    """Map a code to its label; unknown and NULL codes get ``otherwise``."""
    chain = F
    for key, text in labels.items():
        chain = chain.when(code == F.lit(key), F.lit(text))
    return chain.otherwise(F.lit(otherwise)) if otherwise is not None else chain
