"""Wide attribute/measure rows to packed name/value text, and back to long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.functions.dates import day_first_to_iso
from tidemark.functions.text import collapse_space, escape_quotes, number_text, plain_number


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def split_columns(columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(attributes, measures): the name of a measure starts with a bracket."""
    return [c for c in columns if not c.startswith("[")], [c for c in columns if c.startswith("[")]


def attribute_text(column: Column, is_date: bool = False) -> Column:
    """An attribute as packed text: blanks collapsed, dates ISO, ``null`` when absent."""
    text = collapse_space(column.cast("string"))
    if is_date:
        text = day_first_to_iso(text)
    return escape_quotes(F.coalesce(text, F.lit("null")))


def measure_text(df: DataFrame, name: str) -> Column:
    """A measure as packed text, with all its digits and never in scientific notation."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        column = plain_number(column)
    return number_text(column)


def _array_text(parts: Sequence[Column]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]"))


def pack_attributes(names: Sequence[str], dates: Sequence[str] = ()) -> Column:
    """``[{"Attribute": "name", "value": "text"}, ...]`` in the order of the names."""
    return _array_text(
        [
            F.concat(
                F.lit(f'{{"Attribute": "{n}", "value": "'),
                attribute_text(F.col(quoted(n)), n in dates),
                F.lit('"}'),
            )
            for n in names
        ]
    )


def pack_measures(df: DataFrame, names: Sequence[str]) -> Column:
    """``[{"Measure": "name", "value": number}, ...]`` in the order of the names."""
    return _array_text(
        [F.concat(F.lit(f'{{"Measure": "{n}", "value": '), measure_text(df, n), F.lit("}")) for n in names]
    )


def unpivot_text(df: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Long form: one (variable, value) row per id and column, values as text."""
    as_text = df.select(*ids, *[F.col(quoted(n)).cast("string").alias(n) for n in names])
    return as_text.unpivot(list(ids), [F.col(quoted(n)) for n in names], "variable", "value")
