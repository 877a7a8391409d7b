"""Text expressions.  All of them stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the source jobs see it: every Unicode space, the ASCII separators, and a
# backslash-n written out as two characters.  A single plain space already is what a run becomes;
# leaving it out of the pattern saves most of the replacements.
SPACE = r"\s\x1c-\x1f"
SPACE_RUN = rf"(?U) [{SPACE}]+|[{SPACE}&&[^ ]][{SPACE}]*|\\n"


def prefix_or_fallback(code: Column, fallback: str) -> Column:
    """Text before the first dot; without a leading part, or without a dot, the fallback."""
    return F.when(F.instr(code, ".") > 1, F.substring_index(code, ".", 1)).otherwise(F.lit(fallback))


def prefix(code: Column) -> Column:
    """Text before the first dot; the whole code when there is none."""
    return F.split_part(code, F.lit("."), F.lit(1))


def join_nulls_empty(*parts: Column) -> Column:
    """Concatenate, reading NULL as empty text."""
    return F.concat_ws("", *parts)


def join_nulls_win(*parts: Column) -> Column:
    """Concatenate; one NULL part makes the result NULL."""
    return F.concat(*parts)


def cut(column: Column, length: int) -> Column:
    return F.substring(column, 1, length)


def none_text_to_int(column: Column) -> Column:
    """Codes where a lost value was stored as the text ``None``: that reads as 0."""
    return F.replace(column, F.lit("None"), F.lit("0")).cast("int")


def collapse_space(column: Column) -> Column:
    return F.regexp_replace(column, SPACE_RUN, " ")


def escape_quotes(column: Column) -> Column:
    return F.replace(column, F.lit('"'), F.lit('\\"'))


def number_text(column: Column) -> Column:
    """A number as it stands in JSON text: decimal point, ``null`` when absent."""
    return F.replace(F.coalesce(column.cast("string"), F.lit("null")), F.lit(","), F.lit("."))


def plain_number(column: Column) -> Column:
    """A binary floating point number with all its digits and no exponent; NaN reads as absent.

    The shortest text that reads back as the same number is taken apart and its point is moved.
    """
    text = column.cast("double").cast("string")
    form = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, head, tail = (F.regexp_extract(text, form, g) for g in (1, 2, 3))
    power = F.regexp_extract(text, form, 4).cast("int")
    tail = F.when(tail == "0", F.lit("")).otherwise(tail)
    digits = F.concat(head, tail)
    missing = power - F.length(tail)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.concat(sign, digits, F.repeat(F.lit("0"), missing), F.lit(".0"))
    inner = F.concat(sign, F.substring(digits, F.lit(1), power + 1), F.lit("."), digits.substr(power + 2, F.length(digits)))
    moved = F.when(power < 0, small).when(missing >= 0, whole).otherwise(inner)
    return F.when(F.isnan(column.cast("double")), F.lit(None)).when(text.contains("E"), moved).otherwise(text)


def key_uuid(key: Column) -> Column:
    """A UUID-shaped id that depends on the key alone, so retries reproduce it."""
    digest = F.md5(key.cast("binary"))
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in parts])
