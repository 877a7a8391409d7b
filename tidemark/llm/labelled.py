"""Labelled rows for training, and the rows that are held out.

Defined cases: null texts and texts above the bound are not trained on, nor are labels other than 0
and 1 or rows without an id; equal hashes are ordered by id and text; repeated rows count as often
as they occur; empty tables give an empty sample; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, column: str, per_label: int, most_chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_label`` rows of either label, chosen by a hash of the id.

    Only labels 0 and 1 of rows that are not held out; texts above ``most_chars`` are left out of
    training, so what reaches the driver is bounded by the two parameters.  A document with both
    labels counts with each.
    """
    known = labels.filter(F.col(column).isin(0, 1)).select("doc_id", F.col(column).cast("int").alias("label"))
    known = known.filter(~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id")
    texts = docs.filter(F.length("text") <= most_chars).select("doc_id", F.col("text").cast("string").alias("text"))
    rows = []
    for label in (0, 1):
        # Twice as many ids as wanted, as some have no text or a long one.
        ids = known.filter(F.col("label") == label).orderBy(order, "doc_id").limit(2 * per_label)
        chosen = texts.join(ids, "doc_id").orderBy(order, "doc_id", "text").limit(per_label)
        rows += [(r.text, r.label) for r in chosen.collect()]
    return rows
