"""Mixing sources to target weights by entropy balancing.

Sources in order of code points, null last, get the weights 5, 2, 1, 5, 2, 1, ...  A target is a
source's share of all words by weight; no target exceeds three times its source's words, and what
is cut off is shared among the others by weight.

Among all rates between 0 and 3 copies that give a source its target, those closest to one copy
each, by relative entropy, are ``min(3, exp(lambda * size))``.  The multipliers solve the convex
dual, one constraint a source.  Newton steps on the logarithm of the words, kept inside a bracket,
find all of them at once: each step is one aggregation over (source, size, documents) counts.
Sums are exact decimals, so reruns and any partitioning give the same rates.

Rates become whole copies by carrying the rounding error from document to document, the largest
first, so the smallest absorb what is left.  Large sources are dealt to groups by id, each carrying
its own error.

Defined cases: null and empty texts have size 0 and are taken once, which adds no word.  Texts of any
length are counted whole; among equal sizes the smaller id is rounded first.  A null source is a
source, a null id an id.  Rows equal in id, source and text are one entry, whose copies are dealt out
so evenly that they differ by one at most.  No rows give no rows.  Other columns are not looked at,
and come along where documents are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
FINE = 1_000_000


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (5, 2, 1)
    most_copies: int = 3
    tolerance: float = 1e-7
    most_steps: int = 100
    group_rows: int = 5_000


def sized(docs: DataFrame) -> DataFrame:
    """The documents with their number of words as ``size``, columns in the struct ``doc``."""
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), words.alias("size"))


def targets(entries: DataFrame, settings: Settings) -> DataFrame:
    """(grp, source, source_size, docs, target): sources numbered in order of code points."""
    sums = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    # Numbered by sorted ranges.
    placed = stored(
        sums.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("place", F.monotonically_increasing_id()),
        "sources",
    )
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range.
    before = counts.select("part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    placed = placed.withColumn("part", part).join(F.broadcast(before), "part")
    grp = (F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before")).cast("long")
    weight = F.element_at(F.array(*[F.lit(w) for w in settings.weights]), (grp % len(settings.weights) + 1).cast("int"))
    known = placed.select(grp.alias("grp"), "source", "source_size", "docs", weight.alias("weight")).withColumn(
        "most", F.col("source_size") * settings.most_copies
    )
    # Targets at their bound are set aside until the level of the others no longer rises.
    level = 0.0
    while True:
        row = known.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(F.col("weight") * level > F.col("most"), F.col("most"))).alias("bound"),
            F.sum(F.when(F.col("weight") * level <= F.col("most"), F.col("weight"))).alias("free"),
        ).first()
        new = ((row.words or 0) - (row.bound or 0)) / row.free if row.free else level
        if new <= level:
            break
        level = new
    return known.select(
        "grp", "source", "source_size", "docs", F.least(F.col("weight") * F.lit(level), F.col("most").cast("double")).alias("target")
    )


def _rate(settings: Settings):
    """Copies of a document under its source's multiplier."""
    return F.least(F.lit(float(settings.most_copies)), F.exp(F.col("lam") * F.col("size") / F.col("mean")))


def multipliers(entries: DataFrame, goals: DataFrame, settings: Settings) -> DataFrame:
    """``goals`` with ``lam`` and ``mean``: a document's rate is min(3, exp(lam * size / mean))."""
    counts = stored(
        entries.filter("size > 0").join(goals.select("grp", F.col("source").alias("s")), F.expr("source <=> s"))
        .groupBy("grp", "size").agg(F.sum("n").alias("n")),
        "sizes",
    )
    least = counts.groupBy("grp").agg(F.min("size").alias("least"))
    top = F.lit(float(np.log(settings.most_copies)))
    state = stored(
        goals.join(least, "grp").select(
            "grp", "target", "source_size", (F.col("source_size") / F.col("docs")).alias("mean"), "least"
        ).select(
            "grp", "target", "mean", F.lit(None).cast("double").alias("low"),
            (top * F.col("mean") / F.col("least")).alias("high"),
            F.when(F.col("target") >= F.col("source_size") * settings.most_copies, top * F.col("mean") / F.col("least"))
            .otherwise(F.log(F.col("target") / F.col("source_size"))).alias("lam"),
            F.lit(1.0).alias("off"),
        ),
        "multipliers",
    )
    for _ in range(settings.most_steps):
        one = F.col("n") * F.col("size") * _rate(settings)
        free = F.col("lam") * F.col("size") / F.col("mean") < top
        exact = lambda x: F.sum((x * FINE).cast("decimal(38,0)")).cast("double") / FINE
        sums = (
            counts.join(state.select("grp", "lam", "mean"), "grp").groupBy("grp")
            .agg(exact(one).alias("words"), exact(F.when(free, one * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        )
        off = F.abs(F.col("words") - F.col("target")) / F.col("target")
        step = F.col("lam") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        now = state.drop("off").join(sums, "grp").withColumn("off", off)
        now = now.withColumn("low", F.when(F.col("words") < F.col("target"), F.col("lam")).otherwise(F.col("low")))
        now = now.withColumn("high", F.when(F.col("words") > F.col("target"), F.col("lam")).otherwise(F.col("high")))
        # Without a lower end yet, a step that fails falls twice as far.
        inside = (F.col("slope") > 0) & (F.col("words") > 0) & (step < F.col("high")) & (F.col("low").isNull() | (step > F.col("low")))
        halved = F.coalesce((F.col("low") + F.col("high")) / 2, F.col("high") - 2 * F.abs(F.col("high")) - 1)
        done = F.col("off") <= settings.tolerance
        moved = F.when(done, F.col("lam")).when(inside, step).otherwise(halved)
        state = stored(now.select("grp", "target", "mean", "low", "high", moved.alias("lam"), "off"), "multipliers")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= settings.tolerance:
            break
    else:
        raise RuntimeError(f"the mix does not meet its targets after {settings.most_steps} steps")
    return goals.join(state.select("grp", "mean", "lam"), "grp", "left")


def _round(rows: pa.Table, most: int) -> pa.Table:
    """Whole copies of one group, the rounding error carried from the largest to the smallest.

    An entry of n rows gets a total, of which each row has the whole part and ``extra`` rows one more.
    """
    rows = rows.sort_by([(c, o) for c, o in (("size", "descending"), ("doc_id", "ascending"), ("text_hash", "ascending"))])
    copies, extra, rest = [], [], 0.0
    for size, n, rate in zip(rows["size"].to_pylist(), rows["n"].to_pylist(), rows["rate"].to_pylist()):
        if not size:
            copies.append(1)
            extra.append(0)
            continue
        rest += rate * size * n
        c = min(max(int(rest / size + 0.5), 0), most * n)
        rest -= c * size
        copies.append(c // n)
        extra.append(c % n)
    rows = rows.append_column("copies", pa.array(copies, pa.int64())).append_column("extra", pa.array(extra, pa.int64()))
    return rows.select(["doc_id", "source", "size", "text_hash", "n", "source_size", "target", "copies", "extra"])


def _entry(docs: DataFrame) -> DataFrame:
    """``sized`` documents with their hash of the text."""
    return sized(docs).withColumn("text_hash", F.xxhash64(F.col("doc.text").cast("string")))


def _entries(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, source, size, text_hash, n, source_size, target, copies, extra), a row per entry."""
    flat = _entry(docs).select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"), "size", "text_hash")
    entries = stored(flat.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("n")), "entries")
    goals = multipliers(entries, stored(targets(entries, settings), "targets"), settings)
    group = F.pmod(F.xxhash64("doc_id", "size", "text_hash"), F.ceil(F.col("docs") / settings.group_rows).cast("long"))
    rated = entries.join(goals.withColumnRenamed("source", "s"), F.expr("source <=> s")).select(
        "grp", group.alias("part"), "doc_id", "source", "size", "text_hash", "n", "source_size", "target",
        F.coalesce(_rate(settings), F.lit(1.0)).alias("rate"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema}
    return rated.groupBy("grp", "part").applyInArrow(
        lambda rows: _round(rows, settings.most_copies),
        f"doc_id {kinds['doc_id']}, source string, size long, text_hash long, n long, source_size long, target double, "
        "copies long, extra long",
    )


def mixture(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): n equal rows, taken ``copies`` times each."""
    each = F.array(
        F.struct((F.col("n") - F.col("extra")).alias("n"), F.col("copies").alias("copies")),
        F.struct(F.col("extra").alias("n"), (F.col("copies") + 1).alias("copies")),
    )
    return _entries(docs, settings).select(
        "doc_id", "source", "size", "source_size", "target", F.explode(F.filter(each, lambda e: e["n"] > 0)).alias("e")
    ).select("doc_id", "source", "size", "e.n", "source_size", "target", "e.copies")


def mixed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, each as often as the mix takes it, columns as they were."""
    chosen = stored(
        _entries(docs, settings).filter("copies + extra > 0").selectExpr(
            "doc_id AS m_id", "source AS m_source", "size AS m_size", "text_hash AS m_hash", "copies", "extra"
        ),
        "chosen",
    )
    on = F.expr("doc.doc_id <=> m_id AND doc.source <=> m_source AND size = m_size AND text_hash = m_hash")
    found = _entry(docs).join(chosen.filter("copies > 0"), on)
    taken = found.select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")), "doc").select("doc.*")
    more = chosen.filter("extra > 0")
    if more.isEmpty():
        return taken
    # Equal rows that do not share their copies evenly: what is over goes to one of them.
    over = _entry(docs).join(more, on).groupBy("m_id", "m_source", "m_size", "m_hash").agg(
        F.first("doc").alias("doc"), F.first("extra").alias("extra")
    )
    return taken.unionByName(over.select(F.explode(F.sequence(F.lit(1).cast("long"), "extra")), "doc").select("doc.*"))
