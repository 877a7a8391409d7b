"""Chat formatting: a dialogue rendered from the perspective of each participant.

For every participant, that speaker's turns are the assistant's, those of others are a named user's,
and turns of context roles (system) stay what they are.  The mask lists the spans to train on: the
assistant's words and the closing marker after them, as half-open character ranges of the rendered
dialogue.

A dialogue of up to ``part_messages`` messages is one row per participant.  A longer one comes in parts
of so many messages: ``start`` is where a part begins in the dialogue, and the texts of the parts,
joined in order, are the whole rendering; spans count from the dialogue's start.  ``context_turns``
tells which parts hold the context.

A turn's text is shuffled once, to its dialogue, and the speakers are found there.  Longer dialogues,
found by counting, are set apart: their messages are put in order over many tasks, numbered by sorted
ranges, and gathered part by part, so neither a long dialogue, nor many messages with one turn number
or without one, nor a null dialogue id make a row or a task large.

Defined cases: a null text is empty.  A null role is a user without a name and no participant.
Messages are in order of turn, null turns first, then of role and text; repeated rows stay.  Rows with
a null dialogue id form one dialogue.  Texts of any length are rendered whole.  The opening of a marker
inside a text or a role is broken by a blank, and a line end in a role becomes one, so neither can
forge a turn.  A dialogue without participants gives no rows, nor does an empty table.  Other columns
are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

# Spans are gathered for so many messages at a time, as an array that grows is copied at each step.
CHUNK = 256
# Ids of longer dialogues that are sent to every task; more are joined by shuffle.
MOST_SENT = 100_000


@dataclass(frozen=True)
class Settings:
    context_roles: tuple[str, ...] = ("system",)
    part_messages: int = 512
    opening: str = "<|start|>"
    closing: str = "<|end|>"


def _broken(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(message: Column, perspective: Column, settings: Settings) -> Column:
    role = message["role"]
    name = F.replace(_broken(role), F.lit("\n"), F.lit(" "))
    return (
        F.when(role.isin(*settings.context_roles), role).when(role == perspective, F.lit("assistant"))
        .when(role.isNull(), F.lit("user")).otherwise(F.concat(F.lit("user name="), name))
    )


def _is_speaker(role: Column, settings: Settings) -> Column:
    return role.isNotNull() & ~role.isin(*settings.context_roles)


def _rendered(parts: DataFrame, settings: Settings) -> DataFrame:
    """Rows (conv_id, part, perspective, messages) with text, mask from the part's start, and counts."""

    def piece(m: Column) -> Column:
        head = _head(m, F.col("perspective"), settings)
        text = F.concat(F.lit(settings.opening), head, F.lit("\n"), m["body"], F.lit(settings.closing + "\n"))
        return F.struct(
            text.alias("text"), F.length(text).cast("long").alias("size"), F.length(m["body"]).cast("long").alias("body"),
            (m["role"] == F.col("perspective")).alias("own"), m["role"].isin(*settings.context_roles).alias("context"),
        )

    pieces = parts.select("conv_id", "part", "perspective", F.transform("messages", piece).alias("pieces"))
    no_spans = F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)")
    start = F.struct(F.lit(0).cast("long").alias("at"), no_spans.alias("mask"))

    def step(done: Column, p: Column) -> Column:
        end = done["at"] + p["size"]
        span = F.struct((end - p["body"] - len(settings.closing) - 1).alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(p["own"], F.array_append(done["mask"], span)).otherwise(done["mask"]).alias("mask"))

    def ahead(done: Column, c: Column) -> Column:
        return F.struct((done["at"] + c["at"]).alias("at"), F.array_append(done["before"], done["at"]).alias("before"))

    numbers = F.sequence(F.lit(0), F.floor((F.size("pieces") - 1) / CHUNK).cast("int"))
    chunks = F.transform(numbers, lambda c: F.aggregate(F.slice("pieces", c * CHUNK + 1, F.lit(CHUNK)), start, step))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<bigint>)").alias("before"))
    return pieces.select("*", chunks.alias("chunks")).select(
        "conv_id", "part", "perspective", F.size("pieces").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["context"])).cast("long").alias("context_turns"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"),
        F.flatten(F.zip_with("chunks", F.aggregate("chunks", none, ahead)["before"], lambda c, by: _moved(c["mask"], by))).alias("mask"),
    )


def _moved(mask: Column, by: Column) -> Column:
    return F.transform(mask, lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end")))


def perspectives(turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(conv_id, part, perspective, n_turns, context_turns, start, text, mask): mask is an array of
    (start, end)."""
    rows = turns.select("conv_id", "turn", "role", _broken(F.coalesce("text", F.lit(""))).alias("body"))
    long = turns.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).filter(F.col("n") > settings.part_messages)
    known = long.limit(MOST_SENT + 1).count()
    if not known:
        return _short(rows, settings)
    ids = long.select("long_id")
    if known <= MOST_SENT:
        ids = F.broadcast(ids)
    on = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return _short(rows.join(ids, on, "left_anti"), settings).unionByName(_long(rows.join(ids, on, "left_semi"), settings))


_COLUMNS = ["conv_id", "part", "perspective", "n_turns", "context_turns", "start", "text", "mask"]


def _short(rows: DataFrame, settings: Settings) -> DataFrame:
    """Dialogues of one part: gathered whole, their speakers with them."""
    zero = F.lit(0).cast("long")
    message = F.struct("turn", "role", "body")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    speakers = F.array_distinct(F.filter(F.transform("messages", lambda m: m["role"]), lambda r: _is_speaker(r, settings)))
    each = whole.select("conv_id", zero.alias("part"), F.explode(speakers).alias("perspective"), "messages")
    return _rendered(each, settings).withColumn("start", zero).select(*_COLUMNS)


def _long(rows: DataFrame, settings: Settings) -> DataFrame:
    """Dialogues of several parts: numbered by sorted ranges, gathered part by part."""
    order = ["conv_id", "turn", "role", "body"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "messages")
    # The place of a row counts from its range's start.
    ranges = placed.groupBy("conv_id", F.shiftright("place", 33).alias("range")).agg(
        F.min("place").alias("first"), F.count("*").alias("n")
    )
    along = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("conv_id").alias("id"), "range", "first", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    number = F.col("place") - F.col("first") + F.col("before")
    numbered = placed.join(ranges, F.expr("conv_id <=> id AND shiftright(place, 33) = range")).select(
        "conv_id", "role", "body", number.alias("number")
    )
    part = F.floor(F.col("number") / settings.part_messages).alias("part")
    ordered = F.sort_array(F.collect_list(F.struct("number", "role", "body"))).alias("messages")
    parts = numbered.groupBy("conv_id", part).agg(ordered)
    speakers = placed.filter(_is_speaker(F.col("role"), settings)).select(
        F.col("conv_id").alias("speaker_id"), F.col("role").alias("perspective")
    ).distinct()
    each = parts.join(speakers, F.expr("conv_id <=> speaker_id")).drop("speaker_id")
    done = stored(_rendered(each, settings), "parts")
    along = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = done.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("perspective").alias("who"),
        F.coalesce(F.sum(F.length("text")).over(along), F.lit(0)).cast("long").alias("start"),
    )
    begun = done.join(starts, F.expr("conv_id <=> c AND part = p AND perspective = who"))
    return begun.withColumn("mask", _moved(F.col("mask"), F.col("start"))).select(*_COLUMNS)


SQL = f"""
WITH turns AS (
    SELECT conv_id, role, replace(coalesce(text, ''), '<|', '< |') AS body,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST,
                              replace(coalesce(text, ''), '<|', '< |')) - 1 AS number
    FROM conversations
), speakers AS (
    SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), headed AS (
    SELECT t.*, s.perspective, number // {Settings.part_messages} AS part,
           CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' WHEN role IS NULL THEN 'user'
                ELSE 'user name=' || replace(replace(role, '<|', '< |'), chr(10), ' ') END AS head
    FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), pieces AS (
    SELECT *, '<|start|>' || head || chr(10) || body || '<|end|>' || chr(10) AS piece FROM headed
), placed AS (
    SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, perspective ORDER BY number ROWS UNBOUNDED PRECEDING) AS ending
    FROM pieces
)
SELECT conv_id, part, perspective, count(*) AS n_turns, count(*) FILTER (role = 'system') AS context_turns,
       CAST(min(ending - length(piece)) AS BIGINT) AS start, string_agg(piece, '' ORDER BY number) AS text,
       coalesce(string_agg(CASE WHEN role = perspective
           THEN CAST(ending - length(body) - 8 AS BIGINT) || '-' || CAST(ending - 1 AS BIGINT) END, ',' ORDER BY number), '') AS mask
FROM placed GROUP BY conv_id, part, perspective
"""
