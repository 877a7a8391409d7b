"""JSON staging envelopes: rows of (entity, json_text), each text an array of records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENVELOPE = "entity string, json_text string"


@dataclass(frozen=True)
class Field:
    """One typed field of a record; ``strict`` fails the load when the key has no value."""

    name: str
    type: str
    key: str | None = None
    strict: bool = False

    @property
    def json_key(self) -> str:
        return self.key or self.name


SALTS = 32
KEEP_NULLS = {"ignoreNullFields": "false"}
# Records above this share of an envelope are packed with their equals only.
LARGE = 4
# Envelopes filled one after the other by one task.
RUN = 4


def pack_records(
    df: DataFrame,
    entity: Column,
    columns: Sequence[str],
    max_bytes: int = 4 << 20,
    json_options: dict[str, str] = KEEP_NULLS,
) -> DataFrame:
    """Put records into envelopes of at most ``max_bytes``; only a record that is larger alone exceeds it.

    Equal records are counted first, so any number of them is one row.  Envelopes that one record
    fills, and large records, are dealt out by themselves.  What is left of an entity is dealt into
    runs by content; in a run the records stand in the order of their texts, and running sums of
    their bytes cut it into envelopes, of which all but the last are at least half full.  So the
    envelopes are the same however the rows are partitioned, and an entity or a record that makes
    up most of the data is spread over many tasks.
    """
    records = df.select(
        entity.cast("string").alias("entity"),
        F.to_json(F.struct(*columns), json_options).alias("json"),
    )
    # Each record with the comma after it; the brackets take one byte more than the last comma.
    room = max_bytes - 1
    counted = records.groupBy("entity", "json").agg(F.count("*").alias("n"))
    counted = counted.withColumn("size", (F.octet_length("json") + 1).cast("bigint"))
    counted = counted.withColumn("fill", F.greatest(F.expr(f"{room}L div size"), F.lit(1)))
    counted = counted.withColumn("large", F.col("size") > room // LARGE)
    return _of_one_record(counted).unionByName(_of_many_records(counted, room))


def _of_one_record(counted: DataFrame) -> DataFrame:
    """Envelopes that hold one record as often as it fits, and large records' last ones."""
    whole = F.expr("n div fill + IF(large AND n % fill > 0, 1, 0)")
    each = counted.withColumn("whole", whole).filter("whole > 0").select(
        "entity", "json", "n", "fill", F.explode(F.sequence(F.lit(1).cast("bigint"), "whole")).alias("number")
    )
    times = F.least(F.col("fill"), F.expr("n - (number - 1) * fill")).cast("int")
    # Dealt out before the texts are built.
    dealt = each.repartition(F.xxhash64("entity", "json", "number"))
    return dealt.select("entity", _array(F.array_repeat("json", times)).alias("json_text"))


def _of_many_records(counted: DataFrame, room: int) -> DataFrame:
    # One condition on the count, so that it stays behind the counting, which is then done once for all.
    left = counted.withColumn("n", F.expr("IF(large, 0, n % fill)")).filter("n > 0").select("entity", "json", "n", "size")
    bytes_of = left.groupBy("entity").agg(F.sum(F.expr("n * size")).alias("bytes"))
    # Salted, so that the records of one large entity meet its size in many tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salted")
    runs = bytes_of.select(F.col("entity").alias("named"), F.ceil(F.col("bytes") / (RUN * room)).cast("bigint").alias("runs"), salts)
    salt = F.xxhash64("json").bitwiseAND(F.lit(SALTS - 1)).cast("int")  # SALTS is a power of two
    dealt = left.withColumn("salt", salt).join(runs, F.expr("salt = salted AND entity <=> named"))
    dealt = dealt.withColumn("run", F.pmod(F.xxhash64("json", F.lit(1)), F.col("runs")))
    # An envelope takes the records that begin within ``step`` bytes of its run; with the last one it
    # has at most ``room``, as no record here is larger than the difference.
    step = room - room // LARGE
    order = Window.partitionBy("entity", "run").orderBy("json").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("start", F.sum(F.expr("n * size")).over(order) - F.expr("n * size"))
    cut = placed.withColumn(
        "envelope", F.explode(F.expr(f"sequence(start div {step}L, (start + (n - 1) * size) div {step}L)"))
    )
    # Of equal records, those that begin before an envelope's end and not before its start.
    before, until = (f"greatest(({e}) * {step}L - start + size - 1, 0L) div size" for e in ("envelope", "envelope + 1"))
    times = F.expr(f"CAST(least(n, {until}) - {before} AS int)")
    packed = cut.groupBy("entity", "run", "envelope").agg(F.sort_array(F.collect_list(F.struct("json", times.alias("times")))).alias("all"))
    repeated = F.flatten(F.transform("all", lambda r: F.array_repeat(r["json"], r["times"])))
    return packed.select("entity", _array(repeated).alias("json_text"))


def _array(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def append_envelopes(envelopes: DataFrame, path: str) -> None:
    envelopes.select("entity", "json_text").write.mode("append").partitionBy("entity").parquet(path)


def replace_entities(envelopes: DataFrame, path: str, entities: Sequence[str]) -> None:
    """Clear the named entities in staging and load their new envelopes; others stay.

    Each entity also gets one envelope with no records, so that an entity whose new extract is
    empty is cleared as well.
    """
    spark = envelopes.sparkSession
    blank = spark.range(1).select(
        F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity"), F.lit("[]").alias("json_text")
    )
    wanted = envelopes.select("entity", "json_text").filter(F.col("entity").isin(list(entities)))
    (
        wanted.unionByName(blank)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("entity")
        .parquet(path)
    )


def stage_records(df: DataFrame, entity: str, path: str) -> None:
    """Replace one entity's staged records by those of a new extract."""
    replace_entities(pack_records(df, F.lit(entity), df.columns), path, [entity])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """All envelopes; a filter on ``entity`` reads that entity's folder only."""
    return spark.read.schema(ENVELOPE).parquet(path)


def table_schema(fields: Sequence[Field], *more: str) -> str:
    """The schema of a table that holds the fields and further columns."""
    return ", ".join([*[f"`{f.name}` {f.type}" for f in fields], *more])


def raw_schema(fields: Sequence[Field]) -> str:
    """How the fields are read before they are cast."""
    return ", ".join(
        f"`{f.json_key}`: {f.type if f.type.startswith('decimal') else 'string'}" for f in fields
    )


def records(envelopes: DataFrame, entity: str | None, fields: Sequence[Field]) -> DataFrame:
    """The typed records of one entity; with None, of all entities and with ``entity`` in front.

    Text that is no JSON and values of the wrong type fail the load instead of turning into
    NULL.  A missing key is NULL, or an error if it is strict.  Most values are read as text and
    then cast; decimals are read as such, since as text they would pass through binary floating
    point.
    """
    schema = f"array<struct<{raw_schema(fields)}>>"
    wanted = envelopes if entity is None else envelopes.filter(F.col("entity") == entity)
    kept = ["entity"] if entity is None else []
    parsed = F.from_json("json_text", schema, {"mode": "FAILFAST"})
    exploded = wanted.select(*kept, F.explode(parsed).alias("r"))
    return exploded.select(*kept, "r.*").selectExpr(*kept, *[_typed(f) for f in fields])


def _typed(field: Field) -> str:
    value = f"CAST(`{field.json_key}` AS {field.type})"
    if field.strict:
        value = f"coalesce({value}, CAST(raise_error('strict key missing: {field.json_key}') AS {field.type}))"
    return f"{value} AS `{field.name}`"
