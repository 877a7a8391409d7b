"""Landed API extracts: JSON pages and XML entries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

STRICT = {"mode": "FAILFAST"}


def read_records(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    columns: Mapping[str, Column | str],
    multi_line: bool = False,
) -> DataFrame:
    """Records of landed JSON responses, flattened by path.

    A response that is an array yields one row per element.  ``columns`` maps each output name
    to a path such as ``owner.login``; a path through a missing or null object is NULL.  Text
    that does not parse fails the read, here and below.  Responses are expected one per line,
    which lets large files be split; ``multi_line`` reads files that hold one response each.
    """
    raw = spark.read.schema(schema).options(**STRICT).json(path, multiLine=multi_line)
    return flatten(raw, columns)


def flatten(raw: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    picked = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()}
    return raw.select(*[c.alias(n) for n, c in picked.items()])


def read_pages(
    spark: SparkSession, path: str, array: str, record_schema: str, multi_line: bool = False
) -> DataFrame:
    """Records out of the named array of every landed page; an empty array adds nothing.

    A page without its array, or with null for it, is no extract (an error answer, say) and fails
    the read, so that nothing downstream takes it for an empty extract.
    """
    reader = spark.read.schema(f"`{array}` array<struct<{record_schema}>>").options(**STRICT)
    pages = reader.json(path, multiLine=multi_line)
    kind = pages.schema[array].dataType
    missing = F.raise_error(F.lit(f"landed page without its array {array}")).cast(kind)
    return pages.select(F.explode(F.coalesce(F.col(array), missing)).alias("r")).select("r.*")


MANIFEST = "extract string, page long, top long, records long, file string"


class IncompletePages(RuntimeError):
    """Landed pages that do not make up whole extracts."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the fetcher noted for each page as JSON lines: the extract it belongs to, its number, how
    many records were asked for and came, and the file it landed in."""
    return spark.read.schema(MANIFEST).options(**STRICT).json(path)


def page_faults(manifest: DataFrame, first: int = 1) -> DataFrame:
    """(extract, fault) of extracts whose pages are not all noted.

    Pages are fetched until one comes back with fewer records than asked for.  So the numbers run from
    ``first`` without gap or repeat, there is such a last page, and no records come after it.
    """
    short = F.col("records") < F.col("top")
    found = manifest.groupBy("extract").agg(
        F.min("page").alias("least"), F.max("page").alias("most"), F.count("*").alias("pages"), F.countDistinct("page").alias("numbers"),
        F.min(F.when(short, F.col("page"))).alias("last"), F.max(F.when(F.col("records") > 0, F.col("page"))).alias("filled"),
        F.count_if(F.expr("page IS NULL OR top IS NULL OR records IS NULL OR file IS NULL")).alias("unknown"),
    )
    fault = (
        F.when(F.col("unknown") > 0, "a page is not described")
        .when(F.col("pages") > F.col("numbers"), "a page is noted twice")
        .when((F.col("least") != first) | (F.col("most") - F.col("least") + 1 != F.col("numbers")), "a page is missing")
        .when(F.col("last").isNull(), "the last page is missing")
        .when(F.col("filled") > F.col("last"), "records come after a page that is not full")
    )
    return found.select("extract", fault.alias("fault")).filter("fault IS NOT NULL")


def require_pages(spark: SparkSession, path: str, array: str, manifest: DataFrame, first: int = 1, multi_line: bool = False) -> None:
    """Fail unless the landed files are the manifest's pages, whole, and these whole extracts.

    To be called before rows that no page holds count as deleted.  The pages are read once more for
    it, and their records counted without being parsed.
    """
    faults = [f"{r.extract}: {r.fault}" for r in page_faults(manifest, first).limit(10).collect()]
    if not faults:
        # Records as raw text, so that only their number is found out.
        pages = spark.read.schema(f"`{array}` array<string>").options(**STRICT).json(path, multiLine=multi_line)
        landed = pages.select(F.col("_metadata.file_name").alias("file"), F.size(array).alias("n"))
        landed = landed.groupBy("file").agg(F.sum("n").alias("landed"))
        noted = manifest.groupBy("file").agg(F.sum("records").alias("noted"))
        wrong = noted.join(landed, "file", "full").filter("NOT (landed <=> noted)").limit(10)
        faults = [f"{r.file}: {r.landed} records landed, {r.noted} noted" for r in wrong.collect()]
        if not faults and manifest.isEmpty():
            faults = ["no page is noted"]
    if faults:
        raise IncompletePages("; ".join(faults))


def read_xml(
    spark: SparkSession, path: str, row_tag: str, schema: StructType | str, drop: Sequence[str] = ()
) -> DataFrame:
    """One row per ``row_tag`` element, typed by the schema given.

    A file is read by one task, so large extracts should land in several, as ``write_xml`` writes them.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag).options(**STRICT)
    return reader.schema(schema).load(path).drop(*drop)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str, entries_per_file: int = 50_000) -> None:
    """Rows as ``row_tag`` elements, in files of a bounded number of them: no XML file can be split by a reader."""
    writer = df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
    writer.option("maxRecordsPerFile", entries_per_file).save(path)


def escaped_xml(
    responses: DataFrame,
    column: str,
    root_tag: str,
    row_tag: str,
    record_schema: str,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Entries of an XML list that came escaped inside a larger response text.

    Responses are dealt out, as many may lie in one file.  A response is taken apart into one text per
    entry, cheaply, and the entries are dealt out before they are parsed, so one large response is
    parsed by many tasks.  An empty list adds nothing.  A response without both tags of the list (a
    fault, or one cut short), and one with anything but entries in its list, fails the read.
    """
    text = F.replace(F.replace(F.col(column), F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    opening, closing = f"<{root_tag}>", f"</{root_tag}>"
    texts = responses.repartition(F.xxhash64(column)).select(text.alias("text"))
    # Columns of their own, so that each is computed once a response.
    found = texts.select("text", F.locate(opening, F.col("text")).alias("start"), F.locate(closing, F.col("text")).alias("end"))
    text, start, end = F.col("text"), F.col("start"), F.col("end")
    inner = F.when((start > 0) & (end > start), text.substr(start + len(opening), end - start - len(opening))).otherwise(
        F.raise_error(F.lit(f"response without the list {root_tag}")).cast("string")
    )
    tag = re.escape(row_tag)
    pieces = F.split(inner, f"(?<=</{tag}>)|(?<=<{tag}/>)")
    dealt = (
        found.select(F.posexplode(pieces).alias("place", "entry"))
        .select("place", F.trim(F.regexp_replace("entry", "^\\s+|\\s+$", "")).alias("entry"))
        .filter("entry <> ''")
        .repartition(F.xxhash64("place", "entry"))
    )
    # An opening tag at the start, the closing one at the end, and no other in between.
    one = F.col("entry").rlike(f"(?s)^<{tag}(\\s[^>]*)?/>$|^<{tag}(\\s[^>]*)?>((?!<{tag}[\\s/>]).)*</{tag}>$")
    entry = F.when(one, F.col("entry")).otherwise(
        F.raise_error(F.lit(f"list {root_tag} with something else than entries {row_tag}")).cast("string")
    )
    parsed = F.from_xml(entry, f"struct<{record_schema}>", STRICT)
    return dealt.select(parsed.alias("r")).select("r.*").drop(*drop)
