"""The product catalogue: responses to envelopes, enrichment, and both product merges."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import CLASSIFIERS, NO_PREFIX, OTHER_PRODUCTS_LABEL, PRODUCT_TYPE_LABELS
from tidemark.functions.defaults import fill_defaults, label, or_default
from tidemark.functions.text import (
    cut,
    join_nulls_empty,
    join_nulls_win,
    none_text_to_int,
    prefix,
    prefix_or_fallback,
)
from tidemark.operators.aggregates import pivot_max
from tidemark.operators.merge import MergeSpec, filled, filled_null_equal, merge, null_equal, raw
from tidemark.sources.envelope import Field, read_envelopes, records, stage_records, table_schema
from tidemark.sources.extracts import STRICT, read_records
from tidemark.sources.tables import merge_snapshot, shared_folder

PRODUCT, CLASSIFIER = "product", "classifiers"
LIVE_SOURCE_DATE = "0001-01-01"

PRODUCT_RESPONSE = (
    "id string, objectId string, parentId string, code string, name string, "
    "rmsContour struct<unitId: string>, techTribe struct<unitId: string>, "
    "ownerDetails struct<login: string, userName: string>, "
    "techOwnerDetails struct<login: string, userName: string>, status string, "
    "description string, shortDescription string, itObjectStatus string"
)
CLASSIFIER_RESPONSE = (
    "entityId string, classifier struct<id: int>, classifierValue struct<name: string>"
)


def product_paths(sol_type: str, sol_url: str, description_width: int | None = None) -> dict:
    """Output name to path, or expression, of one landed product response.

    ``description_width`` cuts descriptions for a target whose column has that width.
    """
    description = or_default(F.col("description"), "")
    return {
        "id": "id",
        "objectId": "objectId",
        "parentId": "parentId",
        "code": "code",
        "name": "name",
        "rmsContour": "rmsContour.unitId",
        "techTribe": "techTribe.unitId",
        "owner": "ownerDetails.login",
        "ownerName": "ownerDetails.userName",
        "techOwner": "techOwnerDetails.login",
        "techOwnerName": "techOwnerDetails.userName",
        "status": "status",
        "description": cut(description, description_width) if description_width else description,
        "shortDescription": "shortDescription",
        "itObjectStatus": "itObjectStatus",
        "sol_type": F.lit(sol_type),
        "sol_url": F.lit(sol_url),
    }


def kept_classifiers(raw_classifiers: DataFrame) -> DataFrame:
    """Landed classifier responses reduced to the four classifiers in use."""
    return raw_classifiers.filter(F.col("classifier.id").isin(list(CLASSIFIERS))).select(
        F.col("entityId").alias("id"),
        F.col("classifier.id").alias("clf_id"),
        F.col("classifierValue.name").alias("classifier_value_name"),
    )


CLASSIFIER_FIELDS = (
    Field("Id", "int", "id"),
    Field("ClfId", "int", "clf_id"),
    Field("ClassifierValue", "string", "classifier_value_name"),
)
PRODUCT_FIELDS = (
    Field("Id", "int", "id", strict=True),
    Field("ObjectId", "int", "objectId", strict=True),
    Field("ParentId", "int", "parentId"),
    Field("Code", "string", "code"),
    Field("Name", "string", "name"),
    Field("TribeUnitId", "string", "rmsContour"),
    Field("OwnerLogin", "string", "owner"),
    Field("TechOwnerLogin", "string", "techOwner"),
    Field("Status", "string", "status"),
    Field("Description", "string", "description"),
    Field("ShortDescription", "string", "shortDescription"),
    Field("itObjectStatus", "string", "itObjectStatus"),
    Field("Type", "string", "sol_type"),
    Field("SolUrl", "string", "sol_url"),
)


def classifier_table(classifiers: DataFrame) -> DataFrame:
    """One row per product id, one column per classifier in use, greatest value each."""
    named = classifiers.withColumn("Classifier", label(F.col("ClfId"), CLASSIFIERS))
    kept = named.filter(F.col("Classifier").isin(list(CLASSIFIERS.values())))
    return pivot_max(kept, ["Id"], "Classifier", "ClassifierValue", list(CLASSIFIERS.values()))


def enrich_products(
    products: DataFrame,
    classifiers: DataFrame,
    units: DataFrame,
    employees: DataFrame,
    persons: DataFrame,
) -> DataFrame:
    """Product rows with parent, unit, owners, classifiers and type looked up.

    ``units`` (UnitId, TribeCode), ``employees`` (Login, PersonId, DeletedAtSource, IS_DELETED),
    ``persons`` (PersonId, PersonCode).
    """
    parents = products.select(F.col("Id").alias("ParentId"), F.col("ObjectId").alias("ParentObjectId"))
    unit = units.select(F.lower("UnitId").alias("TribeUnitId"), "TribeCode")
    live = (F.col("IS_DELETED") == 0) & (
        F.col("DeletedAtSource") == F.lit(LIVE_SOURCE_DATE).cast("timestamp_ntz")
    )
    login_code = (
        employees.filter(live)
        .select("Login", "PersonId")
        .join(persons.select("PersonId", "PersonCode"), "PersonId", "left")
        .select("Login", "PersonCode")
    )
    owner = login_code.toDF("OwnerLogin", "OwnerPersonCode")
    tech = login_code.toDF("TechOwnerLogin", "TechOwnerPersonCode")
    # The lookups are resolved for narrow rows of keys; the wide product row meets the result once.
    keys = ("Id", "ParentId", "TribeUnitId", "OwnerLogin", "TechOwnerLogin")
    resolved = (
        products.select(*keys).distinct().withColumn("UnitKey", F.lower("TribeUnitId"))
        .join(parents, "ParentId", "left")
        .join(unit.withColumnRenamed("TribeUnitId", "UnitKey"), "UnitKey", "left")
        .join(owner, "OwnerLogin", "left")
        .join(tech, "TechOwnerLogin", "left")
        .join(classifiers, "Id", "left")
        .drop("UnitKey")
        .withColumnsRenamed({k: f"key_{k}" for k in keys})
    )
    joined = products.join(resolved, F.expr(" AND ".join(f"{k} <=> key_{k}" for k in keys)))
    kind = prefix_or_fallback(F.col("Code"), NO_PREFIX)
    enriched = joined.select(
        "ObjectId",
        "ParentObjectId",
        "Code",
        "Name",
        "TribeCode",
        "Type",
        "OwnerPersonCode",
        "TechOwnerPersonCode",
        *CLASSIFIERS.values(),
        kind.alias("ProductTypeSol"),
        label(kind, PRODUCT_TYPE_LABELS, OTHER_PRODUCTS_LABEL).alias("ProductTypeSolName"),
        "Status",
        "Description",
        join_nulls_empty(F.col("SolUrl"), F.lit("/modules/"), F.col("Id").cast("string")).alias("SolUrl"),
        "ShortDescription",
        "itObjectStatus",
    )
    texts = ("OwnerPersonCode", "TechOwnerPersonCode", *CLASSIFIERS.values(), "ShortDescription", "Description", "itObjectStatus")
    return fill_defaults(enriched, {"ParentObjectId": 0, "TribeCode": 0, **{c: "" for c in texts}})


PRODUCT_MERGE = MergeSpec(
    keys=("ObjectId",),
    columns={
        "ParentObjectId": filled(0),
        "Code": raw(),
        "Name": raw(),
        "TribeCode": filled(0),
        "Type": raw(),
        "OwnerPersonCode": filled(""),
        "TechOwnerPersonCode": filled(""),
        "FINDirectionGeneral": filled(""),
        "FINDirectionDetailed": filled(""),
        "FINGroup": filled(""),
        "FINDetailed": filled(""),
        "ProductTypeSol": raw(),
        "ProductTypeSolName": raw(),
        "Status": raw(),
        "Description": filled(""),
        "SolUrl": raw(),
        "ShortDescription": filled_null_equal(""),
        "itObjectStatus": filled_null_equal(""),
    },
    absent="hard",
    updated_at="UpdatedAt",
)


def product_source(
    envelopes: DataFrame, units: DataFrame, employees: DataFrame, persons: DataFrame, products: DataFrame | None = None
) -> DataFrame:
    """The first dialect's product rows.

    ``products``: the extract's typed rows, where they have been parsed already.
    """
    classifiers = classifier_table(records(envelopes, CLASSIFIER, CLASSIFIER_FIELDS))
    if products is None:
        products = records(envelopes, PRODUCT, PRODUCT_FIELDS)
    return enrich_products(products, classifiers, units, employees, persons)


def merge_products(
    target: DataFrame,
    envelopes: DataFrame,
    units: DataFrame,
    employees: DataFrame,
    persons: DataFrame,
    run_ts: datetime,
    products: DataFrame | None = None,
) -> DataFrame:
    """First dialect: rows missing from the extract are deleted for good."""
    return merge(target, product_source(envelopes, units, employees, persons, products), PRODUCT_MERGE, run_ts)


PRODUCT_ROW_FIELDS = (
    Field("id", "int"),
    Field("object_id", "int", "objectId"),
    Field("code", "string"),
    Field("name", "string"),
    Field("customer_unit_id", "string", "rmsContour"),
    Field("executor_unit_id", "string", "techTribe"),
    Field("owner_login", "string", "owner"),
    Field("owner", "string", "ownerName"),
    Field("tech_owner_login", "string", "techOwner"),
    Field("tech_owner", "string", "techOwnerName"),
    Field("status", "string"),
    Field("description", "string"),
    Field("short_description", "string", "shortDescription"),
    Field("it_object_status", "string", "itObjectStatus"),
    Field("type", "string", "sol_type"),
    Field("sol_url", "string"),
)


def product_rows(products: DataFrame, units: DataFrame) -> DataFrame:
    """Second dialect's product rows.  ``units`` (id, tribe_id) with both columns as text."""
    kind = prefix(F.col("code"))
    tribes = units.select(F.col("id").cast("string").alias("customer_unit_id"), "tribe_id")
    return products.join(tribes, "customer_unit_id", "left").withColumns(
        {
            "sol_url": join_nulls_win(F.col("sol_url"), F.lit("/modules/"), F.col("id").cast("string")),
            "product_type_sol": kind,
            "product_type_sol_name": label(F.upper(kind), PRODUCT_TYPE_LABELS, OTHER_PRODUCTS_LABEL),
            "tribe_id": none_text_to_int(F.col("tribe_id")),
        }
    )


PRODUCT_UPSERT = MergeSpec(
    keys=("object_id",),
    columns={
        "code": null_equal(""),
        "name": null_equal(""),
        "tribe_id": null_equal(0),
        "customer_unit_id": null_equal(""),
        "executor_unit_id": null_equal(""),
        "type": null_equal(""),
        "owner": null_equal(""),
        "tech_owner": null_equal(""),
        "tech_owner_login": null_equal(""),
        "owner_login": null_equal(""),
        "product_type_sol": null_equal(""),
        "product_type_sol_name": null_equal(""),
        "status": null_equal(""),
        "description": null_equal(""),
        "short_description": null_equal(""),
        "sol_url": null_equal(""),
        "it_object_status": null_equal(""),
    },
    insert_only=("id",),
    absent="soft",
    deleted_at="deleted_at",
    updated_at="updated_at",
)


def upsert_products(
    target: DataFrame, envelopes: DataFrame, units: DataFrame, run_ts: datetime, products: DataFrame | None = None
) -> DataFrame:
    """Second dialect: NULL, empty and zero are equal, absent rows are soft-deleted.

    ``products``: the extract's typed rows, where they have been parsed already.
    """
    if products is None:
        products = records(envelopes, PRODUCT, PRODUCT_ROW_FIELDS)
    return merge(target, product_rows(products, units), PRODUCT_UPSERT, run_ts)


def parsed_products(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The product extract under the names of either dialect, parsed once and kept as typed rows.

    A key that is strict for one dialect is so for both: the run fails before either target changes.
    """
    fields: dict[str, Field] = {}
    for f in (*PRODUCT_ROW_FIELDS, *PRODUCT_FIELDS):
        strict = f.strict or (f.json_key in fields and fields[f.json_key].strict)
        fields[f.json_key] = Field(f.json_key, f.type, strict=strict)
    path = shared_folder(envelopes.sparkSession, "products")
    records(envelopes, PRODUCT, tuple(fields.values())).write.parquet(path)
    typed = envelopes.sparkSession.read.parquet(path)

    def named(dialect: tuple[Field, ...]) -> DataFrame:
        return typed.select(*[F.col(f.json_key).alias(f.name) for f in dialect])

    return named(PRODUCT_FIELDS), named(PRODUCT_ROW_FIELDS)


PRODUCT_TABLE = ", ".join(
    [
        "ObjectId int",
        *[f"{c} {'int' if c in ('ParentObjectId', 'TribeCode') else 'string'}" for c in PRODUCT_MERGE.columns],
        "UpdatedAt timestamp_ntz",
    ]
)
PRODUCT_ROW_TABLE = table_schema(
    PRODUCT_ROW_FIELDS,
    "tribe_id int",
    "product_type_sol string",
    "product_type_sol_name string",
    "deleted_at timestamp_ntz",
    "updated_at timestamp_ntz",
)


def stage_extracts(
    spark: SparkSession,
    products: Mapping[str, str],
    classifiers: str,
    sol_url: str,
    staging: str,
    description_width: int | None = None,
) -> None:
    """Landed responses to staging; ``products`` maps each product type to its landed folder."""
    raw_classifiers = spark.read.schema(CLASSIFIER_RESPONSE).options(**STRICT).json(classifiers)
    stage_records(kept_classifiers(raw_classifiers), CLASSIFIER, staging)
    by_type = [
        read_records(spark, path, PRODUCT_RESPONSE, product_paths(kind, sol_url, description_width)) for kind, path in products.items()
    ]
    stage_records(reduce(DataFrame.unionByName, by_type), PRODUCT, staging)


def load_products(
    spark: SparkSession,
    staging: str,
    lookups: Mapping[str, DataFrame],
    root: str,
    row_root: str,
    run_ts: datetime,
) -> None:
    """What the staged extracts change into both targets.

    ``lookups``: units, employees and persons as in ``enrich_products``, and tribe_units as the
    units of ``product_rows``.
    """
    envelopes = read_envelopes(spark, staging)
    products, product_records = parsed_products(envelopes)
    merge_snapshot(spark, row_root, product_rows(product_records, lookups["tribe_units"]), PRODUCT_UPSERT, run_ts)
    source = product_source(envelopes, lookups["units"], lookups["employees"], lookups["persons"], products)
    merge_snapshot(spark, root, source, PRODUCT_MERGE, run_ts)
