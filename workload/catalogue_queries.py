"""Product catalogue and dimension queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_with_actions
from tidemark.plans import catalogue, dimensions
from tidemark.plans.issues import issues_to_send
from tidemark.sources.envelope import pack_records
from tidemark.sources.tables import read_relation, shared_folder
from workload.merge_queries import both
from workload.merge_sql import any_differs, merge_sql
from workload.registry import RUN_TS, project, query, select_sql, table

# --- classifiers -----------------------------------------------------------------------------------

_CLASSIFIER_OF_SEGMENT = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 8 WHEN 'BUILDING' THEN 9 WHEN 'FURNITURE' THEN 27 "
    "WHEN 'HOUSEHOLD' THEN 28 ELSE 5 END"
)
_CLASSIFIER_ROWS = {
    "Id": "c_nationkey",
    "ClfId": _CLASSIFIER_OF_SEGMENT,
    "ClassifierValue": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END",
}
# Columns, labels and ids below are what the checks expect, spelled out apart from the library's own.
_CLASSIFIER_COLUMNS = ["FINDirectionGeneral", "FINDirectionDetailed", "FINGroup", "FINDetailed"]
_CLASSIFIER_SQL = "SELECT Id, " + ", ".join(
    f'MAX(CASE WHEN ClfId = {key} THEN ClassifierValue END) AS "{name}"'
    for key, name in zip((8, 9, 27, 28), _CLASSIFIER_COLUMNS)
) + f" FROM ({select_sql(_CLASSIFIER_ROWS, 'customer')}) WHERE ClfId IN (8, 9, 27, 28) GROUP BY Id"


@query(_CLASSIFIER_SQL)
def classifier_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.classifier_table(project(table(spark, sf, "customer"), _CLASSIFIER_ROWS))


# --- product enrichment ------------------------------------------------------------------------------

_CODE = (
    "CASE p_brand WHEN 'Brand#1' THEN CONCAT('TEC.', p_type) WHEN 'Brand#2' THEN CONCAT('INT.', p_type) "
    "WHEN 'Brand#3' THEN 'PLF.1' WHEN 'Brand#4' THEN 'PRO.2.3' WHEN 'Brand#5' THEN 'SRV.' "
    "WHEN 'Brand#6' THEN 'tec.1' WHEN 'Brand#7' THEN '.x' WHEN 'Brand#8' THEN NULL ELSE p_name END"
)
_PRODUCT_ROWS = {
    "Id": "CAST(p_partkey AS INT)",
    "ObjectId": "CAST(p_partkey + 5000000 AS INT)",
    "ParentId": "CASE WHEN p_size = 1 THEN NULL ELSE CAST(p_size * 3 AS INT) END",
    "Code": _CODE,
    "Name": "p_name",
    "TribeUnitId": "CONCAT('U-', CAST(p_size AS STRING))",
    "OwnerLogin": "CONCAT('l', CAST(p_partkey AS STRING))",
    "TechOwnerLogin": "CASE WHEN p_size < 5 THEN NULL ELSE CONCAT('l', CAST(p_size AS STRING)) END",
    "Status": "p_type",
    "Description": "CASE WHEN p_size = 6 THEN NULL ELSE p_name END",
    "ShortDescription": "p_type",
    "itObjectStatus": "CASE WHEN p_size = 7 THEN NULL ELSE p_type END",
    "Type": "p_type",
    "SolUrl": "CASE WHEN p_size = 8 THEN NULL ELSE 'https://catalogue' END",
}
_UNITS = {"UnitId": "CONCAT('u-', CAST(n_nationkey AS STRING))", "TribeCode": "n_regionkey"}
_EMPLOYEES = {
    "Login": "CONCAT('l', CAST(c_custkey AS STRING))",
    "PersonId": "c_custkey",
    "DeletedAtSource": "CASE WHEN c_nationkey = 3 THEN TIMESTAMP_NTZ '2020-01-01 00:00:00' "
    "ELSE TIMESTAMP_NTZ '0001-01-01 00:00:00' END",
    "IS_DELETED": "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END",
}
_PERSONS = {"PersonId": "s_suppkey", "PersonCode": "s_name"}


_OTHER_LABEL = "Внешние продукты (из PPInfo)"


def _labels(kind: str) -> str:
    return f"""CASE {kind} WHEN 'TEC' THEN 'Технопродукты' WHEN 'INT' THEN 'Внутренние продукты'
               WHEN 'PLF' THEN 'ИТ-продукты. Платформы' WHEN 'PRO' THEN 'ИТ-продукты. Приложения'
               WHEN 'SRV' THEN 'ИТ-продукты. Сервисы' ELSE '{_OTHER_LABEL}' END"""


_KIND = """COALESCE(NULLIF(REGEXP_EXTRACT("Code", '^([^.]+)[.]', 1), ''), 'BPR')"""


def _enrich_ctes(product_rows: dict[str, str], relation: str, employees: dict[str, str]) -> str:
    """CTEs up to ``enriched``.

    Every lookup keeps the product's row and multiplies it where the lookup has several rows for
    its key.  A login counts while it is not flagged and its deletion time is exactly the sentinel.
    """
    classified = ", ".join(f"COALESCE(k.\"{c}\", '') AS \"{c}\"" for c in _CLASSIFIER_COLUMNS)
    defaulted = ", ".join(f"COALESCE(p.\"{c}\", '') AS \"{c}\"" for c in ("Description", "ShortDescription", "itObjectStatus"))
    kind = _KIND.replace('"Code"', 'p."Code"')
    return f"""
    product AS ({select_sql({n: both(e) for n, e in product_rows.items()}, relation)}),
    unit AS ({select_sql({n: both(e) for n, e in _UNITS.items()}, "nation")}),
    employee AS ({select_sql({n: both(e) for n, e in employees.items()}, "customer")}),
    code_of AS (SELECT "Login" AS login, s_name AS code FROM employee LEFT JOIN supplier ON s_suppkey = "PersonId"
                WHERE "IS_DELETED" = 0 AND "DeletedAtSource" = TIMESTAMP '0001-01-01 00:00:00'),
    cls AS ({_CLASSIFIER_SQL}),
    enriched AS (
        SELECT p."ObjectId", p."Code", p."Name", p."Type", p."Status", {defaulted}, {classified},
               COALESCE(above."ObjectId", 0) AS "ParentObjectId", COALESCE(u."TribeCode", 0) AS "TribeCode",
               COALESCE(mine.code, '') AS "OwnerPersonCode", COALESCE(tech.code, '') AS "TechOwnerPersonCode",
               {kind} AS "ProductTypeSol", {_labels(kind)} AS "ProductTypeSolName",
               COALESCE(p."SolUrl", '') || '/modules/' || p."Id" AS "SolUrl"
        FROM product p LEFT JOIN cls k ON k."Id" = p."Id" LEFT JOIN code_of tech ON tech.login = p."TechOwnerLogin"
             LEFT JOIN code_of mine ON mine.login = p."OwnerLogin" LEFT JOIN product above ON above."Id" = p."ParentId"
             LEFT JOIN unit u ON u."UnitId" = LOWER(p."TribeUnitId"))
"""


# Two employees to a login, and deletion times a second and a day off the sentinel.
_SHARED_LOGINS = {
    **_EMPLOYEES,
    "Login": "CONCAT('l', CAST(c_custkey - c_custkey % 2 AS STRING))",
    "DeletedAtSource": "CASE c_nationkey WHEN 3 THEN TIMESTAMP_NTZ '2020-01-01 00:00:00' "
    "WHEN 4 THEN TIMESTAMP_NTZ '0001-01-01 00:00:01' WHEN 5 THEN TIMESTAMP_NTZ '0001-01-02 00:00:00' "
    "ELSE TIMESTAMP_NTZ '0001-01-01 00:00:00' END",
}


def _enriched(spark: SparkSession, sf: str, products: DataFrame, employees: dict[str, str]) -> DataFrame:
    customer = table(spark, sf, "customer")
    return catalogue.enrich_products(
        products,
        catalogue.classifier_table(project(customer, _CLASSIFIER_ROWS)),
        project(table(spark, sf, "nation"), _UNITS),
        project(customer, employees),
        project(table(spark, sf, "supplier"), _PERSONS),
    )


@query(f"WITH {_enrich_ctes(_PRODUCT_ROWS, 'part', _SHARED_LOGINS)} SELECT * FROM enriched")
def product_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf, project(table(spark, sf, "part"), _PRODUCT_ROWS), _SHARED_LOGINS)


_RAW_PRODUCT = {
    "id": "CAST(p_partkey AS INT)",
    "objectId": "CAST(p_partkey + 5000000 AS INT)",
    "parentId": _PRODUCT_ROWS["ParentId"],
    "code": _CODE,
    "name": "p_name",
    "rmsContour": "named_struct('unitId', CONCAT('U-', CAST(p_size AS STRING)))",
    "ownerDetails": f"named_struct('login', {_PRODUCT_ROWS['OwnerLogin']}, 'userName', p_name)",
    "techOwnerDetails": "CASE WHEN p_size < 5 THEN NULL ELSE "
    "named_struct('login', CONCAT('l', CAST(p_size AS STRING)), 'userName', p_name) END",
    "status": "p_type",
    "description": _PRODUCT_ROWS["Description"],
    "shortDescription": "p_type",
    "itObjectStatus": _PRODUCT_ROWS["itObjectStatus"],
}
_KEPT_PRODUCT = {
    "ObjectId": "CAST(p_partkey + 5000000 AS INT)",
    "ParentObjectId": "CASE WHEN p_size = 1 THEN 0 ELSE CAST(p_size * 3 + 5000000 AS INT) END",
    "Code": _CODE,
    "Name": "p_name",
    "TribeCode": "0",
    "Type": "'Module'",
    "OwnerPersonCode": "''",
    "TechOwnerPersonCode": "''",
    "FINDirectionGeneral": "''",
    "FINDirectionDetailed": "''",
    "FINGroup": "''",
    "FINDetailed": "''",
    "ProductTypeSol": "'BPR'",
    "ProductTypeSolName": f"'{_OTHER_LABEL}'",
    "Status": "p_type",
    "Description": "p_name",
    "SolUrl": "CONCAT('https://catalogue/modules/', CAST(p_partkey AS STRING))",
    "ShortDescription": "CASE WHEN p_size = 30 THEN NULL ELSE p_type END",
    "itObjectStatus": "p_type",
    "UpdatedAt": "CAST(NULL AS TIMESTAMP_NTZ)",
}
_PRODUCT_BOTH = ("ShortDescription", "itObjectStatus")


def _catalogue_sql() -> str:
    """The enrichment of the product extract (all but PROMO) merged into the stored products."""
    extracted = {
        **_PRODUCT_ROWS,
        "Type": "'Module'",
        "SolUrl": "'https://catalogue'",
        "Description": "CASE WHEN p_size = 6 THEN '' ELSE p_name END",
    }
    ctes = _enrich_ctes(extracted, "part WHERE p_type <> 'PROMO'", _EMPLOYEES)
    columns = [c for c in _KEPT_PRODUCT if c not in ("ObjectId", "UpdatedAt")]
    changed = any_differs(
        [(f's."{c}"', f"COALESCE(t.\"{c}\", '')" if c in _PRODUCT_BOTH else f't."{c}"') for c in columns]
    )
    merged = merge_sql(
        select_sql({n: both(e) for n, e in _KEPT_PRODUCT.items()}, "part WHERE p_type <> 'LARGE'"),
        "SELECT * FROM enriched",
        ["ObjectId"],
        {c: f's."{c}"' for c in columns},
        changed,
        list(_KEPT_PRODUCT),
        absent="hard",
        updated_at="UpdatedAt",
    )
    return f"WITH {ctes}, " + merged.removeprefix("WITH ")


@query(_catalogue_sql())
def product_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Nested product responses flattened, packed, parsed, enriched and merged."""
    part = table(spark, sf, "part")
    raw = project(part.filter("p_type <> 'PROMO'"), _RAW_PRODUCT)
    raw = raw.withColumn("techTribe", F.lit(None).cast("struct<unitId: string>"))
    paths = catalogue.product_paths("Module", "https://catalogue")
    flat = raw.select(*[(F.col(p) if isinstance(p, str) else p).alias(n) for n, p in paths.items()])
    packed = pack_records(flat, F.lit(catalogue.PRODUCT), flat.columns)
    products = catalogue.records(packed, catalogue.PRODUCT, catalogue.PRODUCT_FIELDS)
    target = project(part.filter("p_type <> 'LARGE'"), _KEPT_PRODUCT)
    return merge_with_actions(target, _enriched(spark, sf, products, _EMPLOYEES), catalogue.PRODUCT_MERGE, RUN_TS)


# --- products, second dialect --------------------------------------------------------------------------

_PRODUCT_EXTRACT = {
    "id": "CAST(p_partkey AS INT)",
    "object_id": "CAST(p_partkey + 5000000 AS INT)",
    "code": _CODE,
    "name": "p_name",
    "customer_unit_id": "CAST(p_size AS STRING)",
    "executor_unit_id": "CASE WHEN p_size = 2 THEN NULL ELSE p_brand END",
    "owner_login": "p_brand",
    "owner": "p_name",
    "tech_owner_login": "p_brand",
    "tech_owner": "p_name",
    "status": "p_type",
    "description": "CASE WHEN p_size = 6 THEN NULL ELSE p_name END",
    "short_description": "p_type",
    "it_object_status": "CASE WHEN p_size = 7 THEN '' ELSE p_type END",
    "type": "p_type",
    "sol_url": "CASE WHEN p_size = 8 THEN NULL ELSE 'https://catalogue' END",
}
_PRODUCT_STORED = {
    "id": "CAST(p_partkey + 1 AS INT)",
    "object_id": "CAST(p_partkey + 5000000 AS INT)",
    "code": _CODE,
    "name": "p_name",
    "tribe_id": "CASE WHEN p_size < 25 AND p_size <> 4 THEN p_size ELSE NULL END",
    "customer_unit_id": "CAST(p_size AS STRING)",
    "executor_unit_id": "CASE WHEN p_size = 2 THEN '' ELSE p_brand END",
    "type": "p_type",
    "owner": "p_name",
    "tech_owner": "p_name",
    "tech_owner_login": "p_brand",
    "owner_login": "p_brand",
    "product_type_sol": "CASE WHEN p_brand = 'Brand#8' THEN '' WHEN p_brand = 'Brand#1' THEN 'TEC' ELSE p_name END",
    "product_type_sol_name": f"'{_OTHER_LABEL}'",
    "status": "CASE WHEN p_size = 9 THEN 'old' ELSE p_type END",
    "description": "CASE WHEN p_size = 6 THEN '' ELSE p_name END",
    "short_description": "p_type",
    "sol_url": "CASE WHEN p_size = 8 THEN NULL ELSE "
    "CONCAT('https://catalogue/modules/', CAST(p_partkey AS STRING)) END",
    "it_object_status": "CASE WHEN p_size = 7 THEN NULL ELSE p_type END",
    "deleted_at": "CASE WHEN p_size = 20 THEN TIMESTAMP_NTZ '2023-05-05 00:00:00' END",
    "updated_at": "CAST(NULL AS TIMESTAMP_NTZ)",
}
_TRIBE_UNITS = {
    "id": "n_nationkey",
    "tribe_id": "CASE WHEN n_nationkey = 4 THEN 'None' ELSE CAST(n_nationkey AS STRING) END",
}
_PREFIX = "SPLIT_PART(x.code, '.', 1)"
_UPSERT_COLUMNS = [c for c in _PRODUCT_STORED if c not in ("id", "object_id", "deleted_at", "updated_at")]
_NUMERIC = {"tribe_id": "0"}


@query(
    merge_sql(
        select_sql({n: both(e) for n, e in _PRODUCT_STORED.items()}, "part WHERE p_type <> 'PROMO'"),
        f"""SELECT x.* EXCLUDE (sol_url), x.sol_url || '/modules/' || x.id AS sol_url,
                   {_PREFIX} AS product_type_sol, {_labels(f'UPPER({_PREFIX})')} AS product_type_sol_name,
                   CAST(REPLACE(u.tribe_id, 'None', '0') AS INT) AS tribe_id
            FROM ({select_sql({n: both(e) for n, e in _PRODUCT_EXTRACT.items()}, "part WHERE p_type <> 'LARGE'")}) x
            LEFT JOIN ({select_sql({n: both(e) for n, e in _TRIBE_UNITS.items()}, "nation")}) u
                   ON x.customer_unit_id = CAST(u.id AS VARCHAR)""",
        ["object_id"],
        {c: f's."{c}"' for c in _UPSERT_COLUMNS},
        "(t.deleted_at IS NOT NULL OR "
        + any_differs(
            [
                (f"COALESCE(s.\"{c}\", {_NUMERIC.get(c, repr(''))})", f"COALESCE(t.\"{c}\", {_NUMERIC.get(c, repr(''))})")
                for c in _UPSERT_COLUMNS
            ]
        )
        + ")",
        list(_PRODUCT_STORED),
        absent="soft",
        insert_only=["id"],
        deleted_at="deleted_at",
        updated_at="updated_at",
    )
)
def product_upsert_dialect(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    extract = project(part.filter("p_type <> 'LARGE'"), _PRODUCT_EXTRACT)
    source = catalogue.product_rows(extract, project(table(spark, sf, "nation"), _TRIBE_UNITS))
    target = project(part.filter("p_type <> 'PROMO'"), _PRODUCT_STORED)
    return merge_with_actions(target, source, catalogue.PRODUCT_UPSERT, RUN_TS)


# --- dimensions -----------------------------------------------------------------------------------------


_TRIBES_SQL = """
    SELECT s_suppkey AS id, s_name AS name, 'd' AS description, c_custkey AS tribe_owner_id,
           c_name AS tribe_owner_name, s_nationkey AS cluster_id
    FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey * 20 WHERE s_acctbal >= 0
"""
_CLUSTERS_SQL = """
    SELECT o_orderkey AS id, o_orderpriority AS name, o_orderstatus AS description,
           c_custkey AS cluster_leader_id, c_name AS cluster_leader_name
    FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END
"""


def _tribes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    tribes = project(
        table(spark, sf, "supplier"),
        {
            "TribeCode": "s_suppkey",
            "Name": "s_name",
            "Description": "'d'",
            "TribeLeaderId": "s_suppkey * 20",
            "ClusterId": "s_nationkey",
            "IS_DELETED": "CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END",
        },
    )
    return tribes, _person(spark, sf)


def _clusters(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    clusters = project(
        table(spark, sf, "orders"),
        {
            "ClusterCode": "o_orderkey",
            "Name": "o_orderpriority",
            "Description": "o_orderstatus",
            "ClusterLeaderId": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END",
        },
    )
    return clusters, _person(spark, sf)


@query(_TRIBES_SQL)
def dim_left_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.tribe_dimension(*_tribes(spark, sf))


@query(_CLUSTERS_SQL)
def cluster_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.cluster_dimension(*_clusters(spark, sf))


def _loaded_twice(spark: SparkSession, load) -> DataFrame:
    staging = shared_folder(spark, "dimension")
    for _ in range(2):
        load(staging)
    return read_relation(spark, staging)


@query(_TRIBES_SQL)
def tribes_load(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded_twice(spark, lambda staging: dimensions.load_tribes(*_tribes(spark, sf), staging))


@query(_CLUSTERS_SQL)
def clusters_load(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded_twice(spark, lambda staging: dimensions.load_clusters(*_clusters(spark, sf), staging))


def _person(spark: SparkSession, sf: str) -> DataFrame:
    return project(table(spark, sf, "customer"), {"PersonCode": "c_custkey", "NameLocal": "c_name"})


# A unit keeps its row whatever it points at; a lookup row that is deleted gives no name; code 0 means
# none and has no name, though its tribe still leads to a cluster; a code that occurs more than once in
# a lookup gives the unit once for each.
def _units_sql(chapters: str) -> str:
    return f"""
    WITH unit AS (SELECT c_custkey AS id, c_name AS title, c_mktsegment AS description, c_nationkey AS pointed,
                         c_mktsegment <> 'BUILDING' AS placed FROM customer),
         chapter AS ({chapters})
    SELECT id, title, description, 'org' AS org_code,
           NULLIF(n_regionkey, 0) AS cluster_id, IF(n_regionkey <> 0, r_name, NULL) AS cluster_name_rms,
           IF(placed, NULLIF(pointed, 0), NULL) AS tribe_id, IF(pointed <> 0, n_name, NULL) AS tribe_name_rms,
           IF(placed, NULLIF(pointed, 0), NULL) AS chapter_id, IF(code <> 0, chapter.name, NULL) AS chapter_name_rms
    FROM unit
    LEFT JOIN chapter ON placed AND code = pointed
    LEFT JOIN nation ON placed AND n_nationkey = pointed AND pointed <> 6
    LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey <> 2
    """


_CHAPTERS = "SELECT s_suppkey AS code, s_name AS name FROM supplier WHERE s_acctbal >= 0"
_AGAIN = "SELECT s_suppkey, CONCAT(s_name, ' again') FROM supplier WHERE s_suppkey IN (3, 4) AND s_acctbal >= 0"


@query(_units_sql(f"{_CHAPTERS} UNION ALL {_AGAIN}"))
def unit_denorm(spark: SparkSession, sf: str) -> DataFrame:
    """With two chapter codes that occur twice, so their units come twice."""
    tables = _unit_tables(spark, sf)
    again = tables["chapters"].filter("ChapterCode IN (3, 4)").withColumn("Name", F.concat("Name", F.lit(" again")))
    return dimensions.unit_dimension(**{**tables, "chapters": tables["chapters"].unionByName(again)})


@query(_units_sql(_CHAPTERS))
def units_load(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded_twice(spark, lambda staging: dimensions.load_units(**_unit_tables(spark, sf), staging=staging))


def _unit_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    customer = table(spark, sf, "customer")
    return dict(
        units=project(
            customer, {"UnitId": "c_custkey", "Title": "c_name", "Description": "c_mktsegment", "OrgCode": "'org'"}
        ),
        structure=project(
            customer,
            {
                "UnitId": "CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END",
                "TribeCode": "c_nationkey",
                "ChapterCode": "c_nationkey",
            },
        ),
        tribes=project(
            table(spark, sf, "nation"),
            {
                "TribeCode": "n_nationkey",
                "Name": "n_name",
                "ClusterId": "n_regionkey",
                "IS_DELETED": "CASE WHEN n_nationkey = 6 THEN 1 ELSE 0 END",
            },
        ),
        clusters=project(
            table(spark, sf, "region"),
            {
                "ClusterCode": "r_regionkey",
                "Name": "r_name",
                "IS_DELETED": "CASE WHEN r_regionkey = 2 THEN 1 ELSE 0 END",
            },
        ),
        chapters=project(
            table(spark, sf, "supplier"),
            {
                "ChapterCode": "CAST(s_suppkey AS INT)",
                "Name": "s_name",
                "IS_DELETED": "CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END",
            },
        ),
    )


_HIRED = "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN {none} ELSE o_orderdate END"
_FIRED = (
    "CASE o_orderstatus WHEN 'F' THEN o_orderdate + INTERVAL {year} WHEN 'O' THEN NULL ELSE {none} END"
)


_PERSONS_SQL = f"""
    SELECT DISTINCT c_custkey AS hrgate_person_id, o_orderkey AS hrgate_assignment_id,
           o_orderpriority AS login, STRFTIME(l_shipdate, '%Y-%m-%d %H:%M:%S.000') AS assignment_hire_date,
           s_name AS role, p_type AS position, o_orderstatus AS fio, p_brand AS business_unit,
           r_name AS cluster, t.n_name AS tribe, COALESCE(le.n_name, o.n_name) AS legal_entity
    FROM (SELECT *, {_HIRED.format(none="TIMESTAMP '1900-01-01'")} AS hired,
                 {_FIRED.format(none="TIMESTAMP '1900-01-01'", year="365 DAY")} AS fired FROM orders) m
    JOIN customer ON c_custkey = m.o_custkey
    JOIN lineitem ON l_orderkey = m.o_orderkey
    JOIN nation o ON o.n_nationkey = c_nationkey
    LEFT JOIN part ON p_partkey = l_partkey AND p_size > 5
    LEFT JOIN region ON r_regionkey = p_size
    LEFT JOIN nation t ON t.n_nationkey = p_size
    LEFT JOIN supplier ON s_suppkey = p_size
    LEFT JOIN nation le ON le.n_nationkey = p_size AND le.n_regionkey <> 1
    WHERE (fired >= TIMESTAMP '1998-06-01' OR fired IS NULL OR fired = TIMESTAMP '1900-01-01')
      AND (hired <= TIMESTAMP '1998-06-01' OR hired IS NULL OR hired = TIMESTAMP '1900-01-01')
"""


@query(_PERSONS_SQL)
def active_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.person_snapshot(_person_tables(spark, sf), datetime(1998, 6, 1))


# Here an order is its own assignment, so the two keys of a person's assignment are unique.
_OWN = {"AssignmentId": "o_orderkey", "StaffUnitId": "o_custkey", "HireDate": "o_orderdate"}
_OWN_SQL = "(SELECT o_orderkey AS l_orderkey, o_custkey AS l_partkey, o_orderdate AS l_shipdate FROM orders)"


@query(_PERSONS_SQL.replace("JOIN lineitem ON", f"JOIN {_OWN_SQL} ON"))
def persons_load(spark: SparkSession, sf: str) -> DataFrame:
    """Staging by the two keys of a person's assignment."""
    tables = _person_tables(spark, sf) | {"assignments": project(table(spark, sf, "orders"), _OWN)}
    return _loaded_twice(spark, lambda staging: dimensions.load_persons(tables, datetime(1998, 6, 1), staging))


def _person_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    lineitem, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    none = "TIMESTAMP_NTZ '1900-01-01 00:00:00'"
    return {
        "assignment_mapping": project(
            orders,
            {
                "PersonCode": "o_custkey",
                "AssignmentId": "o_orderkey",
                "EmployeeId": "o_custkey",
                "Login": "o_orderpriority",
                "FIO": "o_orderstatus",
                "HireDate": _HIRED.format(none=none),
                "FireDate": _FIRED.format(none=none, year="'365' DAY"),
            },
        ),
        "employee_codes": project(customer, {"EmployeeCode": "c_custkey"}),
        "person_mapping": project(customer, {"PersonCode": "c_custkey", "SourceSystemPersonId": "c_custkey"}),
        "persons": project(customer, {"PersonId": "c_custkey"}),
        "assignments": project(
            lineitem, {"AssignmentId": "l_orderkey", "StaffUnitId": "l_partkey", "HireDate": "l_shipdate"}
        ),
        "employees": project(customer, {"EmployeeId": "c_custkey", "OrganizationId": "c_nationkey"}),
        "organizations": project(nation, {"OrganizationId": "n_nationkey", "UnitTitle": "n_name"}),
        "staff_units": project(
            part,
            {
                "SourceSystemStaffUnitId": "CASE WHEN p_size > 5 THEN CAST(p_partkey AS STRING) END",
                "PositionName": "p_type",
                "BusinessUnitCode": "p_brand",
                "ClusterCode": "p_size",
                "TribeCode": "p_size",
                "RoleId": "p_size",
                "LegalEntityCode": "p_size",
            },
        ),
        "clusters": project(region, {"ClusterCode": "r_regionkey", "Name": "r_name"}),
        "tribes": project(nation, {"TribeCode": "n_nationkey", "Name": "n_name"}),
        "roles": project(table(spark, sf, "supplier"), {"Code": "CAST(s_suppkey AS INT)", "Name": "s_name"}),
        "legal_entities": project(
            nation,
            {
                "LegalEntityCode": "CASE WHEN n_regionkey <> 1 THEN n_nationkey END",
                "LegalEntityName": "n_name",
            },
        ),
    }


@query(
    """
    SELECT o_orderkey AS "IssueId", c_name AS "Title", o_orderpriority AS "CustomSolSoftware",
           o_orderstatus AS "ClusterName"
    FROM orders JOIN customer ON c_custkey = o_orderkey
    """
)
def issue_extract(spark: SparkSession, sf: str) -> DataFrame:
    custom_status = project(
        table(spark, sf, "orders"),
        {"issue_id": "o_orderkey", "product_code_sol": "o_orderpriority", "cluster_name": "o_orderstatus"},
    )
    issues = project(table(spark, sf, "customer"), {"issue_id": "c_custkey", "issue_name": "c_name"})
    return issues_to_send(custom_status, issues)
