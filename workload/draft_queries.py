"""Act drafts: aggregate, packing, export."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.packing import pack_attributes, pack_measures, split_columns, unpivot_text
from tidemark.plans import drafts
from tidemark.sources.tables import shared_folder
from workload.registry import project, query, table

# --- the aggregate -----------------------------------------------------------------------------------

_PROJECTS = {
    "p_partkey": "p_partkey",
    "ProjectStatus": "CASE WHEN p_type = 'PROMO' THEN 'Closed' ELSE 'Realization' END",
    "WIPFrameworkId": "CASE WHEN p_brand = 'Brand#3' THEN NULL ELSE p_brand END",
    "WIPActsProjectFilter": "p_size <> 9",
    "CustomerCode": "CASE WHEN p_size = 11 THEN 4 ELSE 3 END",
}


_IN_PERIOD = "l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1999-04-01'"


def _act_sql(attributes: str) -> str:
    return f"""
    WITH facts AS (SELECT l_partkey, l_shipdate, l_returnflag, l_linestatus, p_brand,
                          CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_tax AS DECIMAL(18,2)) AS tax
                   FROM lineitem JOIN part ON p_partkey = l_partkey),
         chosen AS (SELECT l_partkey FROM facts GROUP BY l_partkey
                    HAVING COALESCE(MAX(CASE WHEN {_IN_PERIOD} AND tax > 0.07 THEN 1 END), 0) <> 1
                       AND SUM(amount) > 0),
         projects AS (SELECT p_partkey FROM part WHERE p_type <> 'PROMO' AND p_brand <> 'Brand#3'
                      AND p_size <> 9 AND p_size <> 11)
    SELECT {attributes},
           CAST(SUM(CASE WHEN l_returnflag = 'A' THEN amount END) AS DECIMAL(18,2)) AS "[Amount]",
           CAST(SUM(CASE WHEN l_returnflag <> 'N' THEN tax END) AS DECIMAL(18,2)) AS "[Tax]"
    FROM facts
    WHERE {_IN_PERIOD}
      AND l_partkey IN (SELECT p_partkey FROM projects) AND l_partkey IN (SELECT l_partkey FROM chosen)
    GROUP BY {attributes}
    HAVING SUM(CASE WHEN l_returnflag = 'A' THEN amount END) IS NOT NULL
        OR SUM(CASE WHEN l_returnflag <> 'N' THEN tax END) IS NOT NULL
    """


def _act_rows(spark: SparkSession, sf: str, attributes: list[str]) -> DataFrame:
    part, lineitem = table(spark, sf, "part"), table(spark, sf, "lineitem")
    facts = project(
        lineitem.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
        {
            "l_partkey": "l_partkey",
            "l_shipdate": "l_shipdate",
            "l_returnflag": "l_returnflag",
            "l_linestatus": "l_linestatus",
            "p_brand": "p_brand",
            "amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
            "tax": "CAST(l_tax AS DECIMAL(18,2))",
        },
    )
    in_period = F.expr(_IN_PERIOD.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    projects = drafts.realization_projects(project(part, _PROJECTS), "p_partkey")
    return drafts.act_rows(
        facts,
        in_period,
        projects.withColumnRenamed("p_partkey", "l_partkey"),
        "l_partkey",
        flag=F.max(F.when(in_period & (F.col("tax") > 0.07), 1)),
        amount=F.sum("amount"),
        attributes=attributes,
        measures={
            "[Amount]": F.expr("CAST(SUM(CASE WHEN l_returnflag = 'A' THEN amount END) AS DECIMAL(18,2))"),
            "[Tax]": F.expr("CAST(SUM(CASE WHEN l_returnflag <> 'N' THEN tax END) AS DECIMAL(18,2))"),
        },
    )


@query(_act_sql("p_brand, l_returnflag, l_linestatus"))
def act_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return _act_rows(spark, sf, ["p_brand", "l_returnflag", "l_linestatus"])


@query(_act_sql("l_partkey, p_brand, l_returnflag"))
def act_aggregate_by_project(spark: SparkSession, sf: str) -> DataFrame:
    return _act_rows(spark, sf, ["l_partkey", "p_brand", "l_returnflag"])


# --- packing ---------------------------------------------------------------------------------------------

_ACTS = {
    "Donors[Code]": "CASE WHEN p_size = 1 THEN NULL ELSE CONCAT(p_brand, ' ', p_type) END",
    "Donors[Subject]": "CONCAT('say \"', p_name, '\"')",
    "Donors[Start]": "CASE WHEN p_size = 2 THEN NULL WHEN p_size = 3 THEN 'open' "
    "ELSE CONCAT('5.', CASE WHEN p_size < 20 THEN '02' ELSE '11' END, '.2023') END",
    "Projects[Spaces]": "CONCAT(p_type, '  \t x')",
    "[Price до даты]": "CAST(p_retailprice AS DECIMAL(19,4))",
    "[Rate]": "CASE p_size % 4 WHEN 0 THEN 0.00004D WHEN 1 THEN 1.23456789D WHEN 2 THEN 206060005.0D ELSE p_retailprice END",
    "[Size]": "CASE WHEN p_size = 4 THEN NULL ELSE p_size END",
    "[Local]": "CASE WHEN p_size = 5 THEN '1,5' ELSE CAST(p_size AS STRING) END",
}
_DATES = ["Donors[Start]"]


def _acts(spark: SparkSession, sf: str) -> DataFrame:
    return project(table(spark, sf, "part"), {"p_partkey": "p_partkey", **_ACTS})


_ACT_SQL = {
    "Donors[Code]": "CASE WHEN p_size = 1 THEN 'null' ELSE p_brand || ' ' || p_type END",
    "Donors[Subject]": "'say \\\"' || p_name || '\\\"'",
    "Donors[Start]": "CASE WHEN p_size = 2 THEN 'null' WHEN p_size = 3 THEN 'open' "
    "WHEN p_size < 20 THEN '2023-02-05' ELSE '2023-11-05' END",
    "Projects[Spaces]": "p_type || ' x'",
    "[Price до даты]": "CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS VARCHAR)",
    "[Rate]": "CASE p_size % 4 WHEN 0 THEN '0.00004' WHEN 1 THEN '1.23456789' WHEN 2 THEN '206060005.0' "
    "ELSE CAST(p_retailprice AS VARCHAR) END",
    "[Size]": "CASE WHEN p_size = 4 THEN 'null' ELSE CAST(p_size AS VARCHAR) END",
    "[Local]": "CASE WHEN p_size = 5 THEN '1.5' ELSE CAST(p_size AS VARCHAR) END",
}


def _attributes_sql() -> str:
    names = [n for n in _ACT_SQL if not n.startswith("[")]
    parts = [f"""'{{"Attribute": "{n}", "value": "' || {_ACT_SQL[n]} || '"}}'""" for n in names]
    return "'[' || " + " || ', ' || ".join(parts) + " || ']'"


def _measures_sql() -> str:
    names = [n for n in _ACT_SQL if n.startswith("[")]
    parts = [f"""'{{"Measure": "{n}", "value": ' || {_ACT_SQL[n]} || '}}'""" for n in names]
    return "'[' || " + " || ', ' || ".join(parts) + " || ']'"


@query(f"SELECT p_partkey, {_attributes_sql()} AS packed FROM part")
def act_pack_attributes(spark: SparkSession, sf: str) -> DataFrame:
    attributes, _ = split_columns(list(_ACTS))
    return _acts(spark, sf).select("p_partkey", pack_attributes(attributes, _DATES).alias("packed"))


@query(f"SELECT p_partkey, {_measures_sql()} AS packed FROM part")
def act_pack_measures(spark: SparkSession, sf: str) -> DataFrame:
    acts = _acts(spark, sf)
    _, measures = split_columns(acts.columns)
    return acts.select("p_partkey", pack_measures(acts, measures).alias("packed"))


_CODE_SQL = _ACT_SQL["Donors[Code]"]
_UUID_SQL = " || '-' || ".join(
    f"SUBSTR(MD5({_CODE_SQL}), {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
)


@query(
    f"""
    SELECT {_UUID_SQL} AS "ActId", {_attributes_sql()} AS "Attributes", {_measures_sql()} AS "Measures",
           2023 AS "YearNumber", 11 AS "MonthNumber", DATE '2023-11-30' AS "CalculationDate"
    FROM part WHERE p_size <> 1
    """
)
def act_drafts(spark: SparkSession, sf: str) -> DataFrame:
    acts = _acts(spark, sf).drop("p_partkey")
    return drafts.packed_drafts(acts, "Donors[Code]", 2023, 11, date(2023, 11, 30), _DATES)


# --- the whole job at its full width: 36 attributes and 67 measures ---------------------------------------

_WIDE_ATTRIBUTES = [f"Donors[A{k:02d}]" for k in range(36)]
_WIDE_MEASURES = [f"[M{k:02d} до даты]" for k in range(67)]


def _wide_sql() -> str:
    """Attribute k is the brand and k, measure k the sum of amounts of flag 'A', 'N' or 'R' times k."""
    attributes = " || ', ' || ".join(
        f"""'{{"Attribute": "{n}", "value": "' || p_brand || ' {k}' || '"}}'""" for k, n in enumerate(_WIDE_ATTRIBUTES)
    )
    flags = "ANR"
    measures = " || ', ' || ".join(
        f"""'{{"Measure": "{n}", "value": ' || COALESCE(CAST(CAST({k} * sum_{flags[k % 3]} AS DECIMAL(18,2)) AS VARCHAR), 'null') || '}}'"""
        for k, n in enumerate(_WIDE_MEASURES)
    )
    sums = ", ".join(
        f"SUM(CASE WHEN l_returnflag = '{f}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS sum_{f}" for f in flags
    )
    uuid = " || '-' || ".join(
        f"SUBSTR(MD5(p_brand || ' 0'), {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    )
    return f"""
    WITH acts AS (SELECT p_brand, {sums} FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand)
    SELECT '00' AS "ETL_LOG_ID", {uuid} AS "ActId", '[' || {attributes} || ']' AS "Attributes",
           '[' || {measures} || ']' AS "Measures", DATE '2023-11-30' AS "CalculationDate",
           2023 AS "YearNumber", 11 AS "MonthNumber"
    FROM acts
    """


@query(_wide_sql())
def act_job(spark: SparkSession, sf: str) -> DataFrame:
    """Facts aggregated, packed at full width, staged by month and read back, twice."""
    brands = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    facts = table(spark, sf, "lineitem").join(brands, "l_partkey")
    attributes = {n: F.concat("p_brand", F.lit(f" {k}")) for k, n in enumerate(_WIDE_ATTRIBUTES)}
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    measures = {
        n: (F.sum(F.when(F.col("l_returnflag") == "ANR"[k % 3], amount)) * k).cast("decimal(18,2)")
        for k, n in enumerate(_WIDE_MEASURES)
    }
    acts = drafts.wide_acts(facts, ["p_brand"], attributes, measures)
    staging = shared_folder(spark, "drafts")
    for _ in range(2):
        staged = drafts.run_drafts(spark, acts, "Donors[A00]", 2023, 11, date(2023, 11, 30), staging)
    return staged.withColumn("ETL_LOG_ID", F.hex("ETL_LOG_ID"))


@query(
    """
    SELECT p_partkey, 'p_name' AS variable, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'p_type', CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END FROM part
    """
)
def unpivot_attributes(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").withColumn("p_type", F.expr("CASE WHEN p_type <> 'PROMO' THEN p_type END"))
    return unpivot_text(part, ["p_partkey"], ["p_name", "p_size", "p_type"])


# --- export ------------------------------------------------------------------------------------------------

_VIEW = {
    "id": "o_orderkey",
    "ProjectId": "CAST(o_custkey AS STRING)",
    "ProjectCode": "o_orderpriority",
    "CustomerId": "o_custkey",
    "CurrencyId": "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'р\"уб' END",
    "Date": "CAST(o_orderdate AS DATE)",
    "StartPeriodDate": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END",
    "ActStatus": "o_orderstatus",
    "Amount": "CAST(o_totalprice AS DECIMAL(18,2))",
}
_ODATE = "STRFTIME(o_orderdate, '%Y-%m-%dT%H:%M:%S')"
_FIELD_SQL = {
    "id": "CAST(o_orderkey AS VARCHAR)",
    "ProjectId": "CAST(o_custkey AS VARCHAR)",
    "ProjectCode": "'\"' || o_orderpriority || '\"'",
    "CustomerId": "CAST(o_custkey AS VARCHAR)",
    "CurrencyId": "CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '\"р\\\"уб\"' END",
    "Date": f"'\"' || {_ODATE} || '\"'",
    "StartPeriodDate": f"CASE WHEN o_orderstatus = 'O' THEN 'null' ELSE '\"' || {_ODATE} || '\"' END",
    "ActStatus": "'\"' || o_orderstatus || '\"'",
    "Amount": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
}
# The receiver's fields in order, as view column and name where they differ; kept apart from the
# library's own list.
_EXPORTED = [
    (x, "CurrenrId" if x == "CurrencyId" else x)
    for x in (
        "id ProjectId ProjectCode CustomerId ContractorId CurrencyId ContractId ContractName ContractFrame ContractCount "
        "Date StartPeriodDate EndPeriodDate ActStatus ActNumber ActType Hyperion TaskOebsName CapexOpex CostSegmentCode "
        "ResponsibilityCenterCode WIPCustomerCluster Amount SumFot SumMargin SumLeaders SumOverheadCosts"
    ).split()
]
_RECORD_SQL = " || ',' || ".join(
    f"'\"{name}\":' || {_FIELD_SQL.get(column, repr('null'))}" for column, name in _EXPORTED
)


def _export_rows(spark: SparkSession, sf: str) -> DataFrame:
    columns = {c: _VIEW.get(c, "CAST(NULL AS STRING)") for c, _ in _EXPORTED}
    periods = {"Year": "year(o_orderdate)", "MonthNumber": "month(o_orderdate)"}
    return drafts.export_rows(project(table(spark, sf, "orders"), columns | periods), 1997, 11)


@query(
    f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "group",
           '{{"WipActs": [' || STRING_AGG('{{' || {_RECORD_SQL} || '}}', ',' ORDER BY '{{' || {_RECORD_SQL} || '}}')
           || ']}}' AS document
    FROM orders WHERE YEAR(o_orderdate) = 1997 AND MONTH(o_orderdate) = 11 GROUP BY 1
    """
)
def act_export_text(spark: SparkSession, sf: str) -> DataFrame:
    """The month's drafts as one document a day, to the byte: records in the order of their texts."""
    return drafts.export_documents(_export_rows(spark, sf), F.col("Date").cast("date"))


@query(
    """
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "group", o_orderkey AS id,
           CAST(o_custkey AS INT) AS "ProjectId",
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'р"уб' END AS "CurrenrId",
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS "StartPeriodDate",
           CAST(o_totalprice AS DECIMAL(18,2)) AS "Amount"
    FROM orders WHERE YEAR(o_orderdate) = 1997 AND MONTH(o_orderdate) = 11
    """
)
def act_export_json(spark: SparkSession, sf: str) -> DataFrame:
    """The month's drafts as documents per day, taken apart again record by record."""
    documents = drafts.export_documents(_export_rows(spark, sf), F.col("Date").cast("date"), max_bytes=500)
    record = "id bigint, ProjectId int, CurrenrId string, StartPeriodDate timestamp_ntz, Amount decimal(18,2)"
    parsed = F.from_json("document", f"WipActs array<struct<{record}>>").getField("WipActs")
    return documents.select("group", F.explode(parsed).alias("r")).select("group", "r.*")
