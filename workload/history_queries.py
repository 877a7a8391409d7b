"""Increments, marks, periods and typed journal entries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators.increments import advance_mark, slice_start
from tidemark.operators.periods import month_slices, month_spine, widen_period
from tidemark.plans import journal, plan_hours
from tidemark.plans.hours import period_to_load
from tidemark.sources.extracts import escaped_xml, write_xml
from tidemark.sources.tables import append, read_history, read_relation, shared_folder, write_slice
from workload.registry import RUN_TS, RUN_TS_SQL, project, query, table

# --- plan-hours changes of one year ------------------------------------------------------------


def plan_hours_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The nine tables of the history, played by orders (roles), lineitem (competence changes),
    customer (tribes), nation (legal entities) and region (projects)."""
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    region, supplier = table(spark, sf, "region"), table(spark, sf, "supplier")
    return {
        "HoursRoles": project(orders, {"Id": "o_orderkey", "HoursTribeId": "o_custkey", "RoleId": "o_orderpriority"}),
        "HoursRoleHistories": project(
            orders,
            {
                "HoursRoleId": "o_orderkey",
                "Period": "o_orderdate",
                "Increment": "o_totalprice",
                "Date": "o_orderdate",
                "User": "o_custkey",
                "Comment": "o_orderstatus",
            },
        ),
        "HoursCompetences": project(
            orders, {"Id": "o_orderkey", "HoursRoleId": "o_orderkey", "CompetenceId": "o_custkey"}
        ),
        "HoursCompetenceHistories": project(
            lineitem,
            {
                "HoursCompetenceId": "l_orderkey",
                "Period": "l_shipdate",
                "Increment": "l_discount",
                "Date": "l_shipdate",
                "User": "l_partkey",
                "Comment": "l_returnflag",
            },
        ),
        "HoursTribes": project(
            customer, {"Id": "c_custkey", "HoursLegalEntityId": "c_nationkey", "TribeId": "c_mktsegment"}
        ),
        "HoursLegalEntities": project(
            nation, {"Id": "n_nationkey", "HoursProjectId": "n_regionkey", "LegalEntityId": "n_name"}
        ),
        "HoursProjects": project(region, {"Id": "r_regionkey", "ProjectId": "r_regionkey"}),
        "Projects": project(region, {"Id": "r_regionkey", "ProjectCode": "r_name"}),
        "Employee": project(supplier, {"Id": "s_suppkey"}),
    }


_CHANGES = """
    SELECT r_name AS "ProjectCode", n_name AS "LegalEntityId", c_mktsegment AS "TribeId",
           o_orderpriority AS "RoleId", {competence} AS "CompetenceId",
           CAST({moment} AS DATE) AS "Period", 'Direct' AS "Type", '{kind}' AS "SubType",
           {moment} AS "ChangeDate", s_suppkey AS "ChangedBy_EmployeeCode", {comment} AS "Comment",
           {increment} AS "Increment", 'RMS' AS "SourceSystem"
    FROM {facts}
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN supplier ON s_suppkey = {user}
    WHERE {moment} >= TIMESTAMP '1997-01-01' AND {moment} < TIMESTAMP '1998-01-01' AND {increment} <> 0
"""
_ON_ROLE = _CHANGES.format(
    competence="-1",
    moment="o_orderdate",
    kind="Direct on Role",
    comment="o_orderstatus",
    increment="o_totalprice",
    facts="orders",
    user="o_custkey",
)
_ON_COMPETENCE = _CHANGES.format(
    competence="COALESCE(CAST(o_custkey AS INT), -1)",
    moment="l_shipdate",
    kind="Direct on Competence",
    comment="l_returnflag",
    increment="l_discount",
    facts="lineitem JOIN orders ON o_orderkey = l_orderkey",
    user="l_partkey",
)


@query(f"{_ON_ROLE} UNION ALL {_ON_COMPETENCE}")
def incremental_history(spark: SparkSession, sf: str) -> DataFrame:
    return plan_hours.changes(plan_hours_tables(spark, sf), datetime(1997, 1, 1), datetime(1998, 1, 1))


@query(
    f"""
    SELECT event_type AS "TableName",
           CASE WHEN event_type = 'click' THEN {RUN_TS_SQL} ELSE MAX(ts) END AS "LastUpdateDate",
           DATE_TRUNC('minute', CASE WHEN event_type = 'click' THEN {RUN_TS_SQL} ELSE MAX(ts) END) AS slice_from,
           TIMESTAMP '1900-01-01 00:00:00' AS full_from
    FROM events GROUP BY event_type
    UNION ALL SELECT 'fresh', {RUN_TS_SQL}, DATE_TRUNC('minute', {RUN_TS_SQL}), TIMESTAMP '1900-01-01 00:00:00'
    """
)
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    marks = table(spark, sf, "events").groupBy(F.col("event_type").alias("TableName")).agg(
        F.max("ts").alias("LastUpdateDate")
    )
    mark = F.col("LastUpdateDate")
    marks = advance_mark(advance_mark(marks, "click", RUN_TS), "fresh", RUN_TS)
    return marks.select(
        "TableName", mark, slice_start(mark).alias("slice_from"), slice_start(mark, True).alias("full_from")
    )


@query(
    """
    SELECT '00' AS log_id, o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
    """
)
def append_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three slices, the first a full load that replaces what was there and the middle one stored
    twice, together hold every order exactly once; a fourth is stored and then emptied."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    root = shared_folder(spark, "history")
    bounds = [datetime(1, 1, 1), datetime(1997, 1, 1), datetime(1999, 1, 1), datetime(9999, 1, 1)]
    slices = list(zip(bounds, bounds[1:]))
    whole = project(orders, {"log_id": "X'00'", **{c: c for c in orders.columns}})
    write_slice(whole, root, bounds[0])
    for number, (low, high) in enumerate([*slices, slices[1]]):
        part = whole.filter((F.col("o_orderdate") >= dates.at(low)) & (F.col("o_orderdate") < dates.at(high)))
        write_slice(part, root, low, full_load=number == 0)
    write_slice(whole, root, bounds[-1])
    write_slice(whole.filter("o_orderdate IS NULL AND o_orderdate IS NOT NULL"), root, bounds[-1])
    return read_history(spark, root).withColumn("log_id", F.hex("log_id"))


@query(
    """
    SELECT '00' AS log_id, o_orderstatus, o_orderkey, o_totalprice FROM orders
    """
)
def append_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Extracts of three kinds appended to one staging table behind a constant column, each run twice."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    path = shared_folder(spark, "staging")
    # The third extract has every row that the others do not, also those without a status.
    for kind in ("o_orderstatus = 'F'", "o_orderstatus = 'O'", "coalesce(o_orderstatus NOT IN ('F', 'O'), true)"):
        for _ in range(2):
            append(orders.filter(kind), path, {"log_id": F.expr("X'00'")}, run=kind)
    return read_relation(spark, path).withColumn("log_id", F.hex("log_id"))


# --- periods -----------------------------------------------------------------------------------


@query(
    """
    SELECT CAST(m AS DATE) AS date_from, CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS date_to
    FROM (SELECT UNNEST(GENERATE_SERIES(DATE_TRUNC('month', MIN(o_orderdate)),
                                        DATE_TRUNC('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m
          FROM orders)
    """,
    name="month_spine",
)
def month_spine_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    period = table(spark, sf, "orders").agg(
        F.min("o_orderdate").cast("date").alias("date_from"), F.max("o_orderdate").cast("date").alias("date_to")
    )
    return month_spine(widen_period(period))


@query(
    """
    SELECT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS month, COUNT(*) AS n,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1996-11-01' AND l_shipdate < TIMESTAMP '2000-03-01'
    GROUP BY 1
    """
)
def month_sliced_counts(spark: SparkSession, sf: str) -> DataFrame:
    sliced = month_slices(
        table(spark, sf, "lineitem"), F.col("l_shipdate"), datetime(1996, 11, 20), datetime(2000, 2, 10)
    )
    amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)")
    return sliced.groupBy("month").agg(F.count(F.lit(1)).alias("n"), amount.alias("amount"))


@query(
    """
    SELECT CAST(m + INTERVAL 1 MONTH AS DATE) AS date_from,
           CAST(m + INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS date_to,
           CAST(DATE_TRUNC('year', m + INTERVAL 1 MONTH) AS DATE) AS year
    FROM (SELECT MAX(DATE_TRUNC('month', o_orderdate)) AS m FROM orders WHERE o_orderstatus = 'F')
    """
)
def open_period(spark: SparkSession, sf: str) -> DataFrame:
    status = project(
        table(spark, sf, "orders"),
        {
            "PERIOD_DATE": "trunc(o_orderdate, 'MM')",
            "TS_PERIOD_IS_CLOSED": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
        },
    )
    return period_to_load(status)


@query(
    """
    SELECT o_orderkey,
           CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month_start,
           CAST(DATE_TRUNC('year', o_orderdate) AS DATE) AS year_start,
           LAST_DAY(o_orderdate) AS month_end,
           CAST(CAST(o_orderdate AS DATE) + INTERVAL 14 MONTH AS DATE) AS later,
           CAST((2001 - YEAR(o_orderdate)) * 12 + 8 - MONTH(o_orderdate) AS INT) AS months_left,
           STRFTIME(o_orderdate, '%Y-%m-%d %H:%M:%S.000') AS style,
           STRFTIME(o_orderdate, '%Y-%m-%d') AS day_style
    FROM orders
    """
)
def calendar_functions(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.first_of_month(day).alias("month_start"),
        dates.first_of_year(day).alias("year_start"),
        dates.last_of_month(day).alias("month_end"),
        dates.plus_months(day, 14).alias("later"),
        dates.calendar_months(day, F.lit("2001-08-01").cast("date")).alias("months_left"),
        dates.timestamp_text(F.col("o_orderdate")).alias("style"),
        dates.timestamp_text(day).alias("day_style"),
    )


# --- journal typing ------------------------------------------------------------------------------

# The staged columns as the checks expect them, by class; kept apart from the library's own list.
_TEXTS = (
    "SEGMENT1 SEGMENT1_DESCRIPTION SEGMENT2 SEGMENT2_DESCRIPTION SEGMENT2DT SEGMENT2DT_DESCRIPTION SEGMENT2KT "
    "SEGMENT2KT_DESCRIPTION SEGMENT3 SEGMENT3_DESCRIPTION SEGMENT4 SEGMENT4_DESCRIPTION SEGMENT5 SEGMENT5_DESCRIPTION "
    "DESCRIPTION CURRENCY_CODE POSTED_NUMBER AUTHOR_NAME REFERENCE2 DEBET CATEGORY_NAME TASK_NUMBER ORDER_NUMBER "
    "GEN_CONTRACT BI_DATA_TYPE BI_PROJECTS_DIRECTION BI_PROJECTS_TYPE BI_PL_ITEM"
).split()
_MONEY = ["SUM_OPER", "SUM_RUB", "RATE_USD_RUB", "AMOUNT_OLAP"]
_MOMENTS = ["ACCOUNTING_DATE", "PERIOD_OEBS", "PERIOD", "DOC_DATE"]
_ENTRY_COLUMNS = [*_TEXTS, *_MONEY, *_MOMENTS]


def _typed_sql(values: dict[str, str], relation: str, front: str) -> str:
    """Each column's value, or its class default: text '1', money 0, moments 1970-01-01."""
    columns = [f"COALESCE({values.get(c, 'NULL')}, '1') AS \"{c}\"" for c in _TEXTS]
    columns += [f"COALESCE(CAST({values.get(c, 'NULL')} AS DOUBLE), 0) AS \"{c}\"" for c in _MONEY]
    columns += [f"COALESCE({values.get(c, 'NULL')}, TIMESTAMP '1970-01-01') AS \"{c}\"" for c in _MOMENTS]
    return f"SELECT {front}, {', '.join(columns)} FROM {relation}"


_ISO = "STRFTIME(ts, '%Y-%m-%dT%H:%M:%S')"
_BROKEN = """CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN NULL
             WHEN event_type = 'click' THEN {day} ELSE {iso} END"""


@query(
    _typed_sql(
        {
            "ACCOUNTING_DATE": "CASE WHEN event_type NOT IN ('error', 'view', 'click') THEN DATE_TRUNC('second', ts) END",
            "SUM_RUB": "CASE WHEN event_type <> 'signup' THEN value END",
            "RATE_USD_RUB": "75.12345 || (user_id % 10)",
            "DESCRIPTION": "CASE WHEN event_type <> 'purchase' THEN event_type END",
            "SEGMENT1": "CASE WHEN user_id >= 50 THEN '0' || user_id END",
        },
        "events",
        "event_id",
    )
)
def typed_defaults(spark: SparkSession, sf: str) -> DataFrame:
    given = {
        "ACCOUNTING_DATE": _BROKEN.format(
            day="date_format(ts, 'yyyy-MM-dd')", iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
        ),
        "SUM_RUB": "CASE WHEN event_type = 'signup' THEN NULL ELSE value END",
        "RATE_USD_RUB": "concat('75.12345', user_id % 10)",
        "DESCRIPTION": "CASE WHEN event_type = 'purchase' THEN NULL ELSE event_type END",
        "SEGMENT1": "CASE WHEN user_id < 50 THEN NULL ELSE concat('0', user_id) END",
    }
    columns = {c: given.get(c, "CAST(NULL AS STRING)") for c in _ENTRY_COLUMNS}
    raw = project(table(spark, sf, "events"), {"event_id": "event_id", **columns})
    return raw.select("event_id", *[journal.typed_value(c) for c in _ENTRY_COLUMNS])


_ENTRY = {
    "SEGMENT1": "c_name",
    "SEGMENT2": "CASE WHEN c_nationkey > 12 THEN c_mktsegment END",
    "DESCRIPTION": "CONCAT('a <b> & \"c\" ', c_mktsegment)",
    "SUM_OPER": "CAST(CAST(c_acctbal AS DECIMAL(19,4)) AS STRING)",
    "SUM_RUB": "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(19,4)) AS STRING) END",
    "DOC_DATE": "CASE WHEN c_nationkey < 4 THEN 'soon' ELSE '2023-02-28T10:11:12' END",
    "BI_PL_ITEM": "CAST(c_custkey AS STRING)",
}
_ENTRY_SQL = _typed_sql(
    {n: f"TRY_CAST({e} AS TIMESTAMP)" if n in _MOMENTS else e.replace(" STRING)", " VARCHAR)") for n, e in _ENTRY.items()},
    "customer",
    "'00' AS \"ETL_LOG_ID\"",
)


@query(_ENTRY_SQL)
def xml_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as XML entries, read by row tag and schema, typed, staged, read back."""
    xml, staged = shared_folder(spark, "entries"), shared_folder(spark, "journal")
    columns = {c: _ENTRY.get(c, "CAST(NULL AS STRING)") for c in _ENTRY_COLUMNS} | {"REFERENCE2GUID": "c_name"}
    write_xml(project(table(spark, sf, "customer"), columns), xml, "JournalEntries", "JournalEntry")
    journal.stage(journal.read_entries(spark, xml, "JournalEntry"), staged)
    return read_relation(spark, staged).withColumn("ETL_LOG_ID", F.hex("ETL_LOG_ID"))


# Escaped brackets of a text are escaped twice in a response, and one level is taken off.
@query(_ENTRY_SQL.replace("a <b> &", "a &lt;b&gt; &"))
def journal_load(spark: SparkSession, sf: str) -> DataFrame:
    """Responses with one escaped entry each, loaded twice: the second load replaces the first."""
    escape = "replace(replace({0}, '<', '&lt;'), '>', '&gt;')"
    plain = "replace(replace(replace(CAST({0} AS STRING), '&', '&amp;'), '<', '&amp;lt;'), '>', '&amp;gt;')"
    tags = ", ".join(f"coalesce(concat('<{n}>', {plain.format(e)}, '</{n}>'), '')" for n, e in _ENTRY.items())
    body = f"concat('<JournalEntries><JournalEntry>', {tags}, '<REFERENCE2GUID>r</REFERENCE2GUID></JournalEntry></JournalEntries>')"
    responses = project(table(spark, sf, "customer"), {"response": f"concat('<soap>', {escape.format(body)}, '</soap>')"})
    staged = shared_folder(spark, "journal")
    for _ in range(2):
        journal.load(responses, "response", "JournalEntry", staged)
    return read_relation(spark, staged).withColumn("ETL_LOG_ID", F.hex("ETL_LOG_ID"))


@query(
    """
    SELECT c_name AS "A", CAST(c_custkey AS VARCHAR) AS "B" FROM customer
    UNION ALL SELECT c_mktsegment, NULL FROM customer
    """
)
def xml_escaped_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Responses that carry an escaped list of two entries each, one column dropped."""
    entries = (
        "concat('<soap>&lt;JournalEntries&gt;&lt;Entry&gt;&lt;A&gt;', c_name, '&lt;/A&gt;&lt;B&gt;', c_custkey, "
        "'&lt;/B&gt;&lt;R&gt;r&lt;/R&gt;&lt;/Entry&gt;&lt;Entry&gt;&lt;A&gt;', c_mktsegment, "
        "'&lt;/A&gt;&lt;/Entry&gt;&lt;/JournalEntries&gt;</soap>')"
    )
    responses = project(table(spark, sf, "customer"), {"response": entries})
    return escaped_xml(
        responses, "response", "JournalEntries", "Entry", "A string, B string, R string", drop=["R"]
    )
