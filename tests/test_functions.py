"""Examples worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.fixed_values import NO_PREFIX, OTHER_PRODUCTS_LABEL, PRODUCT_TYPE_LABELS
from tidemark.functions import dates, defaults, text
from tidemark.operators.aggregates import keys_where, pivot_max, restrict, summarize
from tidemark.operators.packing import pack_attributes, pack_measures, split_columns, unpivot_text
from tidemark.operators.periods import month_slices, month_spine, open_period, widen_period
from tidemark.plans.dimensions import valid_at
from tidemark.plans.journal import typed_value


def values(spark, build, inputs, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r.out for r in rows.select("i", build(F.col("c")).alias("out")).orderBy("i").collect()]



def test_code_prefixes(spark):
    codes = ["A", ".x", "TEC.1", "tec.1", None, "PLF.a.b", ""]
    assert values(spark, lambda c: text.prefix_or_fallback(c, NO_PREFIX), codes) == [
        "BPR", "BPR", "TEC", "tec", "BPR", "PLF", "BPR",
    ]
    assert values(spark, lambda c: text.prefix(c), codes) == ["A", "", "TEC", "tec", None, "PLF", ""]
    other = OTHER_PRODUCTS_LABEL
    labels = lambda c: defaults.label(F.upper(text.prefix(c)), PRODUCT_TYPE_LABELS, other)
    assert values(spark, labels, ["tec.1", "SRV", "x", None]) == [
        PRODUCT_TYPE_LABELS["TEC"], PRODUCT_TYPE_LABELS["SRV"], other, other,
    ]


def test_defaults(spark):
    assert values(spark, lambda c: defaults.or_default(c, 0), [None, 3], "int") == [0, 3]
    assert values(spark, lambda c: defaults.zero_to_null(c), [0, 3, None], "int") == [None, 3, None]
    assert values(spark, lambda c: defaults.name_of_code(c, F.lit("n")), [0, 3, None], "int") == [None, "n", None]
    assert values(spark, lambda c: defaults.label(c, {1: "one"}), [1, 2], "int") == ["one", None]


def test_concatenation(spark):
    assert values(spark, lambda c: text.join_nulls_empty(c, F.lit("/"), F.lit("1")), ["a", None]) == ["a/1", "/1"]
    assert values(spark, lambda c: text.join_nulls_win(c, F.lit("/"), F.lit("1")), ["a", None]) == ["a/1", None]


def test_none_text(spark):
    assert values(spark, lambda c: text.none_text_to_int(c), ["None", "12", None]) == [0, 12, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, lambda c: text.none_text_to_int(c), ["x"])


def test_text_for_packing(spark):
    spaces = {
        "a \t\n b": "a b",
        "a\\nb": "a b",
        "a \\n b": "a   b",
        "a\u00a0 \u2003b": "a b",
        "a\u2003b": "a b",
        "a\tb": "a b",
        "a\x1cb": "a b",
        " a ": " a ",
        "a b": "a b",
    }
    assert values(spark, lambda c: text.collapse_space(c), list(spaces)) == list(spaces.values())
    assert values(spark, lambda c: text.escape_quotes(c), ['say "x"', "plain"]) == ['say \\"x\\"', "plain"]
    assert values(spark, lambda c: text.number_text(c), ["1,5", None, "2"]) == ["1.5", "null", "2"]
    assert len(values(spark, lambda c: text.cut(c, 4000), ["x" * 5000])[0]) == 4000


def test_doubles_print_in_full(spark):
    numbers = [0.00004, 1.23456789, 206060005.0, 1e35, -1.5e-7, 123456789.125, 1e7, 0.0, float("nan"), None, -2.5]
    assert values(spark, lambda c: text.plain_number(c), numbers, "double") == [
        "0.00004", "1.23456789", "206060005.0", "1" + "0" * 35 + ".0", "-0.00000015", "123456789.125", "10000000.0",
        "0.0", None, None, "-2.5",
    ]


def test_key_uuid_depends_on_the_key_alone(spark):
    a, b, c = values(spark, lambda c: text.key_uuid(c), ["P-1", "P-1", "P-2"])
    assert a == b != c
    assert [len(p) for p in a.split("-")] == [8, 4, 4, 4, 12]


def test_calendar(spark):
    days = [date(2023, 11, 15), date(2024, 1, 31), date(2023, 2, 28)]
    assert values(spark, lambda c: dates.plus_months(c, 2), days, "date") == [date(2024, 1, 15), date(2024, 3, 31), date(2023, 4, 28)]
    assert values(spark, lambda c: dates.plus_months(c, 1), days, "date")[1] == date(2024, 2, 29)
    assert values(spark, lambda c: dates.first_of_month(c), days, "date")[0] == date(2023, 11, 1)
    assert values(spark, lambda c: dates.first_of_year(c), days, "date")[0] == date(2023, 1, 1)
    assert values(spark, lambda c: dates.last_of_month(c), days, "date") == [date(2023, 11, 30), date(2024, 1, 31), date(2023, 2, 28)]
    assert values(spark, lambda c: dates.calendar_months(c, F.lit("2024-02-01").cast("date")), days, "date") == [3, 1, 12]
    moment = [datetime(2024, 5, 6, 7, 8, 9, 123456)]
    assert values(spark, lambda c: dates.to_minute(c), moment, "timestamp_ntz") == [datetime(2024, 5, 6, 7, 8)]
    assert values(spark, lambda c: dates.timestamp_text(c), moment, "timestamp_ntz") == ["2024-05-06 07:08:09.123"]
    assert values(spark, lambda c: dates.timestamp_text(c), [date(2020, 1, 2), None], "date") == ["2020-01-02", None]


def test_unparsable_dates_are_the_epoch(spark):
    inputs = ["2023-02-28T10:11:12", "2023-02-29T10:11:12", "2023-02-28", "n/a", None, "2023-02-28T10:11:12Z"]
    epoch = datetime(1970, 1, 1)
    expected = [datetime(2023, 2, 28, 10, 11, 12), epoch, epoch, epoch, epoch, epoch]
    assert values(spark, lambda c: dates.parse_or_epoch(c), inputs) == expected
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = values(spark, lambda c: dates.parse_or_epoch(c), ["2023-03-12T02:30:00"])
        assert gap == [datetime(2023, 3, 12, 2, 30)]
        assert values(spark, lambda c: dates.to_minute(c), [datetime(2023, 3, 12, 2, 30, 5)], "timestamp_ntz") == gap
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_day_first_dates(spark):
    inputs = ["05.02.2023", "5.2.2023", "31.02.2023", "2023", "soon", None]
    assert values(spark, lambda c: dates.day_first_to_iso(c), inputs) == [
        "2023-02-05", "2023-02-05", "31.02.2023", "2023", "soon", None,
    ]


def test_journal_classes(spark):
    rows = spark.createDataFrame(
        [("1.23456", "x", "2023-01-02T03:04:05", "007"), (None, None, None, None)],
        "SUM_RUB string, DESCRIPTION string, DOC_DATE string, SEGMENT1 string",
    ).select(*[typed_value(c) for c in ("SUM_RUB", "DESCRIPTION", "DOC_DATE", "SEGMENT1")])
    assert [tuple(r) for r in rows.collect()] == [
        (1.23456, "x", datetime(2023, 1, 2, 3, 4, 5), "007"),
        (0.0, "1", datetime(1970, 1, 1), "1"),
    ]


def test_month_spine_crosses_the_year(spark):
    period = spark.createDataFrame([(date(2023, 11, 15), date(2024, 2, 10))], "date_from date, date_to date")
    assert widen_period(period).first() == (date(2023, 11, 1), date(2024, 2, 29))
    months = [tuple(r) for r in month_spine(period).orderBy("date_from").collect()]
    assert months == [
        (date(2023, 11, 1), date(2023, 11, 30)),
        (date(2023, 12, 1), date(2023, 12, 31)),
        (date(2024, 1, 1), date(2024, 1, 31)),
        (date(2024, 2, 1), date(2024, 2, 29)),
    ]


def test_open_period_after_november(spark):
    closed = spark.createDataFrame([(date(2023, 10, 1),), (date(2023, 12, 1),)], "m date")
    assert open_period(closed, "m").first() == (date(2024, 1, 1), date(2024, 1, 31), date(2024, 1, 1))
    assert open_period(closed.limit(0), "m").first() == (None, None, None)


def test_month_slices_take_the_last_day_whole(spark):
    rows = spark.createDataFrame(
        [(datetime(2023, 10, 31, 23, 59),), (datetime(2023, 11, 1),), (datetime(2023, 12, 31, 23, 59),), (datetime(2024, 1, 1),)],
        "t timestamp_ntz",
    )
    got = month_slices(rows, F.col("t"), datetime(2023, 11, 20), datetime(2023, 12, 2)).orderBy("t").collect()
    assert [r.month for r in got] == [date(2023, 11, 1), date(2023, 12, 1)]


def test_validity_bounds(spark):
    now, none = datetime(2024, 1, 1), datetime(1900, 1, 1)
    early, late = datetime(2023, 1, 1), datetime(2025, 1, 1)
    cases = {
        (None, None): True,
        (none, none): True,
        (early, late): True,
        (now, now): True,
        (late, None): False,
        (None, early): False,
        (late, early): False,
    }
    rows = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, h timestamp_ntz, f timestamp_ntz")
    kept = {r.i for r in rows.filter(valid_at(now, F.col("h"), F.col("f"))).collect()}
    assert kept == {i for i, ok in enumerate(cases.values()) if ok}


def test_pivot_and_summaries(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, "z", "q"), (2, "b", None)], "id int, c string, v string")
    assert sorted(map(tuple, pivot_max(rows, ["id"], "c", "v", ["a", "b"]).collect())) == [(1, "y", None), (2, None, None)]
    facts = spark.createDataFrame([("p", 1, None), ("p", 2, 5), ("q", 1, None), (None, 1, 3)], "k string, n int, m int")
    sums = summarize(facts, ["k"], {"[m]": F.sum("m")}).collect()
    assert sorted(map(tuple, sums), key=str) == [("p", 5), (None, 3)]
    keys = keys_where(facts, "k", {"s": F.sum("n")}, F.col("s") > 1)
    assert [tuple(r) for r in keys.collect()] == [("p",)]
    assert restrict(facts, keys, keys).count() == 2


def test_packing(spark):
    acts = spark.createDataFrame(
        [("P \t1", 'a "b"', "05.02.2023", Decimal("10.50"), None, 206060005.0)],
        "`T[Code]` string, `T[Text]` string, `T[Day]` string, `[Sum]` decimal(10,2), `[No]` int, `[Big]` double",
    )
    attributes, measures = split_columns(acts.columns)
    row = acts.select(
        pack_attributes(attributes, ["T[Day]"]).alias("a"), pack_measures(acts, measures).alias("m")
    ).first()
    assert row.a == (
        '[{"Attribute": "T[Code]", "value": "P 1"}, {"Attribute": "T[Text]", "value": "a \\"b\\""}, '
        '{"Attribute": "T[Day]", "value": "2023-02-05"}]'
    )
    assert row.m == (
        '[{"Measure": "[Sum]", "value": 10.50}, {"Measure": "[No]", "value": null}, '
        '{"Measure": "[Big]", "value": 206060005.0}]'
    )


def test_packing_agrees_with_the_long_form(spark):
    """Row-local packing gives what unpivot, sort and group would give."""
    rows = spark.createDataFrame([(1, "x", "y"), (2, None, "z")], "id int, b string, a string")
    long = unpivot_text(rows, ["id"], ["b", "a"]).withColumn("at", F.when(F.col("variable") == "b", 0).otherwise(1))
    element = F.concat(
        F.lit('{"Attribute": "'), "variable", F.lit('", "value": "'), F.coalesce("value", F.lit("null")), F.lit('"}')
    )
    grouped = long.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", element.alias("e")))).alias("l"))
    text_by_id = {r.id: r.t for r in grouped.selectExpr("id", "'[' || array_join(l.e, ', ') || ']' AS t").collect()}
    packed = {r.id: r.t for r in rows.select("id", pack_attributes(["b", "a"]).alias("t")).collect()}
    assert packed == text_by_id
