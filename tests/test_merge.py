"""The merge family on small frames, against a row-by-row model."""

import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import (
    MergeSpec,
    filled,
    filled_null_equal,
    keyed_upsert,
    merge,
    merge_with_actions,
    null_equal,
    raw,
    require_unique,
    soft_delete_absent,
)
from tidemark.sources.tables import write_bucketed

NOW = datetime(2024, 1, 1)
OLD = datetime(2020, 1, 1)
TARGET = "k int, v string, IS_DELETED int, DELETED_AT timestamp_ntz, UPDATED_AT timestamp_ntz"
SOFT = dict(absent="soft", deleted_flag="IS_DELETED", deleted_at="DELETED_AT", updated_at="UPDATED_AT")


def spec(rule, **more):
    return MergeSpec(keys=["k"], columns={"v": rule}, **{**SOFT, **more})


def run(spark, target, source, merge_spec):
    t = spark.createDataFrame(target, TARGET)
    s = spark.createDataFrame(source, "k int, v string")
    rows = merge_with_actions(t, s, merge_spec, NOW).collect()
    return {r.k: r for r in rows}


def live(k, v):
    return (k, v, 0, None, None)


RULES = {"raw": raw(), "filled": filled(""), "null_equal": null_equal(""), "filled_null_equal": filled_null_equal("")}
# (source, target) pairs each rule sees as a change
PLAIN = {("x", "y"), ("x", ""), ("", "x"), ("", "y")}
SOURCE_NULL_IS_EMPTY = {(None, "x"), (None, "y")}
CHANGES = {
    "raw": PLAIN,
    "filled": PLAIN | SOURCE_NULL_IS_EMPTY,
    "null_equal": PLAIN | SOURCE_NULL_IS_EMPTY | {("x", None)},
    "filled_null_equal": PLAIN | SOURCE_NULL_IS_EMPTY | {("x", None)},
}


@pytest.mark.parametrize("rule", RULES)
def test_null_pairings(spark, rule):
    pairs = list(itertools.product([None, "", "x"], [None, "", "x", "y"]))
    out = run(
        spark,
        [live(i, t) for i, (_, t) in enumerate(pairs)],
        [(i, s) for i, (s, _) in enumerate(pairs)],
        spec(RULES[rule]),
    )
    for i, (s, t) in enumerate(pairs):
        changed = (s, t) in CHANGES[rule]
        assert out[i].merge_action == ("update" if changed else "keep"), (rule, s, t)
        written = "" if s is None and RULES[rule].fill is not None else s
        assert out[i].v == (written if changed else t)
        assert out[i].UPDATED_AT == (NOW if changed else None)


def test_delete_guard_and_reactivation(spark):
    out = run(
        spark,
        [
            live(1, "a"),
            (2, "a", 1, OLD, OLD),
            (3, "a", 1, OLD, OLD),
            (4, "a", 0, OLD, None),
            (5, "a", None, None, None),
        ],
        [(3, "a"), (4, "a"), (6, None)],
        spec(raw()),
    )
    assert (out[1].merge_action, out[1].IS_DELETED, out[1].DELETED_AT, out[1].UPDATED_AT) == ("delete", 1, NOW, NOW)
    assert (out[2].merge_action, out[2].DELETED_AT) == ("keep", OLD)
    assert (out[3].merge_action, out[3].IS_DELETED, out[3].DELETED_AT) == ("update", 0, None)
    assert (out[4].merge_action, out[4].DELETED_AT) == ("update", None)
    assert out[5].merge_action == "keep"
    assert (out[6].merge_action, out[6].IS_DELETED, out[6].UPDATED_AT) == ("insert", 0, None)


@pytest.mark.parametrize("absent", ["soft", "hard", "keep"])
def test_the_join_taken_apart_gives_the_same_rows(spark, absent):
    rng = random.Random(4)
    t = spark.createDataFrame([live(k, rng.choice("abc")) for k in range(0, 60, 2)], TARGET)
    s = spark.createDataFrame([(k, rng.choice(["a", "b", None])) for k in range(0, 60, 3)], "k int, v string")
    apart, once = (
        sorted(map(tuple, merge_with_actions(t, s, spec(null_equal(""), absent=absent, unique_target=u), NOW).collect()), key=str)
        for u in (False, True)
    )
    assert apart == once and len(once) > 19


def test_target_keys_that_repeat_or_are_null(spark):
    t = spark.createDataFrame([live(1, "a"), live(1, "b"), live(None, "c"), live(None, "d"), live(2, "e")], TARGET)
    s = spark.createDataFrame([(1, "b"), (3, "f")], "k int, v string")
    got = merge_with_actions(t, s, spec(raw(), unique_target=False), NOW).collect()
    assert sorted((r.k or 0, r.v, r.merge_action) for r in got) == [
        (0, "c", "delete"), (0, "d", "delete"), (1, "b", "keep"), (1, "b", "update"), (2, "e", "delete"), (3, "f", "insert"),
    ]
    for rows in ([live(1, "a"), live(1, "b")], [live(None, "c")]):
        with pytest.raises(Exception, match="merge key"):
            merge(spark.createDataFrame(rows, TARGET), s, spec(raw()), NOW).collect()


def test_rows_deleted_for_good_can_be_told(spark):
    t = spark.createDataFrame([live(1, "a"), live(2, "b")], TARGET)
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    hard = spec(raw(), absent="hard")
    assert [r.merge_action for r in merge_with_actions(t, s, hard, NOW).collect()] == ["keep"]
    for unique in (True, False):
        told = merge_with_actions(t, s, spec(raw(), absent="hard", unique_target=unique), NOW, removed=True)
        assert {(r.k, r.merge_action) for r in told.collect()} == {(1, "keep"), (2, "remove")}


def test_second_run_keeps_everything(spark):
    t = spark.createDataFrame([live(1, "a"), live(2, "b")], TARGET)
    s = spark.createDataFrame([(2, "c"), (3, None)], "k int, v string")
    for rule in RULES.values():
        once = merge(t, s, spec(rule), NOW)
        again = merge_with_actions(once, s, spec(rule), datetime(2025, 1, 1))
        assert {r.merge_action for r in again.collect()} == {"keep"}
        assert sorted(again.drop("merge_action").collect()) == sorted(once.collect())


def test_empty_sides(spark):
    assert run(spark, [live(1, "a")], [], spec(raw()))[1].merge_action == "delete"
    assert run(spark, [], [(1, "a")], spec(raw()))[1].merge_action == "insert"


@pytest.mark.parametrize("source", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_bad_source_keys_fail(spark, source):
    with pytest.raises(Exception, match="merge key"):
        run(spark, [live(2, "a")], source, spec(raw()))


def test_bad_keys_fail_even_if_no_column_is_read(spark):
    t = spark.createDataFrame([live(1, "a")], TARGET)
    s = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate merge key: 1"):
        merge(t, s, spec(raw()), NOW).count()


def test_a_key_repeated_a_million_times_is_cut_before_the_shuffle(spark):
    hot = spark.range(1_000_000).selectExpr("int(id DIV 10000000) AS k", "'a' AS v")
    plan = require_unique(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle
    with pytest.raises(Exception, match="duplicate merge key: 0"):
        require_unique(hot, ["k"]).count()


def test_hard_delete_drops_absent_rows(spark):
    hard = MergeSpec(keys=["k"], columns={"v": raw()}, absent="hard", updated_at="UPDATED_AT")
    out = run(spark, [live(1, "a"), live(2, "a")], [(2, "b"), (3, "c")], hard)
    assert {k: r.merge_action for k, r in out.items()} == {2: "update", 3: "insert"}


def test_update_only_ignores_new_rows(spark):
    update = MergeSpec(keys=["k"], columns={"v": null_equal("")}, insert=False, updated_at="UPDATED_AT")
    out = run(spark, [live(1, "a"), live(2, None)], [(1, "b"), (2, ""), (3, "c")], update)
    assert {k: r.merge_action for k, r in out.items()} == {1: "update", 2: "keep"}


def test_insert_only_column_and_defaults(spark):
    t = spark.createDataFrame([(1, 10, "a", None)], "k int, id int, v string, origin string")
    s = spark.createDataFrame([(1, 99, "b"), (2, 98, "c")], "k int, id int, v string")
    m = MergeSpec(keys=["k"], columns={"v": raw()}, insert_only=["id"], on_insert={"origin": "it's new"})
    assert sorted(merge(t, s, m, NOW).collect()) == [(1, 10, "b", None), (2, 98, "c", "it's new")]


def test_always_overwrites(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(1, "a"), (3, None)], "k int, v string")
    m = MergeSpec(keys=["k"], columns={"v": raw()}, always=True)
    got = {r.k: r.merge_action for r in merge_with_actions(t, s, m, NOW).collect()}
    assert got == {1: "update", 2: "keep", 3: "insert"}


def test_keyed_upsert(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "p int, a int, v string")
    s = spark.createDataFrame([("z", 2, 1), (None, 1, 3)], "v string, a int, p int")
    assert sorted(keyed_upsert(t, s, ["p", "a"]).collect(), key=str) == sorted(
        [(1, 1, "a"), (1, 2, "z"), (3, 1, None)], key=str
    )
    with pytest.raises(Exception, match="duplicate merge key"):
        keyed_upsert(t, s.union(s), ["p", "a"]).collect()


def test_soft_delete_absent(spark):
    t = spark.createDataFrame(
        [(1, None, None), (2, None, None), (3, OLD, OLD)], "k int, deleted_at timestamp_ntz, updated_at timestamp_ntz"
    )
    seen = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out = {r.k: (r.deleted_at, r.updated_at) for r in soft_delete_absent(t, seen, ["k"], NOW).collect()}
    assert out == {1: (None, None), 2: (NOW, NOW), 3: (OLD, OLD)}


def test_specs_that_make_no_sense_are_refused():
    with pytest.raises(ValueError):
        MergeSpec(keys=["k"], columns={}, absent="gone")
    with pytest.raises(ValueError):
        MergeSpec(keys=["k"], columns={}, absent="soft")
    with pytest.raises(ValueError):
        MergeSpec(keys=["k"], columns={}, absent="hard", insert=False)


def test_random_rows_against_a_row_by_row_model(spark):
    """Two-column key, three columns under three rules, every mix of NULLs and audit states."""
    rng = random.Random(7)
    texts, numbers = [None, "", "x", "y"], [None, 0, 1]

    def row():
        return rng.choice(texts), rng.choice(numbers), rng.choice(texts)

    keys = [(i, j) for i in range(40) for j in range(20)]
    target = {k: (*row(), *rng.choice([(0, None), (1, OLD), (0, OLD), (None, None)])) for k in keys if rng.random() < 0.7}
    source = {k: row() for k in keys if rng.random() < 0.7}
    rules = {"a": raw(), "b": filled(0), "c": filled_null_equal("")}
    merge_spec = MergeSpec(
        keys=["i", "j"], columns=rules, absent="soft", deleted_flag="IS_DELETED", deleted_at="DELETED_AT"
    )

    expected = {}
    for k in set(target) | set(source):
        if k not in source:
            a, b, c, flag, at = target[k]
            gone = flag == 0
            expected[k] = (a, b, c, 1 if gone else flag, NOW if gone else at)
            continue
        new = tuple(r.fill if v is None and r.fill is not None else v for v, r in zip(source[k], rules.values()))
        if k not in target:
            expected[k] = (*new, 0, None)
            continue
        *old, flag, at = target[k]
        differs = [
            (r.null_as if n is None else n) != (r.null_as if o is None else o)
            if r.null_as is not None
            else n is not None and o is not None and n != o
            for n, o, r in zip(new, old, rules.values())
        ]
        if flag == 1 or at is not None or any(differs):
            expected[k] = (*new, 0, None)
        else:
            expected[k] = target[k]

    t = spark.createDataFrame(
        [(*k, *v) for k, v in target.items()],
        "i int, j int, a string, b int, c string, IS_DELETED int, DELETED_AT timestamp_ntz",
    )
    s = spark.createDataFrame([(*k, *v) for k, v in source.items()], "i int, j int, a string, b int, c string")
    got = {(r.i, r.j): tuple(r)[2:] for r in merge(t, s, merge_spec, NOW).collect()}
    assert got == expected


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_merge_shuffles_each_side_once(spark, tmp_path):
    spark.range(1000).selectExpr("int(id) k", "string(id) v", "0 IS_DELETED").withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("DELETED_AT", "UPDATED_AT")}
    ).write.parquet(f"{tmp_path}/t")
    spark.range(1000).selectExpr("int(id) k", "string(id + 1) v").write.parquet(f"{tmp_path}/s")
    t, s = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    assert _exchanges(merge(t, s, spec(raw()), NOW)) == 2


def test_a_bucketed_target_is_not_shuffled(spark, tmp_path):
    t = spark.range(1000).selectExpr("int(id) k", "string(id) v", "0 IS_DELETED").withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("DELETED_AT", "UPDATED_AT")}
    )
    spark.sql("DROP TABLE IF EXISTS bucketed_target")
    bucketed = write_bucketed(t, "bucketed_target", f"{tmp_path}/b", ["k"], 8)
    spark.range(1000).selectExpr("int(id + 1) k", "string(id) v").write.parquet(f"{tmp_path}/s")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        merged = merge_with_actions(bucketed, spark.read.parquet(f"{tmp_path}/s"), spec(raw()), NOW)
        assert _exchanges(merged) == 1
        counts = {r.merge_action: r["count"] for r in merged.groupBy("merge_action").count().collect()}
        assert counts == {"insert": 1, "delete": 1, "update": 999}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("DROP TABLE bucketed_target")
