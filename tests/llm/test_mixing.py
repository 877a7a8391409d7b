"""Targets against the rule told step by step, words taken, reruns."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing


def targets(sizes):
    """Shares by weight, what exceeds three times a source's size reshared until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        shares = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if shares[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **shares}
        fixed.update({s: 3 * sizes[s] for s in over})


@pytest.fixture(scope="module")
def uneven(spark):
    rows, k = [], 0
    for source, n, size in (("a", 400, 30), ("B", 5, 400), ("é", 60, 11), (None, 90, 7), ("z", 3, 2), ("", 40, 50), ("big", 2, 9000)):
        for i in range(n):
            rows.append((k, " ".join(["w"] * (size + i % 17)), source))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_words(uneven):
    rows = mixing.mixture(uneven).collect()
    assert len(rows) == uneven.count() and all(0 <= r.copies <= 3 for r in rows)
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
    want = targets(sizes)
    assert {r.source: r.source_size for r in rows} == sizes
    for r in rows:
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
    for source in sizes:
        smallest = min(r.size for r in rows if r.source == source)
        assert abs(taken[source] - want[source]) <= smallest + 1e-6 * want[source], source


def test_rates_solve_the_balance(uneven):
    settings = mixing.Settings()
    entries = mixing.sized(uneven).select("doc.doc_id", "doc.source", "size", F.lit(1).cast("long").alias("n"))
    goals = mixing.multipliers(entries, mixing.targets(entries, settings), settings)
    rated = entries.join(goals.withColumnRenamed("source", "s"), F.expr("source <=> s")).withColumn("rate", mixing._rate(settings))
    for r in rated.groupBy("grp").agg(F.sum(F.col("rate") * F.col("size")).alias("w"), F.first("target").alias("t"), F.max("rate").alias("m")).collect():
        assert r.w == pytest.approx(r.t, rel=1e-5) and r.m <= 3


def test_reruns_agree(uneven):
    once, again = (sorted(map(tuple, mixing.mixture(uneven.repartition(n)).collect()), key=str) for n in (2, 7))
    assert once == again


def test_large_sources_are_dealt_to_groups(uneven):
    rows = mixing.mixture(uneven, mixing.Settings(group_rows=50)).filter("source = 'a'").collect()
    assert sum(r.size * r.copies for r in rows) == pytest.approx(rows[0].target, rel=0.02)


def test_odd_documents(odd_docs, no_docs):
    rows = mixing.mixture(odd_docs).collect()
    assert sum(r.n for r in rows) == 12 and {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r.n * r.copies for r in rows)
    assert mixing.mixture(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


@pytest.mark.parametrize("texts", ["one", "several"])
def test_rows_without_an_id_share_their_copies(spark, texts):
    """A hundred rows of a null id, equal or not: their words come near the target all the same."""
    rows = [(None, "w w w w w" + (f" v{k}" if texts == "several" else " v"), "a", k) for k in range(100)]
    rows += [(k, "x " * 10, "b", k) for k in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, place int")
    mix = mixing.mixture(frame).collect()
    assert sum(r.n for r in mix) == 200
    for source in "ab":
        own = [r for r in mix if r.source == source]
        assert abs(sum(r.size * r.n * r.copies for r in own) - own[0].target) <= 10
    if texts == "one":
        assert len({r.copies for r in mix if r.source == "a"}) == 2
    taken = mixing.mixed(frame).groupBy("source").agg(F.count("*").alias("n"), F.sum(F.size(F.split("text", " "))).alias("w")).collect()
    for r in taken:
        assert r.n == sum(m.n * m.copies for m in mix if m.source == r.source)


def test_many_sources_over_many_ranges(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {
        "spark.sql.shuffle.partitions": "300", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sources = spark.range(3000).selectExpr("id AS doc_id", "concat('s', lpad(string(id), 5, '0')) AS source", "id % 7 + 1 AS size", "1L AS n")
        got = mixing.targets(sources, mixing.Settings()).orderBy("source").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.grp for r in got] == list(range(3000))
    want = targets({r.source: r.source_size for r in got})
    assert all(r.target == pytest.approx(want[r.source], rel=1e-9) for r in got)


def test_a_mix_that_does_not_converge_fails(uneven):
    with pytest.raises(RuntimeError, match="after 1 steps"):
        mixing.mixture(uneven, mixing.Settings(most_steps=1)).count()
