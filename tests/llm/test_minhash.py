"""Near-duplicates against all pairs, and components against union-find."""

import itertools
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import minhash
from tidemark.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    """(n_shingles, component) by id; rows of one id count together for links."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def linked(a, b):
        return any(x and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])

    for a, b in itertools.combinations(sorted(sets), 2):
        if linked(a, b):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: ({len(x) for x in sets[i]}, root(i)) for i in sets}


def check(found, rows):
    got = found.collect()
    assert len(got) == len(rows)
    want = expected([r for r in rows if r[0] is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.n_shingles in want[r.doc_id][0] and r.component_id == want[r.doc_id][1], r
            assert r.kept == (r.doc_id == r.component_id)


@pytest.fixture(scope="module")
def family(spark):
    """A family of near copies with more and fewer edits, a shared passage, and short texts."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(150)] = f"e{rng.randrange(10_000)}"
        texts.append(" ".join(words))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10_000)}" for _ in range(rng.randrange(5, 90))) for _ in range(60)]
    texts += ["a b c", "A  B\tC", "a b c d", "", None, " "]
    return [(1000 - k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("settings", [minhash.Settings(), minhash.Settings(block_shingles=2000, task_shingles=3000)])
def test_family_against_all_pairs(spark, family, settings):
    frame = spark.createDataFrame(family, "doc_id long, text string")
    check(minhash.near_duplicates(frame, settings), family)


def test_odd_documents(odd_docs):
    check(minhash.near_duplicates(odd_docs), [(r.doc_id, r.text) for r in odd_docs.collect()])


def test_one_of_each_group_stays(odd_docs):
    kept = minhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 8, 9, 10]
    assert kept.filter("doc_id IS NULL").count() == 1


def words(*runs):
    return " ".join(f"{name}{k}" for name, n in runs for k in range(n))


# Two texts under id 5, one near 6's and one near 7's; ids 9 and 2 meet through the two texts of 8.
REPEATED = [
    (5, words(("a", 40))), (5, words(("b", 40))), (6, words(("a", 40), ("x", 2))), (7, words(("b", 40), ("y", 2))),
    (8, words(("c", 40))), (8, words(("d", 40))), (9, words(("c", 40), ("x", 1))), (2, words(("d", 40), ("y", 1))),
    (3, words(("e", 40))), (3, words(("f", 40))), (3, ""), (3, None), (4, ""), (8, ""),
]


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_ids_with_several_texts(spark, partitions):
    frame = spark.createDataFrame(REPEATED, "doc_id long, text string").repartition(partitions)
    check(minhash.near_duplicates(frame), REPEATED)
    kept = minhash.deduplicated(frame).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted(
        [(5, REPEATED[0][1]), (5, REPEATED[1][1]), (8, REPEATED[4][1]), (2, REPEATED[7][1]), (3, REPEATED[8][1]), (3, REPEATED[9][1]),
         (3, ""), (3, ""), (4, ""), (8, "")]
    )


@pytest.mark.parametrize("partitions", [1, 5])
def test_of_rows_equal_in_id_and_text_the_same_one_stays(spark, partitions):
    rows = [(1, words(("a", 30)), s) for s in ("z", "b", None, "c")] + [(2, words(("a", 30), ("b", 1)), "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    (row,) = minhash.deduplicated(frame).collect()
    assert (row.doc_id, row.source) == (1, "b")


def test_words_of_the_same_pieces_in_another_order(spark):
    """Words that a polynomial modulo 2^64 takes for one."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(k, " ".join([w] * 3 + ["x"] * 9)) for k, w in enumerate([word, other, word])]
    check(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    sets = list(minhash.shingle_sets(pa.array([word, other, word[:-8], "", word])))
    assert [len(s) for s in sets] == [1, 1, 1, 0, 1] and len({int(s[0]) for s in sets if len(s)}) == 3


def test_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.deduplicated(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    parent = {n: n for e in edges for n in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([*edges, (None, 3), edges[0]], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    real = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in real if root(n) != n}
    assert components(frame.filter(F.col("a") < -1)).count() == 0


def test_blocks_are_bounded_in_rows(spark, family):
    frame = spark.createDataFrame(family, "doc_id long, text string")
    check(minhash.near_duplicates(frame, minhash.Settings(block_rows=8, cells=100)), family)


@pytest.mark.parametrize("two", [False, True])
def test_memory_of_many_short_variants(two):
    """A template of 24 words whose variants differ in the last: no matrix of all pairs is built."""
    n, template = 8000, " ".join(f"t{k}" for k in range(23))
    sets = list(minhash.shingle_sets(pa.array([f"{template} v{k}" for k in range(n)])))
    side = np.arange(n) % 2 if two else None
    tracemalloc.start()
    links = minhash._links(np.arange(n), side, sets, minhash.Settings())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len({x for pair in links for x in pair}) == n and len(links) == n - 1
    assert peak < 300e6
