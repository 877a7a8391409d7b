"""Links and components against brute force."""

import numpy as np
import pytest

from tidemark.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, n int"


def brute(rows, cosine=0.93):
    """(links, component) by place."""
    unit = []
    for i, v, label, *_ in rows:
        good = i is not None and label is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)
        x = np.array(v, float) if good else None
        unit.append(x / np.linalg.norm(x) if good else None)
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is None or unit[b] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]):
                continue
            if unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if unit[k] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return links, [least.get(root(k), r[0]) for k, r in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for k in range(60):
        base = rng.standard_normal(32)
        for _ in range(rng.integers(1, 9)):
            noisy = base + rng.standard_normal(32) * rng.choice([0, 0.05, 0.1, 0.2])
            out.append((len(out), [float(np.float32(x)) for x in noisy * rng.choice([1, 1, 3])], int(k % 3), "r", 1))
    return out


@pytest.mark.parametrize("settings", [embedding_dedup.Settings(), embedding_dedup.Settings(block_rows=2, task_rows=50)])
def test_recall_and_components(spark, rows, settings):
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), settings).collect()}
    links, component = brute(rows)
    assert len(got) == len(rows)
    found = [got[r[0]].n_links for r in rows]
    assert all(f <= w for f, w in zip(found, links)) and sum(found) >= 0.97 * sum(links) > 0
    same = sum(got[r[0]].component_id == c for r, c in zip(rows, component))
    assert same >= 0.97 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.0], 1),
        (11, [1.0, 0.0, 0.0], 1), (12, [1e-30, 0.0], 1), (13, [3e38, 0.0], 1),
    ]
    rows = [(*r, "r", 1) for r in rows]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    links, component = brute(rows)
    want = sorted(((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, component)), key=str)
    assert got == want


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_ids_of_several_vectors(spark, partitions):
    """Id 5 under two labels and with two vectors of one label, each with neighbours of its own."""
    rows = [
        (5, [1.0, 0.0, 0.0], 1), (6, [1.0, 0.01, 0.0], 1), (5, [0.0, 1.0, 0.0], 2), (7, [0.0, 1.0, 0.01], 2), (4, [0.0, 1.0, 0.02], 2),
        (5, [0.0, 0.0, 1.0], 1), (8, [0.01, 0.0, 1.0], 1), (9, [0.02, 0.0, 1.0], 1), (8, [0.0, 0.0, 2.0], 1), (5, [0.0, 0.0, 1.0], 3),
    ]
    rows = [(*r, "r", 1) for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect())
    links, component = brute(rows)
    assert got == sorted((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, component))
    assert {r[1] for r in got if r[0] == 5} == {0, 1, 2, 3}


def test_nothing(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("norm", [0.75, 0.84, 0.97])
def test_recall_with_a_common_mean(spark, norm):
    """Families of five at cosine 0.94 whose vectors share a direction, up to where all pairs link."""
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    inner = (0.94 - norm**2) / (1 - norm**2)
    shared, own = unit(rng.standard_normal((120, 1, 64))), unit(rng.standard_normal((120, 5, 64)))
    away = np.sqrt(max(inner, 0)) * shared + np.sqrt(1 - max(inner, 0)) * own
    vectors = (norm * unit(np.ones(64)) + np.sqrt(1 - norm**2) * unit(away)).reshape(-1, 64)
    rows = [(k, [float(np.float32(x)) for x in v], k // 5 % 2, "r", 1) for k, v in enumerate(vectors)]
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    links, _ = brute(rows)
    assert all(got[k] <= n for k, n in enumerate(links)) and sum(got.values()) >= 0.9 * sum(links) > 0


def test_bits_follow_the_largest_label():
    bits = embedding_dedup.bits_for
    assert [bits(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 10**9, 10**12)] == [16, 16, 16, 17, 30, 30]


@pytest.mark.parametrize("bits", [16, 22])
def test_the_share_of_pairs_that_meet(bits):
    """Tables are added as they get longer; pairs at the threshold meet and lie within the Hamming limit."""
    rng = np.random.default_rng(9)
    unit = rng.standard_normal((3000, 48))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes = embedding_dedup.learned(unit[:2000], embedding_dedup.Settings(), bits)
    away = rng.standard_normal((1000, 48))
    away -= (away * unit[2000:]).sum(axis=1, keepdims=True) * unit[2000:]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    a, b = unit[2000:], 0.93 * unit[2000:] + np.sqrt(1 - 0.93**2) * away
    assert codes.parts(a).shape[1] * bits == codes.maps.shape[1] and codes.parts(a).max() < 1 << bits
    assert (codes.parts(a) == codes.parts(b)).any(axis=1).mean() >= 0.93
    apart = (codes.signs(a) != codes.signs(b)).sum(axis=1)
    assert (apart <= codes.limit).all() and codes.limit < 0.35 * codes.maps.shape[1]


def test_one_list_of_many_near_vectors(spark):
    """A label that holds one family only: each vector links to all others, in blocks and in strips."""
    rng = np.random.default_rng(10)
    base = rng.standard_normal(32)
    rows = [(k, [float(x) for x in base + 0.02 * rng.standard_normal(32)], 1, "r", 1) for k in range(400)]
    settings = embedding_dedup.Settings(block_rows=60, task_rows=100, pairs_at_once=500)
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), settings).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(399, 0)}


def test_few_vectors_in_double_precision(spark):
    rows = [(1, [1.0, 0.1, 0.0], 1), (2, [1.0, 0.1, 0.05], 1), (3, [0.0, 1.0, 0.0], 1), (4, [1e300, 1e299, 0.0], 1), (5, [1.0, 0.0], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (2, 1), 5: (0, 5)}
