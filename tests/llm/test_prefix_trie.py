"""The prefix trie against SQL, and against plain dictionaries on odd input."""

import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie
from tidemark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn int, role string, text string, rep long, node string, depth int, part int, words string, e string"
EXTRA = (9, "n", 3, 4, "w", "e")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def conversations(rows):
    """conv_id -> its turns (role, text) in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in out.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 4
        # As SQL has it, the remainder of a negative id is negative.
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    return out


def plain_nodes(seqs):
    """Every prefix with its figures, one dictionary at a time."""
    members, ends = {}, {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def words(p):
        return len(WORD.findall(p[-1][1])) if p else 0

    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = (len(members[p]) - 1) * words(p) + sum(saved[k] for k in below)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids.get(p, [])), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def nodes(found):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in found.collect())


def trie(spark, rows, branch=False, settings=prefix_trie.Settings()):
    numbered = prefix_trie.numbered(frame(spark, rows))
    if branch:
        return nodes(prefix_trie.trie(*prefix_trie.branched(numbered), settings))
    return nodes(prefix_trie.trie(numbered, numbered.select("conv_id").distinct(), settings))


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "a long, b long").withColumn("f", prefix_trie.two_fattest(F.col("a"), F.col("b"))).collect()
    for r in got:
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x), r


ODD = [
    (None, 0, "a", "lost"), (0, 1, "u", "hi there"), (0, 2, None, None), (0, None, "u", "first"), (3, 5, "u", "x"), (3, 5, "u", "x"),
    (3, 5, "b", "x"), (20, 0, "u", " \t\n"), (21, 0, "ü", "日本 語"), (21, 1, "", "y" * 200_000), (25, 0, "u", "x"), (-7, 1, "u", "hi there"),
    (2, None, "u", "first"), (2, 1, "u", "hi there"), (2, 2, "", ""), (1, None, "u", "first"), (1, 1, "u", "hi there"),
]


@pytest.mark.parametrize("branch", [False, True])
def test_odd_rows(spark, branch):
    own = conversations(ODD)
    assert trie(spark, ODD, branch) == plain_nodes(rebuilt(own) if branch else own)


def test_no_conversations(spark):
    assert trie(spark, []) == [] and trie(spark, [], True) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []


def test_conversation_without_turns(spark):
    # Conversation 1 takes none of its own two turns, and conversation 0 does not exist.
    c = next(c for c in range(1, 20) if crc32(str(c).encode()) % 4 >= 2)
    rows = [(c, 0, "u", "a"), (c, 1, "u", "b")]
    assert trie(spark, rows, True) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    """Few symbols and lengths up to 70, so edges are split at every depth and ends lie on edges."""
    rng = random.Random(seed)
    base = [rng.choice("ab") for _ in range(70)]
    rows = []
    for c in range(90):
        n, keep = rng.choice([1, 2, 3, 8, 33, 64, 70]), rng.choice([0, 1, 2, 16, 31, 32, 64])
        seq = (base[:keep] + [rng.choice("abc") for _ in range(70)])[:n]
        rows += [(c, k, "u", s) for k, s in enumerate(seq)]
    rng.shuffle(rows)
    want = plain_nodes(conversations(rows))
    assert trie(spark, rows) == want
    assert trie(spark, rows, settings=prefix_trie.Settings(batches=6)) == want


def test_long_conversation_is_spread_and_whole(spark):
    """Half of all rows in one conversation, many of them of one turn number."""
    long = [(7, k // 3, "u", f"{k % 50} w") for k in range(6000)]
    rows = long + [(100 + c, k, "u", f"{c % 9} {k}") for c in range(1500) for k in range(4)] + [(8, *r[1:]) for r in long[:3000]]
    assert trie(spark, rows) == plain_nodes(conversations(rows))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_partitions_do_not_matter(spark, sf_dir, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = nodes(QUERIES["op11_zfast_conversations"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == plain_nodes(rebuilt(conversations(rows)))
