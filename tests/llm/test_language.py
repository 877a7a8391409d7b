"""Byte context trees against a plain PPM coder, and predictions on held-out rows."""

import math
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.queries import QUERIES


class Plain:
    """PPM with method C and exclusion, a dictionary of counts for each context."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {}
        for text in texts:
            padded = bytes([language.PAD]) * order + text
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    self.counts.setdefault(padded[i - k : i], {}).setdefault(padded[i], 0)
                    self.counts[padded[i - k : i]][padded[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            known = self.counts.get(context[len(context) - k :])
            if not known:
                continue
            fresh = {s: n for s, n in known.items() if s not in excluded}
            total = sum(fresh.values()) + len(fresh)
            if symbol in fresh:
                return p * fresh[symbol] / total
            if fresh:
                p *= len(fresh) / total
            excluded |= set(known)
        return p / (256 - len(excluded))

    def bits(self, text):
        padded = bytes([language.PAD]) * self.order + text
        return sum(-math.log2(self.probability(padded[i - self.order : i], padded[i])) for i in range(self.order, len(padded)))


def texts(seed, n, letters="abcé ", size=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(size))).encode() for _ in range(n)]


def grown(train, order):
    keys = [language.keys_of(np.frombuffer(t, np.uint8), order) for t in train]
    return language.tree(np.concatenate(keys), order)


def offsets_of(parts):
    return np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@pytest.mark.parametrize("order", [0, 1, 3, 4, 7])
def test_code_lengths_are_those_of_a_plain_coder(order):
    train, asked = texts(1, 30), [*texts(2, 12, "abcdé z"), b"", b"zzzz", "日本".encode()]
    plain, tree = Plain(train, order), grown(train, order)
    model = language.Model(["x", "y"], [tree, grown(texts(3, 9), order)], order, 1 << 16)
    for stretch in (1, 1 << 20):
        got = model.totals(np.frombuffer(b"".join(asked), np.uint8), offsets_of(asked), stretch)
        for text, total in zip(asked, got[:, 0]):
            assert abs(total / language.UNIT - plain.bits(text)) < 1e-3 + 1e-5 * len(text)


def test_probabilities_add_up_to_one():
    tree = grown(texts(4, 40), 3)
    for context in (b"\xff\xff\xff", b"ab ", b"zzz", b"zza", "éa".encode()):
        keys = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert abs(np.exp2(-language.code_lengths(tree, keys)).sum() - 1) < 1e-9


def test_long_texts_are_scored_whole_in_stretches():
    """A text over many stretches, and short ones around their borders, add up to the same bits."""
    train = texts(5, 50)
    model = language.Model(["x"], [grown(train, 4)], 4, 1 << 16)
    asked = [*texts(6, 200, size=90), b"abc " * 5000, b"", *texts(7, 200)]
    got = model.totals(np.frombuffer(b"".join(asked), np.uint8), offsets_of(asked), 1)
    alone = [model.totals(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 1 << 22)[0, 0] for t in asked]
    assert got[:, 0].tolist() == alone


SCHEMA = "doc_id long, text string, lang string, draw string, held_out int, score string"


def test_odd_rows(spark):
    en, de = "the quick brown fox and the lazy dog ", "der schnelle braune Fuchs und der faule Hund "
    rows = [(k, (en if k % 2 else de) * (1 + k % 5), "en" if k % 2 else "de") for k in range(60)]
    rows += rows[:7]
    odd = [
        (1000, None, "en"), (1001, "", "en"), (1002, " 123 !?\n", "de"), (None, en, "xx"), (1003, en * 20_000, None),
        (1004, "é" * 300_000, None), (1005, de, None), (1006, "日本語", None), (1007, "x\x00y", None),
    ]
    frame = spark.createDataFrame([(*r, "d", 1, "s") for r in rows + odd], SCHEMA)
    got = language.predict(frame, language.fitted(frame)).collect()
    assert len(got) == len(rows + odd)
    by_id = {r.doc_id: r for r in got}
    for k in (1000, 1001, 1002):
        assert (by_id[k].lang_pred, by_id[k].score) == ("und", 0.0)
    assert by_id[1003].lang_pred == by_id[None].lang_pred == "en" and by_id[1005].lang_pred == "de"
    assert by_id[None].held_out is True
    for r in got:
        assert 0 <= r.score <= 1
        assert r.lang_pred in ("en", "de", "und")
        if r.doc_id is not None:
            assert r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2)
            if r.doc_id < 60:
                assert r.lang_pred == ("en" if r.doc_id % 2 else "de")


def test_nothing_learned_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "some text", None, "d", 1, "s")], SCHEMA)
    assert language.fitted(frame) is None
    row, = language.predict(frame, None).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language.predict(frame.limit(0), language.fitted(frame.limit(0))).count() == 0


def test_languages_are_bounded(spark):
    frame = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        language.fitted(frame, language.Settings(most_languages=5))


def test_the_sample_is_bounded_and_spread(spark):
    """One language holds nearly all text, in one long document; trees stay small."""
    rng = random.Random(3)
    long = "".join(chr(rng.randrange(97, 123)) for _ in range(2_000_000))
    rows = [(k, "wort " * 20, "de", "d", 1, "s") for k in range(40)]
    key = next(k for k in range(100, 200) if crc32(str(k).encode()) % 4 != 2)
    frame = spark.createDataFrame([*rows, (key, long, "en", "d", 1, "s")], SCHEMA)
    model = language.fitted(frame, language.Settings(sample_bytes=40_000))
    counts = {l: int(np.exp2(t[0].bits).round().sum()) for l, t in zip(model.languages, model.trees)}
    assert 12_000 < counts["en"] < 28_000 and counts["de"] <= 4_000


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op12_ppm_language"](spark, sf_dir)
    rows = got.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_lang_and_source_do_not_reach_a_prediction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fitted(docs)
    blind = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    order = ["doc_id"]
    assert language.predict(docs, model).orderBy(order).collect() == language.predict(blind, model).orderBy(order).collect()
