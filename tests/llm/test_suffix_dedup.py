"""Removed bytes against a search over all strings; suffix groups against all substrings."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup
from tidemark.llm.bwt import shared_prefix_groups


def expected(rows, length=50):
    """Rows as (id, bytes) with masks of removed bytes."""
    starts = {}
    for i, text in rows:
        if i is not None:
            for p in range(len(text) - length + 1):
                s = text[p : p + length]
                starts[s] = min(starts.get(s, i), i)
    out = []
    for i, text in rows:
        mask = bytearray(len(text))
        for p in range(len(text) - length + 1) if i is not None else ():
            if starts[text[p : p + length]] < i:
                mask[p : p + length] = b"\1" * length
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        kept = bytes(c for c, m in zip(text, mask) if not m)
        out.append((i, len(text), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(frame, settings=suffix_dedup.Settings()):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in suffix_dedup.remove_repeats(frame, settings).collect()), key=str)


@pytest.fixture(scope="module")
def copied():
    """Documents made of pieces of each other, with edits, periods, and one letter alphabets."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(0, 400))) for _ in range(12)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            t = rng.choice(texts)
            a = rng.randrange(len(t) + 1)
            parts.append(t[a : a + rng.randrange(30, 200)] + rng.choice(["", "é", "xyz", "\x00"]))
        texts.append("".join(parts))
    texts += ["ab" * 60, "ba" * 70, "a" * 49, "a" * 50, "a" * 200, texts[3], texts[3], "é" * 40, "é" * 30]
    rng.shuffle(texts)
    return [(k * 3 % 101, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize(
    "settings", [suffix_dedup.Settings(), suffix_dedup.Settings(batch_bytes=700, bucket_bytes=900, expand_letters=300)]
)
def test_copied_pieces(spark, copied, settings):
    frame = spark.createDataFrame(copied, "doc_id long, text string").repartition(5)
    assert found(frame, settings) == expected([(i, t.encode()) for i, t in copied])


def test_odd_documents(odd_docs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd_docs.collect() if r.doc_id not in (9, 10)]
    assert found(odd_docs.filter("doc_id IS NULL OR doc_id NOT IN (9, 10)")) == expected(rows)
    long = {r[0]: r[1:4] for r in found(odd_docs)}
    assert long[10] == (300_000, 0, 0) and long[9][1] == 0


def test_nothing(no_docs):
    assert found(no_docs) == []


def test_the_cut_texts_keep_their_columns(odd_docs):
    cut = suffix_dedup.deduplicated(odd_docs)
    assert cut.schema == odd_docs.schema or cut.columns == odd_docs.columns
    rows = {r.doc_id: r for r in cut.collect()}
    assert rows[7].text == " nu"[-3:] or rows[7].n_chars == len(rows[7].text)
    assert rows[5].text and rows[5].rep == 7 and rows[6].source == "ü"


def test_suffix_groups():
    rng = random.Random(4)
    for _ in range(100):
        length, letters = rng.choice([2, 3, 5, 9, 20]), rng.choice([1, 2, 4, 255])
        texts = [[rng.randrange(letters) + 1 for _ in range(rng.randrange(1, 60))] + [0] for _ in range(rng.randrange(1, 9))]
        flat = np.array(sum(texts, []), np.uint16)
        order, group = shared_prefix_groups(flat, length)
        assert sorted(order) == list(range(len(flat)))
        of = dict(zip(order.tolist(), group.tolist()))
        by_string = {}
        for p in range(len(flat) - length + 1):
            if (flat[p : p + length] > 0).all():
                by_string.setdefault(tuple(flat[p : p + length]), set()).add(of[p])
        assert all(len(g) == 1 for g in by_string.values())
        assert len(set().union(*by_string.values())) == len(by_string) if by_string else True


def test_messages_grow_with_the_total():
    settings = suffix_dedup.Settings()
    for total in (10**7, 10**8, 10**9):
        batches, buckets = settings.deal(total)
        more = settings.deal(100 * total)
        assert 50 < more[0] * more[1] / (batches * buckets) < 200
    assert settings.deal(0) == (1, 1) and settings.deal(10**14)[0] == -(-(10**14) // settings.batch_bytes)


@pytest.mark.parametrize("width", [30, 42, 49])
def test_a_short_line_in_many_documents(spark, width):
    """Crowded anchors are split into strings: same bytes go, and no bucket gets the texts around the line."""
    rng = random.Random(width)
    line = "".join(rng.choice("abcdefgh ") for _ in range(width))
    around = lambda: "".join(rng.choice("ijklmnop") for _ in range(90))
    rows = [(k, around() + (line if k % 3 == 0 else "") + around()) for k in range(600)]
    rows += [(1000 + k, rows[3 * k][1][40:200] + around()) for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    settings = suffix_dedup.Settings(batch_bytes=20_000, bucket_bytes=30_000, crowd=40)
    assert found(frame, settings) == expected([(i, t.encode()) for i, t in rows])


def test_a_crowded_anchor_is_spread():
    """The strings around one line fall into all buckets alike."""
    rng = np.random.default_rng(3)
    line = rng.integers(97, 105, 42).astype(np.uint8)
    texts = [np.concatenate([rng.integers(105, 113, 60), line, rng.integers(105, 113, 60)]).astype(np.uint8) for _ in range(2000)]
    data, offsets = np.concatenate(texts), np.arange(2001) * 162
    runs = suffix_dedup._runs(data, offsets, 50)
    value, times = np.unique(runs.anchor, return_counts=True)
    crowded = value[times > 500]
    assert len(crowded) and np.bincount(suffix_dedup._bucket(runs.anchor, 16), minlength=16).max() > 1500
    cut, new = suffix_dedup._split(runs, data, crowded, 50)
    assert cut.size.sum() == runs.size.sum() and (cut.size[new] == 1).all()
    spread = np.bincount(suffix_dedup._bucket(np.unique(cut.anchor[new]), 16), minlength=16)
    assert spread.max() <= 2 * np.median(spread)
