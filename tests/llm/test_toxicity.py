"""Held-out accuracy, misspellings, odd documents."""

import numpy as np
import pyarrow as pa

from tidemark.llm import toxicity


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)


def test_unseen_misspellings_share_grams():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeioutrns"), 5)) for _ in range(200)]
    rows = []
    for k in range(600):
        words = list(rng.choice(plain, 30))
        if k % 3 == 0:
            words[k % 30] = words[(k + 7) % 30] = ("blockhead", "blockheads")[k % 2]
        rows.append((" ".join(words), int(k % 3 == 0)))
    model = toxicity.train(rows)
    base = " ".join(plain[:30])
    clean, seen, misspelt = toxicity.scores(pa.array([base, base + " blockhead blockhead", base + " blockhed Blockheadz"]), model)
    assert clean < 0.5 < misspelt and seen > clean and misspelt > clean + 0.2


def test_grams_of_a_word():
    data = np.frombuffer(b"Ab cdefgh", np.uint8)
    words = toxicity.words_of(data, np.array([0, 9]), lower=True)
    settings = toxicity.Settings(grams=(3, 4))
    grams, bounds = toxicity._grams(data, words, np.arange(2), settings)
    assert np.diff(bounds).tolist() == [2 + 1, 6 + 5]
    again, _ = toxicity._grams(np.frombuffer(b"xx aB", np.uint8), toxicity.words_of(np.frombuffer(b"xx aB", np.uint8), np.array([0, 5]), True), np.array([1]), settings)
    assert again.tolist() == grams[:3].tolist()


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 1), (7, 1, 0), (8, 0, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd_docs, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in toxicity.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(no_docs, labels).count() == 0
