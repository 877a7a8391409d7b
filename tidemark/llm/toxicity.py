"""Toxicity from subword bags.

A word is the bag of its character n-grams, its ends marked; each n-gram has a hash cell with a
vector.  A word's vector is the mean of its n-grams' vectors, a document's that of its distinct words',
and a linear softmax on it gives the label.  Vectors and softmax are trained together, so a
misspelt word that was never seen scores by the n-grams it shares with those that were.  Every
document has ``blank_words`` words with the vector 0 besides its own, which keeps short texts from extremes.

Everything after the vectors is linear.  For scoring, each cell therefore needs one number: its
vector times the difference of the two softmax rows.

Defined cases: null and empty texts, and texts of white space, score by the intercept alone.
Without labels of both kinds every score is 0.5.  Texts of any length are scored whole; for training,
those above ``most_chars`` are left out.  A score of exactly 0.5 counts as toxic.  Rows are scored one
by one, repeated or with null ids alike; other columns are not looked at.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, sample
from tidemark.llm.words import Words, blocks, text_bytes, words_of

U = np.uint64
BLOCK = 1 << 20
_ODD = U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``per_label`` and ``most_chars`` bound the training sample."""

    per_label: int = 2000
    most_chars: int = 10_000
    grams: tuple[int, ...] = (3, 4, 5)
    cell_bits: int = 18
    width: int = 4
    blank_words: int = 600
    epochs: int = 120
    rate: float = 0.1
    decay: float = 1e-3
    scale: float = 600.0
    floor: float = 1e-2
    least_docs: int = 5
    seed: int = 11


@dataclass
class Model:
    weight: np.ndarray
    intercept: float


def _grams(data: np.ndarray, words: Words, which: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(cells of the n-grams of the words, per word the range of its n-grams)."""
    start, size = words.start[which], (words.end - words.start)[which]
    # Each word between two blanks, eight spare bytes at the end.
    bounds = np.concatenate([[0], np.cumsum(size + 1)]) + 1
    flat = np.full(bounds[-1] + 8, 32, np.uint8)
    at = np.arange(size.sum()) + np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(size)])[:-1], size)
    source = np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)])[:-1], size)
    letters = data[source]
    letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters)
    flat[at] = letters
    eight = np.ndarray((len(flat) - 7,), "<u8", buffer=flat, strides=(1,))
    # n-grams of a word begin at its leading blank or later and end at its closing blank at most.
    counts = np.stack([np.maximum(size + 3 - n, 0) for n in settings.grams])
    counts[0] = np.maximum(counts[0], 1)
    per_word = counts.sum(axis=0)
    ends = np.concatenate([[0], np.cumsum(per_word)])
    out = np.empty(ends[-1], np.int32)
    begin = ends[:-1].copy()
    for n, count in zip(settings.grams, counts):
        step = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
        value = (eight[step + np.repeat(bounds[:-1] - 1, count)] & U((1 << 8 * n) - 1)) + U(n)
        value = value * _ODD
        value ^= value >> U(32)
        cells = (value * _ODD >> U(64 - settings.cell_bits)).astype(np.int32)
        out[step + np.repeat(begin, count)] = cells
        begin += count
    return out, ends


def _mean(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Means of the ranges; an empty range has mean 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    n = np.maximum(np.diff(bounds), 1)
    return (total[bounds[1:]] - total[bounds[:-1]]) / n.reshape(-1, *[1] * (values.ndim - 1))


def train(rows: list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Adam on all vectors and both softmax rows, over all rows at a time.

    ``floor`` keeps steps of cells with hardly any gradient small.
    """
    labels = np.array([x for _, x in rows], np.int64)
    cells = 1 << settings.cell_bits
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(cells, np.float32), 0.0)
    data, offsets = text_bytes(pa.array([t for t, _ in rows], pa.large_string()))
    keys, firsts, example = [], [], []
    for a, b in blocks(offsets, BLOCK):
        words = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        keys.append(words.hash)
        firsts.append(np.diff(words.first))
        example.append((words, offsets[a]))
    every = np.concatenate(keys)
    _, at, code = np.unique(every, return_index=True, return_inverse=True)
    whole = Words(
        np.concatenate([w.start + o for w, o in example]), np.concatenate([w.end + o for w, o in example]), every,
        np.concatenate([[0], np.cumsum(np.concatenate(firsts))]),
    )
    grams, bounds = _grams(data, whole, at, settings)
    lengths = np.diff(bounds).astype(np.float32)
    # Word by document counts, by document; transposed by word.
    doc = whole.row()
    pair = np.unique(doc * len(at) + code)
    doc, word = (pair // len(at)).astype(np.int32), (pair % len(at)).astype(np.int32)
    del pair, every, code, keys, whole, example, data
    doc_first = np.searchsorted(doc, np.arange(len(rows) + 1))
    share = (1 / (np.diff(doc_first) + settings.blank_words)[doc]).astype(np.float32)
    by_word = np.argsort(word, kind="stable").astype(np.int32)
    word_first = np.searchsorted(word[by_word], np.arange(len(at) + 1))
    # Cells of few documents only tell these apart; they stay 0, as do cells never seen.
    of_gram = np.repeat(np.arange(len(at), dtype=np.int32), np.diff(bounds))
    in_docs = np.bincount(grams, weights=np.diff(word_first)[of_gram], minlength=cells)
    common = in_docs[grams] >= settings.least_docs
    grams, of_gram = grams[common], of_gram[common]
    del common
    bounds = np.searchsorted(of_gram, np.arange(len(at) + 1))
    used = np.unique(grams)
    gram = np.searchsorted(used, grams).astype(np.int32)
    by_gram = np.argsort(gram, kind="stable").astype(np.int32)
    gram_first = np.searchsorted(gram[by_gram], np.arange(len(used) + 1))

    def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
        total = np.add.reduceat(np.append(values, np.float32(0)), first[:-1])
        total[np.diff(first) == 0] = 0
        return total

    rng = np.random.default_rng(settings.seed)
    vectors = (rng.standard_normal((settings.width, len(used))) * 0.01).astype(np.float32)
    rows_out = (rng.standard_normal((2, settings.width)) * 0.5).astype(np.float32)
    shift = np.zeros(2, np.float32)
    goal = np.eye(2, dtype=np.float32)[labels]
    balance = (0.5 / np.bincount(labels, minlength=2)[labels])[:, None].astype(np.float32)
    of_word, by_word_share = doc[by_word], share[by_word]
    gram_word = of_gram[by_gram]
    params = [vectors, rows_out, shift]
    first_moment, second_moment = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, settings.epochs + 1):
        doc_vectors = np.stack([sums((sums(v[gram], bounds) / lengths)[word] * share, doc_first) for v in vectors], axis=1)
        logits = settings.scale * doc_vectors @ rows_out.T + shift
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        slope = (odds / odds.sum(axis=1, keepdims=True) - goal) * balance
        doc_slope = (settings.scale * slope @ rows_out).T
        back = [sums((sums(d[of_word] * by_word_share, word_first) / lengths)[gram_word], gram_first) for d in doc_slope]
        grads = [
            np.stack(back) + settings.decay * vectors,
            settings.scale * slope.T @ doc_vectors + settings.decay * rows_out,
            slope.sum(axis=0),
        ]
        for p, g, m, v in zip(params, grads, first_moment, second_moment):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= settings.rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + settings.floor)
    weight = np.zeros(cells, np.float32)
    weight[used] = settings.scale * (rows_out[1] - rows_out[0]) @ vectors
    return Model(weight, float(shift[1] - shift[0]))


def scores(column: pa.Array, model: Model, settings: Settings = Settings()) -> np.ndarray:
    data, offsets = text_bytes(column)
    out = np.zeros(len(offsets) - 1)
    for a, b in blocks(offsets, BLOCK):
        part = data[offsets[a] : offsets[b]]
        words = words_of(part, offsets[a : b + 1] - offsets[a], lower=True)
        _, at, code = np.unique(words.hash, return_index=True, return_inverse=True)
        grams, bounds = _grams(part, words, at, settings)
        pair = np.unique(words.row() * max(len(at), 1) + code)
        first = np.searchsorted(pair, np.arange(b - a + 1) * max(len(at), 1))
        own = _mean(_mean(model.weight[grams], bounds)[pair % max(len(at), 1)], first)
        out[a:b] = own * np.diff(first) / (np.diff(first) + settings.blank_words)
    return 1 / (1 + np.exp(-np.clip(out + model.intercept, -500, 500)))


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(sample(docs, labels, "toxic", settings.per_label, settings.most_chars), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores(batch.column("text"), model, settings))], names=["doc_id", "score"]
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = named.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
