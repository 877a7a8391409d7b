"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words.  Each passage is described by shares of
character classes, word shapes, repetition within the passage and within the document, and hash
cells of its words, and encoded by a small network.  Gated attention (a tanh layer times a sigmoid
layer, one weight vector, softmax over the document's passages) says how much each passage counts;
the weighted mean of the encodings gives the score.  Encoder, gates and score are trained together
from document labels alone, so the network finds the passages that decide.

Defined cases: a null or empty text is one passage without words.  Without labels of both kinds
every score is 0.5.  Texts of any length are scored whole; for training, those above ``most_chars``
are left out.  A score equal to ``threshold`` counts as good.  Rows are scored one by one, repeated or
with null ids alike; other columns are not looked at.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, sample
from tidemark.llm.quality_rules import CLASS, CLASSES
from tidemark.llm.words import blocks, text_bytes, windows, words_of

BLOCK = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``per_label`` and ``most_chars`` bound the training sample."""

    per_label: int = 1500
    most_chars: int = 20_000
    passage_words: int = 64
    cells: int = 24
    width: int = 24
    gate: int = 12
    epochs: int = 100
    rate: float = 0.01
    decay: float = 1e-4
    threshold: float = 0.3
    seed: int = 5

    @property
    def features(self) -> int:
        return len(CLASSES) + 8 + self.cells


def features(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(one row of features per passage, per document the range of its passages)."""
    data, offsets = text_bytes(column)
    parts, counts = [], []
    for a, b in blocks(offsets, BLOCK):
        x, n = _block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], settings)
        parts.append(x)
        counts.append(n)
    x = np.concatenate([*parts, np.zeros((0, settings.features), np.float32)])
    return x, np.concatenate([[0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))]).astype(np.int64)


def _repeated(code: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether the same code occurs elsewhere in its row."""
    _, group, count = np.unique(code * np.uint64(0x9E3779B97F4A7C15) + row.astype(np.uint64), return_inverse=True, return_counts=True)
    return count[group] > 1


def _block(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(data, offsets, lower=True)
    n = np.diff(words.first)
    passages = np.maximum(-(-n // settings.passage_words), 1)
    bounds = np.concatenate([[0], np.cumsum(passages)])
    row = words.row()
    own = bounds[row] + (np.arange(len(row)) - words.first[row]) // settings.passage_words
    first = np.searchsorted(own, np.arange(bounds[-1] + 1))
    size = np.maximum(np.diff(first), 1).astype(np.float64)
    out = np.zeros((bounds[-1], settings.features), np.float32)

    def mean(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
        return (total[first[1:]] - total[first[:-1]]) / size

    if len(row):
        # A passage's bytes reach from its first word to the next passage, or to the document's end.
        filled = np.flatnonzero(np.diff(first))
        begin = words.start[first[filled]]
        end = np.minimum(np.concatenate([begin[1:], [len(data)]]), offsets[1:][row[first[filled]]])
        kind = CLASS[data]
        chars = np.maximum(end - begin, 1)
        for k in range(len(CLASSES)):
            total = np.concatenate([[0], np.cumsum(kind == k)])
            out[filled, k] = (total[end] - total[begin]) / chars
        base = len(CLASSES)
        length = (words.end - words.start).astype(np.float64)
        out[:, base] = mean(length) / 10
        out[:, base + 1] = np.sqrt(np.maximum(mean(length**2) / 100 - out[:, base] ** 2, 0))
        head, tail = kind[words.start], kind[words.end - 1]
        out[:, base + 2] = mean(head == CLASSES.index("upper"))
        out[:, base + 3] = mean(tail == CLASSES.index("stop"))
        out[:, base + 4] = mean((tail == CLASSES.index("symbol")) | (head == CLASSES.index("symbol")))
        out[:, base + 5] = mean(_repeated(words.hash, own))
        shingles, at = windows(words, 5)
        again = _repeated(shingles, np.repeat(np.arange(len(n)), np.diff(at)))
        flag = np.zeros(len(row), bool)
        starts = words.first[:-1]
        place = np.arange(len(shingles)) - np.repeat(at[:-1], np.diff(at)) + np.repeat(starts, np.diff(at))
        flag[place] = again
        out[:, base + 6] = mean(flag)
        out[:, base + 7] = np.log1p(np.diff(first)) / 5
        cell = (words.hash % np.uint64(settings.cells)).astype(np.int64)
        table = np.bincount(own * settings.cells + cell, minlength=len(out) * settings.cells).reshape(len(out), -1)
        out[:, base + 8 :] = np.sqrt(table / size[:, None])
    return out, passages


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]


def _forward(x: np.ndarray, bounds: np.ndarray, w: list[np.ndarray]):
    """All layers, for passages in a row."""
    encoder, shift, tanh_gate, sigmoid_gate, attention, score, intercept = w
    h = np.tanh(x @ encoder + shift)
    t, s = np.tanh(h @ tanh_gate), 1 / (1 + np.exp(-(h @ sigmoid_gate)))
    energy = (t * s) @ attention
    top = np.maximum.reduceat(energy, bounds[:-1])
    own = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    odds = np.exp(energy - top[own])
    share = odds / np.add.reduceat(odds, bounds[:-1])[own]
    bag = np.add.reduceat(h * share[:, None], bounds[:-1], axis=0)
    return h, t, s, share, own, bag, 1 / (1 + np.exp(-np.clip(bag @ score + intercept[0], -60, 60)))


def train(rows: list[tuple[str, int]], settings: Settings = Settings()) -> Model:
    """Adam over all passages of the sample at a time, both labels with the same total weight."""
    labels = np.array([y for _, y in rows], np.float64)
    rng = np.random.default_rng(settings.seed)
    shapes = [(settings.features, settings.width), (settings.width,), (settings.width, settings.gate), (settings.width, settings.gate), (settings.gate,), (settings.width,), (1,)]
    w = [rng.standard_normal(shape) * (shape[0] ** -0.5 if len(shape) == 2 else 0.1) for shape in shapes]
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(settings.features), np.ones(settings.features), [np.zeros(shape) for shape in shapes])
    raw, bounds = features(pa.array([t for t, _ in rows], pa.large_string()), settings)
    model = Model(raw.mean(axis=0), raw.std(axis=0) + 1e-3, w)
    x = np.clip((raw - model.mean) / model.scale, -8, 8)
    balance = 0.5 / np.bincount(labels.astype(int), minlength=2)[labels.astype(int)]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for epoch in range(1, settings.epochs + 1):
        h, t, s, share, own, bag, p = _forward(x, bounds, w)
        error = (p - labels) * balance
        d_bag = np.outer(error, w[5])[own]
        d_share = (d_bag * h).sum(axis=1)
        centre = np.add.reduceat(d_share * share, bounds[:-1])
        d_energy = share * (d_share - centre[own])
        d_t = np.outer(d_energy, w[4]) * s * (1 - t * t)
        d_s = np.outer(d_energy, w[4]) * t * s * (1 - s)
        d_h = (d_bag * share[:, None] + d_t @ w[2].T + d_s @ w[3].T) * (1 - h * h)
        grads = [x.T @ d_h, d_h.sum(axis=0), h.T @ d_t, h.T @ d_s, (t * s).T @ d_energy, bag.T @ error, np.array([error.sum()])]
        for q, g, m, v in zip(w, grads, first, second):
            g = g + settings.decay * q
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            q -= settings.rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-8)
    return model


def scores(column: pa.Array, model: Model, settings: Settings = Settings()) -> np.ndarray:
    if not len(column):
        return np.zeros(0)
    raw, bounds = features(column, settings)
    x = np.clip((raw - model.mean) / model.scale, -8, 8)
    return _forward(x, bounds, model.weights)[-1]


def score(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(sample(docs, labels, "quality", settings.per_label, settings.most_chars), settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores(part.column("text"), model, settings))], names=["doc_id", "score"]
                )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = named.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
