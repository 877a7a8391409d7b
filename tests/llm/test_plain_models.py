"""Scores and first training steps of the two classifiers against plain loops and numeric gradients."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import passages, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = [
    "ab cde ab", "Cde fgh, ijklm", "the blockhead the blockheads", "", "x", "ÄÖ äö ab", "a b c d e f g h i j k l m", "fgh fgh fgh ijklm cde",
]


# --- toxicity --------------------------------------------------------------------------------------


def words_of(text):
    return sorted({bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in WORD.findall(text.encode())})


def cells_of(word, settings):
    """The hash cells of a word's n-grams, the word between two blanks."""
    padded, out = b" " + word + b" ", []
    for k, n in enumerate(settings.grams):
        grams = [padded[i : i + n] for i in range(len(padded) - n + 1)]
        for g in grams or ([padded] if k == 0 else []):
            value = (int.from_bytes(g, "little") + n) * int(toxicity._ODD) % 2**64
            value ^= value >> 32
            out.append(value * int(toxicity._ODD) % 2**64 >> (64 - settings.cell_bits))
    return out


def plain_mean(text, weight, settings):
    words = words_of(text)
    total = sum(np.mean([weight[c] for c in cells_of(w, settings)], axis=0) for w in words)
    return total / (len(words) + settings.blank_words) if words else 0 * weight[0]


def test_toxicity_scores_are_those_of_plain_loops():
    settings = toxicity.Settings(blank_words=3)
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.standard_normal(1 << settings.cell_bits).astype(np.float32), 0.3)
    got = toxicity.scores(pa.array([*TEXTS, None]), model, settings)
    want = [1 / (1 + math.exp(-(plain_mean(t, model.weight, settings) + 0.3))) for t in [*TEXTS, ""]]
    assert got.tolist() == pytest.approx(want, abs=1e-6)


def test_toxicity_steps_follow_the_numeric_gradient():
    settings = toxicity.Settings(epochs=1, width=2, blank_words=2, scale=3.0, least_docs=1, floor=0.05, decay=0.01)
    rows = [(t, k % 2) for k, t in enumerate(TEXTS)]
    labels = [y for _, y in rows]
    used = sorted({c for t in TEXTS for w in words_of(t) for c in cells_of(w, settings)})
    place = {c: k for k, c in enumerate(used)}
    rng = np.random.default_rng(settings.seed)
    vectors = (rng.standard_normal((2, len(used))) * 0.01).astype(np.float32).astype(float)
    out, shift = (rng.standard_normal((2, 2)) * 0.5).astype(np.float32).astype(float), np.zeros(2)

    def loss(v, o, b):
        total = settings.decay / 2 * ((v**2).sum() + (o**2).sum())
        weight = {c: v[:, place[c]] for c in used}
        for (t, y) in rows:
            words = words_of(t)
            doc = sum(np.mean([weight[c] for c in cells_of(w, settings)], axis=0) for w in words) if words else np.zeros(2)
            logits = settings.scale * (o @ doc) / (len(words) + settings.blank_words) + b
            total -= 0.5 / Counter(labels)[y] * (logits[y] - np.log(np.exp(logits).sum()))
        return total

    params = [vectors, out, shift]
    stepped = []
    for k, p in enumerate(params):
        g = np.zeros_like(p)
        for at in np.ndindex(p.shape):
            ends = []
            for sign in (1, -1):
                moved = [q.copy() for q in params]
                moved[k][at] += sign * 1e-5
                ends.append(loss(*moved))
            g[at] = (ends[0] - ends[1]) / 2e-5
        stepped.append(p - settings.rate * g / (np.abs(g) + settings.floor))
    model = toxicity.train(rows, settings)
    want = settings.scale * (stepped[1][1] - stepped[1][0]) @ stepped[0]
    assert model.weight[used] == pytest.approx(want, rel=2e-2, abs=2e-4)
    assert model.intercept == pytest.approx(stepped[2][1] - stepped[2][0], abs=1e-3)
    assert np.count_nonzero(model.weight) <= len(used)


# --- passages --------------------------------------------------------------------------------------

SMALL = passages.Settings(passage_words=4, cells=5, width=3, gate=2, epochs=1, decay=0.02)


def plain_score(x, w):
    """Gated attention over the passages of one document, passage by passage."""
    encoder, shift, tanh_gate, sigmoid_gate, attention, score, intercept = w
    hidden, energy = [], []
    for row in x:
        h = [math.tanh(sum(row[i] * encoder[i][j] for i in range(len(row))) + shift[j]) for j in range(len(shift))]
        hidden.append(h)
        gates = []
        for k in range(len(attention)):
            t = math.tanh(sum(h[j] * tanh_gate[j][k] for j in range(len(h))))
            s = 1 / (1 + math.exp(-sum(h[j] * sigmoid_gate[j][k] for j in range(len(h)))))
            gates.append(t * s)
        energy.append(sum(a * g for a, g in zip(attention, gates)))
    share = [math.exp(e) for e in energy]
    bag = [sum(s * h[j] for s, h in zip(share, hidden)) / sum(share) for j in range(len(shift))]
    return 1 / (1 + math.exp(-(sum(b * q for b, q in zip(bag, score)) + intercept[0])))


def start_of(rows, settings):
    rng = np.random.default_rng(settings.seed)
    shapes = [
        (settings.features, settings.width), (settings.width,), (settings.width, settings.gate), (settings.width, settings.gate),
        (settings.gate,), (settings.width,), (1,),
    ]
    w = [rng.standard_normal(s) * (s[0] ** -0.5 if len(s) == 2 else 0.1) for s in shapes]
    raw, bounds = passages.features(pa.array([t for t, _ in rows], pa.large_string()), settings)
    x = np.clip((raw - raw.mean(axis=0)) / (raw.std(axis=0) + 1e-3), -8, 8).astype(float)
    return w, [x[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def test_passage_scores_are_those_of_plain_loops():
    rows = [(t, k % 2) for k, t in enumerate(TEXTS)]
    model = passages.train(rows, passages.Settings(passage_words=4, cells=5, width=3, gate=2, epochs=7))
    _, docs = start_of(rows, SMALL)
    got = passages.scores(pa.array(TEXTS), model, SMALL)
    assert got.tolist() == pytest.approx([plain_score(x, model.weights) for x in docs], abs=1e-6)
    assert len({len(x) for x in docs}) > 2


def test_passage_steps_follow_the_numeric_gradient():
    rows = [(t, k % 2) for k, t in enumerate(TEXTS)]
    w, docs = start_of(rows, SMALL)
    labels = [y for _, y in rows]

    def loss(v):
        total = SMALL.decay / 2 * sum((q**2).sum() for q in v)
        for x, y in zip(docs, labels):
            p = plain_score(x.tolist(), [q.tolist() for q in v])
            total -= 0.5 / Counter(labels)[y] * math.log(p if y else 1 - p)
        return total

    model = passages.train(rows, SMALL)
    checked = 0
    for k, (before, after) in enumerate(zip(w, model.weights)):
        for at in list(np.ndindex(before.shape))[:: 1 if before.size < 20 else 7]:
            ends = []
            for sign in (1, -1):
                moved = [q.copy() for q in w]
                moved[k][at] += sign * 1e-5
                ends.append(loss(moved))
            g = (ends[0] - ends[1]) / 2e-5
            if abs(g) > 1e-5:
                # Adam's first step is the rate, against the gradient.
                assert after[at] - before[at] == pytest.approx(-SMALL.rate * np.sign(g), rel=1e-2), (k, at, g)
                checked += 1
    assert checked > 25
