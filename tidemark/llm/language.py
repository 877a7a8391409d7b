"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``order`` bytes with counts of the byte that
follows.  A byte is coded in the longest context that has been seen: with its count, or with an escape
to the next shorter context, where the bytes the longer one knows are excluded.  Escapes follow
method C (as many escapes as different bytes), and below the empty context all bytes left are equally
likely.  The statistics are frozen, so a text's code length under a language is a sum over its bytes,
exact in units of 2^-16 bit, whatever the batches are.  The language with the shortest code is
predicted; the score is its posterior probability with all languages equally likely beforehand.

Trees are fitted on passages of training texts, drawn over whole texts by a hash of the document and
the place: at about ``sample_bytes`` in all and ``language_bytes`` a language, which bounds the trees,
and so what reaches the driver and every task.  Scoring is one map-only pass over whole texts, a
bounded stretch of bytes at a time; code lengths of recently seen strings are kept in a table of
fixed size.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text if
nothing was learned.  Rows with a null language or text teach nothing; a null id counts as held out.
Texts of any length are scored whole.  Of languages with equal code lengths the first by code point
wins.  Repeated rows are rows of their own, in training too.  No rows give no rows.  More than
``most_languages`` languages fail the run.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mixed, text_bytes

U = np.uint64
UNKNOWN = "und"
# Bytes before the start of a text; UTF-8 has no such byte.
PAD = 0xFF
UNIT = 1 << 16


@dataclass(frozen=True)
class Settings:
    """``order`` bytes of context, 7 at most; the other numbers bound training and memory."""

    order: int = 4
    passage: int = 512
    sample_bytes: int = 8 << 20
    language_bytes: int = 1 << 20
    most_languages: int = 4096
    stretch: int = 1 << 22
    table_bytes: int = 48 << 20


# --- trees ------------------------------------------------------------------------------------


def _below(order: int) -> np.uint64:
    """Mask of the last ``order`` bytes of a key."""
    return U((1 << 8 * order) - 1)


def keys_of(data: np.ndarray, order: int) -> np.ndarray:
    """The string of ``order`` bytes and one more that ends at each byte, bytes before the first padded."""
    long = np.concatenate([np.full(order, PAD, np.uint8), data]).astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for k in range(order + 1):
        key = key << U(8) | long[k : k + len(data)]
    return key


@dataclass
class Level:
    """Contexts of one length: the strings seen, with their counts, and costs by context.

    Costs are in bits.  ``whole`` is that of all symbols and the escape, ``leave`` that of the escape.
    ``next_whole`` and ``next_leave`` are the same for the next shorter context, after an escape from
    this one.
    """

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    whole: np.ndarray
    leave: np.ndarray
    next_whole: np.ndarray
    next_leave: np.ndarray


def tree(keys: np.ndarray, order: int) -> list[Level]:
    """Levels 0 to ``order`` of the context tree of some keys."""
    levels: list[Level] = []
    lower = None
    for k in range(order + 1):
        grams, count = np.unique(keys & _below(k + 1), return_counts=True)
        contexts, start, symbols = np.unique(grams >> U(8), return_index=True, return_counts=True)
        total = np.add.reduceat(count, start) if len(start) else np.zeros(0, np.int64)
        whole = np.log2(total + symbols)
        if lower is None:
            # Below the empty context: all bytes it does not know are equally likely.
            left = 256 - symbols
            next_whole, next_leave = np.log2(np.maximum(left, 1)), np.zeros(len(contexts))
        else:
            grams_below, count_below, contexts_below, total_below, symbols_below = lower
            known = count_below[np.searchsorted(grams_below, grams & _below(k))]
            at = np.searchsorted(contexts_below, contexts & _below(k - 1))
            rest = total_below[at] - (np.add.reduceat(known, start) if len(start) else 0)
            escapes = symbols_below[at] - symbols
            next_whole = np.log2(np.maximum(rest + escapes, 1))
            next_leave = next_whole - np.log2(np.maximum(escapes, 1))
        levels.append(Level(grams, np.log2(count), contexts, whole, whole - np.log2(symbols), next_whole, next_leave))
        lower = grams, count, contexts, total, symbols
    return levels


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of each wanted key in a sorted table."""
    at = np.minimum(np.searchsorted(table, wanted), max(len(table) - 1, 0))
    return at, (table[at] == wanted) if len(table) else np.zeros(len(wanted), bool)


def code_lengths(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Bits for the last byte of each key after the bytes before it."""
    order = len(levels) - 1
    bits = np.zeros(len(keys))
    open_ = np.arange(len(keys))
    escaped = np.zeros(len(keys), bool)
    whole, leave = np.zeros(len(keys)), np.zeros(len(keys))
    for k in range(order, -1, -1):
        level, key = levels[k], keys[open_] & _below(k + 1)
        at, seen = _find(level.contexts, key >> U(8))
        first = seen & ~escaped[open_]
        if len(level.contexts):
            whole[open_[first]] = level.whole[at[first]]
            leave[open_[first]] = level.leave[at[first]]
        gram, hit = _find(level.grams, key)
        done = open_[hit]
        bits[done] += whole[done] - level.bits[gram[hit]]
        # What was not found escapes, if its context is known, and then meets what that context left.
        on = seen & ~hit
        rest = open_[on]
        bits[rest] += leave[rest]
        escaped[rest] = True
        if len(level.contexts):
            whole[rest] = level.next_whole[at[on]]
            leave[rest] = level.next_leave[at[on]]
        open_ = open_[~hit]
    bits[open_] += np.where(escaped[open_], whole[open_], 8.0)
    return bits


# --- scoring ----------------------------------------------------------------------------------


@dataclass
class Model:
    """Languages in order of code point, and the tree of each."""

    languages: list[str]
    trees: list[list[Level]]
    order: int
    table_bytes: int
    known: np.ndarray = field(init=False)
    lengths: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        entries = self.table_bytes // (8 + 4 * len(self.languages))
        self.bits = max(8, min(20, entries.bit_length() - 1))
        # A text's own keys never equal this one: its last byte would be padding.
        self.known = np.full(1 << self.bits, ~U(0))
        self.lengths = np.zeros((1 << self.bits, len(self.languages)), np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """[key, language]: code lengths in units of 2^-16 bit."""
        slot = (mixed(keys) >> U(64 - self.bits)).astype(np.int64)
        out = self.lengths[slot]
        miss = np.flatnonzero(self.known[slot] != keys)
        if len(miss):
            fresh, first, again = np.unique(keys[miss], return_index=True, return_inverse=True)
            found = np.stack([np.rint(code_lengths(t, fresh) * UNIT) for t in self.trees], axis=1).astype(np.int32)
            out[miss] = found[again]
            self.known[slot[miss[first]]] = fresh
            self.lengths[slot[miss[first]]] = found
        return out

    def totals(self, data: np.ndarray, offsets: np.ndarray, stretch: int) -> np.ndarray:
        """[text, language]: code lengths of whole texts, a bounded stretch of bytes at a time."""
        out = np.zeros((len(offsets) - 1, len(self.languages)), np.int64)
        step = max(4096, stretch // (4 * len(self.languages)))
        for start in range(0, len(data), step):
            end = min(start + step, len(data))
            before = min(start, self.order)
            key = keys_of(data[start - before : end], self.order)[before:]
            # The texts that begin or go on here; those that are empty have no bytes to add.
            low = int(np.searchsorted(offsets, start, side="right")) - 1
            high = int(np.searchsorted(offsets, end, side="left"))
            rows = np.arange(low, high)
            rows = rows[offsets[rows + 1] > np.maximum(offsets[rows], start)]
            for j in range(self.order):
                # Byte j of a text has j bytes of context, the others are padding.
                at = offsets[rows] + j - start
                at = at[(at >= 0) & (offsets[rows] + j < np.minimum(offsets[rows + 1], end))]
                key[at] |= U(((1 << 8 * (self.order + 1)) - 1) ^ ((1 << 8 * (j + 1)) - 1))
            out[rows] += np.add.reduceat(self.of(key), np.maximum(offsets[rows] - start, 0), axis=0, dtype=np.int64)
        return out


# --- Spark --------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def fitted(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The trees of all languages of the training rows; None without any."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("draw"),
    )
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).filter("bytes > 0")
    sizes = sizes.limit(settings.most_languages + 1).collect()
    if len(sizes) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    if not sizes:
        return None
    share = min(settings.language_bytes, settings.sample_bytes // len(sizes))
    rates = {r.lang: min(1.0, share / r.bytes) for r in sizes}
    order, passage = settings.order, settings.passage

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            count = -(-np.diff(offsets) // passage)
            row = np.repeat(np.arange(len(langs)), count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            draw = batch.column("draw").to_numpy().view(np.uint64)
            rate = np.array([rates[l] if l in rates else 0.0 for l in langs])
            luck = (mixed(draw[row] + mixed(place.astype(np.uint64) + U(1))) >> U(11)) * 2.0**-53
            chosen = np.flatnonzero(luck < rate[row])
            out = []
            for r, p in zip(row[chosen], place[chosen] * passage):
                begin = offsets[r] + p
                context = data[max(begin - order, offsets[r]) : begin].tobytes()
                body = data[begin : min(begin + passage, offsets[r + 1])].tobytes()
                out.append(bytes([PAD]) * (order - len(context)) + context + body)
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[r] for r in row[chosen]], pa.string()), pa.array(out, pa.binary())], names=["lang", "passage"]
            )

    def grown(group: pa.Table) -> pa.Table:
        parts = group["passage"].to_pylist()
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        inside = np.ones(len(data), bool)
        inside[(np.concatenate([[0], ends[:-1]])[:, None] + np.arange(order)).ravel()] = False
        levels = tree(keys_of(data, order)[inside], order)
        blob = [
            [x.astype("<u8" if x.dtype == np.uint64 else "<f8").tobytes() for x in vars(level).values()] for level in levels
        ]
        return pa.table({"lang": pa.array([group["lang"][0].as_py()]), "levels": pa.array([blob], pa.list_(pa.list_(pa.binary())))})

    trees = (
        rows.mapInArrow(drawn, "lang string, passage binary").groupBy("lang")
        .applyInArrow(grown, "lang string, levels array<array<binary>>").collect()
    )
    kinds = ["<u8", "<f8", "<u8", "<f8", "<f8", "<f8", "<f8"]
    read = {r.lang: [Level(*[np.frombuffer(b, k) for b, k in zip(level, kinds)]) for level in r.levels] for r in trees}
    return Model(sorted(read), [read[l] for l in sorted(read)], order, settings.table_bytes) if read else None


def predict(docs: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("string")).alias("text"),
    )
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            data, offsets = text_bytes(text)
            total = model.totals(data, offsets, settings.stretch)
            best = total.argmin(axis=1)
            behind = (total - total.min(axis=1, keepdims=True)) / UNIT
            score = 1 / np.exp2(-np.minimum(behind, 1000.0)).sum(axis=1)
            some = text.is_valid().to_numpy(zero_copy_only=False)
            names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, some)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                    pa.array(np.where(some, score, 0.0)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
