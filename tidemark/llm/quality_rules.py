"""Quality rules by distribution divergence.

A document is described by two histograms: character classes, and common words.  Both are
compared with the reference of the document's language by Jensen-Shannon distance (base 2, so
between 0 and 1).  The references are the histograms of all other documents of a language, gathered
in a first pass, from which a document's own counts are taken off.  With less than
``least_reference`` words left, the language says nothing, and all other documents together are the
reference; with less than that in these too, only the base rules judge.  Words are counted in a fixed number of hash cells, so a reference has the same
size whatever the corpus holds; its common words are the cells with the largest counts, all other
words are one class.

The references of the ``languages`` languages with most documents go to every task; those of all
others stay in a table, which their documents are joined to.  A document's verdict is the same
either way, and a language that is joined has less than one in ``languages`` of the documents.

Defined cases: null and empty texts have no words and fail the base rules.  A null, empty or
unknown language is compared with the reference of all documents together.  A document below
``least_words`` words gives no stable histogram: only the base rules judge it.  Texts of any length
are counted whole; a distance equal to its bound passes, and of cells with equal counts the lower is
the common one.  Repeated rows are judged one by one, each a reference for the others; null ids are
kept as they are.  No rows give no rows.  Other columns are not looked at, and come back as they were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import stored
from tidemark.llm.words import blocks, text_bytes, windows, words_of

CELLS = 4096
SYMBOLS = b"#*$%&|<>"
# Character classes, by the first byte of a character; 255 marks the other bytes of one.
CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "symbol", "mark", "control", "latin", "wide")
CLASS = np.full(256, CLASSES.index("mark"), np.uint8)
CLASS[:32] = CLASS[127] = CLASSES.index("control")
CLASS[[32, 9, 11, 12, 13]] = CLASSES.index("blank")
CLASS[10] = CLASSES.index("line")
CLASS[list(b".,;:!?'\"()-")] = CLASSES.index("stop")
CLASS[list(SYMBOLS)] = CLASSES.index("symbol")
CLASS[48:58] = CLASSES.index("digit")
CLASS[65:91] = CLASSES.index("upper")
CLASS[97:123] = CLASSES.index("lower")
CLASS[0x80:0xC0] = 255
CLASS[0xC0:0xE0] = CLASSES.index("latin")
CLASS[0xE0:] = CLASSES.index("wide")
LINE, BLANK = CLASSES.index("line"), CLASSES.index("blank")
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True

SIZE = len(CLASSES) + CELLS
REFERENCE = "chars binary, top binary, words binary"
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Limits:
    """The first two limits are the base rules; the distances were set on labelled documents.

    A histogram of n words strays from its source by about 1 / sqrt(n), so each distance has a
    fixed part and a ``noise`` part that shrinks with the length.
    """

    min_words: int = 10
    repeat_percent: int = 20
    least_words: int = 50
    least_reference: int = 1000
    char_distance: float = 0.16
    char_noise: float = 1.0
    word_distance: float = 0.27
    word_noise: float = 1.9
    common: int = 100
    languages: int = 256


@dataclass
class References:
    """Histograms by language: shares of character classes and of common words, the cells of these,
    and the counts behind the shares.

    ``rest`` has the languages that are not held, as (language, chars, top, words); None if all are.
    """

    chars: dict[str, np.ndarray] = field(default_factory=dict)
    cells: dict[str, np.ndarray] = field(default_factory=dict)
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    rest: DataFrame | None = None

    def add(self, lang: str, counts: np.ndarray, common: int) -> None:
        chars, top, words = reference(counts, common)
        self.chars[lang], self.chars[lang + "\0words"] = shares(chars), shares(words)
        self.cells[lang], self.counts[lang] = ranks(top, common), (chars, words)


def ranks(top: np.ndarray, common: int) -> np.ndarray:
    """The rank of each cell, where all that are not common have one."""
    rank = np.full(CELLS, common, np.int16)
    rank[top] = np.arange(len(top))
    return rank


def reference(counts: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the character classes, the common cells, and counts of these and all others."""
    words = counts[len(CLASSES) : SIZE]
    top = np.argsort(-words, kind="stable")[:common].astype(np.int16)
    common_words = np.zeros(common + 1, np.int64)
    np.add.at(common_words, ranks(top, common), words)
    return counts[: len(CLASSES)].copy(), top, common_words


def shares(counts: np.ndarray) -> np.ndarray:
    return counts / max(counts.sum(), 1)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2."""
    m = (p + q) / 2
    a, b = p > 0, q > 0
    d = (p[a] * np.log2(p[a] / m[a])).sum() + (q[b] * np.log2(q[b] / m[b])).sum()
    return float(np.sqrt(max(d / 2, 0.0)))


def _class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    kind = CLASS[data]
    real = kind != 255
    flat = np.bincount(row[real] * len(CLASSES) + kind[real], minlength=(len(offsets) - 1) * len(CLASSES))
    return flat.reshape(-1, len(CLASSES))


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(texts)
    for a, b in blocks(offsets):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Histograms by language, one row per filled cell, and the number of documents as cell SIZE; at
    most 64 languages are held at once."""
    held: dict[str | None, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        langs, cells, counts = [], [], []
        for lang, c in held.items():
            filled = np.flatnonzero(c)
            langs += [lang] * len(filled)
            cells.append(filled)
            counts.append(c[filled])
        held.clear()
        arrays = [pa.array(langs, pa.string()), *(pa.array(np.concatenate(x).astype(k)) for x, k in ((cells, "i4"), (counts, "i8")))]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "cell", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for a, b, data, offsets in _parts(batch.column("text")):
            kinds = _class_counts(data, offsets)
            words = words_of(data, offsets, lower=True)
            cell = (words.hash % np.uint64(CELLS)).astype(np.int64)
            for k in range(b - a):
                c = held.setdefault(langs[a + k], np.zeros(SIZE + 1, np.int64))
                c[: len(CLASSES)] += kinds[k]
                c[SIZE] += 1
                np.add.at(c, cell[words.first[k] : words.first[k + 1]] + len(CLASSES), 1)
                if len(held) > 64:
                    yield out()
    if held:
        yield out()


def references(docs: DataFrame, limits: Limits = Limits()) -> References:
    """References over all documents; what reaches the driver is bounded by the parameters."""
    counted = docs.select("lang", "text").mapInArrow(_count, "lang string, cell int, n long")
    counted = stored(counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")), "histograms")
    found = References()
    total = np.zeros(SIZE + 1, np.int64)
    sizes = counted.filter(f"cell = {SIZE} AND lang <> ''").orderBy(F.desc("n"), "lang").limit(limits.languages + 1)
    largest = [r.lang for r in sizes.select("lang").collect()]
    held = largest[: limits.languages]
    by_lang: dict[str, np.ndarray] = {lang: np.zeros(SIZE + 1, np.int64) for lang in held}
    for lang, cell, n in counted.filter(F.col("lang").isin(held)).select("lang", "cell", "n").collect():
        by_lang[lang][cell] = n
    for lang, counts in by_lang.items():
        found.add(lang, counts, limits.common)
    for cell, n in counted.groupBy("cell").agg(F.sum("n")).collect():
        total[cell] = n
    found.add("", total, limits.common)
    if len(largest) > len(held):
        found.rest = stored(_others(counted.filter(~F.col("lang").isin([*held, ""])), limits.common), "references")
    return found


def _others(counted: DataFrame, common: int) -> DataFrame:
    """(language, chars, top, words) of each language; a row of cells has at most SIZE + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, ...]] = []
            for cells in batch.column("cells"):
                counts = np.zeros(SIZE + 1, np.int64)
                at = cells.values
                counts[at.field("cell").to_numpy()] = at.field("n").to_numpy()
                out.append(tuple(x.tobytes() for x in reference(counts, common)))
            parts = [pa.array(x, pa.binary()) for x in (zip(*out) if out else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([batch.column("language"), *parts], names=["language", "chars", "top", "words"])

    rows = counted.groupBy(F.col("lang").alias("language")).agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    return rows.mapInArrow(run, f"language string, {REFERENCE}")


def _repeat_words(h: np.ndarray, n: int, size: int = 5) -> int:
    """Words covered by windows of a row that occur twice or more in it."""
    if n < size or len(h) < 2:
        return 0
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(len(h) + 1, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return int((np.cumsum(step)[:n] > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def judge(docs: DataFrame, refs: References, limits: Limits = Limits(), columns: list[str] | None = None) -> DataFrame:
    """The documents with their measures, ``base_failed``, both distances and ``kept``.

    The input's columns, or those named in ``columns``, come in a struct ``doc``, so no name of theirs
    can clash.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    own = F.lit(None).cast(T.StructType.fromDDL(REFERENCE)).alias("own")
    if refs.rest is None:
        met = rows.select("doc", own)
    else:
        here = F.coalesce(F.col("doc.lang").isin(list(refs.cells)), F.lit(True))
        theirs = refs.rest.select("language", F.struct("chars", "top", "words").alias("own"))
        joined = rows.filter(~here).join(theirs, F.col("doc.lang") == F.col("language"), "left")
        met = rows.filter(here).select("doc", own).unionByName(joined.select("doc", "own"))
    given = docs.columns if columns is None else columns
    back = T.StructType([f for f in rows.schema["doc"].dataType.fields if f.name in given])
    schema = T.StructType(
        [T.StructField("doc", back, False), *T.StructType.fromDDL(MEASURES).fields]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("char_distance", T.DoubleType())]
        + [T.StructField("word_distance", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    )

    # Tasks get the languages that are held, not the table of the others.
    held = References(cells=refs.cells, counts=refs.counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc")
            place = {f.name: k for k, f in enumerate(doc.type)}
            langs = doc.field(place["lang"]).to_pylist()
            owns = batch.column("own").to_pylist()
            found: list[tuple] = []
            for a, b, data, offsets in _parts(doc.field(place["text"])):
                found += _judge_block(data, offsets, langs[a:b], owns[a:b], held, limits)
            columns = list(zip(*found)) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            kept = doc
            if columns is not None:
                fields = [f for f in doc.type if f.name in given]
                kept = pa.StructArray.from_arrays([doc.field(place[f.name]) for f in fields], fields=fields)
            yield pa.RecordBatch.from_arrays([kept, *arrays], names=schema.names)

    return met.mapInArrow(run, schema)


def _judge_block(data, offsets, langs, owns, refs: References, limits: Limits) -> list[tuple]:
    kinds = _class_counts(data, offsets)
    words = words_of(data, offsets, lower=False)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((CLASS[data] != 255) & (CLASS[data] != BLANK) & (CLASS[data] != LINE), out=lead[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(IS_SYMBOL[data], out=symbols[1:])
    shingles, bounds = windows(words, 5)
    cells = (words_of(data, offsets, lower=True).hash % np.uint64(CELLS)).astype(np.int64)
    out = []
    for k, (lang, own) in enumerate(zip(langs, owns)):
        n = int(words.first[k + 1] - words.first[k])
        s, e = offsets[k], offsets[k + 1]
        repeats = _repeat_words(shingles[bounds[k] : bounds[k + 1]], n)
        failed = n < limits.min_words or 100 * repeats > limits.repeat_percent * n
        near = [0.0, 0.0]
        if n >= limits.least_words:
            if own is not None:
                theirs = [(np.frombuffer(own["chars"], np.int64), ranks(np.frombuffer(own["top"], np.int16), limits.common), np.frombuffer(own["words"], np.int64))]
            else:
                theirs = [(refs.counts[lang][0], refs.cells[lang], refs.counts[lang][1])] if lang and lang in refs.cells else []
            for chars, rank, common in [*theirs, (refs.counts[""][0], refs.cells[""], refs.counts[""][1])]:
                mine = np.bincount(rank[cells[words.first[k] : words.first[k + 1]]], minlength=limits.common + 1)
                # The reference is what the others hold.
                others = common - mine
                if others.sum() >= limits.least_reference:
                    near = [distance(shares(kinds[k]), shares(chars - kinds[k])), distance(shares(mine), shares(others))]
                    break
        noise = max(n, 1) ** -0.5
        kept = not failed and near[0] <= limits.char_distance + limits.char_noise * noise
        kept = kept and near[1] <= limits.word_distance + limits.word_noise * noise
        out.append(
            (n, int(lead[e] - lead[s]), int(symbols[e] - symbols[s]), _dup_lines(data[s:e].tobytes()), repeats, failed, *near, kept)
        )
    return out
