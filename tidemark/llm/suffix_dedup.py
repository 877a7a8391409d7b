"""Removal of byte strings that also start in a document with a smaller id.

Every byte covered by a string of ``length`` bytes (50) that also starts in a document with a
smaller id goes; matches never cross documents, overlaps count, and strings are judged on the
input.  Repeated strings are found on suffix ranges of a Burrows-Wheeler transform
(:mod:`tidemark.llm.bwt`), which needs texts that can repeat each other in one place.  An anchor
brings them there: the smallest hash among a string's 16-byte pieces depends on the string alone,
so all occurrences of a string have the same anchor, wherever they stand.  A run is a maximal
stretch of a document whose strings have one anchor.

1. Documents are dealt to batches by id, of bounded size.  A batch sends its anchors, eight bytes
   each and each once, to buckets by anchor.
   Runs of a batch that look alike count once; their number goes along.
2. A bucket tells each batch which of its anchors a second document has, and which are crowded: a
   short line in very many documents, each time with other text around it, would bring all these
   texts to one bucket.  Batches cut runs at a crowded anchor into their single strings, whose
   anchor is the hash of the whole string, and have these looked at in the same way.
3. The batch sends the texts of the runs at those anchors, each distinct text once with the
   smallest and the largest id that has it.  A passage in any number of documents thus reaches
   its bucket at most once a batch.
4. The bucket joins equal texts of all batches, takes those whose surroundings of the anchor agree
   on one side with another text's (two texts that share a string must), and expands them on the
   transform.  A text that stands alone is one suffix range by itself.  Each start gets the
   smallest id among its range.
5. The batch removes what starts in a document with a smaller id.

The documents are shuffled once; all visits read the same shuffle.  Of documents with equal
texts, only the one with the smallest id is looked at; in the others every byte goes, unless they
are shorter than a string.  Number and size of batches and buckets follow from the total bytes.

Defined cases: a null text is empty.  A row with a null id neither removes nor loses anything.
Rows that repeat an id do not remove each other's bytes.  Any bytes may occur, 0 included, in texts
of any length, which are judged whole; a text shorter than ``length`` loses nothing.  No rows give no
rows.  Further columns come back untouched in the struct ``doc``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.bwt import shared_prefix_groups
from tidemark.llm.store import stored
from tidemark.llm.words import BLOCK, blocks, mixed, text_bytes

U = np.uint64
PIECE = 16
MESSAGE = "b int, kind int, id long, payload binary"
COPY, SHARED, LEAST, CROWDED = 0, 1, 2, 3
SEGMENT = np.dtype([("run", "<i4"), ("low", "<i4"), ("high", "<i4"), ("least", "<i8")])
_ODD = U(0x9E3779B97F4A7C15)
_WEIGHT = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)


@dataclass(frozen=True)
class Settings:
    """``length`` is at least 24; ``batch_bytes`` and ``bucket_bytes`` bound what a task holds at a time.

    Every batch may write to every bucket.  Both sizes therefore follow the square root of the total,
    ``spread`` times, up to their bounds, so that the messages grow with the total and not with its
    square: batches of 9 MB for 1 GB of texts, of 128 MB, the bound, from 0.2 TB on.  An anchor with
    more than ``crowd`` run texts, summed over batches, is crowded.
    """

    length: int = 50
    spread: int = 300
    batch_bytes: int = 128 << 20
    bucket_bytes: int = 256 << 20
    expand_letters: int = 1 << 20
    crowd: int = 4096

    def deal(self, total: int) -> tuple[int, int]:
        """(number of batches, number of buckets) for so many bytes of text."""
        size = max(1, int(self.spread * total**0.5))
        return max(1, -(-total // min(size, self.batch_bytes))), max(1, -(-total // min(2 * size, self.bucket_bytes)))


# --- anchors ---------------------------------------------------------------------------------


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 16 bytes from every place on."""
    n = len(data) - PIECE + 1
    word = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    h = word[:n] * _ODD
    h ^= h >> U(29)
    h += word[8 : 8 + n]
    h *= _ODD
    h ^= h >> U(32)
    h *= _ODD
    h ^= h >> U(29)
    return h


def _anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The smallest piece hash of the string that starts at each place."""
    h, span, wide = _piece_hashes(data), length - PIECE + 1, 1
    while wide * 2 <= span:
        h = np.minimum(h[:-wide], h[wide:])
        wide *= 2
    rest = span - wide
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


@dataclass
class Runs:
    """Runs of a batch: first byte, number of strings, anchor, and row."""

    start: np.ndarray
    size: np.ndarray
    anchor: np.ndarray
    row: np.ndarray


def _runs(data: np.ndarray, offsets: np.ndarray, length: int) -> Runs:
    starts, sizes, anchors = [], [], []
    for a, b in blocks(offsets):
        begin, end = int(offsets[a]), int(offsets[b])
        last = end - length + 1
        if last <= begin:
            continue
        # A run also ends where a document does: at its first string that would cross the end.
        cuts = np.concatenate([offsets[a:b], np.maximum(offsets[a + 1 : b + 1] - length + 1, offsets[a:b])])
        cuts = cuts[cuts < last]
        at, value, before = [], [], None
        for k in range(begin, last, BLOCK):
            high = min(k + BLOCK, last)
            m = _anchors(np.ascontiguousarray(data[k : high + length - 1]), length)
            new = np.ones(len(m), bool)
            new[1:] = m[1:] != m[:-1]
            if before is not None:
                new[0] = m[0] != before
            new[cuts[(cuts >= k) & (cuts < high)] - k] = True
            found = np.flatnonzero(new)
            at.append(found + k)
            value.append(m[found])
            before = m[-1]
        at, value = np.concatenate(at), np.concatenate(value)
        size = np.diff(np.concatenate([at, [last]]))
        doc_end = offsets[np.searchsorted(offsets, at, side="right")]
        whole = at + length <= doc_end
        starts.append(at[whole])
        sizes.append(size[whole])
        anchors.append(mixed(value[whole]))
    none = np.zeros(0, np.int64)
    start = np.concatenate([none, *starts]).astype(np.int64)
    return Runs(
        start,
        np.concatenate([none, *sizes]).astype(np.int64),
        np.concatenate([none.astype(np.uint64), *anchors]),
        np.searchsorted(offsets, start, side="right") - 1,
    )


def _split(runs: Runs, data: np.ndarray, crowded: np.ndarray, length: int) -> tuple[Runs, np.ndarray]:
    """Runs at crowded anchors replaced by one run for each of their strings; which ones are new."""
    hot = _known(runs.anchor, crowded)
    n = runs.size[hot]
    start = np.repeat(runs.start[hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    anchor = np.zeros(len(start), np.uint64)
    for a in range(0, len(start), BLOCK):
        at = start[a : a + BLOCK]
        h = np.zeros(len(at), np.uint64)
        # Eights of bytes, the last one flush with the end.
        for k in [*range(0, length - 8, 8), length - 8]:
            word = data[at[:, None] + np.arange(k, k + 8)].view("<u8")[:, 0]
            h = mixed((h ^ word) * _ODD + U(k + 1))
        anchor[a : a + BLOCK] = h
    parts = [
        (runs.start, start), (runs.size, np.ones(len(start), np.int64)), (runs.anchor, anchor), (runs.row, np.repeat(runs.row[hot], n)),
    ]
    new = np.concatenate([np.zeros(int((~hot).sum()), bool), np.ones(len(start), bool)])
    return Runs(*[np.concatenate([old[~hot], more]) for old, more in parts]), new


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of anchors."""
    return ((anchor >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _known(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the byte ranges in a row, their offsets), copied in blocks."""
    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    out = np.empty(bounds[-1], np.uint8)
    for a, b in blocks(bounds, 1 << 20):
        begin, end = bounds[a], bounds[b]
        out[begin:end] = data[np.arange(end - begin) + np.repeat(start[a:b] - (bounds[a:b] - begin), size[a:b])]
    return out, bounds


def _texts(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow array."""
    flat, bounds = _gathered(data, start, size)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])


def _numbers(blob: bytes | None, kind: str) -> np.ndarray:
    return np.frombuffer(blob or b"", kind)


def _least_by(code: np.ndarray, groups: int, value: np.ndarray, of=np.minimum) -> np.ndarray:
    """The smallest (or another ``of``) value of each code; every code occurs."""
    order = np.argsort(code, kind="stable")
    return of.reduceat(value[order], np.searchsorted(code[order], np.arange(groups))) if groups else value[:0]


# --- the visits to a batch ---------------------------------------------------------------------


class _Batch:
    """The documents of a batch in a fixed order, without those that copy another."""

    def __init__(self, docs: pa.Table, messages: pa.Table, settings: Settings):
        self.settings = settings
        docs = docs.take(pc.sort_indices(docs, [("id", "ascending"), ("text", "ascending")]))
        self.docs, self.ids = docs, docs["id"].to_pylist()
        self.data, self.offsets = text_bytes(docs["text"])
        kinds = messages["kind"].to_numpy()
        self.payloads = [messages["payload"].filter(pa.array(kinds == k)).to_pylist() for k in (COPY, SHARED, LEAST, CROWDED)]
        copies = set(zip(messages["id"].filter(pa.array(kinds == COPY)).to_pylist(), self.payloads[COPY]))
        named = {i for i, _ in copies}
        self.copy = np.array(
            [i in named and (i, hashlib.sha256(self.text(k)).digest()) in copies for k, i in enumerate(self.ids)], bool
        )
        self.own = np.flatnonzero(~self.copy & np.array([i is not None for i in self.ids], bool))
        # Bytes of the documents looked at, in a row of their own.
        parts = [self.data[self.offsets[k] : self.offsets[k + 1]] for k in self.own]
        self.bytes = np.concatenate([*parts, np.zeros(0, np.uint8)])
        self.bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.doc = np.array([self.ids[k] for k in self.own], np.int64)
        self.runs = _runs(self.bytes, self.bounds, settings.length)
        crowded = np.unique(np.concatenate([*[_numbers(x, "<u8") for x in self.payloads[CROWDED]], np.zeros(0, np.uint64)]))
        self.runs, self.single = _split(self.runs, self.bytes, crowded, settings.length)

    def text(self, k: int) -> bytes:
        return self.data[self.offsets[k] : self.offsets[k + 1]].tobytes()

    def texts(self, which: np.ndarray) -> pa.Array:
        return _texts(self.bytes, self.runs.start[which], self.runs.size[which] + self.settings.length - 1)


def _alike(batch: _Batch, runs: Runs) -> np.ndarray:
    """A number for each run that tells most texts of one anchor apart."""
    last = runs.start + runs.size + batch.settings.length - 9
    word = np.ndarray((max(0, len(batch.bytes) - 7),), "<u8", buffer=batch.bytes, strides=(1,)) if len(runs.start) else np.zeros(0, "<u8")
    return mixed(mixed(word[runs.start] * _ODD + word[last]) + runs.size.astype(np.uint64))


def _send_anchors(batch: _Batch, b: int, buckets: int, single: bool = False) -> pa.Table:
    """The anchors of all runs, or of those only that are strings of crowded anchors."""
    runs = batch.runs
    if single:
        runs = Runs(*[x[batch.single] for x in (runs.start, runs.size, runs.anchor, runs.row)])
    order = np.argsort(runs.anchor, kind="stable")
    sorted_anchor, row = runs.anchor[order], runs.row[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_anchor[1:] != sorted_anchor[:-1]])) if len(order) else order
    anchor = sorted_anchor[first]
    several = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first) if len(first) else np.zeros(0, bool)
    times = np.ones(len(first), np.int32)
    if several.any() and not single:
        group = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(order)]])))
        among = np.flatnonzero(several[group])
        chosen = order[among]
        looks = _alike(batch, Runs(*[x[chosen] for x in (runs.start, runs.size, runs.anchor, runs.row)]))
        by = np.lexsort((looks, group[among]))
        g, looks = group[among][by], looks[by]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (looks[1:] != looks[:-1])])
        times = np.maximum(1, np.bincount(g[new], minlength=len(first))).astype(np.int32)
    edges = np.searchsorted(_bucket(anchor, buckets), np.arange(buckets + 1))
    filled = np.flatnonzero(np.diff(edges))
    parts = [(anchor[edges[k] : edges[k + 1]], several[edges[k] : edges[k + 1]], times[edges[k] : edges[k + 1]]) for k in filled]
    return pa.table(
        {
            "k": pa.array(filled.astype(np.int32)),
            "b": pa.array(np.full(len(filled), b, np.int32)),
            "once": pa.array([x[~s].tobytes() for x, s, _ in parts], pa.binary()),
            "several": pa.array([x[s].tobytes() for x, s, _ in parts], pa.binary()),
            "times": pa.array([n[s].astype("<i4").tobytes() for _, s, n in parts], pa.binary()),
        }
    )


def _share_anchors(sent: pa.Table, crowd: int | None) -> pa.Table:
    """Which anchors a second document has, and which of these have more than ``crowd`` texts."""
    once = [_numbers(x, "<u8") for x in sent["once"].to_pylist()]
    several = [_numbers(x, "<u8") for x in sent["several"].to_pylist()]
    every = np.sort(np.concatenate([*once, *several, np.zeros(0, np.uint64)]))
    repeated = every[1:][every[1:] == every[:-1]]
    shared = np.unique(np.concatenate([repeated, *several]))
    to = sent["b"].to_pylist()
    reply = [np.concatenate([x[_known(x, shared)], y]) for x, y in zip(once, several)]
    found = _messages(to, SHARED, [x.tobytes() for x in reply])
    if crowd is None or not len(shared):
        return found
    texts = np.searchsorted(every, shared, side="right") - np.searchsorted(every, shared)
    for x, n in zip(several, [_numbers(x, "<i4") for x in sent["times"].to_pylist()]):
        np.add.at(texts, np.searchsorted(shared, x), n - 1)
    crowded = shared[texts > crowd]
    return pa.concat_tables([found, _messages(to, CROWDED, [x[_known(x, crowded)].tobytes() for x in reply])])


def _messages(to: list[int], kind: int, payloads: list[bytes]) -> pa.Table:
    keep = [k for k, p in enumerate(payloads) if p]
    return pa.table(
        {
            "b": pa.array([to[k] for k in keep], pa.int32()),
            "kind": pa.array([kind] * len(keep), pa.int32()),
            "id": pa.nulls(len(keep), pa.int64()),
            "payload": pa.array([payloads[k] for k in keep], pa.binary()),
        }
    )


def _send_texts(batch: _Batch, b: int, buckets: int) -> pa.Table:
    shared = np.unique(np.concatenate([*[_numbers(x, "<u8") for x in batch.payloads[SHARED]], np.zeros(0, np.uint64)]))
    which = np.flatnonzero(_known(batch.runs.anchor, shared))
    coded = batch.texts(which).dictionary_encode()
    code, n = coded.indices.to_numpy(), len(coded.dictionary)
    doc = batch.doc[batch.runs.row[which]]
    run = _least_by(code, n, which)
    low, high = _least_by(code, n, doc), _least_by(code, n, doc, np.maximum)
    bucket = _bucket(batch.runs.anchor[run], buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out: dict[str, list] = {x: [] for x in ("k", "b", "text", "sizes", "run", "low", "high")}
    for k in np.flatnonzero(np.diff(edges)):
        part = run[order[edges[k] : edges[k + 1]]]
        data, offsets = text_bytes(batch.texts(part))
        chosen = order[edges[k] : edges[k + 1]]
        row = (int(k), b, data.tobytes(), np.diff(offsets).astype("<i4").tobytes(), part.astype("<i4").tobytes())
        for name, value in zip(out, (*row, low[chosen].astype("<i8").tobytes(), high[chosen].astype("<i8").tobytes())):
            out[name].append(value)
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def _cut(batch: _Batch, with_text: bool) -> pa.Table:
    length, runs = batch.settings.length, batch.runs
    segments = np.concatenate([*[_numbers(x, SEGMENT) for x in batch.payloads[LEAST]], np.zeros(0, SEGMENT)])
    removed = np.zeros(len(batch.bytes) + 1, np.int32)
    if len(segments):
        segments = segments[np.argsort(segments["run"], kind="stable")]
        named, counts = np.unique(segments["run"], return_counts=True)
        which = np.flatnonzero(_known(runs.anchor, np.unique(runs.anchor[named])))
        code = batch.texts(which).dictionary_encode().indices.to_numpy()
        of_code = np.full(int(code.max()) + 1, -1)
        of_code[code[np.searchsorted(which, named)]] = np.arange(len(named))
        slot = of_code[code]
        which, slot = which[slot >= 0], slot[slot >= 0]
        first = np.concatenate([[0], np.cumsum(counts)])
        n = counts[slot]
        at = np.arange(n.sum()) + np.repeat(first[slot] - np.concatenate([[0], np.cumsum(n)])[:-1], n)
        which, found = np.repeat(which, n), segments[at]
        less = found["least"] < batch.doc[runs.row[which]]
        which, found = which[less], found[less]
        np.add.at(removed, runs.start[which] + found["low"], 1)
        np.add.at(removed, runs.start[which] + found["high"] - 1 + length, -1)
    gone = np.cumsum(removed[:-1], dtype=np.int32) > 0
    place = {int(k): j for j, k in enumerate(batch.own)}
    rows: list[tuple] = []
    kept_texts: list[bytes] = []
    for k in range(len(batch.ids)):
        text = batch.text(k)
        mask = np.zeros(len(text), bool)
        if batch.copy[k]:
            mask[:] = len(text) >= length
        elif k in place:
            mask = gone[batch.bounds[place[k]] : batch.bounds[place[k] + 1]]
        spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0
        kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if spans else text
        rows.append((batch.ids[k], len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
        kept_texts.append(kept)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [()] * 5, kinds)]
    out = dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), columns))
    if with_text:
        # A cut can split a character; what is left of one goes as well.
        out["kept_text"] = pa.array([x.decode("utf-8", "ignore") for x in kept_texts], pa.string())
        out["doc"] = batch.docs["doc"]
    return pa.table(out)


# --- a bucket ----------------------------------------------------------------------------------


def _least_ids(sent: pa.Table, settings: Settings) -> pa.Table:
    """For every text sent, the starts whose string a smaller id has than the text's largest."""
    sizes = [_numbers(x, "<i4") for x in sent["sizes"].to_pylist()]
    low = np.concatenate([_numbers(x, "<i8") for x in sent["low"].to_pylist()])
    high = np.concatenate([_numbers(x, "<i8") for x in sent["high"].to_pylist()])
    run = np.concatenate([_numbers(x, "<i4") for x in sent["run"].to_pylist()])
    data = np.frombuffer(b"".join(sent["text"].to_pylist()), np.uint8)
    size = np.concatenate(sizes).astype(np.int64)
    coded = _texts(data, np.concatenate([[0], np.cumsum(size)])[:-1], size).dictionary_encode()
    code, texts = coded.indices.to_numpy(), coded.dictionary
    least = _least_by(code, len(texts), low)
    of, start, end, value = _segments(*text_bytes(texts), least, settings)
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    n = np.diff(first)[code]
    at = np.arange(n.sum()) + np.repeat(first[code] - np.concatenate([[0], np.cumsum(n)])[:-1], n)
    sender = np.repeat(np.repeat(np.arange(len(sizes)), [len(x) for x in sizes]), n)
    out = np.zeros(len(at), SEGMENT)
    out["run"], out["low"], out["high"], out["least"] = np.repeat(run, n), start[at], end[at], value[at]
    useful = value[at] < np.repeat(high, n)
    out, sender = out[useful], sender[useful]
    edges = np.searchsorted(sender, np.arange(len(sizes) + 1))
    payloads = [out[edges[k] : edges[k + 1]].tobytes() for k in range(len(sizes))]
    return _messages(sent["b"].to_pylist(), LEAST, payloads)


def _segments(data: np.ndarray, offsets: np.ndarray, least: np.ndarray, settings: Settings):
    """(text, low, high, id), by text: strings starting from low to high of it occur first in that id.

    Texts of one anchor are worked on together, those of about ``expand_letters`` at a time.
    """
    length, size = settings.length, np.diff(offsets)
    anchor = np.empty(len(size), np.uint64)
    for a, b in blocks(offsets, 1 << 20):
        raw = _piece_hashes(np.ascontiguousarray(data[offsets[a] : offsets[b]]))
        first = offsets[a:b] - offsets[a]
        smallest = raw[first]
        for k in range(1, length - PIECE + 1):
            np.minimum(smallest, raw[first + k], out=smallest)
        anchor[a:b] = mixed(smallest)
    order = np.argsort(anchor, kind="stable")
    borders = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1], [True]])) if len(order) else []
    total = np.concatenate([[0], np.cumsum(size[order] + 1)])
    found, begin = [], 0
    for end in borders[1:]:
        if total[end] - total[begin] >= settings.expand_letters or end == len(order):
            rows = order[begin:end]
            flat, bounds = _gathered(data, offsets[:-1][rows], size[rows])
            of, *rest = _chunk(flat, bounds, anchor[rows], least[rows], settings)
            found.append((rows[of], *rest))
            begin = end
    of, start, end, value = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(of, kind="stable")
    return of[order], start[order], end[order], value[order]


def _chunk(data, offsets, anchor, least, settings: Settings):
    """Segments of texts that hold all texts of their anchors."""
    length = settings.length
    joint = _expanding(data, offsets, anchor, settings)
    alone, together = np.flatnonzero(~joint), np.flatnonzero(joint)
    single = (alone, np.zeros(len(alone), np.int64), np.diff(offsets)[alone] - length + 1, least[alone])
    if not len(together):
        return single
    return tuple(np.concatenate(x) for x in zip(single, _expanded(data, offsets, together, least, length)))


def _expanding(data, offsets, anchor, settings: Settings) -> np.ndarray:
    """Which texts may share a string with another text.

    Around its anchor, a shared string reaches at least half of its other bytes to one side.  So
    one of two pieces, the anchor with half of them on the left or with the rest on the right, is
    the same in both texts.  Where an anchor occurs more than once in a text, all texts with it go.
    """
    n, half = len(offsets) - 1, (settings.length - PIECE) // 2
    pieces = mixed(_piece_hashes(data))
    of_byte = np.repeat(np.arange(n), np.diff(offsets))[: len(pieces)]
    hit = np.flatnonzero(pieces == anchor[of_byte])
    hit = hit[hit + PIECE <= offsets[of_byte[hit] + 1]]
    times = np.bincount(of_byte[hit], minlength=n)
    place = np.zeros(n, np.int64)
    place[of_byte[hit]] = hit
    _, group, count = np.unique(anchor, return_inverse=True, return_counts=True)
    several = count[group] > 1
    vague = np.bincount(group[times != 1], minlength=len(count))[group] > 0
    joint = several & vague
    clear = np.flatnonzero(several & ~vague)
    for low, wide in ((half, PIECE + half), (0, settings.length - half)):
        start = place[clear] - low
        fits = (start >= offsets[clear]) & (start + wide <= offsets[clear + 1])
        rows, start = clear[fits], start[fits]
        key = anchor[rows].copy()
        for k in range(wide):
            key += _WEIGHT[data[start + k]] * U((2 * k + 1) * int(_ODD) % (1 << 64))
        _, again, times_seen = np.unique(key, return_inverse=True, return_counts=True)
        joint[rows[times_seen[again] > 1]] = True
    return joint


def _expanded(data, offsets, which, least, length):
    """Segments of the texts ``which`` by expansion on their transform."""
    size = np.diff(offsets)[which]
    bounds = np.concatenate([[0], np.cumsum(size + 1)])
    letters = np.zeros(bounds[-1], np.uint16)
    inside = np.ones(bounds[-1], bool)
    inside[bounds[1:] - 1] = False
    flat = np.arange(size.sum()) + np.repeat(offsets[which] - np.concatenate([[0], np.cumsum(size)])[:-1], size)
    letters[inside] = data[flat].astype(np.uint16) + 1
    order, group = shared_prefix_groups(letters, length)
    text = np.repeat(np.arange(len(which)), size + 1)
    starts = np.arange(len(letters)) + length < bounds[1:][text]
    value = np.where(starts, least[which][text], np.iinfo(np.int64).max)[order]
    smallest = np.minimum.reduceat(value, np.searchsorted(group, np.arange(group[-1] + 1)))
    value = np.empty(len(letters), np.int64)
    value[order] = smallest[group]
    at = np.flatnonzero(starts)
    own, value = text[at], value[at]
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (value[1:] != value[:-1])]))
    count = np.diff(np.concatenate([new, [len(at)]]))
    low = at[new] - bounds[own[new]]
    return which[own[new]], low, low + count, value[new]


# --- the job -----------------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, settings: Settings = Settings(), with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row; with text also kept_text and doc."""
    sums = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("id"),
            F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("payload"),
            F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"),
        ),
        "text-sums",
    )
    total = sums.agg(F.sum("bytes")).first()[0] or 0
    batches, buckets = settings.deal(total)
    b = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("b")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    dealt = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), *([doc] if with_text else []))
    dealt = dealt.select(b, "*")
    firsts = sums.filter("id IS NOT NULL").groupBy("payload").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    copies = sums.join(firsts.filter("n > 1"), "payload").filter("id > least").select(
        b, F.lit(COPY).alias("kind"), "id", "payload"
    )
    copies = stored(copies, "copies")

    def visit(messages: DataFrame, work, schema, needs: int | None = None) -> DataFrame:
        nothing = _no_rows(schema)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or needs is not None and needs not in right["kind"].to_pylist():
                return nothing
            return work(_Batch(left, right, settings), left["b"][0].as_py())

        return dealt.groupBy("b").cogroup(messages.groupBy("b")).applyInArrow(run, schema)

    sent = "k int, b int, once binary, several binary, times binary"
    anchors = visit(copies, lambda batch, b: _send_anchors(batch, b, buckets), sent)
    shared = anchors.groupBy("k").applyInArrow(lambda t: _share_anchors(t, settings.crowd), MESSAGE)
    crowded = shared.filter(F.col("kind") == CROWDED)
    strings = visit(
        copies.unionByName(crowded), lambda batch, b: _send_anchors(batch, b, buckets, single=True), sent, needs=CROWDED
    )
    again = strings.groupBy("k").applyInArrow(lambda t: _share_anchors(t, None), MESSAGE)
    texts = visit(
        copies.unionByName(shared).unionByName(again),
        lambda batch, b: _send_texts(batch, b, buckets),
        "k int, b int, text binary, sizes binary, run binary, low binary, high binary",
    )
    smallest = texts.groupBy("k").applyInArrow(lambda sent: _least_ids(sent, settings), MESSAGE)
    fields = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if with_text:
        fields = fields.add("kept_text", "string").add("doc", dealt.schema["doc"].dataType)
    return visit(copies.unionByName(crowded).unionByName(smallest), lambda batch, b: _cut(batch, with_text), fields)


def _no_rows(schema) -> pa.Table:
    """An empty table; schemas can be read in the driver only."""
    return to_arrow_schema(schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)).empty_table()


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents with repeated strings cut from their texts, columns as they were.

    ``n_chars``, where there is one, counts the text that is left.
    """
    cut = remove_repeats(docs, settings, with_text=True)
    columns = [
        F.col("kept_text").alias("text") if c == "text"
        else F.length("kept_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("doc").getField(c).alias(c)
        for c in docs.columns
    ]
    return cut.select(*columns)
