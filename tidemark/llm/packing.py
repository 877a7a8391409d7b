"""Packing documents into sequences of at most ``length`` tokens, online and in bounded space.

Each partition keeps a fixed number of open windows.  Whole windows' worth of a long document is
emitted at once.  What is left of it goes to the open window it fills best; if none has room and
no more may be opened, the fullest is filled up with the head of the piece and emitted, and the
tail is placed again.  At the end of a partition, the emptiest open windows fill up the fullest, so
at most one window is left.  The leftovers of up to ``fan_in`` partitions are merged in the same
way by one task, level by level, until one window is left: the only one with padding.

Defined cases: a null or empty text is the end token alone.  Rows are packed one by one, repeated
or with null ids alike.  Of windows that a piece fills equally well, the first opened takes it; ids
have no part in the order.  A text of any length is cut into whole windows and a rest.  Other columns
are not looked at.  No rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.tokens import encoder

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "open boolean, ids binary"
)


@dataclass(frozen=True)
class Settings:
    vocabulary: str
    end: int = 1
    length: int = 2048
    open_windows: int = 32
    fan_in: int = 1000


@dataclass(frozen=True)
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def split(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
            Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens),
        )


class Packer:
    """Packs pieces one by one; full windows collect in ``full``."""

    def __init__(self, length: int, open_windows: int):
        self.length, self.most = length, open_windows
        self.open: list[tuple[int, list[Piece]]] = []
        self.full: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.length:
            head, piece = piece.split(self.length)
            self.full.append([head])
        while len(piece.ids):
            n = len(piece.ids)
            room = [(free, k) for k, (free, _) in enumerate(self.open) if free >= n]
            if room:
                free, k = min(room)
                self.open[k][1].append(piece)
                self.open[k] = (free - n, self.open[k][1])
                if free == n:
                    self.full.append(self.open.pop(k)[1])
                return
            if len(self.open) < self.most:
                self.open.append((self.length - n, [piece]))
                return
            free, k = min((free, k) for k, (free, _) in enumerate(self.open))
            head, piece = piece.split(free)
            self.full.append([*self.open.pop(k)[1], head])

    def finish(self) -> list[Piece]:
        """Merge the open windows; returns the pieces of the one that is not full."""
        rest = sorted(self.open, key=lambda w: w[0])
        self.open = []
        while len(rest) > 1:
            free, pieces = rest[0]
            spare, last = rest[-1]
            piece = last.pop()
            if len(piece.ids) > free:
                piece, tail = piece.split(free)
                last.append(tail)
            pieces.append(piece)
            free -= len(piece.ids)
            rest[-1] = (spare + len(piece.ids), last)
            rest[0] = (free, pieces)
            if not last:
                rest.pop()
            if not free:
                self.full.append(pieces)
                rest.pop(0)
        return rest[0][1] if rest else []


def _rows(windows: list[list[Piece]], first: int, opened: bool) -> pa.RecordBatch:
    rows = []
    for k, window in enumerate(windows):
        offset = 0
        for p in window:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            kept = p.ids.astype("<u4").tobytes() if opened else None
            rows.append((p.doc_id, p.start, len(p.ids), crc, p.doc_tokens, first + k, offset, opened, kept))
            offset += len(p.ids)
    kinds = [*[pa.int64()] * 7, pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 9, kinds)], names=names)


def packed(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(settings.length, settings.open_windows)
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            ids, bounds = encoder(settings.vocabulary).encode(batch.column("text"), settings.end)
            for k, name in enumerate(names):
                own = ids[bounds[k] : bounds[k + 1]]
                packer.add(Piece(name, 0, own, len(own)))
            # Emitted pieces let the batch's array go; open ones get a copy of theirs.
            packer.open = [(f, [Piece(p.doc_id, p.start, p.ids.copy(), p.doc_tokens) for p in w]) for f, w in packer.open]
            yield _rows(packer.full, first, False)
            first += len(packer.full)
            packer.full = []
        left = packer.finish()
        yield _rows(packer.full, first, False)
        if left:
            yield _rows([left], first + len(packer.full), True)

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    level = stored(named.mapInArrow(pack, PIECES), "pieces")
    done = [level.filter("NOT open")]
    group, step = F.shiftright("sequence_id", 32), 0
    while level.filter("open").select("sequence_id").distinct().count() > 1:
        step += 1
        group = F.floor(group / settings.fan_in).cast("long")
        opened = level.filter("open").withColumn("grp", group)
        level = stored(opened.groupBy("grp").applyInArrow(_merge(settings, step), PIECES), "pieces")
        done.append(level.filter("NOT open"))
        group = F.shiftright("sequence_id", 32).bitwiseAND(F.lit((1 << 20) - 1))
    done.append(level.filter("open"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open", "ids")


def _merge(settings: Settings, step: int):
    """Merges the leftovers of one group of partitions, in the order of their sequences."""

    def merge(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        packer = Packer(settings.length, settings.open_windows)
        for r in rows.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
            packer.add(Piece(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        first = (step << 52) | (rows["grp"][0].as_py() << 32)
        left = packer.finish()
        parts = [_rows(packer.full, first, False)]
        if left:
            parts.append(_rows([left], first + len(packer.full), True))
        return pa.Table.from_batches(parts)

    return merge
