"""Token ids in files of word-aligned codes (Simple-8b).

A 64-bit word holds a selector in its top four bits and 60 bits of ids.  Selectors 1 to 14 stand
for 60, 30, 20, ... ids of 1, 2, 3, ... bits, as FIELDS says; selector 0 is an escape: the next word
is one id of more than 60 bits as it stands.  Ids are coded in blocks of ``BLOCK``; each block
starts a new word, and the first word of each block is recorded, so that any block can be decoded
alone and all of them by array operations.

A file row is a run of whole documents in ascending id order: the ids of the documents, their
numbers of tokens, the blocks' first words, and the words, all as little-endian integers.  Rows are
kept in Parquet, which any shared store holds and whose writer commits a task's files as one.

Defined cases: a null or empty text is the end token alone.  Rows with a null id come first;
rows that repeat an id follow each other in the order of their texts.  A text of any length is one
document of a file row.  Other columns are not looked at.  No rows give no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder
from tidemark.sources.tables import shared_folder

U = np.uint64
BLOCK = 1024
# (ids in a word, bits of an id) by selector, from 1 on.
FIELDS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNT = np.array([1, *[n for n, _ in FIELDS]], np.int64)
FILE = "shard int, first long, n_ids long, docs binary, tokens binary, blocks binary, words binary"


def _choices(lanes: np.ndarray) -> np.ndarray:
    """For each place, the selector of the word that would start there: as many ids as fit."""
    bits = np.zeros(lanes.shape, np.uint8)
    for power in (32, 16, 8, 4, 2, 1):
        wide = (lanes >> bits) >> U(power) != 0
        bits += wide * np.uint8(power)
    bits += lanes >> bits != 0
    widest = {1: bits}
    for count in sorted(n for n, _ in FIELDS)[1:]:
        # Two shorter windows that overlap, or touch, cover the longer one.
        part = max(n for n in widest if n < count and 2 * n >= count)
        shorter = widest[part]
        widest[count] = np.maximum(shorter[:, : shorter.shape[1] - (count - part)], shorter[:, count - part :])
    choice = np.zeros((len(lanes), BLOCK), np.int8)
    for selector, (count, wide) in reversed(list(enumerate(FIELDS, 1))):
        choice[widest[count][:, :BLOCK] <= wide] = selector
    return choice


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block).

    All blocks are walked side by side, a word of each per round; then the words of one selector
    are put together at a time.  A block's end counts as ids of no bits.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks = -(-n // BLOCK)
    lanes = np.zeros((blocks, BLOCK + 60), np.uint64)
    whole = np.zeros(blocks * BLOCK, np.uint64)
    whole[:n] = ids
    lanes[:, :BLOCK] = whole.reshape(blocks, BLOCK)
    choice = _choices(lanes)
    lane, at, size = np.arange(blocks), np.zeros(blocks, np.int64), np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)
    walked = []
    while len(lane):
        selector = choice[lane, at]
        walked.append((lane, at, selector))
        at = at + COUNT[selector]
        go = at < size[lane]
        lane, at = lane[go], at[go]
    lane, at, selector = (np.concatenate(x) for x in zip(*walked))
    order = np.lexsort((at, lane))
    lane, at, selector = lane[order], at[order], selector[order]
    # An escape takes two words.
    place = np.cumsum(1 + (selector == 0)) - 1 - (selector == 0)
    words = np.zeros(int(place[-1]) + 1 + int(selector[-1] == 0), np.uint64)
    words[place] = selector.astype(np.uint64) << U(60)
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        if s == 0:
            words[place[rows] + 1] = lanes[lane[rows], at[rows]]
            continue
        count, bits = FIELDS[s - 1]
        value = np.zeros(len(rows), np.uint64)
        for k in range(count):
            value |= lanes[lane[rows], at[rows] + k] << U(bits * k)
        words[place[rows]] |= value
    return words, place[np.searchsorted(lane, np.arange(blocks))]


def decode(words: np.ndarray, blocks: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids, by selector and not by word."""
    out = np.zeros(n_ids, np.uint64)
    if not n_ids:
        return out
    selector = (words >> U(60)).astype(np.int64)
    raw = _raw_words(selector)
    code = np.flatnonzero(~raw)
    block = np.searchsorted(blocks, code, side="right") - 1
    count = COUNT[selector[code]]
    total = np.concatenate([[0], np.cumsum(count)])
    first_code = np.searchsorted(code, blocks)
    at = total[:-1] - total[first_code][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n_ids)
    for s in np.unique(selector[code]):
        rows = np.flatnonzero(selector[code] == s)
        if s == 0:
            out[at[rows]] = words[code[rows] + 1]
            continue
        n, bits = FIELDS[s - 1]
        mask = U((1 << bits) - 1)
        for k in range(n):
            place = at[rows] + k
            inside = place < end[rows]
            out[place[inside]] = (words[code[rows[inside]]] >> U(bits * k)) & mask
    return out


def _raw_words(selector: np.ndarray) -> np.ndarray:
    """Which words are raw ids: each follows an escape that is not itself raw."""
    raw = np.zeros(len(selector), bool)
    for k in np.flatnonzero(selector == 0):
        if not raw[k] and k + 1 < len(selector):
            raw[k + 1] = True
    return raw


@dataclass(frozen=True)
class Settings:
    vocabulary: str
    end: int = 1
    row_ids: int = 1 << 18


def write(docs: DataFrame, path: str, settings: Settings) -> None:
    """Files of the documents' ids below ``path``, sorted by doc_id."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            nonlocal first
            names = [n for ns, _, _ in held for n in ns]
            ids = np.concatenate([x for _, x, _ in held])
            sizes = np.concatenate([s for _, _, s in held])
            words, blocks = encode(ids)
            # A null id is written as the smallest integer, which no document may have.
            docs_blob = np.array([np.iinfo(np.int64).min if n is None else n for n in names], "<i8").tobytes()
            values = (shard, first, len(ids), docs_blob, sizes.astype("<i8").tobytes(), blocks.astype("<i8").tobytes(), words.astype("<u8").tobytes())
            first += len(ids)
            held.clear()
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in FILE.split(", ")])

        waiting = 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            ids, bounds = encoder(settings.vocabulary).encode(batch.column("text"), settings.end)
            a = 0
            while a < len(names):
                b = int(np.searchsorted(bounds, bounds[a] + settings.row_ids - waiting, side="right")) - 1
                b = min(max(b, a + (not held)), len(names))
                if b > a:
                    held.append((names[a:b], ids[bounds[a] : bounds[b]].copy(), np.diff(bounds[a : b + 1])))
                    waiting += int(bounds[b] - bounds[a])
                if b < len(names):
                    yield row()
                    waiting = 0
                a = b
        if held:
            yield row()

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = named.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(code, FILE).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids (little-endian, 32 bits) per document."""
    files = spark.read.schema(FILE).parquet(path)
    # One count a shard comes to the driver; shards are as many as the writing tasks.
    counts = {r.shard: r.n for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for shard in sorted(counts):
        before[shard], total = total, total + counts[shard]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                docs, tokens = np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["tokens"], "<i8")
                blocks, words = np.frombuffer(r["blocks"], "<i8"), np.frombuffer(r["words"], "<u8")
                ids = decode(words, blocks, r["n_ids"]).astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(tokens)])
                each = [ids[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, pa.int64(), mask=docs == np.iinfo(np.int64).min),
                        pa.array(bounds[:-1] + r["first"] + before[r["shard"]]),
                        pa.array(tokens),
                        pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        pa.array(each, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def round_trip(docs: DataFrame, settings: Settings) -> DataFrame:
    """Written to a fresh shared folder and read back."""
    path = shared_folder(docs.sparkSession, "token-files")
    write(docs, path, settings)
    return read(docs.sparkSession, path)
