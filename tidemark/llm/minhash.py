"""Near-duplicates by bottom-k sketches.

A document's set holds its distinct windows of five words, as 64-bit hashes.  Its sketch is the
``k`` smallest of them, all under one hash function.  Documents with equal sets form one class
and are represented by the smallest id.  For the classes:

1. Inverted lists.  Two sets with Jaccard 0.75 share about three quarters of the bottom k of
   their union, and each shared value is in both sketches.  Fewer than ``share`` of k (27 of 64,
   six standard deviations off) does not happen in practice (below 2e-7 for a pair right at the
   threshold), so only pairs with that many common values matter.  Values are ordered by their
   frequency: a pair with ``c`` common values has one among the first s - c + 1 of either side,
   where s counts the side's values that occur elsewhere at all.  Only those are listed, so a
   passage that thousands of documents share opens no list unless it makes up most of a document.
2. Groups.  A document's home is the longest list it stands in.  Documents of one home form a
   group; where a list holds documents of several homes, each also visits the larger ones.  Any two
   documents of a list so meet in a group, without a row per pair, and a family of near copies, which
   shares dozens of lists, meets once.
3. A group is cut into blocks, bounded in shingles and in rows, and tasks compare two blocks each, a
   strip of rows at a time.  Retained values give the overlaps of a strip as products of 0/1
   matrices of bounded size, the union sketch of a pair estimates its Jaccard, and pairs far below
   the threshold go, as do those that earlier strips have connected.
4. The remaining pairs are confirmed on the full sets, computed from the whole texts.  Of the links
   a task finds, it returns those that connect something new.

Defined cases: null and empty texts have an empty set and link with nothing.  Fewer words than
five make one window of the whole text.  Texts of any length are taken whole.  Rows with a null id
take part in nothing and are kept.  Rows of one id are one document: it links with whatever any of its
texts links with, and each row gets the document's component.  Where documents are removed, texts
count by themselves: of the rows with linked texts one stays, that of the smallest id (of several
texts under it, that of the smallest text hash), so unrelated texts under one id all stay; of rows
equal in id and text one stays, the first by their other columns.  Other columns, whatever their
names, are untouched.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.store import stored
from tidemark.llm.words import blocks, mixed, text_bytes, windows, words_of


# A row's document and text, the latter as two hashes.
KEY = ["doc_id", "t1", "t2"]


@dataclass(frozen=True)
class Settings:
    """``block_shingles`` and ``block_rows`` bound a block, ``task_shingles`` what one task compares in a
    row, and ``cells`` each matrix of a task."""

    size: int = 5
    percent: int = 75
    k: int = 64
    share: int = 27
    block_shingles: int = 400_000
    task_shingles: int = 1_000_000
    block_rows: int = 16_000
    cells: int = 2_000_000


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct window hashes of each row."""
    data, offsets = text_bytes(column)
    for a, b in blocks(offsets):
        words = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower=True)
        hashes, bounds = windows(words, size)
        for k in range(b - a):
            yield np.unique(hashes[bounds[k] : bounds[k + 1]])


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, t1, t2, n_shingles, set_key, sketch): the key is a 128-bit hash of the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, low = [], [], []
            for s in shingle_sets(batch.column("text"), settings.size):
                sizes.append(len(s))
                keys.append(np.array([mixed(s).sum(), mixed(s ^ np.uint64(0x5DEECE66D)).sum()], np.uint64))
                low.append(s[: settings.k].view(np.int64))
            flat = np.concatenate([*low, np.zeros(0, np.int64)])
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in low])]).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in KEY], pa.array(sizes, pa.int64()), _binary(keys), sketch],
                names=[*KEY, "n_shingles", "set_key", "sketch"],
            )

    return docs.select(*KEY, "text").mapInArrow(
        run, "doc_id long, t1 long, t2 long, n_shingles long, set_key binary, sketch array<long>"
    )


def inverted_lists(classes: DataFrame, settings: Settings) -> DataFrame:
    """(value, rep, n_shingles) for the values under which a class has to be found."""
    posted = classes.select("rep", "n_shingles", F.explode("sketch").alias("value"))
    shared = posted.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    common = posted.join(shared, "value").groupBy("rep", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("vals")
    )
    needed = F.least(F.ceil(F.col("n_shingles") * settings.percent / 100), F.lit(settings.share))
    listed = F.slice("vals", F.lit(1), F.greatest(F.size("vals") - needed + 1, F.lit(0)).cast("int"))
    return common.select("rep", "n_shingles", F.explode(listed).alias("x")).select("x.value", "rep", "n_shingles")


def meetings(lists: DataFrame, settings: Settings) -> DataFrame:
    """(home, x, y, side, rep, n_shingles): who is compared in which task, and in which block it is."""
    longest = lists.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1")
    sized = lists.join(longest, "value")
    home = sized.groupBy("rep").agg(F.max(F.struct("n", "value")).alias("home"))
    placed = stored(sized.select("value", "rep", "n_shingles").join(home, "rep"), "placed")
    homes = placed.select("value", F.col("home").alias("other")).distinct()
    visits = placed.join(homes, "value").filter("other > home").select("rep", "n_shingles", F.col("other").alias("home"))
    members = placed.select("rep", "n_shingles", "home").unionByName(visits).distinct()
    weight = members.groupBy("home").agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("members"))
    full = F.greatest(F.col("weight") / settings.block_shingles, F.col("members") / settings.block_rows)
    blocks = F.ceil(full).cast("int").alias("blocks")
    side = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("side")
    dealt = members.join(weight.filter("members > 1").select("home", blocks), "home").select("*", side)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("home", "side", "rep", "n_shingles", other).select(
        F.col("home.value").alias("home"), F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"),
        "side", "rep", "n_shingles",
    )


class _Coded:
    """The values that occur in more than one set, as codes, by row."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = [len(s) for s in sets]
        _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[code] > 1
        own = np.repeat(np.arange(len(sets)), sizes)[shared]
        self.code = (np.cumsum(count > 1) - 1)[code[shared]].astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(sets)))])
        self.total = int((count > 1).sum())

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.first[rows + 1] - self.first[rows]
        at = np.repeat(self.first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(rows)), n), self.code[at]

    def overlaps(self, left: np.ndarray, right: np.ndarray, cells: int) -> np.ndarray:
        """Sizes of the intersections of each left row with each right row."""
        sides = [self._entries(left), self._entries(right)]
        both = np.ones(self.total, bool)
        for _, code in sides:
            has = np.zeros(self.total, bool)
            has[code] = True
            both &= has
        rank = np.cumsum(both) - 1
        for k, (own, code) in enumerate(sides):
            own, code = own[both[code]], rank[code[both[code]]]
            order = np.argsort(code, kind="stable")
            sides[k] = own[order], code[order]
        out = np.zeros((len(left), len(right)), np.float32)
        columns = max(16, cells // (len(left) + len(right)))
        for c in range(0, int(both.sum()), columns):
            parts = []
            for size, (own, code) in zip(out.shape, sides):
                a, b = np.searchsorted(code, [c, c + columns])
                has = np.zeros((size, columns), np.float32)
                has[own[a:b], code[a:b] - c] = 1
                parts.append(has)
            out += parts[0] @ parts[1].T
        return out


def _estimated(a: np.ndarray, b: np.ndarray, low: np.ndarray, k: int, share: int, chunk: int = 8192) -> np.ndarray:
    """Whether the union sketches of the pairs reach share / k; ``low`` has padded sorted sketches."""
    keep = np.zeros(len(a), bool)
    pad = np.iinfo(np.uint64).max
    for s in range(0, len(a), chunk):
        both = np.sort(np.concatenate([low[a[s : s + chunk]], low[b[s : s + chunk]]], axis=1), axis=1)
        twice = np.zeros(both.shape, bool)
        twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != pad)
        distinct = np.cumsum(~twice & (both != pad), axis=1)
        within = distinct <= k
        union = np.minimum(distinct[:, -1], k)
        keep[s : s + chunk] = (twice & within).sum(axis=1) * k >= union * share
    return keep


def _links(names: np.ndarray, side: np.ndarray | None, sets: list[np.ndarray], settings: Settings) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sides, or of all links in one block."""
    n = np.array([len(s) for s in sets])
    low = np.full((len(sets), settings.k), np.iinfo(np.uint64).max, np.uint64)
    for row, s in zip(low, sets):
        row[: min(len(s), settings.k)] = s[: settings.k]
    retained, whole = _Coded([s[: settings.k] for s in sets]), None
    every = np.arange(len(sets))
    lefts, rights = (every, every) if side is None else (every[side == side.min()], every[side != side.min()])
    parent = every.copy()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    found: list[tuple[int, int]] = []
    start, rows = 0, 1
    while start < len(lefts) and len(rights):
        left = lefts[start : start + rows]
        right = rights if side is not None else rights[start + 1 :]
        start += rows
        # Strips grow, so what the first rows connect is not looked at again.
        rows = min(2 * rows, max(1, settings.cells // len(rights)))
        if not len(right):
            break
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]
        pairs = (retained.overlaps(left, right, settings.cells) > 0) & (parent[left][:, None] != parent[right][None, :])
        size, other = n[left][:, None], n[right][None, :]
        pairs &= 100 * np.minimum(size, other) >= settings.percent * np.maximum(size, other)
        if side is None:
            pairs &= left[:, None] < right[None, :]
        i, j = np.nonzero(pairs)
        quota = 1
        while len(i):
            # Of the pairs that would connect the same two groups, a few are tried before the others.
            while (parent[parent] != parent).any():
                parent[:] = parent[parent]
            x, y = parent[left[i]], parent[right[j]]
            i, j, key = i[x != y], j[x != y], (np.minimum(x, y) * len(sets) + np.maximum(x, y))[x != y]
            order = np.argsort(key, kind="stable")
            i, j, key = i[order], j[order], key[order]
            tried = np.arange(len(key)) - np.searchsorted(key, key) < quota
            quota *= 4
            (a, b), (i, j) = (i[tried], j[tried]), (i[~tried], j[~tried])
            likely = _estimated(left[a], right[b], low, settings.k, settings.share)
            a, b = a[likely], b[likely]
            if not len(a):
                continue
            whole = whole or _Coded(sets)
            rows_a, at = np.unique(a, return_inverse=True)
            rows_b, other_at = np.unique(b, return_inverse=True)
            full = whole.overlaps(left[rows_a], right[rows_b], settings.cells)[at, other_at].astype(np.int64)
            a, b = left[a], right[b]
            linked = 100 * full >= settings.percent * (n[a] + n[b] - full)
            for p, q in zip(a[linked].tolist(), b[linked].tolist()):
                x, y = root(p), root(q)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((int(names[p]), int(names[q])))
    return found


def _compared(met: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): links that connect all classes that any task links; ``texts`` has one of each class."""
    total = met.agg(F.sum("n_shingles")).first()[0] or 0
    tasks = max(1, -(-total // settings.task_shingles))
    task = F.pmod(F.xxhash64("home", "x", "y"), F.lit(tasks)).cast("int").alias("task")
    rows = met.select(task, "home", "x", "y", "side", "rep").join(texts, "rep")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("home", "x", "y", "rep")])
        keys = [table[c].to_numpy() for c in ("home", "x", "y")]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        edges = np.concatenate([np.flatnonzero(new), [len(new)]])
        names, side, found = table["rep"].to_numpy(), table["side"].to_numpy(), []
        for s, e in zip(edges[:-1], edges[1:]):
            sets = list(shingle_sets(table["text"].slice(s, e - s), settings.size))
            found += _links(names[s:e], side[s:e] if keys[1][s] != keys[2][s] else None, sets, settings)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.select("task", "home", "x", "y", "side", "rep", "text").groupBy("task").applyInArrow(run, "a long, b long")


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2"), text.alias("text"))


def _classed(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows' sketches, and classes of equal sets: (set_key, rep, doc_id, t1, t2, group).

    ``rep`` numbers the classes, ``group`` is the smallest number reachable by links between texts.
    The other columns name one row of the class, that of the smallest id.
    """
    named = _named(docs)
    rows = stored(sketches(named, settings), "sketches")
    full = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(
        full.groupBy("set_key").agg(
            F.min(F.struct(*KEY)).alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
        ).select("set_key", F.monotonically_increasing_id().alias("rep"), "least.*", "n_shingles", "sketch"),
        "classes",
    )
    lists = stored(inverted_lists(classes.select("rep", "n_shingles", "sketch"), settings), "lists")
    met = stored(meetings(lists, settings), "meetings")
    # The classes met grow with the corpus: they are joined by shuffle at every size.
    wanted = classes.select("rep", *KEY).join(met.select("rep").distinct(), "rep", "left_semi").hint("merge")
    texts = stored(named.join(wanted, KEY).select("rep", "text").dropDuplicates(["rep"]), "texts")
    final = components(_compared(met, texts, settings))
    grouped = classes.select("set_key", "rep", *KEY).join(final.withColumnRenamed("node", "rep"), "rep", "left")
    return rows, stored(grouped.withColumn("group", F.coalesce("component", "rep")).drop("component"), "grouped")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id, for each row of ``docs``.

    ``class_id`` is the smallest id with an equal set.
    """
    rows, classes = _classed(docs, settings)
    full = rows.filter("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "n_shingles", "set_key")
    placed = full.join(classes.select("set_key", "group", F.col("doc_id").alias("class_id")), "set_key")
    # A document with texts in several groups connects them.
    ids = placed.groupBy("doc_id").agg(F.min("group").alias("group"), F.max("group").alias("most"))
    bridged = ids.filter("group < most").select("doc_id", F.col("group").alias("a"))
    bridges = placed.join(bridged, "doc_id").filter("group > a").select("a", F.col("group").alias("b")).distinct()
    final = components(bridges).withColumnsRenamed({"node": "group", "component": "joined"})
    least = classes.groupBy("group").agg(F.min("doc_id").alias("least")).join(final, "group", "left")
    least = least.withColumn("joined", F.coalesce("joined", "group"))
    smallest = least.groupBy("joined").agg(F.min("least").alias("component_id"))
    component = least.select("group", "joined").join(smallest, "joined").drop("joined")
    known = placed.join(component, "group").select("doc_id", "n_shingles", "component_id", "class_id")
    # Rows without a set follow the document's other rows.
    others = ids.join(component, "group").select(F.col("doc_id").alias("known_id"), "component_id")
    alone = rows.filter("doc_id IS NULL OR n_shingles = 0").join(others, F.expr("doc_id = known_id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.col("doc_id").alias("class_id")
    )
    return known.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"), "class_id"
    )


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents, one of each group of linked texts.  Rows with a null id stay."""
    rows, classes = _classed(docs, settings)
    winners = classes.groupBy("group").agg(F.min(F.struct(*KEY)).alias("least")).select("least.*")
    kept = winners.unionByName(rows.filter("doc_id IS NOT NULL AND n_shingles = 0").select(*KEY).distinct())
    kept = kept.toDF("kept_id", "kept_1", "kept_2")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.col("text").cast("string")
    keyed = docs.filter("doc_id IS NOT NULL").select(
        row.alias("row"), F.col("doc_id").cast("long").alias("kept_id"), F.xxhash64(text).alias("kept_1"), F.xxhash64(text, F.lit(1)).alias("kept_2")
    )
    chosen = keyed.join(kept, ["kept_id", "kept_1", "kept_2"], "left_semi")
    # Rows equal in id and text differ in other columns at most; their printed form orders them.
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    form = F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{k}") for k, c in enumerate(rest)])) if rest else F.lit("")
    one = chosen.groupBy("kept_id", "kept_1", "kept_2").agg(F.min_by("row", form).alias("row"))
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id IS NULL"))
