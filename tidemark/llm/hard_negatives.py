"""Hard negatives by the Four-Russians method: exact integer scores from table lookups.

Components are quantised to integers and cut into bit planes, the top one counting negative.  Eight
dimensions of a plane are one byte.  For each anchor and each eight dimensions a table holds the sums
of all 256 subsets of the anchor's components, so an inner product is a sum of looked-up entries,
shifted by their plane: no multiplications, and no rounding.

Anchors and candidates are dealt into tiles.  A task holds the tables of one tile of anchors, scores
one tile of candidates against them, and returns a few rows per anchor.  A first pass finds each
anchor's positives, the best rows of its own label; a second one scores again and finds, for each
positive, the best rows of other labels within a band below the positive's score.  All rows meet all
anchors; no list is cut before its order is known.  The rows moved are anchors times candidate tiles
plus candidates times anchor tiles, and tiles grow with the table up to what a task can hold.

Defined cases: a row with a null label, a null vector or a null or non-finite component takes no
part.  A row with a null id is a candidate, behind others of its score, and no anchor.  An empty vector
scores 0 with other empty ones; vectors of different lengths do not meet.  Repeated rows, equal in id,
label and quantised vector, are one row; rows that share an id only are rows of their own, each an
anchor where the id is one.  Ties go to the smaller id.  No rows, or no anchors, give no rows.  A
component or score too large for exact 64-bit ranking fails the run.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

GROUP = 8
# Exact ranking: bits of a component, and of a score, which leaves room for the place in a tile.
MOST_BITS, SCORE_BITS = 31, 46
# Anchors scored at a time, so that their tables stay in the processor's cache.
STRIP = 128


@dataclass(frozen=True)
class Settings:
    """``low`` and ``high`` are the band of negatives, in hundredths of the positive's score."""

    scale: int = 256
    anchor_every: int = 100
    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    tiles: int = 24
    least_rows: int = 2048
    most_rows: int = 16384
    least_anchors: int = 256
    most_anchors: int = 2048


# --- numpy: planes, tables, scores ------------------------------------------------------------


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of integer rows in two's complement, as bytes [row, plane, eight dimensions]."""
    n, dim = values.shape
    wide = np.zeros((n, -(-dim // GROUP) * GROUP), np.int64)
    wide[:, :dim] = values
    bit = (wide[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(bit.astype(np.uint8), axis=2, bitorder="little")


def values_of(planes: np.ndarray) -> np.ndarray:
    """The integers behind the planes; dimensions that fill the last byte are zero."""
    bit = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    return np.tensordot(_weights(planes.shape[1]), bit, axes=(0, 1))


def _weights(bits: int) -> np.ndarray:
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[eight dimensions, byte, anchor]: the sum of the anchor's components that the byte selects."""
    n, dim = anchors.shape
    table = np.zeros((dim // GROUP, 1 << GROUP, n), np.int64)
    for k in range(GROUP):
        # Each further component doubles the subsets: those without it, and the same with it.
        table[:, 1 << k : 2 << k] = table[:, : 1 << k] + anchors[:, k::GROUP].T[:, None, :]
    return table


def scores_of(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[candidate, anchor]: exact inner products, by lookups, shifts and additions."""
    n, bits, groups = planes.shape
    total = np.zeros((n, table.shape[2]), table.dtype)
    for k in range(bits):
        part = np.zeros_like(total)
        for g in range(groups):
            part += table[g].take(planes[:, k, g], axis=0)
        part <<= k
        if k == bits - 1:
            total -= part
        else:
            total += part
    return total


def _narrow(table: np.ndarray, bits: int) -> np.ndarray:
    """The table in 32 bits where every partial sum of a score fits them."""
    most = int(np.abs(table).max(axis=(1, 2)).sum()) << bits if table.size else 0
    if most >> SCORE_BITS:
        raise ValueError(f"scores above 2^{SCORE_BITS} cannot be ranked exactly")
    return table.astype(np.int32) if most < 1 << 31 else table


# --- tiles --------------------------------------------------------------------------------------


def _strips(anchors: pa.Table, theirs: np.ndarray) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(anchors, their labels, planes, keys [anchor, candidate], shift) of some anchors at a time.

    A key is score << shift plus the place from the end: larger is better, and no two are equal.
    """
    anchors = anchors.combine_chunks().sort_by([("anchor", "ascending")])
    n = len(theirs)
    shift = n.bit_length()
    for start in range(0, anchors.num_rows, STRIP):
        some = anchors.slice(start, STRIP)
        label, planes = _read(some)
        table = _narrow(subset_sums(values_of(planes)), theirs.shape[1])
        key = (scores_of(table, theirs).T.astype(np.int64) << shift) + np.arange(n - 1, -1, -1)
        yield some, label, planes, key, shift


def _read(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(labels, planes) of a tile."""
    label, dim, bits = (rows[c].to_numpy() for c in ("label", "dim", "bits"))
    flat = np.frombuffer(b"".join(rows["planes"].to_pylist()), np.uint8)
    return label, flat.reshape(len(label), int(bits[0]), -(-int(dim[0]) // GROUP))


def _in_order(rows: pa.Table) -> pa.Table:
    """Candidates by id, null ids last."""
    return rows.combine_chunks().sort_by([("vec_id", "ascending")])


def _joined(parts: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64))


def _best_positives(anchors: pa.Table, rows: pa.Table, most: int) -> pa.Table:
    """For each anchor the best rows of its label in this tile, the anchor's own row apart."""
    rows = _in_order(rows)
    label, theirs = _read(rows)
    n, ids = len(label), rows["vec_id"].to_pylist()
    own_rows = {(i, int(l), p.tobytes()): k for k, (i, l, p) in enumerate(zip(ids, label, theirs))}
    worst = np.iinfo(np.int64).min
    names, picked, scores = [], [], []
    for some, own, mine, key, shift in _strips(anchors, theirs):
        for a, (name, own_id) in enumerate(zip(some["anchor"].to_pylist(), some["vec_id"].to_pylist())):
            line = np.where(label == own[a], key[a], worst)
            self = own_rows.get((own_id, int(own[a]), mine[a].tobytes()))
            if self is not None:
                line[self] = worst
            top = np.argpartition(line, n - most)[n - most :] if n > most else np.arange(n)
            top = top[line[top] > worst]
            names.append(np.full(len(top), name))
            picked.append(top)
            scores.append(line[top] >> shift)
    return pa.table({"anchor": _joined(names), "row_id": rows["vec_id"].take(_joined(picked)), "score": _joined(scores)})


def _best_negatives(anchors: pa.Table, rows: pa.Table, settings: Settings) -> pa.Table:
    """For each anchor and positive the best rows of other labels within the band, in this tile."""
    rows = _in_order(rows)
    label, theirs = _read(rows)
    n = len(label)
    names, ranks, picked, scores = [], [], [], []
    for some, own, _, key, shift in _strips(anchors, theirs):
        for a, (name, positives) in enumerate(zip(some["anchor"].to_pylist(), some["positives"].to_pylist())):
            line = np.sort(key[a][label != own[a]])
            for p in positives:
                # Scores s with low * p <= 100 * s <= high * p, as whole numbers.
                least, most = -(-settings.low * p["score"] // 100), settings.high * p["score"] // 100
                low, high = np.searchsorted(line, [least << shift, (most + 1) << shift])
                best = line[max(int(low), int(high) - settings.negatives) : int(high)]
                names.append(np.full(len(best), name))
                ranks.append(np.full(len(best), p["rank"]))
                picked.append(n - 1 - (best & ((1 << shift) - 1)))
                scores.append(best >> shift)
    return pa.table(
        {
            "anchor": _joined(names), "positive": _joined(ranks).cast(pa.int32()),
            "row_id": rows["vec_id"].take(_joined(picked)), "score": _joined(scores),
        }
    )


_NONE = pa.table({c: pa.array([], pa.int64()) for c in ("anchor", "row_id", "score")})
_NO_PAIRS = _NONE.add_column(1, "positive", pa.array([], pa.int32()))


# --- Spark ----------------------------------------------------------------------------------------


def quantised(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, label, values): the rows that take part, components as whole numbers."""
    usable = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter("label IS NOT NULL AND embedding IS NOT NULL").filter(
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    whole = F.transform("embedding", lambda x: F.floor(x * settings.scale))
    return usable.select("vec_id", "label", whole.alias("values"))


def _packed(rows: DataFrame, bits: int) -> DataFrame:
    """(vec_id, label, dim, bits, planes) of distinct rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("values")
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            dims = np.diff(offsets)
            out: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims):
                chosen = np.flatnonzero(dims == dim)
                values = flat[offsets[chosen][:, None] + np.arange(dim)]
                for k, p in zip(chosen, planes_of(values.astype(np.int64).reshape(len(chosen), dim), bits)):
                    out[k] = p.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), pa.array(dims.astype(np.int32)),
                    pa.array(np.full(len(dims), bits, np.int32)), pa.array(out, pa.binary()),
                ],
                names=["vec_id", "label", "dim", "bits", "planes"],
            )

    return rows.mapInArrow(run, "vec_id long, label long, dim int, bits int, planes binary").distinct()


def _tiles(rows: Column, least: int, most: int, wanted: int) -> Column:
    """How many tiles so many rows get: ``wanted``, unless the tiles get too small or too large."""
    size = F.least(F.greatest(F.ceil(rows / wanted), F.lit(least)), F.lit(most))
    return F.greatest(F.ceil(rows / size), F.lit(1)).cast("int")


def _spread(rows: DataFrame, own: str, other: str) -> DataFrame:
    """Each row in a tile of its own side, once for each tile of the other side."""
    place = F.pmod(F.xxhash64("vec_id", "label", "planes"), F.col(f"{own}_tiles")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_tiles") - 1))
    kept = [c for c in rows.columns if not c.endswith("_tiles")]
    return rows.select(*kept, place.alias(own), f"{other}_tiles").select(*kept, own, every.alias(other))


def mine(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors``
    (vec_id, label, embedding)."""
    rows = quantised(vectors, settings)
    ends = rows.agg(
        F.max(F.array_max("values")).alias("high"), F.min(F.array_min("values")).alias("low")
    ).first()
    bits = max(int(ends.high or 0).bit_length(), (-int(ends.low or 0) - 1).bit_length()) + 1
    if bits > MOST_BITS:
        raise ValueError(f"components need {bits} bits; scores are exact for at most {MOST_BITS}")
    packed = stored(_packed(rows, bits), "planes")
    is_anchor = F.col("vec_id") % settings.anchor_every == 0
    sizes = packed.groupBy("dim").agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"))
    tiles = sizes.filter("anchors > 0").select(
        "dim",
        _tiles(F.col("rows"), settings.least_rows, settings.most_rows, settings.tiles).alias("r_tiles"),
        _tiles(F.col("anchors"), settings.least_anchors, settings.most_anchors, 1).alias("a_tiles"),
    )
    dealt = packed.join(tiles, "dim")
    # Ids may repeat, so an anchor is named by its place, which the stored table keeps.
    anchors = stored(dealt.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    candidates = stored(_spread(dealt, "r", "a"), "candidates")

    def met(anchors: DataFrame, run, schema: str) -> DataFrame:
        place = ["dim", "r", "a"]
        left = _spread(anchors, "a", "r").groupBy(*place)
        return left.cogroup(candidates.groupBy(*place)).applyInArrow(run, schema)

    def positives(a: pa.Table, r: pa.Table) -> pa.Table:
        return _best_positives(a, r, settings.positives) if a.num_rows and r.num_rows else _NONE

    def negatives(a: pa.Table, r: pa.Table) -> pa.Table:
        return _best_negatives(a, r, settings) if a.num_rows and r.num_rows else _NO_PAIRS

    best = [F.desc("score"), F.asc_nulls_last("row_id")]
    ranked = met(anchors, positives, "anchor long, row_id long, score long").withColumn(
        "rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*best))
    ).filter(F.col("rank") <= settings.positives)
    chosen = stored(ranked, "positives")
    lists = chosen.groupBy("anchor").agg(F.collect_list(F.struct("rank", "score")).alias("positives"))
    found = met(anchors.join(lists, "anchor"), negatives, "anchor long, positive int, row_id long, score long").withColumn(
        "place", F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*best))
    ).filter(F.col("place") <= settings.negatives)
    known = chosen.select(
        "anchor", F.col("rank").alias("positive"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        found.join(known, ["anchor", "positive"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("row_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


SQL = """
WITH finite AS (
    SELECT vec_id, CAST(label AS BIGINT) AS label, embedding FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), whole AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM finite
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS anchor_v, r.vec_id AS row_id, r.label = a.label AS same,
           r.vec_id IS NOT DISTINCT FROM a.vec_id AND r.v = a.v AND r.label = a.label AS self,
           CAST(coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
    FROM whole a JOIN whole r ON len(a.v) = len(r.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE same AND NOT self
    QUALIFY row_number() OVER (PARTITION BY anchor_id, own, anchor_v ORDER BY score DESC, row_id NULLS LAST) <= 5
), numbered AS (
    SELECT anchor_id, own, anchor_v, row_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id, own, anchor_v ORDER BY score DESC, row_id NULLS LAST) AS number
    FROM positives
), banded AS (
    SELECT p.*, n.row_id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.own, p.anchor_v, p.number
                              ORDER BY n.score DESC, n.row_id NULLS LAST) AS rank
    FROM numbered p JOIN scored n USING (anchor_id, own, anchor_v)
    WHERE NOT n.same AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM banded WHERE rank <= 5
"""
