"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Binary codes come from rotations of the principal axes that bring the axes close to plus or minus
one (iterative quantisation), learned on a bounded sample.  Several rotations from different
starts give the bits of a table each: as many bits as the logarithm of the vectors of the largest
label, 16 at least, so that lists of vectors with nothing in common stay short however many
there are.  Vectors of one label that agree in all bits of a table meet there.  Two vectors at
cosine 0.93 differ in about an eighth of their bits if the mean is small, and in more the longer the
mean is, as it is subtracted.  So tables are added, beyond ``tables``, until a share ``recall`` of
pairs right at the threshold, made from the sample, meets in one.  A mean that would take more than
``most_tables`` is not subtracted: rotations are then learned without it, which keeps the angles, at
the price of longer lists.

Who meets first compares codes.  Only vectors that have, in a list, another within the Hamming
distance that pairs at the threshold keep (six deviations above their mean) are sent there with
their numbers and reranked by the cosine of the original vectors in double precision, which alone
decides.

Equal vectors of a label form one class, which stands in the tables once.  Lists of a table are cut
into blocks, and tasks compare two blocks each; they return rows, counts per vector and the links
that connect something new, never pairs.  A pair counts in the first table in which it meets.

Defined cases: a null, empty or zero vector, one with null or non-finite components, a null label
and a null id link with nothing; such a row is its own component and kept.  Vectors of different
lengths never link.  Rows that repeat an id are vectors of their own, each with its links; equal
vectors of a label link whatever their ids.  Pairs right at the threshold link.  Vectors of any length
are taken whole.  No rows give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.store import stored

LEAST_BITS, MOST_BITS = 16, 30


@dataclass(frozen=True)
class Settings:
    """``sample`` rows, of ``sample_numbers`` numbers together, bound the vectors that the rotations
    are learned on, not those in the tables."""

    cosine: float = 0.93
    tables: int = 24
    recall: float = 0.95
    most_tables: int = 256
    probes: int = 2000
    sample: int = 20_000
    sample_numbers: int = 4_000_000
    steps: int = 20
    axes: int = 64
    block_rows: int = 2048
    task_rows: int = 20_000
    pairs_at_once: int = 1 << 18
    seed: int = 3


def bits_for(vectors: int) -> int:
    """Bits of a table for so many vectors of one label."""
    return min(MOST_BITS, max(LEAST_BITS, (max(1, vectors) - 1).bit_length()))


@dataclass
class Codes:
    """The linear maps whose signs are the bits, for one length of vectors, and the Hamming distance
    up to which codes count as near."""

    mean: np.ndarray
    maps: np.ndarray
    bits: int
    limit: int = 0

    def signs(self, unit: np.ndarray) -> np.ndarray:
        return ((unit - self.mean) @ self.maps) > 0

    def parts(self, unit: np.ndarray) -> np.ndarray:
        """The parts of each vector's code, one for each table."""
        bits = self.signs(unit).reshape(len(unit), -1, self.bits)
        return bits @ (1 << np.arange(self.bits, dtype=np.int32))


def _at_threshold(unit: np.ndarray, settings: Settings, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose cosine is the threshold; they differ towards another vector, or in any direction."""
    half = settings.probes // 2
    a = np.tile(np.resize(unit, (half, unit.shape[1])), (2, 1))
    away = np.concatenate([np.resize(np.roll(unit, 1, axis=0), (half, unit.shape[1])), rng.standard_normal((len(a) // 2, unit.shape[1]))])
    away -= (away * a).sum(axis=1, keepdims=True) * a
    size = np.linalg.norm(away, axis=1, keepdims=True)
    ok = size[:, 0] > 1e-6
    a, away = a[ok], away[ok] / size[ok]
    return a, settings.cosine * a + np.sqrt(1 - settings.cosine**2) * away


def learned(unit: np.ndarray, settings: Settings, bits: int = LEAST_BITS) -> Codes:
    """Codes fitted to unit vectors; where there are none, to random ones of the length given."""
    dim = unit.shape[1]
    rng = np.random.default_rng(settings.seed)
    if len(unit) < 2:
        unit = rng.standard_normal((settings.probes, dim))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    # Rotations keep the vectors they are fitted to off the borders, so pairs are made of others;
    # of few vectors, of all, as a quarter would not stand for the rest.
    apart = min(settings.probes // 2, len(unit) // 4) if len(unit) >= 400 else len(unit)
    a, b = _at_threshold(unit[-apart:], settings, np.random.default_rng(settings.seed + 1))
    unit = unit[:-apart] if apart < len(unit) else unit

    def rotations(x: np.ndarray):
        """Rotated principal axes, from another start at each call.

        Few or alike vectors lead every start to one rotation.  So steps get fewer as tables are added."""
        _, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, : min(dim, settings.axes)]
        y = x @ axes

        def rotated(made: int) -> np.ndarray:
            turn, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
            for _ in range(settings.steps * settings.tables // max(settings.tables, made)):
                u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
                turn = (u @ v).T
            return axes @ turn

        return rotated

    mean = unit.mean(axis=0)
    found = _enough(mean, rotations(unit - mean), a, b, bits, settings.most_tables, settings)
    return found or _enough(np.zeros(dim), rotations(unit), a, b, bits, None, settings)


def _enough(mean, more, a: np.ndarray, b: np.ndarray, bits: int, most: int | None, settings: Settings) -> Codes | None:
    """Codes of as many tables as bring the pairs together; None if that takes more than ``most``."""
    maps, spare, met = [], np.zeros((len(mean), 0)), np.zeros(len(a), bool)
    while len(maps) < settings.tables or met.sum() < settings.recall * len(met):
        if most is not None and len(maps) >= max(most, settings.tables):
            return None
        while spare.shape[1] < bits:
            spare = np.concatenate([spare, more(len(maps))], axis=1)
        maps.append(spare[:, :bits])
        spare = spare[:, bits:]
        met |= ((((a - mean) @ maps[-1]) > 0) == (((b - mean) @ maps[-1]) > 0)).all(axis=1)
    codes = Codes(mean, np.concatenate(maps, axis=1), bits)
    apart = (codes.signs(a) != codes.signs(b)).sum(axis=1)
    codes.limit = int(apart.mean() + 6 * apart.std()) + 1 if len(apart) else codes.maps.shape[1]
    return codes


def _normed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows that may link, their unit vectors); a null is read as no number."""
    x = x.astype(np.float64)
    top = np.abs(x).max(axis=1)
    good = np.flatnonzero(np.isfinite(top) & (top > 0))
    x = x[good] / top[good, None]
    return good, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, vectors as they are, unit vectors in double precision) of each length of the vectors
    that may link."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    dims = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    found = []
    for dim in np.unique(dims[dims > 0]):
        place = np.flatnonzero(dims == dim)
        x = flat[offsets[place][:, None] + np.arange(dim)]
        good, unit = _normed(x)
        if len(good):
            found.append((place[good], x[good], unit))
    return found


def _bytes(rows: np.ndarray) -> pa.Array:
    """Each row of numbers as one binary value."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def coded(vectors: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, int], int]:
    """(vec_id, label, dim, key, vector, parts) of the vectors that may link, with the Hamming limit of
    each length and the bits of a table.

    ``key`` is a 128-bit digest of the vector.
    """
    item = vectors.schema["embedding"].dataType.elementType
    kind = "float" if item == T.FloatType() else "double"
    good = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast(f"array<{kind}>").alias("embedding"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    sizes = good.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"))
    most, longest = sizes.agg(F.max("n"), F.max("dim")).first()
    bits = bits_for(most or 0)
    limit = min(settings.sample, max(2, settings.sample_numbers // max(1, longest or 0)))
    drawn = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).select("embedding").toArrow()
    by_dim = {x.shape[1]: x for _, _, x in _units(drawn["embedding"].combine_chunks())} if drawn.num_rows else {}
    codes = {dim: learned(x, settings, bits) for dim, x in by_dim.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(codes)
        for batch in batches:
            for place, x, unit in _units(batch.column("embedding")):
                dim, chosen = unit.shape[1], batch.take(pa.array(place))
                if dim not in known:
                    known[dim] = learned(np.zeros((0, dim)), settings, bits)
                parts = known[dim].parts(unit).astype(np.int32)
                ends = pa.array(np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1])
                raw = _bytes(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        chosen.column("vec_id"), chosen.column("label"), pa.array(np.full(len(place), dim, np.int32)),
                        pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in raw.to_pylist()], pa.binary()), raw,
                        pa.ListArray.from_arrays(ends, pa.array(parts.ravel())),
                    ],
                    names=["vec_id", "label", "dim", "key", "vector", "parts"],
                )

    found = good.mapInArrow(run, "vec_id long, label string, dim int, key binary, vector binary, parts array<int>")
    return found, {dim: c.limit for dim, c in codes.items()}, bits


# --- pairs of one task -------------------------------------------------------------------------


@dataclass
class _Lists:
    """The rows of a task, sorted by list and pair of blocks; lists run from edge to edge."""

    rows: pa.Table
    edges: np.ndarray
    side: np.ndarray
    one: np.ndarray
    table: np.ndarray
    parts: np.ndarray
    dim: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> list[_Lists]:
        """By number of tables, as vectors of different lengths may have different ones."""
        rows = rows.combine_chunks().sort_by([(c, "ascending") for c in ("dim", "label", "slot", "table", "x", "y", "rep")])
        label = rows["label"].combine_chunks().dictionary_encode().indices.to_numpy()
        keys = [label, *[rows[c].to_numpy() for c in ("dim", "slot", "table", "x", "y")]]
        new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        dim = keys[1]
        found = []
        for d in np.unique(dim):
            low, high = np.searchsorted(dim, [d, d + 1])
            part = rows.slice(low, high - low)
            parts = part["parts"].combine_chunks().flatten().to_numpy().astype(np.uint32).reshape(high - low, -1)
            edges = np.concatenate([np.flatnonzero(new[low:high]), [high - low]])
            x, y = (part[c].to_numpy() for c in ("x", "y"))
            found.append(cls(part, edges, part["side"].to_numpy(), x == y, part["table"].to_numpy(), parts, part["dim"].to_numpy()))
        return found

    def stretches(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(a, b): all pairs of places in one list, about so many at a time."""
        size = np.diff(self.edges)
        place = np.arange(self.edges[-1])
        # Each row meets those behind it in its list.
        behind = np.repeat(self.edges[1:], size) - place - 1
        total = np.concatenate([[0], np.cumsum(behind)])
        begin = 0
        while begin < len(place):
            end = max(begin + 1, int(np.searchsorted(total, total[begin] + at_once, side="right")) - 1)
            n = behind[begin:end]
            a = np.repeat(place[begin:end], n)
            b = a + 1 + np.arange(len(a)) - np.repeat(total[begin:end] - total[begin], n)
            met = self.one[a] | (self.side[a] != self.side[b])
            yield a[met], b[met]
            begin = end

    def first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs meet in no earlier table."""
        same = self.parts[a] == self.parts[b]
        return same.argmax(axis=1) == self.table[a]


def _close(rows: pa.Table, limits: dict[int, int], settings: Settings) -> pa.Table:
    """The rows that have another within the Hamming limit of their length in a list they first meet in."""
    kept = []
    for lists in _Lists.of(rows):
        hit = np.zeros(len(lists.parts), bool)
        limit = limits.get(int(lists.dim[0]), 1 << 30)
        for a, b in lists.stretches(settings.pairs_at_once):
            apart = np.bitwise_count(lists.parts[a] ^ lists.parts[b]).sum(axis=1, dtype=np.int32)
            near = np.flatnonzero(apart <= limit)
            a, b = a[near], b[near]
            fresh = lists.first(a, b)
            hit[a[fresh]] = True
            hit[b[fresh]] = True
        kept.append(lists.rows.filter(pa.array(hit)))
    return pa.concat_tables(kept)


def _joined(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``low``, the smallest place reachable from each, after linking a with b."""
    while True:
        x, y = low[a], low[b]
        differ = x != y
        if not differ.any():
            return low
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while True:
            nearer = low[low]
            if (nearer == low).all():
                break
            low = nearer


def _compared(rows: pa.Table, settings: Settings) -> pa.Table:
    """Counts of linked vectors by class, and connections, of the block pairs of one task."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lists in _Lists.of(rows):
        raw = lists.rows["vector"].combine_chunks()
        width = len(raw[0].as_py()) // int(lists.dim[0])
        vectors = np.frombuffer(b"".join(raw.to_pylist()), f"<f{width}").reshape(len(raw), -1)
        _, unit = _normed(vectors)
        rep, n = lists.rows["rep"].to_numpy(), lists.rows["n"].to_numpy()
        count, low = np.zeros(len(rep), np.int64), np.arange(len(rep))
        for a, b in lists.stretches(max(1, settings.pairs_at_once // max(1, unit.shape[1] // 16))):
            near = np.flatnonzero(np.einsum("ij,ij->i", unit[a], unit[b]) >= settings.cosine)
            a, b = a[near], b[near]
            fresh = lists.first(a, b)
            a, b = a[fresh], b[fresh]
            np.add.at(count, a, n[b])
            np.add.at(count, b, n[a])
            low = _joined(low, a, b)
        linked, moved = np.flatnonzero(count), np.flatnonzero(low != np.arange(len(low)))
        out.append((rep[linked], np.full(len(linked), -1), count[linked]))
        out.append((rep[moved], rep[low[moved]], np.zeros(len(moved), np.int64)))
    a, b, n = (np.concatenate(x) for x in zip(*out))
    return pa.table({"a": pa.array(a), "b": pa.array(b.astype(np.int64), mask=b < 0), "n": pa.array(n)})


# --- the job -----------------------------------------------------------------------------------


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``."""
    found, limits, _ = coded(vectors, settings)
    usable = stored(found.withColumn("row", F.monotonically_increasing_id()), "codes")
    # Ids may repeat, so classes have numbers of their own: the smallest of their rows.
    kind = ["label", "dim", "key"]
    classes = stored(
        usable.groupBy(*kind).agg(F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("n")), "classes"
    )
    reps = classes.select("rep", "n").join(usable.select(F.col("row").alias("rep"), "label", "dim", "parts"), "rep")
    slots = reps.select("rep", "label", "dim", F.posexplode("parts").alias("table", "part")).select(
        "rep", F.xxhash64("label", "dim", "table", "part").alias("slot"), F.col("table").cast("short").alias("table")
    )
    lists = slots.groupBy("slot").agg(F.count("*").alias("rows")).filter("rows > 1")
    blocks = F.ceil(F.col("rows") / settings.block_rows).cast("int")
    dealt = slots.join(lists.select("slot", blocks.alias("blocks")), "slot")
    side = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    met = dealt.select("slot", "table", "rep", side.alias("side"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = stored(
        met.select("slot", "table", "rep", "side", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y")), "meetings"
    )
    task_rows = settings.task_rows

    def dealt_out(rows: DataFrame, number: int) -> DataFrame:
        """By task; both blocks of a pair go to one."""
        task = F.pmod(F.xxhash64("slot", "x", "y"), F.lit(max(1, -(-number // task_rows)))).cast("int")
        return rows.withColumn("task", task).groupBy("task")

    place = "label string, dim int, slot long, table short, x int, y int, side int, rep long, n long, parts array<int>"
    names = [c.split()[0] for c in place.split(", ")]
    close = stored(
        dealt_out(met.join(reps, "rep").select(*names), met.count())
        .applyInArrow(lambda t: _close(t.select(names), limits, settings), place),
        "close",
    )
    numbers = usable.select(F.col("row").alias("rep"), "vector")
    links = stored(
        dealt_out(close.join(numbers, "rep"), close.count()).applyInArrow(lambda t: _compared(t, settings), "a long, b long, n long"),
        "links",
    )
    label = components(links.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    counts = links.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    classed = stored(
        classes.join(counts, "rep", "left").join(label, "rep", "left").select(
            *kind, "least", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("group"),
        ),
        "classed",
    )
    smallest = classed.groupBy("group").agg(F.min("least").alias("component_id"))
    named = classed.select(*kind, "n_links", "group").join(smallest, "group")
    linked = usable.select("vec_id", *kind).join(named, kind).select("vec_id", "n_links", "component_id")
    return _with_rest(vectors, usable, linked)


def _with_rest(vectors: DataFrame, usable: DataFrame, linked: DataFrame) -> DataFrame:
    """Adds the rows that cannot link; of an id in several rows, as many as do not link."""
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    rest = ids.exceptAll(usable.select("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(rest).withColumn("kept", F.expr("vec_id <=> component_id"))
