"""A trie of conversation prefixes, built as a z-fast trie and expanded into its nodes.

A conversation is a string whose symbols are turns.  Every prefix has a digest of 128 bits, a sum
without carry of keyed hashes of (depth, role, text); the key is drawn anew for each run, so no text
can be made to collide.  The trie is kept compacted: a node is a prefix where conversations end or
part, with the edge of single prefixes above it.  Each node is hashed by its handle, the prefix whose
length is the two-fattest number (the one with most trailing zero bits) of its edge.

Distinct conversations are inserted in batches, each twice as large as the one before.  A batch finds
the exit node of each of its conversations by fat binary search: one lookup of the prefix at the
two-fattest depth of the open interval per round, all conversations at a time, in as many rounds as
the longest one's length has bits.  An edge is split where conversations leave it; only the turns
below the exits are then grouped into new nodes.  Sums over subtrees double the distance they cover
with every round, so they take the logarithm of the trie's height.  At the end edges are expanded
into one row per prefix.

Everything is a join or an aggregate over narrow rows (ids, depths, digests, word counts) that
adaptive execution can split; texts are shuffled once, to be put in order.  Turns are numbered and
digested by range partitions whose ends are reconciled, so a conversation of any length is spread
over tasks.  Equal conversations are one entry from the start.  The only thing a single task does for
one key is the SHA-256 of a node's ids, which is sequential by definition: it streams over sorted
rows and holds one digest.

Defined cases: rows without a conversation id belong to none and are left out.  A null role or text is
empty, and null turns come first.  Turns of one number are ordered by role and text; repeated rows are
turns of their own (equal ones are all sorted by one task).  Conversations of any length, and texts of
any length, are taken whole.  A conversation without turns is a member of the root only.  No
conversations give no rows, not even a root.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.words import mixed

U = np.uint64
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
DIGEST = ["p1", "p2"]


@dataclass(frozen=True)
class Settings:
    batches: int = 3


# --- order and digests ------------------------------------------------------------------------------


def _runs(conv: np.ndarray, last: int | None) -> tuple[np.ndarray, np.ndarray, bool]:
    """(first row of each run of one id, run of each row, whether the first run goes on from before)."""
    new = np.concatenate([[True], conv[1:] != conv[:-1]])
    return np.flatnonzero(new), np.cumsum(new) - 1, last is not None and conv[0] == last


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, e1, e2, words): each turn with its number and a digest of role and text."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    order = ["conv_id", "turn", "role", "text"]
    key = uuid.uuid4().hex
    digest = F.unhex(F.sha2(F.concat(F.lit(key), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), "conv_id", digest.alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            first, of, goes_on = _runs(conv, last)
            number = np.arange(len(conv)) - first[of] + 1
            if goes_on:
                number[of == 0] += count
            last, count = conv[-1], int(number[-1])
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<i8").reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part"), batch.column("conv_id"), pa.array(number.astype(np.int64)),
                    pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), batch.column("words"),
                ],
                names=["part", "conv_id", "place", "e1", "e2", "words"],
            )

    schema = "part int, conv_id long, place long, e1 long, e2 long, words long"
    local = stored(ordered.mapInArrow(run, schema), "turns")
    before = _carried(local, "place", {"place": F.sum})
    return _with_carried(local, before).select(
        "conv_id", (F.col("place") + F.coalesce("before_place", F.lit(0))).alias("depth"), "e1", "e2", "words"
    )


def _carried(local: DataFrame, order: str, sums: dict) -> DataFrame:
    """(part, conv_id, before_…): what earlier partitions hold of the id a partition begins with.

    One row per partition.  Only a partition's first id can go on from before, and of the one before
    that is its last id.
    """
    ends = local.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", order, *[c for c in sums if c != order])).alias("last")
    )
    by_id = Window.partitionBy("last.conv_id").orderBy("part")
    along = Window.orderBy("part")
    upto = ends.select(
        "part", "first", F.col("last.conv_id").alias("id"), *[agg(f"last.{c}").over(by_id).alias(c) for c, agg in sums.items()]
    )
    earlier = upto.select(
        "part", F.col("first").alias("conv_id"), F.lag("id").over(along).alias("id"),
        *[F.lag(c).over(along).alias(f"before_{c}") for c in sums],
    )
    return earlier.filter("id = conv_id").drop("id")


def _with_carried(local: DataFrame, before: DataFrame) -> DataFrame:
    # At most one row per partition of the sorted table.
    return local.join(F.broadcast(before), ["part", "conv_id"], "left")


def branched(rows: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others, from numbered rows: (rows, conversations).

    Conversation c takes the first h turns of conversation c - c % every instead of its own first h,
    h being crc32(c) % heads; all of them, if these are fewer.
    """
    conv = F.col("conv_id")
    start = F.struct("depth", "e1", "e2", "words")
    first = F.sort_array(F.collect_list(F.when(F.col("depth") < heads, start)))
    known = stored(rows.groupBy("conv_id").agg(first.alias("start")), "starts")
    taken = known.select(
        "conv_id", (F.crc32(conv.cast("string")) % heads).alias("h"), (conv - conv % every).alias("other")
    ).join(known.select(F.col("conv_id").alias("other"), "start"), "other", "left")
    taken = taken.select("conv_id", "h", F.filter("start", lambda s: s["depth"] <= F.col("h")).alias("start"))
    count = F.when(F.col("start").isNull(), 0).otherwise(F.size("start"))
    own = rows.join(taken.select("conv_id", "h", count.alias("n")), "conv_id")
    own = own.filter("depth > h").withColumn("depth", F.expr("depth - h + n")).select(*rows.columns)
    new = taken.filter("start IS NOT NULL").select("conv_id", F.explode("start").alias("s")).select("conv_id", "s.*")
    return own.unionByName(new), known.select("conv_id")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, words, total): the digest of each prefix and of the one before
    it, the words of its last turn, and of all its turns."""
    ordered = rows.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth").select(
        F.spark_partition_id().alias("part"), "conv_id", "depth", "e1", "e2", "words"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ends = None, (U(0), U(0), np.int64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth = (batch.column(c).to_numpy() for c in ("conv_id", "depth"))
            first, of, goes_on = _runs(conv, last)
            out, done = [], []
            place = mixed(depth.astype(np.uint64))
            for name, end in zip(("e1", "e2", "words"), ends):
                value = batch.column(name).to_numpy()
                if name == "words":
                    run = np.cumsum(value)
                    own = run - (run[first] - value[first])[of]
                    own[of == 0] += end if goes_on else 0
                else:
                    value = mixed(value.view(np.uint64) + place)
                    run = np.bitwise_xor.accumulate(value)
                    own = run ^ (run[first] ^ value[first])[of]
                    own[of == 0] ^= end if goes_on else U(0)
                    out.append(pa.array(value.view(np.int64)))
                out.append(pa.array(own.view(np.int64)))
                done.append(own[-1])
            last, ends = conv[-1], tuple(done)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("part", "conv_id", "depth")], *out, batch.column("words")],
                names=["part", "conv_id", "depth", "t1", "p1", "t2", "p2", "total", "words"],
            )

    schema = "part int, conv_id long, depth long, t1 long, p1 long, t2 long, p2 long, total long, words long"
    local = stored(ordered.mapInArrow(run, schema), "prefixes")
    before = _carried(local, "depth", {"p1": F.bit_xor, "p2": F.bit_xor, "total": F.sum})
    whole = _with_carried(local, before)
    for c in DIGEST:
        whole = whole.withColumn(c, F.col(c).bitwiseXOR(F.coalesce(f"before_{c}", F.lit(0))))
    return whole.select(
        "conv_id", "depth", *DIGEST, F.expr("p1 ^ t1 AS q1"), F.expr("p2 ^ t2 AS q2"), "words",
        (F.col("total") + F.coalesce("before_total", F.lit(0))).alias("total"),
    )


# --- the compacted trie -------------------------------------------------------------------------------


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with most trailing zero bits."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), bits))


def _at(rows: DataFrame, paths: DataFrame, who: str, depth: str, names: dict[str, str], how: str = "left") -> DataFrame:
    """Adds columns of the path row that conversation ``who`` has at a depth."""
    there = paths.select(F.col("rep").alias(who), F.col("depth").alias(depth), *[F.col(c).alias(n) for c, n in names.items()])
    return rows.join(there, [who, depth], how)


def _hashed(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes below the root with handle (f, f1, f2), and the first prefix of the edge (b, b1, b2)."""
    edges = nodes.filter("e > 0").withColumn("f", two_fattest(F.col("a"), F.col("e"))).withColumn("b", F.expr("a + 1"))
    edges = _at(edges, paths, "rep", "f", {"p1": "f1", "p2": "f2"})
    return stored(_at(edges, paths, "rep", "b", {"p1": "b1", "p2": "b2"}), "handles")


def located(batch: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(rep, n, e, p1, p2, a, node_rep, lcp): exit node of each conversation, and how much of it is known."""
    hashed = _hashed(nodes, paths)
    node = ["e", "p1", "p2", "a", "node_rep"]
    root = [F.lit(0).cast("long").alias(c) for c in ("e", "p1", "p2", "a", "node_rep")]
    state = batch.select("rep", "n", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"), *root)
    found = hashed.select("f", "f1", "f2", *[F.col("rep" if c == "node_rep" else c).alias(f"hit_{c}") for c in node])
    finished, near, size = [], paths, None
    while True:
        state = stored(state, "search")
        finished.append(state.filter("low >= high"))
        state = state.filter("low < high")
        left = state.count()
        if not left:
            break
        if size is not None and left <= size // 2:
            # Few are still searching: go on with their paths only, within their open intervals.
            span = state.select("rep", "low", "high")
            near = stored(near.join(span, "rep").filter("depth > low AND depth <= high").drop("low", "high"), "near")
            size = left
        size = size or left
        probe = _at(state.withColumn("f", two_fattest(F.col("low"), F.col("high"))), near, "rep", "f", {"p1": "f1", "p2": "f2"})
        state = probe.join(found, ["f", "f1", "f2"], "left").select(
            "rep", "n", F.coalesce("hit_e", "low").alias("low"),
            F.when(F.col("hit_e").isNull(), F.col("f") - 1).otherwise(F.col("high")).alias("high"),
            *[F.when(F.col("hit_e").isNull(), F.col(c)).otherwise(F.col(f"hit_{c}")).alias(c) for c in node],
        )
    reached = finished[0]
    for more in finished[1:]:
        reached = reached.unionByName(more)
    # Past the whole extent, the exit may be on the edge of a child whose handle lies too deep.
    reached = _at(reached.withColumn("b", F.expr("e + 1")), paths, "rep", "b", {"p1": "b1", "p2": "b2"})
    reached = _at(reached, paths, "rep", "e", {"p1": "x1", "p2": "x2"})
    past = F.expr("e = 0 OR coalesce(x1 = p1 AND x2 = p2, false)")
    children = hashed.select("b", "b1", "b2", *[F.col("rep" if c == "node_rep" else c).alias(f"hit_{c}") for c in node])
    reached = reached.withColumn("past", past).join(children, ["b", "b1", "b2"], "left")
    on = F.col("past") & F.col("hit_e").isNotNull()
    exits = reached.select(
        "rep", "n", *[F.when(on, F.col(f"hit_{c}")).otherwise(F.col(c)).alias(c) for c in node],
        F.when(~on & F.col("past"), F.col("e")).alias("lcp"),
    )
    exits = stored(exits, "exits")
    # On the way through an edge: the deepest prefix that equals the edge's own.
    within = exits.filter("lcp IS NULL").select("rep", "node_rep", "a", "e").join(
        paths.select("rep", "depth", *DIGEST), "rep"
    ).filter("depth > a AND depth <= e")
    edge = paths.select(F.col("rep").alias("node_rep"), "depth", *DIGEST)
    shared = within.join(edge, ["node_rep", "depth", *DIGEST]).groupBy("rep").agg(F.max("depth").alias("shared"))
    return stored(
        exits.join(shared, "rep", "left").withColumn("lcp", F.coalesce("lcp", "shared", "a")).drop("shared"), "located"
    )


def inserted(found: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes (e, p1, p2, rep, a) after a located batch joined the trie."""
    # Edges that conversations leave are split there.
    leaving = found.filter("lcp < e").groupBy("e", *DIGEST, "a", "lcp").agg(F.min("rep").alias("rep"))
    points = _at(leaving, paths, "rep", "lcp", {"p1": "s1", "p2": "s2"})
    edge = Window.partitionBy("e", *DIGEST).orderBy("lcp")
    splits = points.withColumn("above", F.coalesce(F.lag("lcp").over(edge), "a"))
    cut = points.groupBy("e", *DIGEST).agg(F.max("lcp").alias("cut"))
    kept = nodes.join(cut, ["e", *DIGEST], "left").select("e", *DIGEST, "rep", F.coalesce("cut", "a").alias("a"))
    split = splits.select(F.col("lcp").alias("e"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), "rep", F.col("above").alias("a"))
    # Below the exits: prefixes where conversations end or part are nodes.
    tails = stored(found.select("rep", "n", "lcp").join(paths, "rep").filter("depth > lcp"), "tails")
    plain = tails.groupBy("depth", *DIGEST).agg(
        F.min("rep").alias("rep"), F.max(F.expr("depth = n")).alias("ends"), F.first("q1").alias("q1"), F.first("q2").alias("q2")
    )
    plain = stored(plain, "plain")
    kids = plain.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("kids")
    )
    place = ["depth", *DIGEST]
    new = plain.join(kids, place, "left").filter("ends OR kids > 1").select(*place, F.col("rep").alias("first"))
    path = Window.partitionBy("rep").orderBy("depth")
    marked = tails.join(new, place).withColumn("above", F.coalesce(F.lag("depth").over(path), "lcp"))
    grown = marked.filter("rep = first").select(F.col("depth").alias("e"), *DIGEST, "rep", F.col("above").alias("a"))
    return stored(kept.unionByName(split).unionByName(grown), "nodes")


def compacted(sequences: DataFrame, paths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Nodes (e, p1, p2, rep, a): depth and digest of the prefix, a conversation through it, the depth
    of the node above.  The root has depth 0 and no node above (-1)."""
    spark = sequences.sparkSession
    nodes = stored(
        spark.range(1).selectExpr("0L AS e", "0L AS p1", "0L AS p2", "CAST(NULL AS long) AS rep", "-1L AS a"), "root"
    )
    draw = F.pmod(F.xxhash64("rep"), F.lit((1 << settings.batches) - 1)) + 1
    for k in range(settings.batches):
        batch = sequences.filter("n > 0").filter(F.length(F.bin(draw)) == k + 1).select("rep", "n")
        if k == 0:
            # Nothing is known yet: every exit is the root.
            found = batch.selectExpr("*", "0L AS e", "0L AS p1", "0L AS p2", "0L AS a", "0L AS node_rep", "0L AS lcp")
        else:
            found = located(batch, nodes, paths)
        nodes = inserted(found, nodes, paths)
    return nodes


# --- subtrees and expansion -----------------------------------------------------------------------------


def _subtree_sums(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """(node, …) with sums and the smallest value over each node's subtree.

    After k rounds a node has what lies less than 2^k edges below it, and points 2^k edges up.
    """
    total = stored(nodes.select("node", F.col("parent").alias("up"), *sums, least), "subtrees")
    while True:
        climbing = total.filter("up IS NOT NULL")
        if climbing.isEmpty():
            return total.drop("up")
        given = climbing.groupBy(F.col("up").alias("node")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in sums], F.min(least).alias("more_least")
        )
        higher = total.select(F.col("node").alias("up"), F.col("up").alias("next"))
        total = stored(
            total.join(given, "node", "left").join(higher, "up", "left").select(
                "node", F.col("next").alias("up"),
                *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in sums],
                F.least(least, "more_least").alias(least),
            ),
            "subtrees",
        )


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of rows (node, conv_id): a stream over each node's ids in order."""
    ordered = ends.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            names, out = [], []
            node, conv = batch.column("node").to_numpy(), batch.column("conv_id").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else []
            for s, e in zip(first, [*first[1:], len(node)]):
                text = ",".join(map(str, conv[s:e].tolist())).encode()
                if node[s] == last:
                    digest.update(b"," + text)
                    continue
                if last is not None:
                    names.append(last)
                    out.append(digest.hexdigest())
                last, digest = int(node[s]), hashlib.sha256(text)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(out, pa.string())], names=["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    return ordered.mapInArrow(run, "node long, ends_sha256 string")


def trie(rows: DataFrame, conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``rows`` are as of ``numbered``, ``conversations`` (conv_id) lists all, those without turns too.
    """
    walked = prefixes(rows)
    last = walked.groupBy("conv_id").agg(F.max(F.struct("depth", *DIGEST, "total")).alias("last"))
    zero = F.lit(0).cast("long")
    finals = stored(
        conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(last, "conv_id", "left").select(
            "conv_id", *[F.coalesce(f"last.{c}", zero).alias(n) for c, n in (("depth", "n"), ("p1", "p1"), ("p2", "p2"), ("total", "total"))]
        ),
        "finals",
    )
    sequences = stored(
        finals.groupBy("n", *DIGEST).agg(
            F.min("conv_id").alias("rep"), F.count("*").alias("ends"), F.first("total").alias("total")
        ),
        "sequences",
    )
    paths = stored(walked.withColumnRenamed("conv_id", "rep").join(sequences.select("rep"), "rep", "left_semi"), "paths")
    nodes = compacted(sequences, paths, settings).withColumn("node", F.monotonically_increasing_id())
    nodes = _at(stored(nodes, "named").withColumn("b", F.expr("a + 1")), paths, "rep", "b", {"q1": "u1", "q2": "u2", "total": "t", "words": "w"})
    # Words of all turns above the edge, and through it.
    nodes = _at(nodes.withColumn("above", F.expr("coalesce(t - w, 0)")), paths, "rep", "e", {"total": "total"}).drop("t", "w")
    parents = nodes.select(F.col("node").alias("parent"), F.col("e").alias("a"), F.col("p1").alias("u1"), F.col("p2").alias("u2"))
    nodes = nodes.join(parents, ["a", "u1", "u2"], "left")
    ending = sequences.select(F.col("n").alias("e"), *DIGEST, "ends", F.col("rep").alias("least"), F.col("total").alias("through"))
    nodes = stored(nodes.join(ending, ["e", *DIGEST], "left"), "tree")
    ends = _ends_digest(finals.withColumnRenamed("n", "e").join(nodes.select("node", "e", *DIGEST), ["e", *DIGEST]))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    own = nodes.join(children, "node", "left").select(
        "node", "parent", "e", "a", "rep", "least", "above", F.coalesce("children", zero).alias("children"),
        F.coalesce("ends", zero).alias("convs"), F.expr("CASE WHEN children IS NULL THEN 1L ELSE 0L END AS leaves"),
        F.expr("coalesce(ends * through, 0L) AS reach"), F.expr("coalesce(total, 0L) - above AS edge"),
        F.coalesce("total", zero).alias("upto"),
    )
    own = stored(own, "values")
    below = _subtree_sums(own.withColumn("edges", F.col("edge")), ["convs", "leaves", "reach", "edges"], "least")
    own = own.select("node", "parent", "e", "a", "rep", "children", "above", "edge", "upto").join(below, "node")
    # What lies below the edge saves the sum of (members - 1) * words of its edges.  Members times
    # words is, summed over the conversations that end there, their words below this edge.
    own = stored(own.withColumn("deeper", F.expr("reach - convs * above - edges - (convs - 1) * edge")), "sums")
    over = own.select(F.col("node").alias("parent"), F.col("least").alias("over"))
    nodes = own.join(over, "parent", "left").join(ends, "node", "left").filter("convs > 0")
    expanded = nodes.join(paths.select("rep", "depth", "words", "total"), "rep").filter("depth > a AND depth <= e")
    root = nodes.filter("e = 0").selectExpr("*", "0L AS depth", "0L AS words", "0L AS total").select(*expanded.columns)
    no_end = F.lit(EMPTY_SHA256)
    return expanded.unionByName(root).select(
        F.col("least").alias("conv_id"), "depth", F.expr("CASE WHEN depth = a + 1 THEN over ELSE least END AS parent_conv_id"),
        F.col("convs").alias("n_convs"), F.expr("CASE WHEN depth = e THEN children ELSE 1L END AS n_children"),
        F.col("leaves").alias("n_leaves"), F.expr("(convs - 1) * (upto - total + words) + deeper AS saved_tokens"),
        F.when(F.expr("depth = e"), F.coalesce("ends_sha256", no_end)).otherwise(no_end).alias("ends_sha256"),
    )


SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS other,
           xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: ascii(s))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), heads AS (
    SELECT c.conv_id, b.i AS d, b.role, b.text, b.words FROM convs c JOIN turns b ON b.conv_id = c.other AND b.i <= c.h
), rebuilt AS (
    SELECT * FROM heads
    UNION ALL
    SELECT t.conv_id, t.i - c.h + coalesce(n, 0), t.role, t.text, t.words
    FROM turns t JOIN convs c USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id) USING (conv_id)
    WHERE t.i > c.h
), walked AS (
    SELECT conv_id, d, words, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY d) AS prefix FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, [] FROM convs
), named AS (
    SELECT *, dense_rank() OVER (ORDER BY d, prefix) AS node, d = max(d) OVER (PARTITION BY conv_id) AS last FROM walked
), nodes AS (
    SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM named GROUP BY node
), edges AS (
    SELECT DISTINCT a.node AS up, b.node AS node FROM named a JOIN named b ON a.conv_id = b.conv_id AND b.d = a.d + 1
), below AS (
    SELECT DISTINCT a.node AS up, b.node AS node FROM named a JOIN named b ON a.conv_id = b.conv_id AND b.d >= a.d
), children AS (
    SELECT up AS node, count(*) AS n_children FROM edges GROUP BY up
), sums AS (
    SELECT b.up AS node, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (c.node IS NULL) AS leaves
    FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.node = b.node GROUP BY b.up
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN children c USING (node)
LEFT JOIN edges e ON e.node = n.node LEFT JOIN nodes p ON p.node = e.up
"""
