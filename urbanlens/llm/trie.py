"""A z-fast trie of conversation prefixes.

A conversation is a path of turns. The compacted trie has a node where paths part or end; its edge holds the depths ``(lo, hi]`` above it.
The dictionary has each node under the hash of its path cut at its *handle*, the two-fattest number of ``(lo, hi]`` (the one divisible by
the largest power of two). A fat binary search for a path asks for the two-fattest depth of the interval that is left: a hit moves the
lower end to the found node's depth, a miss the upper end below the asked depth, so a path of n turns needs log2(n) look-ups, whatever
the trie's depth. One more look-up by the next turn and a comparison along the one edge where the path leaves the trie give its exit.

Conversations are inserted in batches: every batch is searched in the trie of the batches before it, all look-ups of a round being one join on
the hash; the exits within edges split these, and what goes on below the exits is joined to them, compacted. Equal conversations
are one path. Then numbers of members, leaves and saved bytes are summed up the compacted nodes by pointers that double their
distance each round, and the edges are expanded, one row for each depth.

A path's key is ``(depth, bytes so far, two 64-bit hashes)``: hashes of a turn, its place included, XORed over the path. That is a running
value over range-partitioned rows (one number per partition closes the gaps), so no conversation is gathered in a
row or a task, however many turns it has. Joins on a hot node are of one row against many and are split; digests of long member lists are
streamed over packed pieces.

Edge cases: a null conversation id is no conversation and takes no part; null roles and texts are empty; turns of equal number go by role and text
(:func:`numbered_turns`; null numbers first), repeated rows are turns of their own; conversations without turns are members of the root; no conversation, no
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import discard, is_empty, materialize, returning_memory
from urbanlens.operators.ordering import numbered

#: Shares of the paths (by hash) that have been inserted after each batch.
BATCHES = (1 / 16, 1 / 4, 1)
#: Depths that an expanded edge joins at once; conversation ids in a piece of a digest's input; rounds of a search in one plan.
_CHUNK, _IDS, _ROUNDS = 64, 4096, 4
_KEY = "struct<d:bigint,b:bigint,k1:bigint,k2:bigint>"


def two_fattest(a: Column, b: Column) -> Column:
    """The number in ``(a, b]`` that is divisible by the largest power of two: b without the bits below the highest that differs."""
    low = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def numbered_turns(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, h1, h2, n_bytes``: every turn's place in its conversation from 1, two hashes of role and text, and its text's UTF-8 bytes."""
    rows = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                       F.coalesce(F.col(text), F.lit("")).alias("text")).filter("conv_id is not null")
    rows = rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(1), "role").alias("h2"), F.octet_length("text").cast("long").alias("n_bytes"))
    return numbered(rows, ["conv_id"], F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), name="pos").select("conv_id", "pos", "h1", "h2", "n_bytes")


def _running(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv_id, pos, t1, t2, n_bytes``) in order, with running XORs and sums over each partition and the partition's number."""
    import pyarrow as pa
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(shards, "conv_id", "pos").sortWithinPartitions("conv_id", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x1 = x2 = total = np.int64(0)
        for b in batches:
            if not b.num_rows:
                continue
            t1, t2, n = (np.asarray(b[c]) for c in ("t1", "t2", "n_bytes"))
            r1, r2, s = np.bitwise_xor.accumulate(t1) ^ x1, np.bitwise_xor.accumulate(t2) ^ x2, np.cumsum(n) + total
            x1, x2, total = r1[-1], r2[-1], s[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r1), pa.array(r2), pa.array(s)], names=[*b.schema.names, "x1", "x2", "s"])

    out = ranged.mapInArrow(returning_memory(run), "conv_id long, pos long, t1 long, t2 long, n_bytes long, x1 long, x2 long, s long")
    return materialize(out.withColumn("part", F.spark_partition_id()), "trie-running")


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, d, key, prev``: for every turn (``conv_id, pos, h1, h2, n_bytes``) the key of the path to it and to the turn before."""
    rows = turns.select("conv_id", "pos", F.xxhash64("pos", "h1").alias("t1"), F.xxhash64("h2", "pos").alias("t2"), "n_bytes")
    rows = _running(rows)
    totals = rows.groupBy("part").agg(F.bit_xor("t1").alias("t1"), F.bit_xor("t2").alias("t2"), F.sum("n_bytes").alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("part", *(F.coalesce(f.over(before), F.lit(0)).alias(c) for c, f in (("c1", F.bit_xor("t1")), ("c2", F.bit_xor("t2")), ("cs", F.sum("n")))))
    rows = rows.join(F.broadcast(carry), "part").select("conv_id", "pos", "t1", "t2", "n_bytes", F.col("x1").bitwiseXOR(F.col("c1")).alias("x1"),
                                                        F.col("x2").bitwiseXOR(F.col("c2")).alias("x2"), (F.col("s") + F.col("cs")).alias("s"))
    first = rows.filter("pos = 1").select("conv_id", F.col("x1").bitwiseXOR(F.col("t1")).alias("o1"), F.col("x2").bitwiseXOR(F.col("t2")).alias("o2"),
                                          (F.col("s") - F.col("n_bytes")).alias("os"))
    k1, k2, b = F.col("x1").bitwiseXOR(F.col("o1")), F.col("x2").bitwiseXOR(F.col("o2")), F.col("s") - F.col("os")
    return rows.join(first, "conv_id").select(
        "conv_id", F.col("pos").alias("d"), F.struct(F.col("pos").alias("d"), b.alias("b"), k1.alias("k1"), k2.alias("k2")).alias("key"),
        F.struct((F.col("pos") - 1).alias("d"), (b - F.col("n_bytes")).alias("b"), k1.bitwiseXOR(F.col("t1")).alias("k1"), k2.bitwiseXOR(F.col("t2")).alias("k2")).alias("prev"))


def _root() -> Column:
    return F.struct(*(F.lit(0).cast("long").alias(c) for c in ("d", "b", "k1", "k2")))


def _at(path: DataFrame, rep: str, depth: str, name: str) -> DataFrame:
    """The keys of paths at a depth, named to be joined on ``rep`` and ``depth``."""
    return path.select(F.col("conv_id").alias(rep), F.col("d").alias(depth), F.col("key").alias(name))


def _with_handles(edges: DataFrame, path: DataFrame) -> DataFrame:
    """``rep, lo, key`` (the key at the upper and lower end, and a path through both) with the keys at the handle and below ``lo``."""
    edges = edges.select("rep", "lo", "key", two_fattest(F.col("lo.d"), F.col("key.d")).alias("f"), (F.col("lo.d") + 1).alias("f2"))
    return edges.join(_at(path, "rep", "f", "handle"), ["rep", "f"]).join(_at(path, "rep", "f2", "name"), ["rep", "f2"]).select("rep", "lo", "key", "handle", "name")


def exits(batch: DataFrame, edges: DataFrame, path: DataFrame, longest: int) -> DataFrame:
    """``rep, n, x, edge``: how many turns of each path (``rep, n``) are in the trie, and the edge within which it leaves it, if any."""
    state = batch.select("rep", "n", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))
    found = edges.select(F.col("handle").alias("asked"), F.col("key").alias("hit"), F.col("lo.d").alias("above"))
    for k in range(longest.bit_length()):
        state = state.withColumn("f", F.when(F.col("a") < F.col("b"), two_fattest(F.col("a"), F.col("b"))))
        state = state.join(_at(path, "rep", "f", "asked"), ["rep", "f"], "left").join(found, "asked", "left").withColumn("f2", F.col("hit.d"))
        state = state.join(_at(path, "rep", "f2", "own"), ["rep", "f2"], "left")
        # a miss; a node on the path; a node whose edge the path leaves below the handle
        a = F.when(F.col("hit").isNull(), F.col("a")).when(F.col("own") == F.col("hit"), F.col("hit.d")).otherwise(F.col("above"))
        b = F.when(F.col("f").isNull(), F.col("b")).when(F.col("hit").isNull(), F.col("f") - 1).when(F.col("own") == F.col("hit"), F.col("b")).otherwise(F.col("above"))
        state = state.select("rep", "n", a.alias("a"), b.alias("b"))
        if k % _ROUNDS == _ROUNDS - 1:
            state = materialize(state, "trie-search")
    below = state.withColumn("f", F.col("a") + 1).join(_at(path, "rep", "f", "name"), ["rep", "f"], "left").join(
        edges.select("name", F.col("key").alias("edge"), F.col("rep").alias("through")), "name", "left").select("rep", "n", "a", "edge", "through")
    below = materialize(below, "trie-below")
    within = below.filter("edge is not null").select("rep", "n", "a", "edge", "through")
    own = within.join(path.select(F.col("conv_id").alias("rep"), "d", "key"), "rep").filter("d > a and d <= edge.d")
    common = own.join(path.select(F.col("conv_id").alias("through"), "key"), ["through", "key"]).groupBy("rep").agg(F.max("d").alias("x"))
    return materialize(below.join(common, "rep", "left").select("rep", "n", F.coalesce("x", "a").alias("x"), "edge"), "trie-exits")


def insert(batch: DataFrame, edges: DataFrame | None, path: DataFrame, longest: int) -> DataFrame:
    """The edges of the trie after the paths ``batch`` (``rep, n``) are added."""
    if edges is None:
        out = batch.select("rep", "n", F.lit(0).cast("long").alias("x"), F.lit(None).cast(_KEY).alias("edge"))
    else:
        out = exits(batch, edges, path, longest)
    new = materialize(out.join(path.withColumnRenamed("conv_id", "rep"), "rep").filter("d > x").select("rep", "n", "x", "d", "key", "prev"), "trie-new")
    ends = new.filter("d = n").select("key")
    parting = new.filter("d > x + 1").select("prev", "key").distinct().groupBy("prev").agg(F.count("*").alias("ways")).filter("ways > 1").select(F.col("prev").alias("key"))
    nodes = new.join(ends.union(parting).distinct(), "key", "left_semi")
    upper = F.lag("key").over(Window.partitionBy("rep").orderBy("d"))
    starts = new.filter("d = x + 1").select("rep", F.col("prev").alias("start"))
    nodes = nodes.select("rep", "key", upper.alias("upper")).join(starts, "rep").select("rep", F.coalesce("upper", "start").alias("lo"), "key")
    added = _with_handles(nodes.groupBy("key").agg(F.min(F.struct("rep", "lo")).alias("m")).select("m.rep", "m.lo", "key"), path)
    if edges is None:
        return materialize(added, "trie-edges")
    points = out.filter("edge is not null").select("edge", F.col("x").alias("f")).distinct()
    halves = edges.join(points.withColumnRenamed("edge", "key"), "key").select("rep", "lo", F.col("key").alias("whole"), "f")
    halves = halves.join(_at(path, "rep", "f", "key"), ["rep", "f"]).select("rep", "lo", "whole", "key")
    whole = edges.join(points.select(F.col("edge").alias("key")).distinct(), "key", "left_semi").select("rep", "lo", F.col("key").alias("whole"), "key")
    order = Window.partitionBy("whole").orderBy("key.d")
    pieces = halves.unionByName(whole).select("rep", F.coalesce(F.lag("key").over(order), "lo").alias("lo"), "key")
    kept = edges.join(points.select(F.col("edge").alias("key")).distinct(), "key", "left_anti")
    return materialize(kept.unionByName(_with_handles(pieces, path)).unionByName(added), "trie-edges")


def summed_up(nodes: DataFrame, sums: list[str], least: list[str] = ()) -> DataFrame:
    """``nodes`` (``key, up``, values) with values summed (or the least taken) over each node's subtree.

    After round k a node has what lies less than 2^k steps below it, and a pointer 2^k steps up.
    """
    state = materialize(nodes, "trie-sums")
    while not is_empty(state.filter("up is not null")):
        below = state.filter("up is not null").groupBy(F.col("up").alias("key")).agg(
            *(F.sum(c).alias(f"_{c}") for c in sums), *(F.min(c).alias(f"_{c}") for c in least))
        far = state.select(F.col("key").alias("up"), F.col("up").alias("_up"))
        longer = state.join(below, "key", "left").join(far, "up", "left").select(
            "key", F.col("_up").alias("up"), *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums), *(F.least(c, f"_{c}").alias(c) for c in least))
        longer = materialize(longer, "trie-sums")
        discard(state)
        state = longer
    return state.drop("up")


def list_digests(rows: DataFrame) -> DataFrame:
    """``key, digest``: SHA-256 of each key's conversation ids, ascending and joined by commas, from ``key, conv_id``.

    Ranges of the sorted rows are packed into pieces; a key's pieces are then read in order by one task, one piece at a time.
    """
    import pyarrow as pa
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flat = rows.select("key.*", "conv_id")
    key = ["d", "b", "k1", "k2"]
    ranged = flat.repartitionByRange(shards, *key, "conv_id").sortWithinPartitions(*key, "conv_id")
    schema = pa.schema([*((c, pa.int64()) for c in key), ("first", pa.int64()), ("piece", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, ids = np.stack([np.asarray(b[c]) for c in key], axis=1), np.asarray(b["conv_id"])
            cuts = np.flatnonzero(np.r_[True, (parts[1:] != parts[:-1]).any(axis=1), True]) if len(ids) else []
            cuts = [c for i, j in zip(cuts[:-1], cuts[1:], strict=True) for c in range(i, j, _IDS)]
            pieces = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(cuts, [*cuts[1:], len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(parts[cuts, i] if cuts else [], pa.int64()) for i in range(4)), pa.array(ids[cuts] if cuts else [], pa.int64()),
                                              pa.array(pieces, pa.string())], schema=schema)

    packed = ranged.mapInArrow(pack, "d long, b long, k1 long, k2 long, first long, piece string")
    dealt = packed.repartition(shards, *key).sortWithinPartitions(*key, "first")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, out = None, None, []
        for b in batches:
            for *k, _, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k != own:
                    if own:
                        out.append((*own, state.hexdigest()))
                    own, state = k, hashlib.sha256(piece.encode())
                else:
                    state.update(f",{piece}".encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*key, "digest"])
                out = []
        if own:
            out.append((*own, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*key, "digest"])

    return dealt.mapInArrow(read, "d long, b long, k1 long, k2 long, digest string").select(F.struct(*key).alias("key"), "digest")


def prefix_nodes(turns: DataFrame, conversations: DataFrame, batches: tuple[float, ...] = BATCHES) -> DataFrame:
    """Every node of the expanded trie: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns``: ``conv_id, pos, h1, h2, n_bytes`` with ``pos`` from 1 without gaps; ``conversations``: ``conv_id``, those without turns too.
    ``conv_id`` is a node's smallest member, ``saved_tokens`` what storing each prefix once saves below the node, in bytes of text.
    """
    path = materialize(paths(turns), "trie-paths")
    last = path.groupBy("conv_id").agg(F.max("key").alias("key"))
    empty = conversations.select("conv_id").distinct().join(last, "conv_id", "left_anti").select("conv_id", _root().alias("key"))
    ends = materialize(last.unionByName(empty), "trie-ends")
    same = materialize(ends.groupBy("key").agg(F.min("conv_id").alias("rep"), F.count("*").alias("members")), "trie-same")
    reps = same.filter("key.d > 0").select("rep", F.col("key.d").alias("n"), (F.pmod(F.xxhash64("key.k1", "key.k2"), F.lit(1 << 20)) / (1 << 20)).alias("share"))
    own = materialize(path.join(reps.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi"), "trie-paths")
    discard(path)
    longest = same.agg(F.max("key.d")).first()[0] or 0
    edges, done = None, 0.0
    for upto in batches if longest else ():
        batch = reps.filter((F.col("share") >= done) & (F.col("share") < upto)).select("rep", "n")
        edges, before, done = insert(batch, edges, own, longest), edges, upto
        discard(before)
    if edges is None:  # no conversation has a turn
        edges = own.select(F.col("conv_id").alias("rep"), F.col("prev").alias("lo"), "key").limit(0)

    ways = edges.groupBy(F.col("lo").alias("key")).agg(F.count("*").alias("ways"))
    nodes = edges.select("key", F.col("lo").alias("up")).unionByName(
        conversations.limit(1).select(_root().alias("key"), F.lit(None).cast(_KEY).alias("up")))
    nodes = nodes.join(same, "key", "left").join(ways, "key", "left").select(
        "key", "up", F.coalesce("members", F.lit(0)).alias("n_convs"), F.coalesce("ways", F.lit(0)).alias("ways"), F.col("rep").alias("least"))
    nodes = materialize(nodes, "trie-nodes")
    totals = summed_up(nodes.select("key", "up", "n_convs", "least", (F.col("ways") == 0).cast("long").alias("n_leaves")), ["n_convs", "n_leaves"], ["least"])
    totals = materialize(nodes.select("key", "up", "ways").join(totals, "key"), "trie-totals")
    saved = (F.col("n_convs") - 1) * (F.col("key.b") - F.coalesce(F.col("up.b"), F.lit(0)))
    saved = summed_up(totals.select("key", "up", saved.alias("saved")), ["saved"])

    compact = totals.join(saved, "key").join(list_digests(ends).withColumnRenamed("digest", "ends"), "key", "left")
    above = totals.select(F.col("key").alias("up"), F.col("least").alias("above"))
    compact = compact.join(above, "up", "left").join(edges.select("key", "rep"), "key", "left")
    compact = materialize(compact, "trie-compact")
    chunk = F.floor(F.col("d") / _CHUNK)
    spread = compact.filter("up is not null").withColumn("chunk", F.explode(F.sequence(F.floor((F.col("up.d") + 1) / _CHUNK), F.floor(F.col("key.d") / _CHUNK))))
    steps = own.select(F.col("conv_id").alias("rep"), chunk.alias("chunk"), "d", F.col("prev.b").alias("before"))
    rows = spread.join(steps, ["rep", "chunk"]).filter("d > up.d and d <= key.d").unionByName(
        compact.filter("up is null").select("*", F.lit(0).cast("long").alias("chunk"), F.col("key.d").alias("d"), F.lit(0).cast("long").alias("before")))
    node, top = F.col("d") == F.col("key.d"), F.col("d") == F.col("up.d") + 1
    return rows.select(
        F.col("least").alias("conv_id"), F.col("d").alias("depth"), F.when(top, F.col("above")).when(F.col("up").isNotNull(), F.col("least")).alias("parent_conv_id"), "n_convs",
        F.when(node, F.col("ways")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - F.coalesce((F.col("n_convs") - 1) * (F.col("before") - F.col("up.b")), F.lit(0))).alias("saved_tokens"),
        F.coalesce(F.when(node, F.col("ends")), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
