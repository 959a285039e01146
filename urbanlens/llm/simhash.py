"""SimHash near-duplicate detection over a Gray-order hierarchical index.

Fingerprints: every text is split at ASCII white space, lower-cased in A-Z, and each run of ``shingle`` words (repeats included) is hashed
with XXH64 (seed 42); a bit is 1 if it is set in over half of the hashes.

Search, exact for ``distance`` differing bits, over *distinct* fingerprints:

* Upper nodes hold shared masked bit patterns ``(mask, pattern)``. The 64 bits are cut into ``distance + 1`` parts; two linked
  fingerprints agree in one part at least, so each fingerprint enters one node per part. A node with more than ``node_size``
  members hands them down: its free bits are cut in the same way and each member enters the nodes of the longer masks. By
  the same argument no link is lost, and a node shrinks until it fits: no node is ever larger than a task's bound, however
  many fingerprints share a pattern. Members of single-member nodes are dropped.
* Inside a node the members are sorted by Gray rank, so neighbours differ little. Groups of 16 consecutive members, and groups of 16
  such groups, keep the bits they all share. Two groups are compared on the bits both share: the differences found
  so far are carried down, and a pair of groups is pruned as a whole when they exceed ``distance``.
* Links go through connected components (large-star, small-star).

Scale: one pass over the texts; then only 8-byte fingerprints move. A document's exact copies are one fingerprint from the first shuffle on.
A fingerprint has at most 2080 others within two bits, so links are bounded by the distinct fingerprints.

Edge cases: null, empty and blank texts have fingerprint zero and are linked like any other; texts with fewer words than a
shingle are one shingle; repeated rows share a component; rows with a null id get their component's smallest id, null if there is none; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from urbanlens.llm.common import discard, is_empty, materialize, sealed
from urbanlens.llm.components import components

#: Fixed value: the seed of the shingle hash.
SEED = 42
_BLOCK = 1 << 16
_FAN = 16


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit values have each bit, from bit 0 up."""
    counts = np.zeros((8, 8), np.int64)
    for at in range(0, len(h), _BLOCK):
        part = h[at:at + _BLOCK]
        rows = np.zeros((-(-len(part) // 255), 255), np.uint64)
        rows.reshape(-1)[:len(part)] = part
        for j in range(8):  # eight byte lanes are summed at once; 255 ones fit a byte
            lanes = ((rows >> np.uint64(j)) & np.uint64(0x0101010101010101)).sum(axis=1, dtype=np.uint64)
            counts[j] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.T.reshape(64)


def fingerprint(text: str | None, shingle: int) -> int:
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        few = words[at:min(at + _BLOCK, n) + shingle - 1]
        runs = [b" ".join(few)] if len(few) < shingle else map(b" ".join, zip(*(few[i:] for i in range(shingle)), strict=False))
        counts += bit_counts(np.array([digest(s, SEED) for s in runs], np.uint64))
    return int(((2 * counts > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprint_column(text: Column, shingle: int) -> Column:
    """The fingerprint's 64 bits as a (signed) long."""
    @pandas_udf("long")
    def f(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).astype(np.int64))
    return f(text)


def cut(mask: int, parts: int) -> list[int]:
    """The free bits of a mask in ``parts`` runs, as masks."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [sum(1 << int(i) for i in run) for run in np.array_split(free, parts) if len(run)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(c: Column) -> Column:
    """Place in Gray order, as a long whose signed order is that order."""
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c.bitwiseXOR(F.lit(_long(1 << 63)))


def links(codes: DataFrame, distance: int = 2, node_size: int = 2048) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the distinct longs ``code`` that differ in 1 to ``distance`` bits."""
    masks = cut(0, distance + 1)
    node_size = max(node_size, 1 << distance)  # with as few free bits as ``distance`` all members are linked: no cut is needed
    rows = codes.select("code", F.explode(F.array(*(F.lit(_long(m)) for m in masks))).alias("mask"))
    rows = rows.withColumn("pattern", F.col("code").bitwiseAND(F.col("mask")))
    found, depth = [], 0
    while True:
        rows = materialize(rows, "simhash-nodes")
        sizes = materialize(rows.groupBy("mask", "pattern").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-sizes")
        sized = rows.join(sizes, ["mask", "pattern"])
        pairs = materialize(_search(sized.filter(F.col("n") <= node_size), distance), "simhash-links")
        found.append(pairs)
        large = sizes.filter(F.col("n") > node_size)
        if is_empty(large):
            discard(rows)
            break
        # masks of one depth are few: products of the cuts above them
        split = {m: cut(m, distance + 1) for m in masks}
        masks = sorted({m | part for m, parts in split.items() for part in parts})
        longer = F.create_map(*(x for m, parts in split.items() for x in (
            F.lit(_long(m)), F.array(*(F.lit(_long(m | p)) for p in parts)))))
        down = rows.join(large.select("mask", "pattern"), ["mask", "pattern"], "left_semi")
        rows = down.select("code", F.explode(F.element_at(longer, F.col("mask"))).alias("mask"))
        rows = rows.withColumn("pattern", F.col("code").bitwiseAND(F.col("mask"))).distinct()
        depth += 1
    out = found[0]
    for pairs in found[1:]:
        out = out.unionByName(pairs)
    return out.distinct()


def _search(members: DataFrame, distance: int) -> DataFrame:
    """Links inside each node; nodes are bounded, and come whole to a task, sorted by Gray rank."""
    shards = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("mask", "pattern", "code", gray_rank(F.col("code")).alias("rank")).repartition(shards, "mask", "pattern")
    dealt = dealt.sortWithinPartitions("mask", "pattern", "rank").select("mask", "pattern", "code")

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            new = (frame["mask"].diff().ne(0) | frame["pattern"].diff().ne(0)).to_numpy()
            last = int(np.flatnonzero(new)[-1]) if len(frame) else 0
            yield _pairs(frame.iloc[:last], new[:last], distance)
            rest = frame.iloc[last:]
        if rest is not None and len(rest):
            new = np.zeros(len(rest), bool)
            new[0] = True
            yield _pairs(rest, new, distance)

    return dealt.mapInPandas(search, "a long, b long")


class _Level:
    """Groups of consecutive children: the bits all members share, their values, and the children's range."""

    def __init__(self, mask: np.ndarray, value: np.ndarray, node: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None):
        self.mask, self.value, self.node, self.first, self.end = mask, value, node, first, end

    def above(self) -> _Level:
        start = np.flatnonzero(np.r_[True, self.node[1:] != self.node[:-1]])
        size = np.diff(np.r_[start, len(self.node)])
        within = np.arange(len(self.node)) - np.repeat(start, size)
        first = np.flatnonzero(within % _FAN == 0)
        end = np.r_[first[1:], len(self.node)]
        ones = np.bitwise_and.reduceat(self.value & self.mask, first)
        zeros = np.bitwise_and.reduceat(~self.value & self.mask, first)
        return _Level(ones | zeros, ones, self.node[first], first, end)


def _pairs(frame: pd.DataFrame, new: np.ndarray, distance: int) -> pd.DataFrame:
    code = frame["code"].to_numpy(np.int64).view(np.uint64)
    if len(code) < 2:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    levels = [_Level(np.full(len(code), ~np.uint64(0)), code, np.cumsum(new))]
    while len(np.unique(levels[-1].node)) < len(levels[-1].node):
        levels.append(levels[-1].above())
    n = len(levels[-1].node)
    out_a, out_b = [], []

    def descend(k: int, i: np.ndarray, j: np.ndarray, differ: np.ndarray, compared: np.ndarray) -> None:
        """Pairs (i, j) of groups at level k; ``differ`` differences found on the bits ``compared``."""
        level = levels[k]
        if k == 0:
            out_a.append(i)
            out_b.append(j)
            return
        below = levels[k - 1]
        for at in range(0, len(i), 8192):
            p, q = i[at:at + 8192], j[at:at + 8192]
            np_, nq = level.end[p] - level.first[p], level.end[q] - level.first[q]
            total = np_ * nq
            pair = np.repeat(np.arange(len(p)), total)
            place = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
            a, b = level.first[p][pair] + place // nq[pair], level.first[q][pair] + place % nq[pair]
            keep = a <= b if k > 1 else a < b
            a, b, pair = a[keep], b[keep], pair[keep]
            common = below.mask[a] & below.mask[b]
            more = np.bitwise_count((below.value[a] ^ below.value[b]) & common & ~compared[at:at + 8192][pair])
            d = differ[at:at + 8192][pair] + more
            near = d <= distance
            descend(k - 1, a[near], b[near], d[near], common[near])

    top = levels[-1]
    if len(levels) > 1:
        descend(len(levels) - 1, np.arange(n), np.arange(n), np.zeros(n, np.int64), top.mask)
    a = code[np.concatenate(out_a)].view(np.int64) if out_a else np.empty(0, np.int64)
    b = code[np.concatenate(out_b)].view(np.int64) if out_b else np.empty(0, np.int64)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 2) -> DataFrame:
    """``id, code, component_id``: the fingerprint of every row as a long, and the smallest id its links reach."""
    prints = materialize(docs.select(F.col(id_col), fingerprint_column(F.col(text_col), shingle).alias("code")), "simhash-prints")
    codes = materialize(prints.groupBy("code").agg(F.min(id_col).alias("smallest")), "simhash-codes")
    roots = components(links(codes.select("code"), distance))
    rooted = codes.join(roots, F.col("code") == F.col("vertex"), "left").select(
        "code", "smallest", F.coalesce("root", "code").alias("root"))
    rooted = materialize(rooted, "simhash-rooted")
    smallest = materialize(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "simhash-smallest")
    named = materialize(rooted.join(smallest, "root").select("code", "component_id", "root"), "simhash-components")
    return prints.join(named, "code").select(id_col, "code", "component_id", "root")


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, that with the smallest id.

    Rows that repeat an id count as one; of rows without id one stays if its group has no id at all.
    """
    groups = near_duplicates(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_col="id", text_col="text", shingle=shingle, distance=distance)
    kept = groups.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(
        F.col("id").alias("kept_id"), F.col("code").alias("kept_code"), F.col("root").alias("kept_root"))
    kept = materialize(kept, "simhash-kept")
    rows, name, restored = sealed(docs)
    own_id, own_text = F.col(name[id_col]), F.col(name[text_col])
    if not is_empty(kept.groupBy("kept_id").agg(F.count("*").alias("n")).filter("n > 1 or kept_id is null")):
        # repeated or missing ids: the row is found by its fingerprint too, and one row of a group is chosen
        coded = rows.withColumn("own_code", fingerprint_column(own_text, shingle))
        found = coded.join(kept.distinct(), own_id.eqNullSafe(F.col("kept_id")) & (F.col("own_code") == F.col("kept_code")))
        first = Window.partitionBy("kept_root").orderBy(own_text)
        return restored(found.withColumn("place", F.row_number().over(first)).filter("place = 1"))
    return restored(rows.join(kept.select("kept_id"), own_id == F.col("kept_id"), "left_semi"))
