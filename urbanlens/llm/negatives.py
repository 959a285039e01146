"""Hard negatives for contrastive training by a secondary-sort shuffle.

Every anchor has positives (its ``positives`` best rows of the same label) and, for each of them, hard negatives: the ``negatives`` best
rows of another label whose score lies between two shares of the positive's score. Scores are inner products of quantised vectors.

The pairs that can matter are packed into keys ``(anchor, descending score, side, id)``; one shuffle by anchor sorts them within each
partition (``repartition`` and ``sortWithinPartitions``, the DataFrame form of ``repartitionAndSortWithinPartitions``), and a streaming iterator reads
them in that order: a positive opens a window, a negative that fits is given to the open windows, a window closes when it is full or
below its range. The iterator holds the few open windows of one anchor, never the anchor's pairs. Of equal scores a
positive comes first, so that a window of score zero is open when its negatives arrive.

Pairs are scored in blocks, anchors (a stated query set) against all rows: rows are dealt by a hash of their id into blocks of at most about
``_BLOCK`` rows, one partition each, and the anchors pass every block in small batches. Before anything is shuffled a
block keeps, for each anchor, its own best ``positives`` (first pass), then for each window its own best ``negatives`` (second pass; the windows are
known by then). What a block drops is beaten by enough rows of the same block, so nothing of the result is lost, however many rows share a label,
a score or a vector. Blocks are sets of ids: a hot label or vector is spread over all of them.

Edge cases: rows with a null id, label or vector, or a null or non-finite component take no part, nor do rows with a component of 2^25 or more
once quantised (a score must fit a long); shorter vectors are filled with zeros; of rows that repeat an id the one with the smallest
(label, vector) counts; ties of score go to the smaller id; anchors without positives and positives whose score is negative give no row; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import discard, is_empty, materialize, returning_memory

#: Rows of a block, and scores that a task holds at once.
_BLOCK, _SCORES = 1 << 15, 1 << 21
#: Components from here on (quantised) are out of range.
_LIMIT = 1 << 25
_NONE = np.iinfo(np.int64).max


def quantised(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component as ``array<int>``; null if a component is null, not finite or out of range."""
    wide = F.transform(vector, lambda x: x.cast("double") * scale)
    bad = F.exists(wide, lambda x: x.isNull() | ~(F.abs(F.coalesce(x, F.lit(0.0))) < _LIMIT))  # NaN is above all
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x).cast("int")))


def best(scores: np.ndarray, wanted: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """``(row, column, score)`` of the ``k`` best wanted entries of each row; of equal scores the leftmost."""
    n = scores.shape[1]
    if int(np.abs(scores).max(initial=0)) < (1 << 61) // n:
        key = np.where(wanted, np.arange(n) - scores * n, _NONE)
        if n > k:
            key = np.partition(key, k - 1, axis=1)[:, :k]
        row, place = np.nonzero(key != _NONE)
        column = key[row, place] % n
        yield from zip(row.tolist(), column.tolist(), scores[row, column].tolist(), strict=True)
        return
    for row in range(len(scores)):  # scores too large to share an integer with a place
        column = np.flatnonzero(wanted[row])
        for c in column[np.argsort(-scores[row, column], kind="stable")[:k]].tolist():
            yield row, c, int(scores[row, c])


def _matrix(vectors: list, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every sum is an integer that they hold."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(d, 1) < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _scored(rows: DataFrame, anchors: DataFrame, blocks: int, pick: Callable) -> DataFrame:
    """``anchor_id, score, id`` of the pairs that ``pick(scores, same, windows)`` wants of each block. ``anchors`` have a column ``windows``."""
    import pyarrow as pa
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    sides = rows.select(block.alias("block"), F.lit(0).alias("side"), "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("windows")).unionByName(
        anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), "id", "label", "vector", "windows"))
    dealt = sides.repartitionById(blocks, F.col("block")).sortWithinPartitions("side", "id")
    schema = pa.schema([("anchor_id", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], None
        for batch in batches:
            own = np.asarray(batch["side"]) == 0
            vector = batch["vector"].to_numpy(zero_copy_only=False)
            if own.any():
                ids.extend(np.asarray(batch["id"])[own].tolist())
                labels.extend(np.asarray(batch["label"])[own].tolist())
                vectors.extend(vector[own])
            at = np.flatnonzero(~own)
            if not len(at) or not ids:
                continue
            if held is None:
                held = np.array(ids, np.int64), np.array(labels, np.int64), _matrix(vectors, max(map(len, vectors)))
                vectors.clear()
            anchor_id, label = np.asarray(batch["id"])[at], np.asarray(batch["label"])[at]
            windows = batch["windows"].take(pa.array(at)).to_pylist()
            step = max(1, _SCORES // len(ids))
            for first in range(0, len(at), step):
                some = slice(first, first + step)
                m = _matrix(list(vector[at[some]]), max([1, *(len(v) for v in vector[at[some]])]))
                scores = _products(m, held[2])
                same = label[some, None] == held[1][None, :]
                other = anchor_id[some, None] != held[0][None, :]
                found = sorted(set(pick(scores, same & other, ~same & other, windows[some])))
                if found:
                    row, column, score = map(np.array, zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(anchor_id[some][row]), pa.array(score.astype(np.int64)), pa.array(held[0][column])], schema=schema)

    return dealt.mapInArrow(returning_memory(run), "anchor_id long, score long, id long")


def _in_order(pairs: DataFrame, read: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``read`` over ``(anchor, score, positive, id)`` in the order of the packed keys, an anchor's rows one after the other in one task."""
    import pyarrow as pa
    shards = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("anchor_id", (-F.col("score")).alias("down"), (~F.col("positive")).alias("side"), "id")
    dealt = pairs.select(key.alias("key")).repartition(shards, "key.anchor_id").sortWithinPartitions("key").select("key.*")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32() if f.endswith(" int") else pa.int64() for f in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for anchor, down, side, other in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield anchor, -down, not side, other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in read(rows(batches)):
            held.append(row)
            if len(held) >= 1 << 13:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    return dealt.mapInArrow(run, schema)


def mine(rows: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; negatives score from ``low`` to ``high`` per cent of the positive.

    ``is_anchor``: a condition on the columns of ``rows``.
    """
    table = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), quantised(F.col(vector_col), scale).alias("vector"),
                        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).dropna()
    table = materialize(table, "negatives-rows")
    if not is_empty(table.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")):
        single = table.groupBy("id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("r")).select("id", "r.*")
        several, table = table, materialize(single, "negatives-rows")
        discard(several)
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(shards, -(-table.count() // _BLOCK))
    anchors = table.filter("is_anchor").drop("is_anchor")

    def same_label(scores, same, other, windows):
        return best(scores, same, positives)

    def first_of_anchor(pairs):
        anchor, n = None, 0
        for a, score, _, other in pairs:
            anchor, n = a, n + 1 if a == anchor else 1
            if n <= positives:
                yield a, score, other

    pairs = _scored(table, anchors.withColumn("windows", F.lit(None).cast("array<bigint>")), blocks, same_label)
    opened = materialize(_in_order(pairs.withColumn("positive", F.lit(True)), first_of_anchor, "anchor_id long, score long, id long"), "negatives-positives")

    def in_windows(scores, same, other, windows):
        for j in range(max(map(len, windows))):
            p = np.array([w[j] if j < len(w) else -1 for w in windows], np.int64)[:, None]
            yield from best(scores, other & (p >= 0) & (100 * scores <= high * p) & (100 * scores >= low * p), negatives)

    def windows_of_anchor(pairs):
        anchor, opened = None, []
        for a, score, positive, other in pairs:
            if a != anchor:
                anchor, opened = a, []
            if positive:
                opened.append([other, score, 0])
                continue
            still = []
            for w in opened:
                if low * w[1] <= 100 * score <= high * w[1]:
                    w[2] += 1
                    yield a, w[0], w[2], other, w[1], score
                if w[2] < negatives and 100 * score >= low * w[1]:
                    still.append(w)
            opened = still

    windows = opened.groupBy("anchor_id").agg(F.sort_array(F.collect_set("score")).alias("windows"))  # at most ``positives`` scores
    wanted = anchors.join(windows.withColumnRenamed("anchor_id", "id"), "id")
    pairs = _scored(table, wanted, blocks, in_windows).withColumn("positive", F.lit(False)).unionByName(opened.withColumn("positive", F.lit(True)))
    pairs = materialize(pairs, "negatives-pairs")
    discard(table)
    discard(opened)
    return _in_order(pairs, windows_of_anchor, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
