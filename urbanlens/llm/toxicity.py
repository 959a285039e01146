"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word is the sum of the embeddings of its hashed features: the word itself and its beginnings of four to seven letters, which
inflected forms share. Filters of widths 1 to 3 over embedded words are max-pooled over segments of ``SEGMENT`` words; a
document's features are the largest and the mean of its segments' responses (how strong, and how often), followed by a logistic layer.
It learns from every labelled row that is not held out, whole texts: rows are dealt into shards by a hash, each shard's task trains a copy of the network in numpy for one
pass, and the copies are averaged on the executors (local gradient descent; the driver gets one network a pass). Features seen in fewer than ``MIN_DOCS`` of all
texts learned from have no embedding, so names and typing errors aren't learned by heart. Words are found, hashed and numbered once, for many
texts at a time; the passes read the numbers, not the texts.

A quarter of these rows (by a hash of the text) sets the scores instead of the network: their raw scores, counted in steps of ``1 / STEPS``, are shifted so that 0.7 is
the threshold of the best F1 over all languages, and each language with enough of them has a threshold of its own. The language chooses the threshold, it never enters a score.

Scoring is one pass over whole texts without a shuffle, with a broadcast model of fixed size (2 MB).

Edge cases: null texts and texts without a word score 0; null labels and ids aren't learned from; of several labels of a document the largest counts; without both
classes among the labelled rows every score is 0; rows with unknown language use the common threshold; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import copy
import functools
import itertools
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import held_out, returning_memory
from urbanlens.llm.conv import Adam, MaxConv, windows

BUCKETS, DIM, FILTERS, WIDTHS, SEGMENT = 1 << 15, 16, 12, (1, 2, 3), 32
BEGINNINGS, MIN_DOCS, DROPPED = (4, 5, 6, 7), 4, 0.15
#: The score from which a document counts as toxic.
THRESHOLD = 0.7
#: Rows of a class that a language needs, in the part kept back, for a threshold of its own.
_ENOUGH = 15
#: Labelled rows of a shard, on average; rows or characters that a task holds at once; passes over the rows, as many for a large table as for a small one.
SHARD, CHUNK, CHUNK_CHARS, PASSES = 4096, 2048, 8 << 20, 6
#: Characters whose words are found at once; bytes from which a word is hashed by itself.
AT_ONCE, LONG = 1 << 20, 64
#: Steps of a raw score when they are counted; parts in which vectors are added; a weight's whole-number unit, so that sums don't depend on their order.
STEPS, PARTS, UNIT = 256, 16, 2.0 ** -24
_WORD = re.compile(r"\w+")


def text_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(word: str) -> tuple[int, ...]:
    """Buckets of the word and of its beginnings, always as many; 0 stands for none."""
    out = [1 + zlib.crc32(b"=" + word.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)]
    for n in BEGINNINGS:
        out.append(1 + zlib.crc32(word[:n].encode("utf-8", "surrogatepass")) % (BUCKETS - 1) if len(word) >= n else 0)
    return tuple(out)


@functools.lru_cache(1)
def _in_words() -> np.ndarray:
    """Whether a code point is part of a word."""
    out = np.zeros(0x110000, bool)
    for m in _WORD.finditer("".join(map(chr, range(0x110000)))):
        out[m.start():m.end()] = True
    return out


@functools.lru_cache(1)
def _crc_steps() -> np.ndarray:
    """What CRC-32 adds for a byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ np.uint32(0xEDB88320), out >> 1)
    return out


def _crc_on(state: np.ndarray, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 states carried on over ``data[at:end]``, byte by byte for all words at once."""
    out, some, steps = state.copy(), np.flatnonzero(at < end), _crc_steps()
    state, at, end = state[some], at[some], end[some]
    while len(some):
        state = steps[(state ^ data[at]) & 255] ^ state >> 8
        at = at + 1
        more = at < end
        out[some[~more]] = state[~more]
        some, state, at, end = some[more], state[more], at[more], end[more]
    return out


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each text; a key of each word; the different keys and their ``features``. Words are those of ``text_words``, found and hashed all at once."""
    texts = [t.lower() for t in texts]
    whole = "\n".join(texts)
    data = whole.encode("utf-8", "surrogatepass")
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.flatnonzero(np.diff(_in_words()[points], prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    sizes = np.diff(np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts])), prepend=0)
    place = np.arange(len(points) + 1)
    if len(data) != len(points):
        np.cumsum(1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF), out=place[1:])
    octets, first = np.frombuffer(data, np.uint8), place[start]
    long = place[end] - first > LONG
    prefix, found, last = np.full(len(start), 0xFFFFFFFF, np.uint32), [], first
    for n in BEGINNINGS:
        have = end - start >= n
        to = np.where(have, place[np.minimum(start + n, end)], last)
        prefix, last = _crc_on(prefix, octets, last, to), to
        found.append(np.where(have, 1 + (prefix ^ 0xFFFFFFFF) % (BUCKETS - 1), 0))
    own = _crc_on(np.full(len(start), zlib.crc32(b"=") ^ 0xFFFFFFFF, np.uint32), octets, first, np.where(long, first, place[end])) ^ 0xFFFFFFFF
    for i in np.flatnonzero(long):
        own[i] = zlib.crc32(b"=" + data[first[i]:place[end[i]]])
    keys = own.astype(np.uint64) << 32 | prefix
    different, at = np.unique(keys, return_index=True)
    return sizes, keys, different, np.stack([1 + own[at] % (BUCKETS - 1), *(f[at] for f in found)], axis=1).astype(np.int64)


def numbered(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers of the words of each text, in the order in which words come up, and the features of each number. Number 0 is the filling."""
    parts, some, chars = [], [], 0
    for t in texts:
        some.append(t)
        chars += len(t)
        if chars >= AT_ONCE:
            parts.append(coded(some))
            some, chars = [], 0
    if some or not parts:
        parts.append(coded(some))
    sizes, keys, different, feats = (np.concatenate(x) for x in zip(*parts, strict=True))
    different, at = np.unique(different, return_index=True)
    place = np.searchsorted(different, keys)
    first = np.full(len(different), len(keys))
    np.minimum.at(first, place, np.arange(len(keys)))
    order = np.argsort(first)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    return np.split(number[place], np.cumsum(sizes)[:-1])[:len(texts)], np.concatenate([np.zeros((1, feats.shape[1]), np.int64), feats[at[order]]])


class ToxicNet:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.03, (BUCKETS, DIM)).astype(np.float32)
        self.conv = MaxConv(DIM, FILTERS, WIDTHS, rng)
        self.out = rng.normal(0, 0.1, 2 * self.conv.size).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self.scale, self.shift, self.thresholds = 1.0, 0.0, {}

    def prepare(self, seen: np.ndarray, total: np.ndarray) -> ToxicNet:
        """``seen``: texts of each class that have a feature, ``total``: all. Features that too few texts have get no embedding; the first coordinate of the others
        starts at their log-odds."""
        odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 0.5) / (total[0] + 1))
        error = np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))  # of few sightings little is believed
        self.embedding[:, 0] = (np.sign(odds) * np.maximum(np.abs(odds) - 2 * error, 0)).clip(-1, 4) / 2
        self.used = seen.sum(axis=0) >= MIN_DOCS
        self.used[0] = False
        self.embedding[~self.used] = 0
        self.conv.w[0][0, 0, 0] = self.conv.w[1][0, 0, 0] = self.conv.w[1][1, 0, 0] = 1.0
        self.out[0] = self.out[self.conv.size] = 1.0
        self.weight = (total.sum() / (2 * np.maximum(total, 1))).astype(np.float32) ** 0.5
        return self

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.out, self.bias, *self.conv.w, *self.conv.b]

    def learn(self, chunks: Iterable[Chunk], rng: np.random.Generator, batch: int = 32, rate: float = 0.003) -> None:
        """One pass over the chunks."""
        adam = Adam(self.parameters, rate, [0.3])
        for docs, feats, y, _ in chunks:
            self._learn_chunk(docs, feats, y, adam, rng, batch)

    def _learn_chunk(self, docs: list[np.ndarray], feats: np.ndarray, y: np.ndarray, adam: Adam, rng: np.random.Generator, batch: int) -> None:
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), batch):
            some = order[at:at + batch]
            # words are left out at random, so that no text is known by one of them
            rows = [windows(docs[i][rng.random(len(docs[i])) > DROPPED] if len(docs[i]) > 8 else docs[i], SEGMENT) for i in some]
            own, ids = np.unique(np.concatenate(rows), return_inverse=True)
            ids = ids.reshape(-1, SEGMENT)
            words = self.embedding[feats[own]].sum(axis=1)
            pooled, places = self.conv.pool_with_places(ids, words)
            starts = np.cumsum([0, *map(len, rows[:-1])])
            size = np.array([len(r) for r in rows])
            x, best = self._document(pooled, starts, size)
            p = 1 / (1 + np.exp(-(x @ self.out + self.bias)))
            g = ((p - y[some]) * self.weight[y[some]] / len(some)).astype(np.float32)
            dx = g[:, None] * self.out
            n = self.conv.size
            d_pooled = np.repeat(dx[:, n:] / size[:, None], size, axis=0)
            np.add.at(d_pooled, (best, np.arange(n)[None, :]), dx[:, :n])
            d_w, d_b, d_words = self.conv.gradients(ids, words, pooled, places, d_pooled)
            d_embedding = np.zeros_like(self.embedding)
            at_once = feats[own][:, :, None] * DIM + np.arange(DIM)  # along one axis numpy adds faster
            np.add.at(d_embedding.reshape(-1), at_once.ravel(), np.broadcast_to(d_words[:, None, :], at_once.shape).ravel())
            d_embedding += 1e-6 * self.embedding
            d_embedding[~self.used] = 0
            adam.step([d_embedding, x.T @ g + 1e-3 * self.out, g.sum(keepdims=True), *d_w, *d_b])

    @staticmethod
    def _document(pooled: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest and mean response of each document's segments, and the segment that has the largest."""
        top = np.maximum.reduceat(pooled, starts)
        mean = np.add.reduceat(pooled, starts) / size[:, None]
        is_top = pooled >= np.repeat(top, size, axis=0)
        first = np.minimum.reduceat(np.where(is_top, np.arange(len(pooled))[:, None], len(pooled)), starts)
        return np.concatenate([top, mean], axis=1).astype(np.float32), first

    def raw(self, docs: list[np.ndarray], tables: list[list[np.ndarray]]) -> np.ndarray:
        rows = [windows(d, SEGMENT) for d in docs]
        ids = np.concatenate(rows)
        pooled = np.concatenate([self.conv.pool(ids[at:at + 512], tables) for at in range(0, len(ids), 512)])
        size = np.array([len(r) for r in rows])
        starts = np.cumsum([0, *size[:-1]])
        top, mean = np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / size[:, None]
        return np.concatenate([top, mean], axis=1) @ self.out + self.bias

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * raw + self.shift).clip(-30, 30)))

    def calibrate(self, found: dict[tuple[str | None, int, int], int]) -> None:
        """``found``: texts by language, class and step of the raw score."""
        langs, y, raw = np.array([k[0] for k in found], object), np.array([k[1] for k in found]), np.array([k[2] for k in found]) / STEPS
        n = np.array(list(found.values()))
        middle, spread = best_threshold(raw, y, n), max(float(np.average((raw - np.average(raw, weights=n)) ** 2, weights=n)) ** 0.5, 1e-6)
        self.scale = min(4.0, max(0.5, 4 / spread))
        self.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - self.scale * middle)
        score = self.scores(raw)
        for lang in sorted({v for v in langs if v is not None}):
            own = langs == lang
            if min(n[own & (y == 1)].sum(), n[own & (y == 0)].sum()) >= _ENOUGH:
                self.thresholds[lang] = float(np.clip(best_threshold(score[own], y[own], n[own]), 0.3, 0.95))


def best_threshold(score: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The cut of the best F1, in the middle of the gap below it; ``n`` texts have each score and class."""
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum((n * y)[order])
    f1 = 2 * hits / (np.cumsum(n[order]) + max(1, hits[-1]))
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


#: Numbers of the words of each text, features of each number, class and language of each text.
Chunk = tuple[list[np.ndarray], np.ndarray, np.ndarray, list]
#: A chunk as it lies on disk: its part and first shard; its numbers in one array, low and high halves apart (the high ones take little room); the words of each text; features, classes, languages.
Packed = tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]
FITTED, KEPT = 0, 1


def packed(rows: Iterable[Row]) -> Iterator[Packed]:
    """The rows of a task by their part, in pieces that fit in memory; neighbours of the same id and text count once."""
    some, chars, last, shard = ([], []), [0, 0], [None, None], [None, None]
    for r in rows:
        k = r.part
        if (r.id, r.text) == last[k]:
            continue
        last[k] = (r.id, r.text)
        if shard[k] is None:
            shard[k] = r.shard
        some[k].append(r)
        chars[k] += len(r.text)
        if len(some[k]) >= CHUNK or chars[k] >= CHUNK_CHARS:
            yield _pack(k, shard[k], some[k])
            some[k].clear()
            chars[k] = 0
    for k in (FITTED, KEPT):
        if some[k]:
            yield _pack(k, shard[k], some[k])


def _pack(part: int, shard: int, rows: list[Row]) -> Packed:
    docs, feats = numbered([r.text for r in rows])
    ids = np.concatenate(docs)
    return part, shard, np.stack([ids & 0xFFFF, ids >> 16]).astype(np.uint16), np.array([len(d) for d in docs]), feats.astype(np.uint16), np.array([r.y for r in rows]), [r.lang for r in rows]


def chunks(found: Iterable[Packed], part: int) -> Iterator[Chunk]:
    """The chunks of one part, taken apart again."""
    for k, _, ids, sizes, feats, y, langs in found:
        if k == part:
            yield np.split(ids[0].astype(np.int64) | ids[1].astype(np.int64) << 16, np.cumsum(sizes)[:-1]), feats.astype(np.int64), y, langs


def _summed(vectors: RDD) -> np.ndarray:
    """The sum of vectors of whole numbers, added in parts on the executors: the driver gets a single vector."""
    parts = vectors.flatMap(lambda v: list(enumerate(np.array_split(v, PARTS)))).reduceByKey(lambda a, b: np.add(a, b, dtype=np.int64), PARTS).collectAsMap()
    return np.concatenate([parts[i] for i in range(PARTS)])


def _seen(rows: RDD) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class that have a feature, and texts of each class."""
    def count(part: Iterator[Packed]) -> Iterator[np.ndarray]:
        seen, total = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for docs, feats, y, _ in chunks(part, FITTED):
            total += np.bincount(y, minlength=2)
            for ids, label in zip(docs, y, strict=True):
                seen[label, np.unique(feats[np.unique(ids)])] += 1
        yield np.concatenate([total, seen.ravel()])

    out = _summed(rows.mapPartitions(returning_memory(count)))
    return out[2:].reshape(2, BUCKETS), out[:2]


def _pass(rows: RDD, net: ToxicNet, number: int) -> ToxicNet:
    """The mean of the networks that the shards made of ``net`` in one pass."""
    shared = rows.context.broadcast(net)

    def fit(part: Iterator[Packed]) -> Iterator[np.ndarray]:
        part = (p for p in part if p[0] == FITTED)
        first = next(part, None)
        if first is not None:
            own = copy.deepcopy(shared.value)  # the worker keeps the shared one for other tasks
            own.learn(chunks(itertools.chain([first], part), FITTED), np.random.default_rng([number, first[1]]))
            yield np.concatenate([np.ones(1, np.int32), *(np.rint(p.ravel() / UNIT).astype(np.int32) for p in own.parameters)])

    out = _summed(rows.mapPartitions(returning_memory(fit)))
    shared.unpersist()
    mean, at = copy.deepcopy(net), 1
    for p in mean.parameters:
        p[...] = (out[at:at + p.size] / out[0] * UNIT).reshape(p.shape)
        at += p.size
    return mean


def _raw_scores(rows: RDD, net: ToxicNet, of: int) -> dict[tuple[str | None, int, int], int]:
    """Texts of a part by language, class and step of the raw score."""
    shared = rows.context.broadcast(net)

    def count(part: Iterator[Packed]) -> Iterator[tuple]:
        found = Counter()
        for docs, feats, y, langs in chunks(part, of):
            tables = shared.value.conv.tables(shared.value.embedding[feats].sum(axis=1))
            raw = np.concatenate([shared.value.raw([d], tables) for d in docs])
            found.update(zip(langs, y.tolist(), np.rint(raw.clip(-32, 32) * STEPS).astype(int).tolist(), strict=True))
        yield from found.items()

    out = dict(sorted(rows.mapPartitions(returning_memory(count)).reduceByKey(operator.add, PARTS).collect(), key=str))
    shared.unpersist()
    return out


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> ToxicNet | None:
    """A network from all labelled rows that are not held out; None without both classes."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.cast("string").alias("lang")).filter(F.length("text") > 0).filter(~held_out(F.col("id")))
    # copies of a text are all kept back or none, so that the part kept back is new to the network; the order within shards is by hash
    shards = -(-sum(counts.values()) // SHARD)
    # texts meet their labels in the partition that is their shard, so they are shuffled once; within it the order is by hash
    met = rows.withColumn("y", F.lit(None).cast("int")).unionByName(known, allowMissingColumns=True).repartition(shards, "id")
    learned = met.withColumn("y", F.max("y").over(Window.partitionBy("id"))).filter("text is not null and y is not null")
    # copies of a text are all kept back or none, so that the part kept back is new to the network
    learned = learned.withColumns({"shard": F.pmod(F.hash("id"), F.lit(shards)), "kept": F.crc32("text") % 4 == 0, "h": F.xxhash64("id", "text")})
    learned = learned.sortWithinPartitions("h", "id", F.col("lang").asc_nulls_last())

    def dealt(part: Column) -> RDD:
        """The chunks: words are looked for and hashed once, every pass reads their numbers."""
        rows = learned.withColumn("part", part.cast("int")).drop("kept", "h").rdd
        # no more networks a pass than shards
        rows = rows if rows.getNumPartitions() <= shards else rows.coalesce(shards)
        return rows.mapPartitions(returning_memory(packed)).persist(StorageLevel.DISK_ONLY)

    found, kept = dealt(F.col("kept")), KEPT
    try:
        classes = set(found.flatMap(lambda p: {(p[0], y) for y in p[5].tolist()}).distinct(PARTS).collect())
        if len({y for _, y in classes}) < 2:
            return None
        if len(classes) < 4:  # a part without a class: all rows do both
            found.unpersist()
            found, kept = dealt(F.lit(FITTED)), FITTED
        net = ToxicNet().prepare(*_seen(found))
        for number in range(PASSES):
            net = _pass(found, net, number)
        net.calibrate(_raw_scores(found, net, kept))
        return net
    finally:
        found.unpersist()


def score(docs: DataFrame, net: ToxicNet | None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, held_out, score, predicted, threshold, rejected`` (and the columns ``keep``) for every row, from the whole text alone."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scored(texts: list) -> np.ndarray:
        net, out = shared.value, np.zeros(len(texts))
        docs, feats = numbered([t or "" for t in texts])
        some = [i for i, d in enumerate(docs) if len(d)]
        if some:
            out[some] = net.scores(net.raw([docs[i] for i in some], net.conv.tables(net.embedding[feats].sum(axis=1))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 100):
                batch = whole.slice(first, 100)
                s = scored(batch["_text"].to_pylist()) if shared.value else np.zeros(batch.num_rows)
                columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "_text"]
                names = [n for n in batch.schema.names if n != "_text"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(s, pa.float64())], names=[*names, "score"])

    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None)
    rows = docs.select(F.col(id_col), *(F.col(c) for c in keep), lang.cast("string").alias("_lang"), F.col(text_col).cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("score", "double")
    out = rows.mapInArrow(returning_memory(run), schema)
    own = net.thresholds if net else {}
    limit = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for kv in own.items() for v in kv)), F.col("_lang")), F.lit(THRESHOLD)) if own else F.lit(THRESHOLD)
    return out.select(F.col(id_col), *keep, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      limit.alias("threshold"), (F.col("score") >= limit).alias("rejected"))


def remove_toxic(docs: DataFrame, net: ToxicNet | None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` below their language's threshold."""
    own = [f"_own_{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    named = docs.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own, strict=True)))
    named = named.withColumns({"_id": F.col(own[docs.columns.index(id_col)]), "_body": F.col(own[docs.columns.index(text_col)]),
                               "_language": F.col(own[docs.columns.index(lang_col)]) if lang_col in docs.columns else F.lit(None).cast("string")})
    out = score(named, net, id_col="_id", text_col="_body", lang_col="_language", keep=tuple(own))
    return out.filter(~F.col("rejected")).select(*(F.col(o).alias(c) for o, c in zip(own, docs.columns, strict=True)))
