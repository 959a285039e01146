"""Language identification with a byte convolutional network.

Every text, in lower case and UTF-8, is cut into fixed-length windows of bytes; filters of several widths over embedded bytes are max-pooled over
a window and a softmax layer gives its languages; the text's answer is the mean over all of its windows, by their bytes. Trained in numpy on a
bounded sample of labelled rows: at most about ``docs_per_language`` rows of each of the ``languages_learned`` commonest languages and ``docs_in_all`` of all
together (by a hash of the id, the same rows on every run), none of more than ``longest`` characters, at most ``windows_per_doc`` windows of each. Scoring is one pass without a shuffle; the model is a broadcast of fixed size (under 10 MB).

Edge cases: null texts and texts without a letter are ``und`` with score 0; a table with no labelled row answers ``und`` for all; rows with null
language or null id are never learned from; repeated rows get the same answer; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import held_out, returning_memory
from urbanlens.llm.conv import Adam, MaxConv, softmax, windows

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 4, 6), 16, 8


def text_ids(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)


class ByteNet:
    def __init__(self, languages: list[str], seed: int = 0):
        self.languages, rng = languages, np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.embedding[0] = 0
        self.conv = MaxConv(DIM, FILTERS, WIDTHS, rng)
        self.out = rng.normal(0, 0.1, (self.conv.size, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.004, seed: int = 1) -> ByteNet:
        """``x``: windows of bytes; ``y``: numbers of languages. Rare languages weigh as much as common ones."""
        rng = np.random.default_rng(seed)
        weight = (len(y) / np.maximum(np.bincount(y, minlength=len(self.languages)), 1) / len(self.languages)).astype(np.float32)
        parameters = [self.embedding, self.out, self.bias, *self.conv.w, *self.conv.b]
        adam = Adam(parameters, rate)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                some = order[at:at + batch]
                ids = x[some].astype(np.intp)
                pooled, places = self.conv.pool_with_places(ids, self.embedding)
                p = softmax(pooled @ self.out + self.bias)
                p[np.arange(len(some)), y[some]] -= 1
                g = p * (weight[y[some]] / len(some))[:, None]
                d_w, d_b, d_embedding = self.conv.gradients(ids, self.embedding, pooled, places, g @ self.out.T)
                d_embedding[0] = 0
                adam.step([d_embedding, pooled.T @ g + 1e-4 * self.out, g.sum(axis=0), *d_w, *d_b])
        return self

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Tables for pairs of neighbouring bytes: half as many look-ups."""
        out = []
        for parts in self.conv.tables(self.embedding):
            out.append([(parts[j][:, None, :] + parts[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, len(parts), 2)])
        return out

    def logits(self, x: np.ndarray, tables: list[list[np.ndarray]], batch: int = 128) -> np.ndarray:
        out = []
        for at in range(0, len(x), batch):
            part = x[at:at + batch].astype(np.intp)
            out.append(self.conv.pool((part[:, :-1] << 8) | part[:, 1:], tables, step=2) @ self.out + self.bias)
        return np.concatenate(out)


def sample_windows(texts: list[str], labels: list[int], per_doc: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows at random places of the texts, every third one cut short as short texts are."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    for text, label in zip(texts, labels, strict=True):
        ids = text_ids(text)
        for k in range(min(per_doc, 1 + len(ids) // WINDOW)):
            n = int(rng.integers(12, WINDOW)) if k % 3 == 1 or rng.random() < 0.2 else WINDOW
            at = int(rng.integers(0, max(1, len(ids) - n + 1)))
            x.append(windows(ids[at:at + n], WINDOW)[0])
            y.append(label)
    return np.array(x, np.uint8).reshape(-1, WINDOW), np.array(y, np.int64)


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = 1200,
          docs_in_all: int = 40_000, languages_learned: int = 200, longest: int = 200_000, windows_per_doc: int = 6) -> ByteNet | None:
    """A network from the rows that are not held out; None if no row has a language. The bounds are those of the sample of labelled rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        ~held_out(F.col("id")) & F.col("lang").isNotNull() & (F.length("text").between(1, longest)))
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages_learned)
    counts = {r.lang: r.n for r in common.collect()}  # a row for each language learned
    if not counts:
        return None
    languages = sorted(counts)
    each = min(docs_per_language, docs_in_all // len(languages))
    share = F.create_map(*(F.lit(v) for lang in languages for v in (lang, int(1e6 * min(1.0, each / counts[lang])))))
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang"))).select("id", "lang", "text").toPandas()
    sample = sample.sort_values(["id", "text"]).drop_duplicates()
    number = {lang: i for i, lang in enumerate(languages)}
    x, y = sample_windows(sample["text"].tolist(), [number[v] for v in sample["lang"]], windows_per_doc)
    return ByteNet(languages).fit(x, y) if len(x) else None


def identify(docs: DataFrame, net: ByteNet | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, lang_pred, score`` for every row, from the whole text alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    import pyarrow as pa
    schema = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, tables = shared.value, None
        for whole in batches:
            for first in range(0, whole.num_rows, 200):
                batch = whole.slice(first, 200)
                pred, score = ["und"] * batch.num_rows, [0.0] * batch.num_rows
                chosen, parts, bytes_of = [], [], []
                for i, t in enumerate(batch["text"].to_pylist() if net else ()):
                    if t and any(map(str.isalpha, t)):
                        ids = text_ids(t)
                        chosen.append(i)
                        parts.append(windows(ids, WINDOW))
                        n = np.full(len(parts[-1]), WINDOW)
                        n[-1] = len(ids) - WINDOW * (len(n) - 1)
                        bytes_of.append(n)
                if chosen:
                    tables = tables or net.pair_tables()
                    starts = np.cumsum([0, *map(len, parts[:-1])])
                    weight = np.concatenate(bytes_of).astype(np.float32)[:, None]
                    logits = np.add.reduceat(net.logits(np.concatenate(parts), tables) * weight, starts) / np.add.reduceat(weight, starts)
                    p = softmax(logits)
                    for i, k, s in zip(chosen, p.argmax(axis=1), p.max(axis=1), strict=True):
                        pred[i], score[i] = net.languages[k], float(s)
                yield pa.RecordBatch.from_arrays([batch["id"].cast(pa.int64()), batch["held_out"], pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema=schema)

    return rows.mapInArrow(returning_memory(run), "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
