"""A corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``, works on all rows its predecessor kept, and is written as Parquet and reread
as the next one's ``docs``. All but the last return the columns of ``docs``.

* ``toxicity`` drops the documents that the classifier rejects (by the threshold of their language). It learns from the whole ``documents`` table's labelled rows, as
  far as they are not held out.
* ``simhash`` keeps the document with the smallest id of each group of near duplicates (3-word shingles, 2 bits).
* ``repeats`` cuts every byte that a ``REPEATED``-byte string or a passage of ``PASSAGE`` words covers which also starts elsewhere in what is left;
  ``n_chars`` follows the text.
* ``decontamination`` drops the documents that contain 0.8 or more of a benchmark item's 5-word shingles, or all words of a shorter item in a row.
* ``tokens`` returns ``doc_id, source, lang, n_tokens, token_ids, ids_sha256, decoded_sha256`` of each kept text; the last is of the text that the ids decode to.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm.bpe import tokenize
from urbanlens.llm.common import materialize
from urbanlens.llm.decontam import remove_contaminated
from urbanlens.llm.repeats import remove_repeats
from urbanlens.llm.simhash import deduplicate
from urbanlens.llm.toxicity import remove_toxic, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: A repeated string goes if it has so many bytes, or so many words (more than fifty), however short they are.
REPEATED, PASSAGE = 256, 51
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_toxic(docs, train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, shingle=3, distance=2)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = remove_repeats(docs, least=REPEATED, words=PASSAGE)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, _table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8, short_runs=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenize(docs, f"{TOKENIZERS}/word_bpe_49k.json", keep=[c for c in ("source", "lang") if c in docs.columns])


STAGES: list[tuple[str, Stage]] = [("toxicity", toxicity), ("simhash", simhash), ("repeats", repeats), ("decontamination", decontamination), ("tokens", tokens)]

#: SQL can't express the classifier, the fingerprints or the merges: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
