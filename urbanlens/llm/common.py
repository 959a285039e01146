"""Helpers shared by the operators of this package: tables in the shared folder, hashes, train/held-out split."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.session import checkpoint_subdir
from urbanlens.sources.scratch import forget, stored

#: A side is broadcast only when its proven size is at most this many bytes.
BROADCAST_BYTES = 8 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that ``spark.checkpoint.dir`` names."""
    return checkpoint_subdir(spark, f"llm/{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost executor costs only its running tasks;
    the scan that follows has exact sizes, and a join of two such scans is one that AQE can split when a key is hot. All
    tables of an application are in one folder, which ``urbanlens.sources.scratch.clear`` deletes when results have been written.
    """
    return stored(df, name)


def discard(df: DataFrame | None) -> None:
    """Delete a table made by :func:`materialize` once nothing will read it again."""
    if hasattr(df, "_scratch_path"):
        forget(df)


def sealed(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns named by number, the new name of each, and what gives them back: no column of a caller's clashes with one of ours."""
    own = [f"_own_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*own), dict(zip(docs.columns, own, strict=True)), lambda df: df.select(*own).toDF(*docs.columns)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def held_out(doc_id: Column) -> Column:
    """True for the rows no model may learn from: crc32 of the id's text, modulo 3, is 1 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def returning_memory(run):
    """A ``mapInArrow``/``mapInPandas`` function that, when its task ends, hands freed memory back to the system.

    Python workers are used again by later tasks and stages, and an allocator keeps what a task's arrays took.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc
            gc.collect()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return wrapped


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside a lambda an expression would be computed for every element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Lower-case words of a text, split at white space; an empty array for a null or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{3000}]+"), lambda w: w != "")


def shingle_hashes(word_array: Column, n: int) -> Column:
    """A 64-bit hash of every run of ``n`` words, in order, repeats included; a shorter sequence is one run, none has none."""
    # a hash passes over nulls: what would reach beyond the end is not there
    runs = let(F.transform(word_array, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - n, F.lit(0))), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(n)))))
    return F.when(F.size(word_array) > 0, runs).otherwise(F.array().cast("array<bigint>"))
