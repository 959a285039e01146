"""Threshold-scaled document sketches, DataFrame functions only.

A sketch keeps every distinct shingle hash below a fixed fraction, one in ``SCALE``, of the hash range, the same for all texts, and at least the ``FLOOR``
smallest (all, if there are fewer). Whether a hash is below the fraction depends on the hash alone, so sketches of parts merge by union, equal texts have
equal sketches, and ``|A & B| / |A|`` estimates what part of A is in B even when B is thousands of times longer. The floor is part of the
definition and keeps short texts comparable; it merges too, as the smallest hashes of a union are among the smallest of its parts. A
sketch says below which ``limit`` it has all of the text's hashes: the fraction's, or that of its largest kept hash, or the whole range. Two sketches
are compared below the smaller limit, from what they hold and nothing else.

``neighbours`` puts every document beside the next one by ascending id without a global window: ids (not texts) are range-sorted,
each range finds its successors, and the ranges' first ids, one row per partition, close the gaps. A text is cut into shingles once, where it is
read; its predecessor is sent the sketch, and of the text the start that an edit of the predecessor's length takes.

Edge cases: null and blank texts have the empty sketch (likeness 1 to another empty one, 0 to any other); where A keeps no hash below the common limit, the
likeness is 0; texts of fewer words than a shingle are one shingle; rows that repeat an id follow one another's successor, and of them the
smallest text is the one that precedes; a null id sorts first; a single document is its own successor; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import is_empty, let, materialize, shingle_hashes, words

#: One hash in ``SCALE`` is kept, and the ``FLOOR`` smallest in any case.
SCALE, FLOOR = 32, 64
_RANGE = 1 << 62
_LIMIT = _RANGE // SCALE
_EMPTY = "array<bigint>"


def _limited(smallest: Column, below: Column) -> Column:
    """The sketch, given the ``FLOOR + 1`` smallest distinct hashes and all distinct ones below the fraction, both ascending."""
    few = F.struct(F.when(F.size(smallest) > FLOOR, F.element_at(smallest, FLOOR) + 1).otherwise(F.lit(_RANGE)).alias("limit"), F.slice(smallest, 1, FLOOR).alias("hashes"))
    return F.when(F.size(below) >= FLOOR, F.struct(F.lit(_LIMIT).alias("limit"), below.alias("hashes"))).otherwise(few)


def _sketch_of(hashes: Column) -> Column:
    def of(h: Column) -> Column:
        below = F.array_sort(F.array_distinct(F.filter(h, lambda x: x < _LIMIT)))
        return let(below, lambda b: F.when(F.size(b) >= FLOOR, F.struct(F.lit(_LIMIT).alias("limit"), b.alias("hashes"))).otherwise(
            let(F.slice(F.array_sort(F.array_distinct(h)), 1, FLOOR + 1), lambda s: _limited(s, F.slice(b, 1, 0)))))
    return let(hashes, of)


def sketch(text: Column, n: int = 5) -> Column:
    """``struct<limit bigint, hashes array<bigint>>``, hashes distinct and ascending, from shingles of ``n`` words."""
    return let(words(text), lambda w: _sketch_of(F.transform(shingle_hashes(w, n), lambda h: F.shiftrightunsigned(h, 2))))


def sketch_text(s: Column) -> Column:
    """The sketch as a string: limit and hashes."""
    return F.concat(s["limit"].cast("string"), F.lit(":"), F.array_join(s["hashes"].cast("array<string>"), ","))


def _compare(a: Column, b: Column, ratio) -> Column:
    both = let(F.least(a["limit"], b["limit"]), lambda m: F.struct(F.filter(a["hashes"], lambda h: h < m).alias("x"), F.filter(b["hashes"], lambda h: h < m).alias("y")))
    return let(both, lambda p: let(F.size(F.array_intersect(p["x"], p["y"])).cast("double"), lambda n: ratio(n, F.size(p["x"]), F.size(p["y"]))))


def _blank(s: Column) -> Column:
    return F.size(s["hashes"]) == 0


def containment(a: Column, b: Column) -> Column:
    """Estimate, from 0 to 1, of the part of A's shingles that B has."""
    return _compare(a, b, lambda n, x, y: F.when(x > 0, n / x).otherwise((_blank(a) & _blank(b)).cast("double")))


def similarity(a: Column, b: Column) -> Column:
    """Estimate, from 0 to 1, of the Jaccard similarity of A's and B's shingles."""
    return _compare(a, b, lambda n, x, y: F.when(x + y > 0, n / (x + y - n)).otherwise((_blank(a) & _blank(b)).cast("double")))


def merge_sketches(parts: DataFrame, key: str, sketch_col: str = "sketch") -> DataFrame:
    """The sketch of the union of each key's parts.

    Only the hashes below the least limit count, each once; those below the fraction stay, and the smallest if these are too few.
    """
    limits = parts.groupBy(key).agg(F.min(f"{sketch_col}.limit").alias("least"))
    hashes = parts.select(key, F.explode(f"{sketch_col}.hashes").alias("hash")).distinct()
    hashes = hashes.join(limits, key).filter("hash < least")
    place = F.row_number().over(Window.partitionBy(key).orderBy("hash"))
    lists = hashes.withColumn("place", place).filter((F.col("hash") < _LIMIT) | (F.col("place") <= FLOOR + 1)).groupBy(key).agg(
        F.array_sort(F.collect_list("hash")).alias("kept"))
    rows = limits.join(lists, key, "left").withColumn("kept", F.coalesce("kept", F.array().cast(_EMPTY)))
    merged = _limited(F.slice("kept", 1, FLOOR + 1), F.filter("kept", lambda h: h < _LIMIT))
    return rows.select(key, F.struct(F.least(merged["limit"], F.col("least")).alias("limit"), merged["hashes"].alias("hashes")).alias(sketch_col))


def successors(ids: DataFrame, id_col: str) -> DataFrame:
    """``id, next_id`` for every distinct id of ``ids``; the last one's successor is the first (null sorts first)."""
    shards = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.select(F.col(id_col).alias("id")).distinct().repartitionByRange(shards, F.col("id").asc_nulls_first())
    ranged = materialize(ranged.withColumn("range", F.spark_partition_id()), "sketch-ranges")
    firsts = ranged.groupBy("range").agg(F.min_by(F.struct("id"), F.struct(F.col("id").isNotNull(), "id")).alias("first"))
    firsts = materialize(firsts, "sketch-firsts")  # one row for each partition
    order = Window.orderBy("range")
    after = firsts.select("range", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("beyond"))
    inner = F.lead(F.struct("id")).over(Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first()))
    return ranged.withColumn("inner", inner).join(F.broadcast(after), "range").select("id", F.coalesce("inner", "beyond")["id"].alias("next_id"))


def neighbours(rows: DataFrame) -> DataFrame:
    """``id, n_chars, text, sketch, next_start, next_sketch, next_n_chars`` for every row of ``id, text, n_chars, sketch``.

    One shuffle brings each text to its id's place in the chain; the second sends the predecessor no more than it needs: the
    sketch, and as much of the text as half of the predecessor's length.
    """
    chain = materialize(successors(rows, "id"), "sketch-chain")
    sizes = rows.groupBy("id").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("n"))
    sizes = materialize(sizes, "sketch-sizes")
    places = chain.withColumnRenamed("next_id", "own").join(sizes.withColumnsRenamed({"id": "p_id"}), F.col("id").eqNullSafe(F.col("p_id")))
    places = materialize(places.select(F.col("own"), F.col("id").alias("prev_id"), F.floor(F.col("n_chars") / 2).cast("int").alias("half")), "sketch-places")
    based = rows.join(places.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("own")))
    ahead = based.select("prev_id", F.substring("text", F.lit(1), F.col("half")).alias("next_start"), F.col("sketch").alias("next_sketch"),
                         F.col("n_chars").alias("next_n_chars"))  # the same columns on both sides: one shuffle of the texts serves both
    if not is_empty(sizes.filter("n > 1")):  # of rows that repeat an id the smallest text precedes
        ahead = based.groupBy("id").agg(F.min(F.struct("text", "prev_id", "half", "sketch", "n_chars")).alias("r")).select(
            F.col("r.prev_id").alias("prev_id"), F.expr("substring(r.text, 1, r.half)").alias("next_start"), F.col("r.sketch").alias("next_sketch"),
            F.col("r.n_chars").alias("next_n_chars"))
    return based.select("id", "n_chars", "text", "sketch").join(ahead.hint("merge"), F.col("id").eqNullSafe(F.col("prev_id"))).drop("prev_id")


def compare_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """Every document's sketch beside those of its edited text (its second half replaced by the next document's start) and of the next document.

    ``near_edited`` and ``near_next`` estimate what part of the document's shingles the edited text and the next one have.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", "text", F.length("text").cast("long").alias("n_chars"), sketch(F.col("text"), shingle).alias("sketch"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = neighbours(rows)
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_start", F.lit(1), half))
    pairs = pairs.select(F.col("id").alias(id_col), "n_chars", "next_n_chars", edited.alias("edited"), F.col("sketch").alias("s"), F.col("next_sketch").alias("x"))
    pairs = pairs.select(id_col, "n_chars", "next_n_chars", F.sha2("edited", 256).alias("edited_sha256"), "s", "x", F.explode(F.array(sketch(F.col("edited"), shingle))).alias("e"))
    a, e, x = F.col("s"), F.col("e"), F.col("x")
    return pairs.select(id_col, "n_chars", "next_n_chars", "edited_sha256", sketch_text(a).alias("fingerprint"), sketch_text(e).alias("edited_fingerprint"),
                        containment(a, e).alias("near_edited"), containment(a, x).alias("near_next"),
                        similarity(a, e).alias("jaccard_edited"), similarity(a, x).alias("jaccard_next"))
