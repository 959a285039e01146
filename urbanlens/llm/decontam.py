"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame functions only.

Which short test items are inside which documents, at a containment of ``threshold`` or more of the item's distinct word shingles?
A document has hundreds of times an item's shingles, so signatures of documents would meet those of items by chance only;
here the *items* are sketched and whole documents are looked up:

* Items are partitioned by size, in powers of two. An item of q shingles may miss ``m = q - ceil(threshold * q)`` of them. The sketch of a partition
  holds the ``2 m + 1`` smallest hashes of an item, m taken at the partition's upper size (hashes that fewer items share go first, so a
  phrase common to all items picks no document). Any document that contains the item has all but m of the item's sketch: more than half of it.
  So the containment estimated on the sketch never loses a document, and few others pass it.
* Documents too small for an item never meet it.
* A document that holds ``least`` of a sketch holds one of all but ``least - 1`` of its hashes: only by those that fewest items share are documents and
  items brought together, so that a phrase common to many items doesn't join all of them with all documents that have it.
* What passes is verified by counting all of the item's shingles that the document has.

Scale: one pass over all texts, no shuffle of texts: their shingle hashes meet the leading sketch hashes in a broadcast join when the counted items
prove it small, in a shuffled one otherwise; only the documents that share one are read and cut up a second time, for all of the items' shingles. Documents that
hold the same passage by the thousand give rows in proportion to what they contain.

Words are runs of letters, marks and digits in lower case, so that punctuation doesn't hide a passage.

Edge cases: null and blank texts and items contain nothing and are contained in nothing; a text of fewer words than a shingle is one
shingle, which only a text of just these words has unless ``short_runs`` is set, as the query and the pipeline do: then documents are also cut into runs of each number of words below a
shingle's that some item has, and a short item is found wherever its words stand in a row; equal items are found each; rows that repeat id and text give one row per item; rows without id are told
apart by their text; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import BROADCAST_BYTES, let, materialize, sealed, shingle_hashes


def plain_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def distinct_shingles(text: Column, n: int, shorter: list[int] = ()) -> Column:
    """Hashes of the runs of ``n`` words, and of those of each number of words in ``shorter``."""
    return let(plain_words(text), lambda w: F.array_distinct(F.concat(shingle_hashes(w, n), *(
        F.when(F.size(w) > k, shingle_hashes(w, k)).otherwise(F.array().cast("array<bigint>")) for k in shorter))))


def short_lengths(items: DataFrame, *, text_col: str, shingle: int) -> list[int]:
    """The numbers of words below a shingle's that items have: ``shingle - 1`` numbers at most."""
    n = items.select(F.size(plain_words(F.col(text_col))).alias("n"))
    return sorted(r.n for r in n.filter((F.col("n") > 0) & (F.col("n") < shingle)).distinct().collect())


def item_shingles(items: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``item_id, hash, q``: an item's distinct shingles and their number."""
    rows = items.select(F.col(id_col).alias("item_id"), distinct_shingles(F.col(text_col), shingle).alias("hashes"))
    return rows.filter("item_id is not null").select("item_id", F.explode("hashes").alias("hash"), F.size("hashes").alias("q"))


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """``item_id, hash, least, lead``: each item's sketch, how many of it a document that contains the item has at least, and which it has one of at least."""
    need = lambda q: F.ceil(q * F.lit(threshold) - 1e-9)
    upper = F.pow(F.lit(2), F.floor(F.log2("q")) + 1) - 1  # of the item's size partition
    width = (upper - need(upper)) * 2 + 1
    shared = shingles.groupBy("hash").agg(F.count("*").alias("n_items"))
    order = Window.partitionBy("item_id").orderBy("n_items", "hash")
    ranked = shingles.join(shared, "hash").withColumn("place", F.row_number().over(order))
    kept = F.least(width, F.col("q"))
    least = F.greatest(kept - (F.col("q") - need(F.col("q"))), F.lit(1)).cast("int")
    return ranked.filter(F.col("place") <= kept).select("item_id", "hash", least.alias("least"), (F.col("place") <= kept - least + 1).alias("lead"))


def find_contained(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8, short_runs: bool = False) -> DataFrame:
    """``id, text_hash, item_id, n_shared, n_item, containment`` for every item that a document contains."""
    shingles = materialize(item_shingles(items, id_col=item_id_col, text_col=item_text_col, shingle=shingle).distinct(), "decontam-items")
    listed = materialize(shingles.select("hash").distinct(), "decontam-hashes")
    n_rows = shingles.count()
    small = n_rows * 64 <= BROADCAST_BYTES
    side = (lambda t: F.broadcast(t)) if small else (lambda t: t)
    shorter = short_lengths(items, text_col=item_text_col, shingle=shingle) if short_runs else []
    sketched = materialize(sketches(shingles, threshold), "decontam-sketches")
    lead = sketched.filter("lead").join(shingles.select("item_id", "q").distinct(), "item_id").select("item_id", "hash", "q")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def spread(rows: DataFrame) -> DataFrame:
        hashes = rows.select("id", "text_hash", distinct_shingles(F.col("text"), shingle, shorter).alias("hashes"))
        return hashes.select("id", "text_hash", F.size("hashes").alias("n_doc"), F.explode("hashes").alias("hash"))

    # documents meet the items' sketches; only those that share a leading hash with an item are cut up again, for all of the items' shingles
    key = ["id", "text_hash", "item_id"]
    met = spread(rows).join(side(lead), "hash").filter(F.col("n_doc") >= F.col("q") * threshold - 1e-9)
    pairs = materialize(met.select(*key).distinct(), "decontam-pairs")
    some = pairs.select(F.col("id").alias("p_id"), F.col("text_hash").alias("p_hash")).distinct()
    again = rows.join(some, F.col("id").eqNullSafe(F.col("p_id")) & (F.col("text_hash") == F.col("p_hash")), "left_semi")
    hits = materialize(spread(again).join(side(listed), "hash", "left_semi").select("id", "text_hash", "hash").distinct(), "decontam-hits")

    def held(wanted: DataFrame) -> DataFrame:
        """The rows ``id, text_hash, item_id, hash`` whose hash the document has: only pairs in question are spread out."""
        h = hits.select(*(F.col(k).alias(f"h_{k}") for k in ("id", "text_hash", "hash")))
        return wanted.join(h, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_text_hash")) & (F.col("hash") == F.col("h_hash")), "left_semi")
    possible = held(pairs.join(side(sketched), "item_id"))
    possible = possible.groupBy(*key).agg(F.count("*").alias("n"), F.first("least").alias("least")).filter("n >= least").select(*key)
    exact = held(materialize(possible, "decontam-possible").join(side(shingles), "item_id"))
    counted = exact.groupBy(*key).agg(F.count("*").alias("n_shared"), F.first("q").cast("long").alias("n_item"))
    counted = counted.withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return counted.filter(F.col("containment") >= threshold).withColumnsRenamed({"id": id_col, "item_id": item_id_col})


def remove_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    found = find_contained(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = materialize(found.select(F.col(id_col).alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "decontam-bad")
    rows, name, restored = sealed(docs)
    return restored(rows.join(bad, F.col(name[id_col]).eqNullSafe(F.col("bad_id")) & (F.xxhash64(name[text_col]) == F.col("bad_hash")), "left_anti"))
