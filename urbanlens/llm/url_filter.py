"""URL rules behind a blocked Bloom filter, DataFrame functions only.

A rule is ``(host, path, verdict)``; it fits a URL whose host is the rule's host or one of its subdomains and whose
path starts with the rule's path; the longest fitting rule decides. Every fitting rule equals, letter for letter, one
of the URL's *canonical keys*: a suffix of its host at a label boundary followed by a prefix of its path as long as
some rule's path. So judging is a lookup of a few keys per distinct URL:

1. the listed keys are written into a blocked Bloom filter: one 256-bit block per key, four bits in it, held as a
   table ``(block, w0, w1, w2, w3)`` built by ``bit_or`` (mergeable, map-side combined);
2. every key of every distinct ``(host, path)`` probes its one block;
3. possible hits go to an exact join on the key itself, which removes the false positives.

Scale: only ``url`` is read from the pages. Hot URLs and hosts shrink to one row by ``distinct`` before any probe.
The filter takes about 10 bytes per rule (two bytes of bits), so it is broadcast only when the counted rules prove it small;
beyond that, probe and exact join are shuffled joins of plain tables, which AQE splits when a key such as ``com/`` is hot.

Edge cases: a null URL or one without ``://`` has empty host and path, and no rule; repeated rows are judged one by
one (the verdict depends on the URL only); an empty rule table allows all; of equal rules with both verdicts, block wins;
columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import BROADCAST_BYTES, materialize

RULES = "host string, path string, verdict string"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_WORDS = ("w0", "w1", "w2", "w3")
#: Bits of the filter for each listed key, in blocks of 256.
BITS_PER_KEY = 16


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _bit(key: Column, i: int) -> Column:
    """The key's bit in word ``i`` of its block."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64)).cast("int"))


def bloom_blocks(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter as a table: one row for each block that has a key."""
    c = F.col(key)
    return keys.groupBy(F.pmod(F.xxhash64(c), F.lit(n_blocks)).alias("block")).agg(
        *(F.bit_or(_bit(c, i)).alias(w) for i, w in enumerate(_WORDS)))


def probe(candidates: DataFrame, key: str, blocks: DataFrame, n_blocks: int, small: bool) -> DataFrame:
    """The candidates whose four bits are all set in their block: every listed key, and few others."""
    c = F.col(key)
    side = F.broadcast(blocks) if small else blocks
    hit = candidates.withColumn("block", F.pmod(F.xxhash64(c), F.lit(n_blocks))).join(side, "block")
    for i, w in enumerate(_WORDS):
        hit = hit.filter(F.col(w).bitwiseAND(_bit(c, i)) != 0)
    return hit.drop("block", *_WORDS)


def canonical_keys(host: Column, path: Column, path_lengths: Sequence[int], labels: int) -> Column:
    """Every string a fitting rule can have: suffixes of the host of up to ``labels`` labels times path prefixes of the listed lengths.

    No listed host has more labels, so that a host of any length has a bounded number of keys.
    """
    suffixes = F.array_distinct(F.array(*(F.substring_index(host, ".", -k) for k in range(1, labels + 1))))
    lengths = F.filter(F.array(*(F.lit(int(n)) for n in path_lengths)), lambda n: n <= F.length(path))
    return F.flatten(F.transform(F.filter(suffixes, lambda s: s != ""),
                                 lambda s: F.transform(lengths, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))


def judge_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``pages``."""
    rows = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    listed = rules.filter("host != '' and path is not null").groupBy(
        F.concat(ascii_lower(F.col("host")), "path").alias("rule"), F.length("path").alias("path_length")).agg(
        F.max("verdict").alias("rule_verdict"),  # of 'allow' and 'block' the larger is 'block'
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"))
    listed = materialize(listed, "url-rules")
    shape = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("rule")), F.lit(0)).alias("chars"),
                       F.max("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).first()  # as many lengths as URLs can have: bounded
    if shape.n == 0:
        return rows.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    n_blocks = max(1, -(-shape.n * BITS_PER_KEY // 256))
    small_filter, small_rules = n_blocks * 40 <= BROADCAST_BYTES, shape.n * 64 + 4 * shape.chars <= BROADCAST_BYTES
    blocks = bloom_blocks(listed, "rule", n_blocks)
    keys = rows.select("host", "path").distinct().select(
        "host", "path", F.explode(canonical_keys(F.col("host"), F.col("path"), sorted(shape.lengths), shape.labels)).alias("rule"))
    if not small_filter:
        keys = materialize(keys, "url-keys")
        blocks = materialize(blocks, "url-filter")
    possible = probe(keys, "rule", blocks, n_blocks, small_filter)
    if not small_rules:
        possible = materialize(possible, "url-possible")
    exact = possible.join(F.broadcast(listed) if small_rules else listed, "rule")
    best = exact.groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict"), F.length("rule")).alias("best"))
    best = materialize(best.select("host", "path", "best.rule", "best.rule_verdict"), "url-verdicts")
    # a row for each URL that a rule fits: a table that grows with the pages is never broadcast
    return rows.join(best.hint("merge"), ["host", "path"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict"))
