"""Removal of long repeated byte strings with a run-length index (see :mod:`run_index`).

A byte goes when a string of ``least`` bytes that covers it also starts anywhere else in the corpus. An index of the whole corpus in one
place is out of the question, so texts that can share such a string are first brought together:

1. *Anchors.* In every window of ``least`` bytes the k-byte string with the smallest hash is an anchor. Equal windows choose the
   same anchor, so every repeated string shows up as a repeated anchor, with equal surroundings. One pass over the texts
   writes ``(anchor, segment, position)``, both as hashes; a segment is the anchor with all the windows that can contain it.
2. *Copies.* Where the segment itself repeats, all its bytes go: no text is needed for that, so the bulk of the repetition, however often a
   passage occurs, is settled by a count with map-side combine.
3. *Variants.* Anchors that occur with several different segments (one edit near a copy, a passage amid new text) send one text of each
   segment to a task. Several anchors' segments, those of one document merged where they overlap, make one index; matching statistics of
   at least ``least`` are repeated strings. An anchor with more than ``most`` different segments is split first: its windows are dealt into
   four runs by where they start, the windows of a run share a longer string than the anchor, and that is the run's anchor; so on
   until the group fits or the anchor is the whole window. No group is larger than a task's bound and no window is lost.
4. Spans are merged by document and cut from the bytes.

With ``words``, passages of that many words go too if they have fewer than ``least`` bytes: every such run of words is written with its
hash (few texts have any), and the places of a hash that occurs again are spans like the others. Words stand between white space and
have a letter, mark or digit (a bar between cells is no word); punctuation at a passage's ends may differ.

Edge cases: null texts are empty and keep null text; texts shorter than ``least`` have no repeats; rows that repeat id and text are two
places of the same string, so all of it goes; rows without id are told apart by their text; texts of any length are read in
overlapping pieces; an empty table gives no rows; other columns are ignored (and kept by ``remove_repeats``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from urbanlens.llm.common import discard, is_empty, materialize, returning_memory, sealed
from urbanlens.llm.run_index import RunIndex

#: Bytes of an anchor at most (a third of a repeated string otherwise), and different segments that an index takes.
ANCHOR, MOST = 128, 1024
#: Bytes of text that a task scans at once, and that one index holds.
_PIECE, _INDEX = 1 << 19, 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_KEY = ["doc_id", "text_hash"]
#: White space of one byte, of several (Unicode White_Space), and what isn't a letter, mark or digit at a word's ends.
_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
_PLAIN = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_WIDE_SPACE = regex.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_CORE = regex.compile(r"[\p{L}\p{M}\p{N}](?:.*[\p{L}\p{M}\p{N}])?", regex.S)
#: Rows of passages that a task holds at once.
_PASSAGES = 1 << 16


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64."""

    base, n = 0x2545F4914F6CDD1D, 0

    @classmethod
    def upto(cls, n: int) -> None:
        if n > cls.n:
            cls.n = max(n, 1 << 16)
            inverse = pow(cls.base, -1, 1 << 64)
            cls.up, cls.down = (np.cumprod(np.r_[np.uint64(1), np.full(cls.n, x, np.uint64)]) for x in (cls.base, inverse))


def anchors(data: np.ndarray, end: np.ndarray, least: int, k: int) -> np.ndarray:
    """Positions of the anchors of ``data``, several texts in a row; ``end[i]`` is where the text that holds byte i ends."""
    width, n = least - k + 1, len(data) - k + 1
    if len(data) < least:
        return np.empty(0, np.int64)
    _Powers.upto(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * _Powers.up[:len(data)], out=total[1:])
    h = (total[k:] - total[:-k]) * _Powers.down[:n]
    h ^= h >> np.uint64(32)
    h *= _MULTIPLIER
    h = (h >> np.uint64(24) << np.uint64(24)) | np.arange(n, dtype=np.uint64)  # of equal hashes the leftmost counts
    rows = -(-n // width)
    h = np.r_[h, np.full(rows * width - n, ~np.uint64(0))].reshape(rows, width)
    forth = np.minimum.accumulate(h, axis=1).reshape(-1)
    back = np.minimum.accumulate(h[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = len(data) - least + 1
    least_of = np.minimum(back[:windows], forth[width - 1:width - 1 + windows])
    own = np.flatnonzero(end[:windows] >= np.arange(windows) + least)
    at = (least_of[own] & np.uint64((1 << 24) - 1)).astype(np.int64)
    return at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at


def text_bytes(t: str | None) -> bytes:
    return (t or "").encode("utf-8", "surrogatepass")


def anchor_table(docs: DataFrame, least: int, k: int) -> DataFrame:
    """``doc_id, text_hash, at, before, after, anchor, segment``: one row for each anchor of each text."""
    import pyarrow as pa
    schema = "doc_id long, text_hash long, at long, before int, after int, anchor long, segment long"
    out = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("at", pa.int64()), ("before", pa.int32()), ("after", pa.int32()),
                     ("anchor", pa.int64()), ("segment", pa.int64())])
    reach = least - k

    def scan(texts: list[bytes], ids: list, hashes: list, offsets: list[int], own_from: list[int], own_to: list[int]) -> pa.RecordBatch:
        from xxhash import xxh3_64_intdigest as digest
        data = b"".join(texts)
        size = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(size)
        at = anchors(np.frombuffer(data, np.uint8), np.repeat(end, size), least, k)
        which = np.searchsorted(end, at, side="right")
        place = at - (end - size)[which] + np.array(offsets, np.int64)[which]
        own = (place >= np.array(own_from, np.int64)[which]) & (place < np.array(own_to, np.int64)[which])
        at, which, place = at[own], which[own], place[own]
        begin = end[which] - size[which]
        first, last = np.maximum(at - reach, begin), np.minimum(at + least, end[which])
        a = np.array([digest(data[i:i + k]) for i in at.tolist()], np.uint64)
        s = np.array([digest(data[i:j], p) for i, j, p in zip(first.tolist(), last.tolist(), (at - first).tolist(), strict=True)], np.uint64)
        id_array = pa.array(ids, pa.int64()).take(pa.array(which))
        hash_array = pa.array(hashes, pa.int64()).take(pa.array(which))
        return pa.RecordBatch.from_arrays([id_array, hash_array, pa.array(place), pa.array((at - first).astype(np.int32)),
                                           pa.array((last - at).astype(np.int32)), pa.array(a.view(np.int64)), pa.array(s.view(np.int64))], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(batch["doc_id"].to_pylist(), batch["text_hash"].to_pylist(), batch["text"], strict=True):
                t = text.as_buffer().to_pybytes() if text.is_valid else b""
                if len(t) < least:
                    continue
                # pieces overlap by more than a segment on either side, and each anchor belongs to one piece
                cuts = range(0, max(1, len(t) - 2 * least), _PIECE)
                for own in cuts:
                    first = max(0, own - 2 * least)
                    piece = t[first:own + _PIECE + 2 * least]
                    group.append((piece, doc_id, text_hash, first, own, len(t) if own == cuts[-1] else own + _PIECE))
                    held += len(piece)
                    if held >= _PIECE:
                        yield scan(*map(list, zip(*group, strict=True)))
                        group, held = [], 0
        if held:
            yield scan(*map(list, zip(*group, strict=True)))

    return docs.select("doc_id", "text_hash", F.col("text").cast("binary").alias("text")).mapInArrow(returning_memory(run), schema)


def _indexed(rows: DataFrame, least: int) -> DataFrame:
    """Repeated spans among ``(group, doc_id, text_hash, start, bytes, known)``; what is known to repeat gives no row."""
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(shards, "group").sortWithinPartitions("group")

    def spans(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["no_id", "doc_id", "text_hash", "start"], kind="stable")
        # segments of one text that touch become one string: a place is in the index once
        strings, heads, wanted = [], [], []
        for key, start, data, known in zip(zip(rows["no_id"], rows["doc_id"], rows["text_hash"], strict=True), rows["start"], rows["bytes"], rows["known"], strict=True):
            if heads and heads[-1][0] == key and start <= heads[-1][1] + len(strings[-1]):
                strings[-1] += data[max(0, heads[-1][1] + len(strings[-1]) - start):]
                wanted[-1] |= not known
            else:
                strings.append(data)
                heads.append((key, start))
                wanted.append(not known)
        who, first, last = RunIndex(strings).long_matches(least)
        keep = np.array(wanted)[who]
        who, first, last = who[keep], first[keep], last[keep]
        start = np.array([h[1] for h in heads], np.int64)[who]
        return pd.DataFrame({"doc_id": pd.array([None if heads[i][0][0] else heads[i][0][1] for i in who], "Int64"),
                             "text_hash": np.array([h[0][2] for h in heads], np.int64)[who], "first": start + first, "last": start + last})

    def whole_groups(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Parts of about ``_INDEX`` bytes that break between groups; the last one may be the start of a group."""
        group = rows["group"].to_numpy()
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.r_[0, np.cumsum(rows["bytes"].str.len().to_numpy())]
        at = 0
        while at < len(rows):
            ends = starts[(starts > at) & (size[starts] - size[at] >= _INDEX)]
            end = int(ends[0]) if len(ends) else len(rows)
            yield rows.iloc[at:end]
            at = end

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            parts = list(whole_groups(frame if rest is None else pd.concat([rest, frame], ignore_index=True)))
            for part in parts[:-1]:
                yield spans(part)
            rest = parts[-1] if parts else rest
        if rest is not None and len(rest):
            yield spans(rest)

    return dealt.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0))).mapInPandas(
        returning_memory(run), "doc_id long, text_hash long, first long, last long")


#: Into how many runs the windows of a large group are split at each turn.
_RUNS = 4


def _split(rows: DataFrame, least: int) -> DataFrame:
    """Each segment once for every run of its windows: windows that start within a run share more bytes than the anchor, all
    that lie between the last one's start and the first one's end. Those bytes are the run's anchor."""
    free = F.lit(least) - F.col("k")  # windows start from ``offset - free`` to ``offset``
    run = F.ceil((free + 1) / _RUNS).cast("int")
    first = F.col("offset") - free + F.col("i") * run
    last = F.least(first + run - 1, F.col("offset"))
    out = rows.select("doc_id", "text_hash", "start", "bytes", "known", "k", "offset", F.explode(F.array(*map(F.lit, range(_RUNS)))).alias("i"))
    out = out.withColumns({"a": F.greatest(first, F.lit(0)), "b": F.least(last, F.length("bytes") - least)}).filter("a <= b")
    # the anchor is that of the whole run, even if the text begins or ends within it
    out = out.withColumns({"low": first, "high": last}).filter("high >= 0 and low + %d <= length(bytes) and low <= high" % least)
    out = out.select("doc_id", "text_hash", (F.col("start") + F.col("a")).alias("start"), "known", (least - (F.col("high") - F.col("low"))).alias("k"),
                     (F.col("high") - F.col("a")).alias("offset"), F.substring("bytes", F.col("a") + 1, F.col("b") - F.col("a") + least).alias("bytes"))
    return out.select("*", F.xxhash64(F.substring("bytes", F.col("offset") + 1, F.col("k"))).alias("group"), F.xxhash64("bytes", "offset").alias("segment"),
                      F.xxhash64(*_KEY, "start").alias("place"))


def repeated_spans(docs: DataFrame, least: int = 400, k: int | None = None, most: int = MOST) -> DataFrame:
    """``doc_id, text_hash, first, last``: byte ranges, not yet merged, of every repeated string. ``docs``: ``doc_id, text_hash, text``."""
    k = k or max(1, min(ANCHOR, least // 3))
    table = materialize(anchor_table(docs, least, k), "repeats-anchors")
    segments = materialize(table.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
                           F.first("at").alias("at"), F.first("before").alias("before"), F.first("after").alias("after")), "repeats-segments")
    copies = segments.filter("n > 1").select("anchor", "segment")
    spans = [materialize(table.join(copies, ["anchor", "segment"], "left_semi").select(
        "doc_id", "text_hash", (F.col("at") - F.col("before")).alias("first"), (F.col("at") + F.col("after")).alias("last")), "repeats-copies")]
    discard(table)
    variants = materialize(segments.groupBy("anchor").agg(F.count("*").alias("n_segments")).filter("n_segments > 1"), "repeats-variants")
    wanted = segments.join(variants, "anchor").groupBy(*_KEY).agg(F.collect_list(F.struct(
        F.col("anchor").alias("group"), (F.col("at") - F.col("before")).alias("start"), F.col("before").alias("offset"),
        (F.col("before") + F.col("after")).alias("size"), (F.col("n") > 1).alias("known"), "n_segments")).alias("wanted"))
    wanted = materialize(wanted.withColumnsRenamed({c: f"w_{c}" for c in _KEY}), "repeats-wanted")
    # rows that repeat id and text are one place: the index joins them, and their segments are known to repeat
    found = docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("text_hash") == F.col("w_text_hash")))
    found = found.select("doc_id", "text_hash", F.col("text").cast("binary").alias("data"), F.explode("wanted").alias("w"))
    rows = materialize(found.select("doc_id", "text_hash", "w.group", "w.start", "w.offset", "w.known", "w.n_segments", F.lit(k).alias("k"),
                       F.substring("data", (F.col("w.start") + 1).cast("int"), F.col("w.size")).alias("bytes")), "repeats-texts")
    part = ["group", *_KEY, "start", "bytes", "known"]
    bounded = [rows.filter(F.col("n_segments") <= most).select(*part)]
    rows = rows.filter(F.col("n_segments") > most)
    while not is_empty(rows):
        parts = materialize(_split(rows, least), "repeats-parts")
        # one place can come here from two anchors: only different places are a repetition
        counts = materialize(parts.groupBy("group", "segment").agg(F.min("place").alias("place"), (
            (F.min("place") != F.max("place")) | F.max("known")).alias("repeats")), "repeats-segments")
        spans.append(parts.filter("not known").join(counts.filter("repeats").select("group", "segment"), ["group", "segment"], "left_semi").select(
            "doc_id", "text_hash", F.col("start").alias("first"), (F.col("start") + F.length("bytes")).alias("last")))
        sized = materialize(counts.groupBy("group").agg(F.count("*").alias("n_segments")).filter("n_segments > 1"), "repeats-groups")
        rows = materialize(parts.drop("known").join(counts.join(sized, "group"), ["group", "segment", "place"]).withColumnRenamed("repeats", "known"), "repeats-texts")
        bounded.append(rows.filter(F.col("n_segments") <= most).select(*part))
        rows = rows.filter(F.col("n_segments") > most)
    spans.append(_indexed(_union(bounded), least))
    return _union(spans)


def _core(word: bytes) -> tuple[int, int]:
    """Bytes before and after a word's letters, marks and digits."""
    m = _CORE.search(t := word.decode("utf-8", "surrogatepass"))
    return len(text_bytes(t[:m.start()])), len(text_bytes(t[m.end():]))


def short_passages(data: bytes, words: int, least: int) -> Iterator[tuple[int, int]]:
    """Ranges of all runs of ``words`` words that have fewer than ``least`` bytes, with and without punctuation at either end."""
    space = _SPACE[np.frombuffer(data, np.uint8)]
    for m in _WIDE_SPACE.finditer(data):
        space[m.start():m.end()] = True
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)

    def near() -> np.ndarray:  # a passage has one byte of either end word at least
        return np.flatnonzero(starts[words - 1:] - ends[:max(0, len(ends) - words + 1)] + 2 < least)
    if not len(near()):
        return
    # of the few texts that go on, what is no word is left out
    is_word = np.add.reduceat(_PLAIN[np.frombuffer(data, np.uint8)].astype(np.int64), starts) > 0
    for i in np.flatnonzero(~is_word).tolist():
        is_word[i] = bool(_CORE.search(data[starts[i]:ends[i]].decode("utf-8", "surrogatepass")))
    starts, ends = starts[is_word], ends[is_word]
    for i in near().tolist():
        a, b, c, d = int(starts[i]), int(ends[i]), int(starts[i + words - 1]), int(ends[i + words - 1])
        before, after = _core(data[a:b])[0], _core(data[c:d])[1]
        for x in {a, a + before}:
            for y in {d, d - after}:
                if y - x < least:
                    yield x, y


def repeated_passages(docs: DataFrame, words: int, least: int) -> DataFrame:
    """``doc_id, text_hash, first, last`` of every run of ``words`` words under ``least`` bytes that also stands elsewhere."""
    import pyarrow as pa
    out = pa.schema([("passage", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            passage, doc_id, text_hash, first, last = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(np.array(passage, np.uint64).view(np.int64)), *(pa.array(c, pa.int64()) for c in (doc_id, text_hash, first, last))], schema=out)

        rows = []
        for b in batches:
            for doc_id, text_hash, text in zip(b["doc_id"].to_pylist(), b["text_hash"].to_pylist(), b["text"], strict=True):
                t = text.as_buffer().to_pybytes() if text.is_valid else b""
                for first, last in short_passages(t, words, least):
                    rows.append((digest(t[first:last]), doc_id, text_hash, first, last))
                    if len(rows) >= _PASSAGES:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    table = docs.select("doc_id", "text_hash", F.col("text").cast("binary").alias("text")).mapInArrow(
        returning_memory(run), "passage long, doc_id long, text_hash long, first long, last long")
    table = materialize(table, "repeats-passages")
    again = materialize(table.groupBy("passage").agg(F.count("*").alias("n")).filter("n > 1").select("passage"), "repeats-again")
    return table.join(again, "passage", "left_semi").select("doc_id", "text_hash", "first", "last")


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def merge_spans(first, last) -> list[list[int]]:
    """Maximal runs of the union of ranges, given by ascending starts; none for null."""
    out: list[list[int]] = []
    for a, b in zip(first, last, strict=True) if first is not None else ():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(b))
        else:
            out.append([int(a), int(b)])
    return out


def cut(data: bytes, runs: list[list[int]]) -> bytes:
    parts, at = [], 0
    for first, last in runs:
        parts.append(data[at:first])
        at = last
    return b"".join([*parts, data[at:]])


def _own(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def _by_text(spans: DataFrame, name: str) -> DataFrame:
    """``span_id, span_hash`` and the starts and ends of a text's ranges, as arrays named after ``name``."""
    spans = spans.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("s"))
    return materialize(spans.select(F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"), F.col("s.first").alias(f"{name}_first"),
                                    F.col("s.last").alias(f"{name}_last")), "repeats-by-text")


def _joined(rows: DataFrame, id_col: str, text_col: str, spans: DataFrame) -> DataFrame:
    return rows.join(spans.hint("shuffle_hash"), rows[id_col].cast("long").eqNullSafe(F.col("span_id")) & (F.xxhash64(rows[text_col]) == F.col("span_hash")), "left")


def _runs(spans: DataFrame, name: str, least: int) -> DataFrame:
    """``doc_id, text_hash, start, length`` of the merged ranges of at least ``least`` bytes."""
    @pandas_udf("array<struct<start:long,length:long>>")
    def merged(first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "length": b - a} for a, b in merge_spans(x, y) if b - a >= least] for x, y in zip(first, last, strict=True)], dtype=object)
    rows = spans.select(F.col("span_id").alias("doc_id"), F.col("span_hash").alias("text_hash"), F.explode(merged(F.col(f"{name}_first"), F.col(f"{name}_last"))).alias("r"))
    return rows.select("doc_id", "text_hash", "r.start", "r.length")


def longer_spans(own: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """``doc_id, text_hash, first, last`` of the strings of ``least`` bytes that repeat, given where shorter strings do: both places of such a
    string lie within ``runs``, so only these parts of the texts are searched."""
    runs = materialize(runs.select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), "start", "length"), "repeats-runs")
    parts = own.join(runs.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")))
    part = F.substring(F.col("text").cast("binary"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    parts = parts.select("doc_id", "text_hash", "start", "length", part.alias("text"))
    parts = materialize(parts.select("*", F.xxhash64("text").alias("c1"), F.xxhash64("length", "text").alias("c2")), "repeats-runs-text")
    # runs that occur again whole need no search: one of each contents stands for all of them
    single = materialize(parts.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.first("text").alias("text")), "repeats-contents")
    places = materialize(parts.select("doc_id", "text_hash", "start", "length", "c1", "c2"), "repeats-places")
    discard(parts)
    found = repeated_spans(single.select(F.col("c1").alias("doc_id"), F.col("c2").alias("text_hash"), "text"), least)
    found = found.select(F.col("doc_id").alias("c1"), F.col("text_hash").alias("c2"), "first", "last").join(single.filter("n = 1").select("c1", "c2"), ["c1", "c2"], "left_semi")
    again = places.join(single.filter("n > 1").select("c1", "c2"), ["c1", "c2"], "left_semi")
    rest = places.join(found, ["c1", "c2"])
    return again.select("doc_id", "text_hash", F.col("start").alias("first"), (F.col("start") + F.col("length")).alias("last")).unionByName(
        rest.select("doc_id", "text_hash", (F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last")))


def removal_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 400, passage: int = 256, words: int = 51) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every row without its repeated strings of ``least`` bytes; and ``text, n_kept``, what is left
    without repeated passages too: strings of ``passage`` bytes (at most ``least``) and, however short, runs of ``words`` words.

    Passages are found first. A repeated string of ``least`` bytes lies within them, so the second search reads repeated text alone.
    """
    @pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, n_kept long")
    def f(text: pd.Series, first: pd.Series, last: pd.Series, passage_first: pd.Series, passage_last: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b, c, d in zip(text, first, last, passage_first, passage_last, strict=True):
            data, runs = text_bytes(t), merge_spans(a, b)
            kept = cut(data, runs)
            rest = t if c is None else cut(data, merge_spans(c, d)).decode("utf-8", "ignore")
            out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), rest, len(text_bytes(rest))))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "n_kept"])
    own = _own(docs, id_col, text_col)
    found = repeated_spans(own, passage)
    short = _by_text(found.unionByName(repeated_passages(own, words, passage)), "passage")
    long = _by_text(longer_spans(own, _runs(short, "passage", least), least), "long")
    both = materialize(short.join(long.withColumnsRenamed({"span_id": "l_id", "span_hash": "l_hash"}), F.col("span_id").eqNullSafe(F.col("l_id")) & (
        F.col("span_hash") == F.col("l_hash")), "left").drop("l_id", "l_hash"), "repeats-both")
    rows = _joined(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", both)
    return rows.select(F.col("id").alias(id_col), f("text", "long_first", "long_last", "passage_first", "passage_last").alias("d")).select(id_col, "d.*")


def kept_text(text: Column, first: Column, last: Column) -> Column:
    """The text without the bytes of the ranges; characters that a range cuts in two go whole."""
    @pandas_udf("string")
    def f(text: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or a is None else cut(text_bytes(t), merge_spans(a, b)).decode("utf-8", "ignore")
                          for t, a, b in zip(text, first, last, strict=True)], dtype=object)
    return f(text, first, last)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes cut from its texts; ``words``: passages of so many words go even if they have fewer than ``least`` bytes."""
    rows, name, restored = sealed(docs)
    own = _own(rows, name[id_col], name[text_col])
    spans = repeated_spans(own, least)
    if words:
        spans = spans.unionByName(repeated_passages(own, words, least))
    rows = _joined(rows, name[id_col], name[text_col], _by_text(spans, "cut"))
    return restored(rows.withColumn(name[text_col], kept_text(F.col(name[text_col]), F.col("cut_first"), F.col("cut_last"))))
