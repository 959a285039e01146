r"""Byte-pair encoding with word ends, and decoding.

A word is a doubly linked list of symbols; a heap holds ``(merge rank, position)`` of adjacent pairs. The best pair is
merged in place, its new neighbours are pushed, and entries whose symbols have changed since are skipped when they come up. Ties of rank go
to the left. Decoding reads the ids that encoding gave and concatenates vocabulary strings, one space between tokens (the vocabulary file
names no decoder); digests of decoded texts are of what comes from the ids.

Which steps come before the merges (special strings, NFC, white space, lower case, word pattern, byte alphabet) is read from
the vocabulary file's format and done here as the file states it. Text between white space is independent of its
surroundings once normalised, so a task keeps the ids of chunks it has seen; that cache has a fixed size and changes no result.

One pass, no shuffle: rows stay in the partition that reads them; the vocabulary is a file of fixed size that each worker
loads by its path (a parameter) once. Memory is that of one batch of rows plus the cache.

Edge cases: null and empty texts have no tokens and decode to the empty text; special strings inside a text become
their own ids; very long words cost n log n; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from urbanlens.llm.common import returning_memory

#: Unicode White_Space: what the pattern ``\s`` of the vocabulary file means.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Fixed value: the word pattern of the vocabulary file's format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Entries of either cache of words and chunks.
_KEPT = 1 << 18
_LONG = 1 << 20
_NONE: dict[int, int] = {}
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]
#: Ids that are decoded at once, and rows that are encoded before they are handed on.
_DECODED, _ROWS = 1 << 16, 256


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the rest for code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        size = max(self.strings) + 1
        #: By the left id, the rank of its pair with a right id; and what the merge of each rank gives.
        self.pairs = [_NONE] * size
        for rank, (a, b) in enumerate(pairs):
            if self.pairs[self.vocab[a]] is _NONE:
                self.pairs[self.vocab[a]] = {}
            self.pairs[self.vocab[a]][self.vocab[b]] = rank
        self.merged = [self.vocab[a + b] for a, b in pairs]
        #: By id, a blank and the vocabulary string in UTF-8.
        self.spelled = [b" " + self.strings[i].encode("utf-8", "surrogatepass") if i in self.strings else None for i in range(size)]
        alphabet = byte_alphabet()
        self.first = [self.vocab.get(alphabet[b], -1) for b in range(256)]
        self.last = [self.vocab.get(alphabet[b] + self.end, -1) for b in range(256)]
        longest = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self._words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE))
        self._space = regex.compile(f"[{SPACE}]+")
        self._seen: dict[str, bytes] = {}  # of words and chunks
        self._old: dict[str, bytes] = {}

    @staticmethod
    def _check(spec: dict) -> None:
        """Only the format that this class implements."""
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        pre = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["pattern"].get("Regex") != WORDS or (kinds, pre, split["behavior"], split["invert"], spec["decoder"]) != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "Removed", True, None) \
                or spec["model"]["unk_token"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("a vocabulary of another format")

    def merge(self, word: str) -> list[int]:
        """The ids of one word: merges by a heap over a linked list of symbols."""
        data, pairs, merged = word.encode("utf-8", "surrogatepass"), self.pairs, self.merged
        symbol = list(map(self.first.__getitem__, data))
        symbol[-1] = self.last[data[-1]]
        if -1 in symbol:
            symbol = [s for s in symbol if s >= 0]
        n = len(symbol)
        rank_at = [pairs[a].get(b, -1) for a, b in zip(symbol, symbol[1:])]  # of the pair that starts at a place
        heap = [rank * n + at for at, rank in enumerate(rank_at) if rank >= 0]  # rank and place in one integer
        if not heap:
            return symbol
        rank_at.append(-1)
        before, after = list(range(-1, n)), list(range(1, n + 1))  # n: the end
        heapify(heap)
        while heap:
            rank, at = divmod(heappop(heap), n)
            if rank_at[at] != rank:
                continue  # stale: one of the two has been merged since
            right = after[at]
            symbol[at] = new = merged[rank]
            symbol[right] = rank_at[right] = -1
            after[at] = far = after[right]
            before[far] = at
            left = before[at]
            if left >= 0:
                rank_at[left] = rank = pairs[symbol[left]].get(new, -1)
                if rank >= 0:
                    heappush(heap, rank * n + left)
            rank_at[at] = rank = -1 if far == n else pairs[new].get(symbol[far], -1)
            if rank >= 0:
                heappush(heap, rank * n + at)
        return [s for s in symbol if s >= 0]

    def _word(self, word: str) -> bytes:
        """Ids (little-endian, 32 bits) of one word. A full cache becomes the old one, of which what is asked for again comes back."""
        out = self._seen.get(word)
        if out is None:
            out = self._old.get(word)
            if out is None:
                ids = self.merge(word)
                out = _PACK[len(ids)](*ids) if len(ids) < 16 else _pack(ids)
            if len(word) < 64:
                if len(self._seen) >= _KEPT:
                    self._old, self._seen = self._seen, {}
                self._seen[word] = out
        return out

    def _chunk(self, chunk: str) -> bytes:
        """Ids of normalised text without white space: ASCII letters alone are one word of the pattern."""
        if chunk.isalpha() and chunk.isascii():
            return self._word(chunk)
        out = self._old.get(chunk)
        if out is None:
            out = b"".join(map(self._word, self._words.findall(chunk)))
        if len(chunk) < 64 and len(self._seen) < _KEPT:
            self._seen[chunk] = out
        return out

    def _parts(self, text: str) -> Iterator[bytes]:
        at = 0
        if any(map(text.__contains__, self.special)):
            for m in self._special.finditer(text):
                yield from self._plain(text[at:m.start()])
                yield _pack([self.special[m[0]]])
                at = m.end()
        yield from self._plain(text[at:])

    def _plain(self, text: str) -> Iterator[bytes]:
        if not text.isascii():
            # lower case letter by letter: a capital sigma has no final form of its own here
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        at = 0
        while len(text) - at > _LONG:  # a long text goes in pieces that end at white space
            m = self._space.search(text, at + _LONG)
            if not m:
                break
            yield self._ids(text[at:m.start()])
            at = m.end()
        yield self._ids(text[at:])

    def _ids(self, text: str) -> bytes:
        # ``str.split`` also breaks at four control characters that are no white space here
        chunks = self._space.split(text) if any(map(text.__contains__, "\x1c\x1d\x1e\x1f")) else text.split()
        out = list(map(self._seen.get, chunks))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._chunk(chunks[i])
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        data = self.packed(text)
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))

    def packed(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        return b"".join(self._parts(text or ""))

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number and SHA-256 of packed ids, and SHA-256 of the text that they decode to."""
        decoded = hashlib.sha256()
        for at in range(0, len(ids), 4 * _DECODED):
            part = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids[at:at + 4 * _DECODED], "<u4").tolist()))
            decoded.update(memoryview(part)[at == 0:])  # no blank before the first
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded.hexdigest()


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def load(path: str) -> WordBPE:
    return WordBPE(path)


def encode_column(path: str, text: Column) -> Column:
    """``array<int>`` of token ids."""
    @pandas_udf("array<int>")
    def ids(s: pd.Series) -> pd.Series:
        return s.map(load(path).encode)
    return ids(text)


def decode_column(path: str, ids: Column) -> Column:
    """The decoded text of an ``array<int>``."""
    @pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else load(path).decode(list(x)))
    return text(ids)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, keep: list[str], with_ids: bool) -> DataFrame:
    """One pass over the texts, a few rows at a time, so that a task never holds the ids of a whole batch."""
    import pyarrow as pa
    rows = docs.select(F.col(id_col), *keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    kept = rows.drop("__text")
    schema = StructType([*kept.schema.fields, StructField("n_tokens", LongType()), *[StructField("token_ids", ArrayType(IntegerType()))] * with_ids,
                         StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for first in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(first, _ROWS)
                ids = [bpe.packed(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
                n, sha, decoded = zip(*map(bpe.digests, ids), strict=True)
                columns = [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    ends = np.cumsum([0, *n]).astype(np.int32)
                    columns.insert(-2, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(returning_memory(run), schema)


def digests(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: what encoding and then decoding every text gives."""
    return _encoded(docs, path, id_col, text_col, [], with_ids=False)


def tokenize(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``id``, the columns ``keep``, ``n_tokens, token_ids, ids_sha256, decoded_sha256``: the stored form of a tokenized corpus."""
    return _encoded(docs, path, id_col, text_col, list(keep), with_ids=True)
