"""Deterministic sharded WARC writer and its reader.

* Equal payloads of at least ``min_revisit`` bytes are written once: the smallest key is the *response*, the others are
  *revisit* records that name it. Digests are counted with map-side combine; only repeated digests join back to the
  narrow ``(key, digest)`` rows, as two plain tables, so that a payload which a third of all pages share is split by AQE.
* Records are range-sorted by key (then URL and digest, so a hot or null key is split too); each task streams its range
  through ``zlib``, one gzip member per record, and rolls to a new file when the *compressed* size passes ``roll_bytes``.
  Names come from range and roll numbers, dates from a parameter, record ids from contents: the same rows give the same bytes.
* Headers, lengths and digests are made anew from the payload; nothing is copied from the input.
* Commit: a task attempt writes under a name of its own in ``_temporary``; one manifest row per finished file is stored
  as a table, and only then a job renames exactly the files that the manifest lists. Files of lost or repeated attempts
  are never listed, so never read; the rename can be repeated.
* Reading goes file by file through the manifest, one record in memory at a time, and checks every response's digest.

Files are reached through ``pyarrow.fs``, so the folder may be any store it knows (local, HDFS, S3, GCS).

Edge cases: null html is an empty payload; empty and small payloads are always responses; a null URL is written as an
empty target; a null key is written as no key and read back as null, and never is the response that others refer to
unless all keys of the group are null (then all are responses); rows with the same smallest key are all responses;
an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import materialize, shared_path

MANIFEST = "file string, temporary string, n_records long, n_bytes long, sha256 string, first_key long, last_key long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_BUFFER = 1 << 20
_SLICE = 1 << 13


def plan_records(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html",
                 min_revisit: int = 100) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, refers_to, html``; html is null for revisits."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    repeated = materialize(
        rows.filter(F.col("payload_bytes") >= min_revisit).groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
        .select("digest", "first"), "warc-repeated")
    out = rows.join(repeated, F.col("payload_digest") == F.col("digest"), "left")
    revisits = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return out.select("page_id", "url", "payload_bytes", "payload_digest",
                      F.when(revisits, F.col("first")).alias("refers_to"), F.when(~revisits, F.col("html")).alias("html"))


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"


def target_headers(key: int | None, url: str | None) -> list[tuple[str, str]]:
    """The target URI as it is; one that is missing, or that no header line can hold, has a stand-in and is written as JSON beside it."""
    if url and url.isprintable() and url == url.strip():
        return [("WARC-Target-URI", url)]
    stand_in = quote(url, safe="/:?#[]@!$&'()*+,;=%") if url else f"urn:x-page:{key}"
    return [("WARC-Target-URI", stand_in), ("X-Original-URI", json.dumps(url))]


def encode_record(r: dict, date: str) -> bytes:
    """One WARC/1.1 record; ``r`` has the columns of :func:`plan_records`."""
    revisit = r["refers_to"] is not None
    payload = b"" if revisit else r["html"].encode("utf-8", "surrogatepass")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
    block = http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(r["page_id"], r["payload_digest"])),
            ("WARC-Date", date), *target_headers(r["page_id"], r["url"]),
            ("WARC-Payload-Digest", f"sha256:{r['payload_digest']}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
            ("Content-Type", "application/http; msgtype=response"), ("X-Payload-Length", str(r["payload_bytes"]))]
    if r["page_id"] is not None:
        head.append(("X-Record-Key", str(r["page_id"])))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(r["refers_to"], r["payload_digest"])), ("X-Refers-To-Key", str(r["refers_to"]))]
    head.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _store(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


class _Roll:
    """The file that a task is writing."""

    def __init__(self, folder: str, shard: int, number: int):
        self.store, base = _store(folder)
        self.file = f"part-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f"_temporary/{uuid.uuid4().hex}/{self.file}"
        path = f"{base}/{self.temporary}"
        self.store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.sha, self.n_bytes, self.n, self.first, self.last = self.store.open_output_stream(path, compression=None), hashlib.sha256(), 0, 0, None, None

    def add(self, record: bytes, key: int | None) -> None:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member with no name and no time
        data = z.compress(record) + z.flush()
        self.out.write(data)
        self.sha.update(data)
        self.first = key if self.first is None else self.first
        self.last, self.n, self.n_bytes = key, self.n + 1, self.n_bytes + len(data)

    def close(self) -> dict:
        self.out.close()
        return {"file": self.file, "temporary": self.temporary, "n_records": self.n, "n_bytes": self.n_bytes,
                "sha256": self.sha.hexdigest(), "first_key": self.first, "last_key": self.last}


def _rows(batches: Iterator) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _arrow(rows: list[dict], schema):
    import pyarrow as pa
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def write_warc(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", html: str = "html",
               min_revisit: int = 100, roll_bytes: int = 256 << 20, date: str = "1970-01-01T00:00:00Z",
               shards: int | None = None) -> DataFrame:
    """Write every row as a record under ``folder``; the committed manifest, one row per file."""
    import pyarrow as pa

    spark = pages.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["page_id", "url", "payload_digest"]
    records = plan_records(pages, key=key, url=url, html=html, min_revisit=min_revisit)
    dealt = records.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = pa.schema([("file", pa.string()), ("temporary", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()),
                        ("sha256", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64())])

    def write(batches):
        from pyspark import TaskContext
        shard, number, roll = TaskContext.get().partitionId(), 0, None
        for r in _rows(batches):
            roll = roll or _Roll(folder, shard, number)
            roll.add(encode_record(r, date), r["page_id"])
            if roll.n_bytes >= roll_bytes:
                yield _arrow([roll.close()], schema)
                roll, number = None, number + 1
        if roll:
            yield _arrow([roll.close()], schema)

    manifest = materialize(dealt.mapInArrow(write, MANIFEST), "warc-manifest")

    def commit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        for frame in frames:
            for f in frame.itertuples():
                done = store.get_file_info(f"{base}/{f.file}")
                if not (done.is_file and done.size == f.n_bytes):  # else an earlier attempt has renamed it
                    store.move(f"{base}/{f.temporary}", f"{base}/{f.file}")
            yield frame

    committed = manifest.repartition(min(shards, 64), "file").mapInPandas(commit, MANIFEST)
    return materialize(committed, "warc-committed")


def _members(store, path: str) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    with store.open_input_stream(path, compression=None) as stream:
        data, at = stream.read(_BUFFER), 0
        while data:
            z, parts = zlib.decompressobj(31), []
            while not z.eof:
                if at == len(data):
                    data, at = stream.read(_BUFFER), 0
                    if not data:
                        raise ValueError(f"{path}: the last record is cut off")
                piece = data[at:at + _SLICE]  # what a member leaves over is copied: a slice at most
                parts.append(z.decompress(piece))
                at += len(piece) - len(z.unused_data)
            if at == len(data):
                data, at = stream.read(_BUFFER), 0
            yield b"".join(parts)


def decode_record(record: bytes) -> dict:
    """The columns of ``RECORD``; raises when lengths or digests don't agree with the contents."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    h = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != h["WARC-Block-Digest"]:
        raise ValueError("not a whole WARC record")
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = h["WARC-Type"] == "revisit"
    digest, n = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["X-Payload-Length"])
    if not revisit:
        n, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest or n != int(h["X-Payload-Length"]):
            raise ValueError("payload and digest differ")
    return {"page_id": int(h["X-Record-Key"]) if "X-Record-Key" in h else None, "url": json.loads(h["X-Original-URI"]) if "X-Original-URI" in h else h["WARC-Target-URI"], "payload_bytes": n,
            "payload_digest": digest, "record_type": h["WARC-Type"], "refers_to": int(h["X-Refers-To-Key"]) if revisit else None}


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files that ``manifest`` lists."""
    import pyarrow as pa

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches):
        store, base = _store(folder)
        for f in _rows(batches):
            rows = []
            for member in _members(store, f"{base}/{f['file']}"):
                rows.append(decode_record(member))
                if len(rows) == 1000:
                    yield _arrow(rows, schema)
                    rows = []
            yield _arrow(rows, schema)

    shards = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(shards, "file").mapInArrow(read, RECORD)


def rewrite_and_read(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder in the shared store and read the archives back."""
    folder = shared_path(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, **options), folder)
