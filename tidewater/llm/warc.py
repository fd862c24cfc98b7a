"""Deterministic sharded WARC writer, and a reader of what it wrote.

Pages are dealt to shards by ranges of page_id. The bounds come from a sample chosen by the
hash of the id, so the same pages give the same shards, files and bytes in any run. A task
sorts its shards and writes each to files that roll over once ROLL_BYTES compressed bytes are
reached; every record is a gzip member with headers and digests made anew.

Of pages with equal payloads of at least `least` bytes that with the smallest page_id is
written as a response, the others as revisits of it, without the payload. Only ids and digests
are compared for this; payloads are shuffled once, to their shard.

Commit: a task writes under temporary names that hold a random part, so attempts that are
repeated or lost do no harm. The rows that Spark accepts from the tasks form a table; its
files are renamed, which can be repeated, and the table is then written as the manifest.
Readers take the files that the manifest lists and no others.

A null html is an empty payload, a null url the page's own urn. Rows with equal ids are
records of their own; where the payload is equal too and the id is the smallest, each is a
response. A null page_id counts as larger than all others. An empty table gives an empty
manifest. Control characters in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Compressed bytes after which a file is closed, payload bytes of a shard, and compressed
#: bytes that a task reads back.
ROLL_BYTES, SHARD_BYTES, READ_BYTES = 1 << 20, 8 << 20, 4 << 20
MAX_SHARDS, SAMPLE = 10_000, 50_000
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "file string, temporary string, shard bigint, records bigint, bytes bigint, sha256 string"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, url string, file string, offset bigint")


# --- records ----------------------------------------------------------------------------

def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page:{page_id}')}>"


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member without a time stamp."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"),
                                                   ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def page_record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
               ("WARC-Date", DATE), ("WARC-Target-URI", _clean(url) if url else f"urn:page:{page_id}"),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-Id", str(refers_to))]
    return member(headers, http if revisit else http + payload)


def info_record(file: str) -> bytes:
    return member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(file)), ("WARC-Date", DATE),
                   ("WARC-Filename", file), ("Content-Type", "application/warc-fields")],
                  b"software: tidewater\r\nformat: WARC file version 1.1\r\n")


# --- writing ----------------------------------------------------------------------------

class Roller:
    """Writes records to the files of a shard under temporary names."""

    def __init__(self, folder: str, roll: int):
        from pyarrow import fs
        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.roll, self.out, self.rows, self.shard, self.part = roll, None, [], None, 0

    def close(self):
        if self.out:
            self.out.close()
            self.rows.append((self.file, self.temporary, self.shard, self.records, self.bytes, self.sha.hexdigest()))
            self.out = None

    def write(self, shard: int, data: bytes):
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        elif self.out and self.bytes >= self.roll:
            self.close()
            self.part += 1
        if not self.out:
            self.file = f"{shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.file}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}", compression=None)
            self.sha, self.bytes, self.records = hashlib.sha256(), 0, 0
            self._put(info_record(self.file))
        self._put(data)
        self.records += 1

    def _put(self, data: bytes):
        self.out.write(data)
        self.sha.update(data)
        self.bytes += len(data)


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat another's payload."""
    ids = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"),
                       F.octet_length("html").alias("size")).filter(F.col("size") >= least)
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    return (ids.join(first.filter((F.col("n") > 1) & F.col("refers_to").isNotNull()), "digest")
            .filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct())


def _bounds(pages: DataFrame) -> np.ndarray:
    """First ids of all shards but the first."""
    total = pages.agg(F.count("page_id"), F.sum(F.octet_length("html"))).first()
    shards = min(MAX_SHARDS, -(-int(total[1] or 0) // SHARD_BYTES))
    if shards < 2:
        return np.zeros(0, np.int64)
    each = max(1, total[0] // SAMPLE)
    ids = pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(each)) == 0).select("page_id").filter(F.col("page_id").isNotNull())
    found = np.sort(ids.toArrow().column(0).to_numpy())
    return np.unique(found[np.arange(1, shards) * found.size // shards]) if found.size else np.zeros(0, np.int64)


def write(pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes page_id, url and html to files in the folder; returns the manifest."""
    pages = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    bounds = _bounds(pages)

    @F.pandas_udf("bigint")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right"))

    marks = _revisits(pages, least)
    rows = (pages.withColumns({"digest": F.lit(None).cast("string"), "refers_to": F.lit(None).cast("bigint")})
            .unionByName(marks.withColumns({"url": F.lit(None).cast("string"), "html": F.lit(None).cast("string")})))
    rows = rows.withColumn("shard", shard_of(F.coalesce("page_id", F.lit((1 << 63) - 1))))
    # A mark comes before the page that it is about.
    rows = (rows.repartition(len(bounds) + 1, "shard")
            .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), F.col("html").asc_nulls_first()))

    def work(batches):
        out, marked, current = Roller(folder, roll), {}, object()
        for batch in batches:
            for row in batch.to_pylist():
                if row["page_id"] != current:
                    marked, current = {}, row["page_id"]
                if row["html"] is None:
                    marked[row["digest"]] = row["refers_to"]
                    continue
                payload = row["html"].encode()
                refers_to = marked.get(hashlib.sha1(payload).hexdigest()) if marked else None
                out.write(row["shard"], page_record(row["page_id"], row["url"], payload, refers_to, refers_to is not None))
        out.close()
        yield from C.to_batches(dict(zip(("file", "temporary", "shard", "records", "bytes", "sha256"),
                                         map(list, zip(*out.rows))))) if out.rows else ()

    done = C.stored(C.map_batches(rows, work, MANIFEST))

    def rename(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{root}/{row['temporary']}", f"{root}/{row['file']}"
                if store.get_file_info(old).type != fs.FileType.NotFound:
                    store.move(old, new)
                elif store.get_file_info(new).type == fs.FileType.NotFound:
                    raise FileNotFoundError(new)
            yield batch

    manifest = f"{folder}/manifest"
    C.map_batches(done, rename, MANIFEST).write.parquet(manifest)
    return done.sparkSession.read.parquet(manifest)


# --- reading ----------------------------------------------------------------------------

def records(stream):
    """(offset, headers, block) of each record of a file of gzip members, one at a time."""
    held, offset, ended = b"", 0, False
    while True:
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not held:
                held = b"" if ended else stream.read(1 << 20)
                ended = not held
                if ended:
                    if used:
                        raise EOFError("a record is cut off")
                    return
            parts.append(unpack.decompress(held))
            used += len(held) - len(unpack.unused_data)
            held = unpack.unused_data
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield offset, headers, rest[:int(headers["Content-Length"])]
        offset += used


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The page records of the files in a manifest, their digests checked."""

    def work(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for offset, head, block in records(stream):
                        kind = head["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        named = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(head["X-Payload-Length"])
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if digest(payload) != named or len(payload) != size:
                                raise ValueError(f"{file}: digest of the record at {offset}")
                        page, refers = head.get("X-Page-Id"), head.get("X-Refers-To-Page-Id")
                        rows.append((page and int(page), size, named, kind, refers and int(refers),
                                     head["WARC-Target-URI"], file, offset))
                        if len(rows) == 4096:
                            yield from _table(rows)
                            rows = []
                if rows:
                    yield from _table(rows)

    # By number, so that Spark does not join the few rows of the manifest to one task again.
    size = manifest.agg(F.count("*"), F.sum("bytes")).first()
    tasks = min(size[0], 1 + (size[1] or 0) // READ_BYTES)
    return C.map_batches(manifest.select("file").repartition(max(1, tasks)), work, RECORDS)


def _table(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return C.to_batches({n: pa.array(v, k) for n, v, k in zip(names, zip(*rows), kinds)})
