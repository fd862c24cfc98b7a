"""What the operators share: batch mapping, intermediate tables, word and n-gram hashes.

Functions sent to workers are pickled by value, so the workers need no copy of the package.
Names are 64-bit hashes of the content, computed alike by every task; two different
strings get the same name with a probability of about n * n / 2**65 for n strings.
"""

from __future__ import annotations

import contextlib
import os
import sys
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of an Arrow batch. Texts may be long, so a batch is kept small.
BATCH_ROWS = 512
#: Bytes of text that a task works on at once.
SLICE_BYTES = 1 << 20

U = np.uint64
GOLD, MIX_A, MIX_B = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xC2B2AE3D27D4EB4F)

#: ASCII white space, the separators of the word pattern [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and bytes beyond ASCII.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# --- tables -----------------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below spark.checkpoint.dir, which all executors share. Where
    that is unset a temporary folder takes its place, in a session of one process, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Spark's setting that removes what an execution has shuffled when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _cleaned(spark: SparkSession):
    """What a write shuffles is read by nothing else: it goes with the write, and not when the
    driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a table in the shared folder and read again: later work starts
    there, also after executors are lost."""
    path = shared_folder(df.sparkSession)
    with _cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, work, schema) -> DataFrame:
    """work(iterator of record batches) on small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


def slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """Record batches cut or joined to about `limit` bytes of the column, with its values as bytes;
    null counts as empty."""
    held, texts, size = [], [], 0

    def flush():
        out = pa.Table.from_batches(held).combine_chunks()
        return out, texts

    for batch in batches:
        values = batch.column(column).cast(pa.large_binary()).to_pylist()
        first = 0
        for i, value in enumerate(values):
            texts.append(value or b"")
            size += len(value or b"") + 64
            if size >= limit:
                held.append(batch.slice(first, i + 1 - first))
                yield flush()
                held, texts, size, first = [], [], 0, i + 1
        if first < len(values):
            held.append(batch.slice(first))
    if held:
        yield flush()


def to_batches(arrays: dict, schema: pa.Schema | None = None):
    out = pa.table(arrays, schema=schema)
    return out.combine_chunks().to_batches(max_chunksize=1 << 16)


def shielded(docs: DataFrame, work, *names: str) -> DataFrame:
    """The rows that work(docs) keeps, with the columns of docs, also where those have the
    names of columns that work adds."""
    prefix = "_own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    own = {c: f"{prefix}{c}" for c in docs.columns if c.lower() in names}
    kept = work(docs.withColumnsRenamed(own))
    return kept.drop(*names).withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def crc_of(value) -> int:
    return zlib.crc32(str(value).encode())


# --- hashes -----------------------------------------------------------------------------

def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * MIX_A
    return h ^ (h >> U(29))


def joined_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two neighbours, in this order."""
    return mixed(a * MIX_B + b)


class Words:
    """The words of several texts: names, and where they lie.

    name: uint64 for each word, never 0; first: for each text the index of its first word,
    and the number of words at the end; start, end: byte positions in `data`, all texts
    with a blank between them; at: byte position of each text there."""

    def __init__(self, texts: list[bytes], apart: np.ndarray = BLANK, lower: bool = False):
        self.data = b" ".join([*texts, b" " * 16])
        raw = np.frombuffer(self.data, np.uint8)
        if lower:
            raw = LOWER[raw]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.concatenate([[0], np.cumsum(sizes + 1)])
        gap = apart[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.at)
        self.name = self._names(raw)

    def _names(self, raw: np.ndarray) -> np.ndarray:
        raw = np.ascontiguousarray(raw)
        eight = np.ndarray(shape=(max(raw.size - 7, 0),), dtype="<u8", buffer=raw, strides=(1,))
        size = self.end - self.start
        name = mixed(size.astype(U) * GOLD + U(1))
        rows, at, left = np.arange(size.size), self.start, size
        while rows.size:
            part = eight[at]
            short = left < 8
            part[short] &= (U(1) << (left[short] * 8).astype(U)) - U(1)
            name[rows] = joined_name(name[rows], part)
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        name[name == 0] = U(1)
        return name

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


class Numbers(dict):
    """Numbers of strings; one that is new gets the next number and is kept in fresh."""

    def __init__(self):
        super().__init__()
        self.next, self.fresh = 1, []

    def __missing__(self, string):
        out = self[string] = self.next + len(self.fresh)
        self.fresh.append(string)
        return out


def grams(name: np.ndarray, n: int) -> np.ndarray:
    """Names of all n consecutive values; empty if there are fewer. Built by doubling."""
    count = name.size - n + 1
    if count <= 0:
        return name[:0]
    out, at, size, level = None, 0, 1, name
    while True:
        if n & size:
            part = level[at:at + count]
            out = part if out is None else joined_name(out, part)
            at += size
        if size * 2 > n:
            return mixed(out + U(n))
        level = joined_name(level[:level.size - size], level[size:])
        size *= 2


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the n-grams of `total` values lie inside one group; first: group starts."""
    ok = np.zeros(max(total - n + 1, 0), bool)
    if not ok.size:
        return ok
    step = np.zeros(ok.size + 1, np.int64)
    lo, hi = first[:-1], np.maximum(first[1:] - n + 1, first[:-1])
    keep = hi > lo
    np.add.at(step, lo[keep], 1)
    np.add.at(step, hi[keep], -1)
    ok[:] = np.cumsum(step[:-1]) > 0
    return ok


def covered(starts: np.ndarray, lengths, total: int) -> np.ndarray:
    """Which of `total` places lie in one of the spans."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def group_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between the group starts; empty groups give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
