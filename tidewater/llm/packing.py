"""Best-fit packing of token sequences, improved by a swap-based local search.

Documents are tokenized, closed with an end id and cut into pieces of `capacity` tokens, of
which only the first may be shorter. Full pieces are sequences of their own. Short pieces are
dealt at random over shards of about SHARD_PIECES; a shard is packed best-fit, largest first,
and then improved: pieces of the emptier of two underfull bins move to the fuller, or are
exchanged one for one or two for one against smaller ones there, whenever the sum of squared
fills grows, until bins empty, the bound of total size / capacity is reached or PASSES passes
are made. A shard wastes less than a few sequences, so the number of shards hardly matters.

Only piece lengths and checksums are shuffled, never tokens. Null and empty texts are one piece
with the end id. Repeated rows are packed as often as they occur; of the columns only doc_id
and text are used.
"""

from __future__ import annotations

import base64
import math
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
END_ID = 2
SHARD_PIECES = 8192
PASSES = 6
#: Text chunks that a task remembers with their ids.
MEMO_CHUNKS = 200_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
SEQUENCES = f"{PIECES}, sequence_id bigint, offset bigint"


# --- tokens -----------------------------------------------------------------------------

class Encoder:
    """Token ids of texts, as the tokenizer file gives them, with the end id.

    The byte-pair merges never cross a split of the text, and the text is split before every
    single blank or line end. So a chunk between those has the same ids wherever it stands:
    chunks are encoded once and their ids put together. Texts with other white space or
    longer runs of it are encoded whole."""

    SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
    RUNS = [a + b + c for a in " \n" for b in " \n" for c in " \n"]

    def __init__(self, tokenizer: str, ranks: str, pattern: str, end_id: int):
        import tiktoken
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.path, self.whole = tokenizer, None
        self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.size = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.size[rank] = len(token)
        with open(tokenizer, encoding="utf-8") as f:
            self.special = re.findall(r'"content": ?"([^"]+)"', f.read(4000))
        self.end_id = end_id
        self.forget()

    def forget(self):
        """An empty memory that holds only the end id, as number 0."""
        self.number = C.Numbers()
        self.ids = np.array([self.end_id], np.uint32)
        self.first, self.count = np.zeros(1, np.int64), np.ones(1, np.int64)

    def _add(self, ids: np.ndarray, firsts: np.ndarray, counts: np.ndarray):
        self.first = np.concatenate([self.first, self.ids.size + firsts])
        self.count = np.concatenate([self.count, counts])
        self.ids = np.concatenate([self.ids, ids])

    def _entire(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path)
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _learn(self, chunks: list[str]):
        """Ids of new chunks, encoded in one go. A chunk that begins a text has a tab in
        front; it is encoded after a line end, which is then passed over. The two chunks
        that are white space alone would run together with others and come last."""
        firsts, counts = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        blank = [i for i, c in enumerate(chunks) if c in ("", "\n")]
        solid = [i for i, c in enumerate(chunks) if c not in ("", "\n")]
        head = np.fromiter((chunks[i][0] == "\t" for i in solid), np.int64, len(solid))
        pieces = [c if c[0] == "\n" else "\n" + c[1:] if c[0] == "\t" else " " + c
                  for c in map(chunks.__getitem__, solid)]
        ids = self.fast.encode_ordinary("".join(pieces))
        if solid:
            ends = np.cumsum(self.size[np.array(ids, np.int64)])
            sizes = np.fromiter((len(p.encode()) for p in pieces), np.int64, len(pieces))
            cut = np.searchsorted(ends, np.cumsum(sizes)) + 1
            begin = np.concatenate([[0], cut[:-1]]) + head
            firsts[solid], counts[solid] = begin, cut - begin
        for i in blank:
            more = self.fast.encode_ordinary(chunks[i] or " ")
            firsts[i], counts[i] = len(ids), len(more)
            ids += more
        self._add(np.array(ids, np.uint32), firsts, counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of ids of each."""
        if len(self.number) > MEMO_CHUNKS or self.ids.size > 8 * MEMO_CHUNKS:
            self.forget()
        lists, alone, number = [], {}, self.number.__getitem__
        self.number.next, self.number.fresh = self.first.size, []
        for i, text in enumerate(texts):
            if (text[-2:].isspace() and len(text) > 1 or any(c in text for c in self.SPACES)
                    or any(r in text for r in self.RUNS) or any(s in text for s in self.special)):
                alone[i] = self._entire(text)
                lists.append(None)
                continue
            chunks = text.replace("\n", " \n").split(" ")
            if chunks[0]:
                chunks[0] = "\t" + chunks[0]
            else:
                del chunks[0]
            lists.append(np.fromiter(map(number, chunks), np.int64, len(chunks)))
        if self.number.fresh:
            self._learn(self.number.fresh)
        for i, ids in alone.items():
            lists[i] = np.array([self.first.size], np.int64)
            self._add(np.array(ids, np.uint32), np.zeros(1, np.int64), np.array([len(ids)], np.int64))
        end = np.zeros(1, np.int64)
        chunk = np.concatenate([x for one in lists for x in (one, end)]) if lists else end[:0]
        counts = self.count[chunk]
        total = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.first[chunk] - total[:-1], counts) + np.arange(total[-1])
        last = np.cumsum([x.size + 1 for x in lists]) if lists else end[:0]
        return self.ids[at], np.diff(np.concatenate([[0], total[last]]))


def pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length and the checksum of the ids."""

    def work(batches):
        encoder = Encoder(tokenizer, ranks, pattern, end_id)
        for rows, texts in C.slices(batches):
            ids, counts = encoder.encode([t.decode() for t in texts])
            doc, piece, start, length, crc = [], [], [], [], []
            at = 0
            for i, n in enumerate(counts.tolist()):
                size = n - (n - 1) // capacity * capacity
                begin = 0
                for p in range((n - 1) // capacity + 1):
                    doc.append(i)
                    piece.append(p)
                    start.append(begin)
                    length.append(size)
                    crc.append(zlib.crc32(ids[at + begin:at + begin + size].astype("<u4").tobytes()))
                    begin, size = begin + size, capacity
                at += n
            yield from C.to_batches({"doc_id": rows.column("doc_id").take(pa.array(doc, pa.int64())),
                                     "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                                     "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return C.map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, PIECES)


# --- bins -------------------------------------------------------------------------------

def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece: the fullest one that still has room, largest pieces first."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, bins = 0, 0  # there: bit r is set if a bin with r places left exists
    out = np.zeros(sizes.size, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = there >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                there &= ~(1 << left)
        else:
            b, left = bins, capacity
            bins += 1
        out[i] = b
        left -= size
        room[left].append(b)
        there |= 1 << left
    return out


def improve(sizes: np.ndarray, bins: np.ndarray, capacity: int, passes: int = PASSES) -> np.ndarray:
    """Local search from a packing; the number of bins never grows."""
    bins, n = bins.copy(), int(bins.max(initial=-1)) + 1
    fill = np.bincount(bins, sizes, n).astype(np.int64)
    least = math.ceil(int(sizes.sum()) / capacity)
    used = n
    for _ in range(passes):
        changed = False
        for a in np.argsort(fill, kind="stable").tolist():
            if used <= least:
                return bins
            if not 0 < fill[a] < capacity:
                continue
            while True:
                step = _step(sizes, bins, fill, capacity, a)
                if not step:
                    break
                gone, back, b = step
                for i in gone:
                    bins[i] = b
                if back is not None:
                    bins[back] = a
                moved = int(sizes[gone].sum()) - (int(sizes[back]) if back is not None else 0)
                fill[a] -= moved
                fill[b] += moved
                changed = True
                if fill[a] == 0:
                    used -= 1
                    break
        if not changed:
            break
    return bins


def _step(sizes, bins, fill, capacity, a):
    """The best exchange that moves load from bin a to another: pieces that go, the piece that
    comes back or None, and the other bin."""
    own = np.flatnonzero(bins == a)
    room = capacity - fill
    others = np.flatnonzero((room > 0) & (fill > 0))
    others = others[others != a]
    if not others.size:
        return None
    fits = sizes[own].min() <= room[others].max()
    if fits:  # a move: the largest piece that has room elsewhere, where it fits best
        for i in own[np.argsort(-sizes[own], kind="stable")].tolist():
            b = others[room[others] >= sizes[i]]
            if b.size:
                b = b[np.argmin(room[b])]
                if fill[b] + sizes[i] > fill[a]:
                    return [i], None, int(b)
    there = np.flatnonzero((room[bins] > 0) & (bins != a))
    best, found = 0, None
    groups = [[i] for i in own.tolist()]
    if own.size <= 16:
        groups += [[i, j] for k, i in enumerate(own.tolist()) for j in own[k + 1:].tolist()]
    for gone in groups:
        more = int(sizes[gone].sum()) - sizes[there]
        b = bins[there]
        gain = np.where((more > 0) & (more <= room[b]), more * (fill[b] - fill[a] + more), 0)
        k = int(np.argmax(gain)) if gain.size else 0
        if gain.size and gain[k] > best:
            best, found = gain[k], (gone, int(there[k]), int(b[k]))
    return found


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset; negative ids are those of full pieces."""
    parts = C.stored(parts).withColumn("_row", F.monotonically_increasing_id())
    short = parts.filter(F.col("length") < capacity)
    shards = max(1, math.ceil(short.count() / SHARD_PIECES))
    short = short.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))

    def work(rows: pa.Table) -> pa.Table:
        sizes = rows.column("length").to_numpy()
        shard = rows.column("_shard")[0].as_py()
        bins = improve(sizes, best_fit(sizes, capacity), capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        new = np.ones(order.size, bool)
        new[1:] = bins[order][1:] != bins[order][:-1]
        begin = (ends - sizes[order])[np.flatnonzero(new)]
        offset = np.zeros(order.size, np.int64)
        offset[order] = ends - sizes[order] - begin[np.cumsum(new) - 1]
        return (rows.drop_columns(["_row", "_shard"]).append_column("sequence_id", pa.array(bins + (shard << 32)))
                .append_column("offset", pa.array(offset)))

    full = parts.filter(F.col("length") >= capacity).drop("_row").withColumns({
        "sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})
    return full.unionByName(short.groupBy("_shard").applyInArrow(work, SEQUENCES))
