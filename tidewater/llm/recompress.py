"""Substring dedup by recompression: words covered by a run of `window` words that also
starts in a document with a smaller id.

Texts are recompressed in ROUNDS rounds: a coin, taken from the symbol's name and the round,
makes each symbol a left or a right one, and a left symbol followed by a right one becomes a
new symbol. The name of a symbol is a hash of what it is made of, so tasks name alike without
asking each other, and equal substrings get equal symbols except for the first 2**ROUNDS - 1
words at each end, which neighbours outside can draw in. Symbols that repeat (runs) never
merge with each other, as they have the same coin; a run is named by its symbol, whatever its
length, so a run that is cut off by the end of a window is still the same run.

A phrase is a symbol with those that follow, up to PHRASE words or a little more. The anchor of
a window is the smallest name among the phrases that begin early enough in its interior to
lie in it whole: equal windows have the same. So high-level phrases that repeat, counted over
all documents, reveal where long repeats can be; windows with other anchors have none. Of the
windows left, names of all `window` words are compared: within groups of equal anchors, or,
for frequent anchors, by counting them over all tasks (see repeats.py). Each gets the smallest
id of a document that has it, equal segments of windows being merged before.

The rules: words are runs of anything but ASCII white space, unchanged. Null, empty and short
texts lose nothing. Equal ids count as one document that never makes another's words repeat;
equal rows get equal results. A null id is larger than all others.
"""

from __future__ import annotations

import hashlib
import sys
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import graph as G
from . import repeats as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(R)
cloudpickle.register_pickle_by_value(G)

WINDOW = 50
#: Rounds of pairing, after which a symbol has 2**ROUNDS words at most, and words of a phrase.
ROUNDS, PHRASE = 2, 12
#: Bytes of window names that a task holds before it hands them over.
HELD_BYTES = 32 << 20
LAST = (1 << 63) - 1

PIECES = "kind int, row bigint, doc bigint, start bigint, segment bigint, anchor bigint, hot boolean, data binary"
VERDICT = "segment bigint, begin bigint, stop bigint, least bigint"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def symbols(name: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols after some rounds, and the word at which each begins; none crosses the
    end of a text. first: the first word of each text, and the number of words."""
    symbol, start = name, np.arange(name.size)
    head = np.zeros(name.size + 1, bool)
    head[first] = True
    for turn in range(rounds):
        if symbol.size < 2:
            break
        salt = C.U((turn + 1) * int(C.GOLD) % (1 << 64))
        coin = (C.mixed(symbol + salt) >> C.U(63)).astype(bool)
        pair = np.zeros(symbol.size, bool)
        pair[:-1] = ~coin[:-1] & coin[1:] & ~head[start[1:]]
        drawn = np.zeros(symbol.size, bool)
        drawn[1:] = pair[:-1]
        new = symbol.copy()
        at = np.flatnonzero(pair)
        new[at] = C.joined_name(symbol[at], symbol[at + 1])
        symbol, start = new[~drawn], start[~drawn]
    return symbol, start


def anchored(words: C.Words, window: int, rounds: int, phrase: int):
    """Segments of all texts: text number, start, windows and anchor.

    A window of w words starting at p takes the phrases that begin in [p + m, p + w - m - l],
    m = 2**rounds - 1 and l = phrase + 2**rounds - 1 words at most; the interval holds the
    beginning of a symbol as it is no shorter than 2**rounds."""
    name = words.name
    first = words.first
    none = np.zeros(0, np.int64)
    margin, longest = 2 ** rounds - 1, phrase + 2 ** rounds - 1
    width = window - 2 * margin - longest + 1
    if name.size < window:
        return none, none, none, none.astype(np.uint64)
    symbol, start = symbols(name, first, rounds)
    # The phrase at a symbol: all symbols up to the first one that begins `phrase` words on.
    stop = np.searchsorted(start, start + phrase)
    place = np.cumsum(np.concatenate([[C.U(0)], symbol * _powers(symbol.size)]), dtype=np.uint64)
    whole = (place[stop] - place[:-1]) * _powers(symbol.size, inverse=True)
    value = np.full(name.size, np.iinfo(np.uint64).max)
    value[start] = np.minimum(C.mixed(whole), np.iinfo(np.uint64).max - C.U(1))
    least = R.minima(value, width)  # of beginnings in [i, i + width)
    anchor = least[margin:margin + name.size - window + 1]
    begin, size = R.runs(anchor, C.within(first, window, name.size))
    held = anchor[begin]
    text = np.searchsorted(first, begin, "right") - 1
    return text, begin - first[text], size, held


_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd base modulo 2**64, or of its inverse."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _anchors(docs: DataFrame, window: int, rounds: int, phrase: int) -> DataFrame:
    def work(batches):
        for rows, texts in C.slices(batches):
            words = C.Words(texts)
            text, start, size, anchor = anchored(words, window, rounds, phrase)
            yield from C.to_batches({"anchor": anchor.view(np.int64), "row": rows.column("row").take(pa.array(text)),
                                     "start": start, "n": size.astype(np.int32), "times": np.ones(size.size, np.int32)})

    return C.map_batches(docs.select("row", "text"), work, R.ANCHORS)


def _pieces(fetched: DataFrame, window: int) -> DataFrame:
    """kind 0: the place (row, start) of a segment, with the document; kind 1: a segment's
    window names, once for each task that met it, with the smallest document."""

    def work(batches):
        places, held, size = [], {}, 0

        def flush():
            out = [(0, *p, None, None, None) for p in places]
            out += [(1, None, doc, None, name, anchor, hot, data) for name, (doc, anchor, hot, data) in held.items()]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            return C.to_batches({n: pa.array(v, k) for n, v, k in zip(names, zip(*out), kinds)}) if out else ()

        for rows, texts in C.slices(batches):
            words = C.Words(texts)
            gram = C.grams(words.name, window)
            for i, (row, doc, wanted) in enumerate(zip(rows.column("row").to_pylist(), rows.column("doc_id").to_pylist(),
                                                       rows.column("segments").to_pylist())):
                doc = LAST if doc is None else doc
                at = int(words.first[i])
                for s in wanted:
                    data = gram[at + s["start"]:at + s["start"] + s["n"]].tobytes()
                    name = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)
                    old = held.get(name)
                    held[name] = (min(doc, old[0]) if old else doc, s["anchor"], s["hot"], data)
                    size += 40 if old else len(data) + 200
                    places.append((row, doc, s["start"], name))
            if size > HELD_BYTES:
                yield from flush()
                places, held, size = [], {}, 0
        yield from flush()

    return C.stored(C.map_batches(fetched.select("row", "doc_id", "text", "segments"), work, PIECES))


def _runs(owner: np.ndarray, least: np.ndarray, first: np.ndarray):
    """Runs of equal least documents inside segments."""
    edge = np.ones(owner.size, bool)
    edge[1:] = (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
    begin = np.flatnonzero(edge)
    stop = np.append(begin[1:], owner.size)
    return owner[begin], begin - first[owner[begin]], stop - first[owner[begin]], least[begin]


def _settled(segments: DataFrame) -> DataFrame:
    """The smallest document of every window, by segment, for segments with few of the same
    anchor; one row for each segment."""

    def settle(tables):
        data = [np.frombuffer(x, np.uint64) for t in tables for x in t.column("data").cast(pa.large_binary()).to_pylist()]
        segment = np.concatenate([t.column("segment").to_numpy() for t in tables])
        doc = np.concatenate([t.column("doc").to_numpy() for t in tables])
        anchor = np.concatenate([t.column("anchor").to_numpy() for t in tables]).view(np.uint64)
        size = np.fromiter(map(len, data), np.int64, len(data))
        first = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(size.size), size)
        key = C.joined_name(np.concatenate(data), anchor[owner])
        order = np.lexsort((doc[owner], key))
        new = np.ones(key.size, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        least = np.zeros(key.size, np.int64)
        least[order] = doc[owner][order][np.flatnonzero(new)][np.cumsum(new) - 1]
        who, begin, stop, low = _runs(owner, least, first)
        yield from C.to_batches({"segment": segment[who], "begin": begin, "stop": stop, "least": low})

    def work(batches):
        held, size = [], 0
        for table in R.grouped(batches, "anchor"):
            held.append(table)
            size += table.nbytes
            if size > C.SLICE_BYTES:
                yield from settle(held)
                held, size = [], 0
        if held:
            yield from settle(held)

    rows = segments.filter(~F.col("hot")).select("anchor", "segment", "doc", "data")
    return C.map_batches(rows.repartition(F.col("anchor")).sortWithinPartitions("anchor"), work, VERDICT)


def _frequent(segments: DataFrame) -> DataFrame:
    """The same for frequent anchors, by window over all tasks."""

    def windows(batches):
        for batch in batches:
            data = [np.frombuffer(x, np.uint64) for x in batch.column("data").cast(pa.large_binary()).to_pylist()]
            size = np.fromiter(map(len, data), np.int64, len(data))
            owner = np.repeat(np.arange(size.size), size)
            place = np.arange(owner.size) - np.repeat(np.cumsum(size) - size, size)
            if data:
                yield from C.to_batches({"segment": batch.column("segment").take(pa.array(owner)), "begin": place,
                                         "w": np.concatenate(data).view(np.int64), "doc": batch.column("doc").take(pa.array(owner))})

    every = C.map_batches(segments.filter("hot").select("segment", "doc", "data"), windows,
                          "segment bigint, begin bigint, w bigint, doc bigint")
    least = every.groupBy("w").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter(F.col("least") < F.col("most"))
    return every.join(least, "w").select("segment", "begin", (F.col("begin") + 1).alias("stop"), "least")


def spans(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, phrase: int = PHRASE) -> DataFrame:
    """(row, spans): where windows begin, as pieces [begin, stop), that a smaller document
    has too; for keyed documents."""
    found = R.repeated(_anchors(docs, window, rounds, phrase))
    pieces = _pieces(R.with_text(docs, R.lists(found, "anchor")), window)
    segments = C.stored(pieces.filter(F.col("kind") == 1).groupBy("segment", "anchor", "hot")
                        .agg(F.min("doc").alias("doc"), F.first("data").alias("data")))
    places = pieces.filter(F.col("kind") == 0).select("segment", "row", "doc", "start")
    whole = segments.select("segment", F.lit(0).cast("bigint").alias("begin"),
                            F.expr("octet_length(data) div 8").alias("stop"), F.col("doc").alias("least"))
    verdicts = _settled(segments).unionByName(_frequent(segments)).unionByName(whole)
    return C.stored(places.join(verdicts, "segment").filter(F.col("least") < F.col("doc")).groupBy("row").agg(
        F.collect_set(F.struct((F.col("start") + F.col("begin")).alias("begin"),
                               (F.col("start") + F.col("stop")).alias("stop"))).alias("spans")))


def _finished(rows: DataFrame, window: int, with_text: bool, sent=None) -> DataFrame:
    """The result for rows with spans; or, if a filter is given, for those outside it, which
    have none. The filter is tried here, as a step of its own would take a second worker."""
    def work(batches):
        for table, texts in C.slices(R.passing(batches, sent.value, False) if sent else batches):
            out = []
            for text, found in zip(texts, repeat(None) if sent else table.column("spans").to_pylist()):
                words = text.split()
                kept, at = [], 0
                for s in sorted(found or [], key=lambda s: s["begin"]):
                    kept += words[at:s["begin"]]
                    at = max(at, s["stop"] + window - 1)
                kept += words[at:]
                left = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest(), left.decode()))
            n, removed, sha, left = map(list, zip(*out))
            more = {"kept": pa.array(left, pa.string())} if with_text else {}
            yield from C.to_batches({"doc_id": table.column("doc_id"), "n_words": pa.array(n, pa.int64()),
                                     "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string()), **more})

    where = G.place_in_filter("row").alias("_place") if sent else "spans"
    return C.map_batches(rows.select("doc_id", "text", where), work, RESULT + ", kept string" * with_text)


def removed(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, phrase: int = PHRASE,
            with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256; the words that are left, joined by one
    blank, as well, if asked for."""
    docs = R.keyed(docs)
    found = spans(docs, window, rounds, phrase)
    sent = R.sent_filter(found, "row")
    touched = R.filtered(docs, sent, "row", True).join(found, "row", "left")
    return _finished(touched, window, with_text).unionByName(_finished(docs, window, with_text, sent))
