"""Suffix-array dedup: bytes covered by a string of `window` bytes that starts elsewhere too.

A sparse suffix array of all documents is built by a distributed merge sort. Its suffixes
start at anchors: the smallest name of a gram of GRAM bytes in each window (minimizer), so
every window has one, and equal windows have theirs at the same place. Suffixes whose anchor
occurs only once cannot match and are left out before the sort.

A suffix here is the text from the anchor to the end of the last window of the segment,
followed by the text before the anchor read backwards; so it holds all windows around the
anchor. Tasks sort their suffixes, merge equal ones, and hand over runs for ranges of suffixes,
front-coded: each suffix as the length of the prefix it shares with the one before and the
rest. A task gets all runs of a range and merges them with a loser tree that carries the shared
prefix lengths along; prefixes known to be equal are never compared again. Where the prefix
shared by neighbours is shorter than the gram a new group of matches begins; inside a group
the windows that occur twice are settled exactly.

Ranges are cut at grams sampled from the runs, so a group lies in one range. Groups of frequent
anchors could be of any size. Their segments, equal ones merged, are taken as texts and go through
the same steps with a longer gram, which tells more of them apart; those whose anchor is still
frequent go on with a longer one, and the last gram is the window.

Null texts are empty, and texts shorter than the window lose nothing. Equal rows count as
occurrences of their own, so their windows repeat. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
import sys
from array import array
from bisect import bisect_right
from itertools import chain, groupby, islice, repeat

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

WINDOW, GRAM = 200, 48
#: Bytes of suffixes in a run, segments that a range should have, and most ranges.
RUN_BYTES, RANGE_SEGMENTS, MAX_RANGES = 32 << 20, 20_000, 20_000
#: Bytes of text that a task makes names of at once; they take some hundred bytes for each.
SLICE = 1 << 18
#: One anchor in so many gives its gram as a sample for the ranges' bounds; of those SAMPLE.
SAMPLE_EVERY, SAMPLE = 64, 50_000

ANCHORS = f"{R.ANCHORS}, twice boolean, head binary"
PIECES = "kind int, row bigint, start bigint, segment bigint, data binary, size bigint, range int"
VERDICT = "segment bigint, begin bigint, stop bigint"


# --- anchors ----------------------------------------------------------------------------

def anchored(texts: list[bytes], window: int, gram: int):
    """Segments of all texts: text number, start, windows, anchor and its occurrences."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    if data.size < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    name = C.grams(data.astype(np.uint64) + C.GOLD, gram)
    least = R.minima(name, window - gram + 1)
    start, size = R.runs(least, C.within(first, window, data.size))
    anchor = least[start]
    # How often a segment holds its anchor: among the places that are minima of some window.
    place = np.flatnonzero(_is_minimum(name, least, window - gram + 1))
    low, high = np.searchsorted(place, start), np.searchsorted(place, start + size + window - gram)
    owner = np.repeat(np.arange(start.size), high - low)
    nth = np.arange(owner.size) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    times = np.bincount(owner, name[place[low[owner] + nth]] == anchor[owner], start.size).astype(np.int64)
    text = np.searchsorted(first, start, "right") - 1
    return text, start - first[text], size, anchor, np.clip(times, 1, 2)


def _is_minimum(name: np.ndarray, least: np.ndarray, width: int) -> np.ndarray:
    """Places whose name is the smallest of some window."""
    # least[i] is the minimum of name[i:i + width]; place p is one if it equals any of
    # least[p - width + 1 .. p], of which the largest is the maximum of minima.
    pad = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    high = ~R.minima(~pad, width)
    return high[:name.size] == name


# --- runs -------------------------------------------------------------------------------

class Suffixes:
    """The suffixes of the segments of some texts. The names of all grams are made at once; a
    segment only looks for the smallest of its own."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        self.texts, self.window, self.gram = texts, window, gram
        self.first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).tolist()
        self.name = C.grams(np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + C.GOLD, gram)

    def at(self, text: int, start: int, n: int) -> tuple[bytes, bytes, int]:
        """The bytes of a segment of n windows, its suffix at its anchor, and the number of bytes
        before the anchor."""
        place = self.first[text] + start
        at = int(self.name[place:place + n + self.window - self.gram].argmin())
        piece = self.texts[text][start:start + n + self.window - 1]
        return piece, piece[at:] + piece[:at][::-1], at


def segment_name(suffix: bytes, before: int) -> int:
    return int.from_bytes(hashlib.blake2b(suffix, digest_size=8, salt=before.to_bytes(8, "little")).digest(),
                          "little", signed=True)


def encoded(items: list[tuple[bytes, int, int, bool]]) -> bytes:
    """A sorted run (suffix, bytes before the anchor, name, whether it occurred twice),
    front-coded."""
    out, last = [], b""
    for suffix, before, name, twice in items:
        same = shared(last, suffix, 0)
        out.append(len(suffix).to_bytes(4, "little") + same.to_bytes(4, "little") + before.to_bytes(3, "little")
                   + bytes([twice]) + name.to_bytes(8, "little", signed=True))
        out.append(suffix[same:])
        last = suffix
    return b"".join(out)


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    other = int.from_bytes(a[known:end], "big") ^ int.from_bytes(b[known:end], "big")
    return end - (other.bit_length() + 7) // 8


def decoded(run: bytes):
    """The items of a run with the length that each shares with the one before."""
    at, last = 0, b""
    while at < len(run):
        size, same = int.from_bytes(run[at:at + 4], "little"), int.from_bytes(run[at + 4:at + 8], "little")
        before, twice = int.from_bytes(run[at + 8:at + 11], "little"), run[at + 11] == 1
        name = int.from_bytes(run[at + 12:at + 20], "little", signed=True)
        at += 20
        last = last[:same] + run[at:at + size - same]
        at += size - same
        yield last, before, name, twice, same


class LoserTree:
    """Merges sorted runs. Every run's head carries the length of the prefix it shares with
    the last item given out; of two heads the one that shares more comes first, and only
    heads that share equally much are compared, from there on."""

    def __init__(self, sources: list):
        self.sources = [iter(s) for s in sources]
        k = max(1, len(self.sources))
        self.head = [next(s, None) for s in self.sources] + [None] * (k - len(self.sources))
        self.same = [0] * k
        self.k, self.loser = k, [-1] * k
        winner = [0] * (2 * k)
        for i in range(k):
            winner[k + i] = i
        for node in range(k - 1, 0, -1):
            winner[node], self.loser[node] = self._play(winner[2 * node], winner[2 * node + 1])
        self.first = winner[1] if k > 1 else 0

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then shares what it shares with the winner."""
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.same[a], self.same[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        s, t = x[0], y[0]
        n = shared(s, t, p)
        if n == len(s) or n < len(t) and s[n] < t[n]:
            self.same[b] = n
            return a, b
        self.same[a] = n
        return b, a

    def __iter__(self):
        """Items with the length of the prefix shared with the item before."""
        while self.head[self.first] is not None:
            run = self.first
            item = self.head[run]
            yield item, self.same[run]
            self.head[run] = item = next(self.sources[run], None)
            self.same[run] = item[4] if item else 0
            node, winner = (self.k + run) // 2, run
            while node:
                winner, self.loser[node] = self._play(winner, self.loser[node])
                node //= 2
            self.first = winner


# --- the operator -----------------------------------------------------------------------

def _anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """All segments, and for some anchors the gram. A text that occurs twice counts as two."""
    def work(batches):
        for rows, texts in C.slices(batches, limit=SLICE):
            text, start, size, anchor, times = anchored(texts, window, gram)
            twice = rows.column("twice").to_numpy()[text]
            every = (anchor & C.U(SAMPLE_EVERY - 1)) == 0
            head = np.full(anchor.size, None, object)
            if every.any():
                suffixes = Suffixes(texts, window, gram)
                for i in np.flatnonzero(every).tolist():
                    head[i] = suffixes.at(int(text[i]), int(start[i]), int(size[i]))[1][:gram]
            yield from C.to_batches({
                "anchor": anchor.view(np.int64), "row": rows.column("row").take(pa.array(text)), "start": start,
                "n": size.astype(np.int32), "times": np.where(twice, 2 * times, times).astype(np.int32),
                "twice": twice, "head": pa.array(head.tolist(), pa.binary())})

    return C.map_batches(docs.select("row", "text", "twice"), work, ANCHORS)


def _bounds(found: DataFrame) -> list[bytes]:
    """First grams of all ranges but the first."""
    cold = found.filter(~F.col("hot"))
    number = min(MAX_RANGES, cold.count() // RANGE_SEGMENTS + 1)
    heads = sorted(bytes(r["head"]) for r in cold.filter(F.col("head").isNotNull()).groupBy("anchor")
                   .agg(F.min("head").alias("head")).orderBy("anchor").limit(SAMPLE).select("head").collect())
    return sorted({heads[i * len(heads) // number] for i in range(1, number)}) if heads else []


def _pieces(fetched: DataFrame, bounds: list[bytes], window: int, gram: int) -> DataFrame:
    """What becomes of the wanted segments. kind 0: the place (row, start) of a segment, but not
    in texts that occur twice, which repeat as a whole; kind 1: a front-coded run for a range;
    kind 2: a segment of a frequent anchor, its text and how often the task met it."""

    def work(batches):
        places, cold, hot, size = [array("q") for _ in range(3)], {}, {}, 0

        def flush():
            rows, starts, names = (np.array(p, np.int64) for p in places)
            yield from batch(kind=np.zeros(rows.size, np.int32), row=rows, start=starts, segment=names)
            items = sorted((*key, name, count > 1) for key, (name, count) in cold.items())
            cut = [bisect_right(bounds, item[0][:gram]) for item in items]
            runs, at, held = [], 0, 0
            for number, same in groupby(cut):
                n = len(list(same))
                runs.append((number, encoded(items[at:at + n])))
                at, held = at + n, held + len(runs[-1][1])
                if held > C.SLICE_BYTES or at == len(items):
                    yield from batch(kind=[1] * len(runs), range=[n for n, _ in runs], data=[run for _, run in runs])
                    runs, held = [], 0
            wide = iter(hot.items())
            while part := list(islice(wide, 4096)):
                yield from batch(kind=[2] * len(part), segment=[name for _, (name, _) in part], data=[piece for piece, _ in part],
                                 size=[count for _, (_, count) in part])

        def batch(**columns):
            n = len(columns["kind"])
            return C.to_batches({f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                 for f in kinds}) if n else ()

        kinds = [pa.field(*x) for x in (("kind", pa.int32()), ("row", pa.int64()), ("start", pa.int64()), ("segment", pa.int64()),
                                        ("data", pa.binary()), ("size", pa.int64()), ("range", pa.int32()))]
        for rows, texts in C.slices(batches, limit=SLICE):
            suffixes = Suffixes(texts, window, gram)
            for i, (row, twice, wanted) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("row", "twice", "segments")))):
                for s in wanted:
                    piece, suffix, before = suffixes.at(i, s["start"], s["n"])
                    held, key = (hot, piece) if s["hot"] else (cold, (suffix, before))
                    name, count = held.get(key) or (segment_name(suffix, before), 0)
                    size += 40 if count else 2 * len(piece) + 200
                    held[key] = (name, count + 1 + twice)
                    if not twice:
                        for column, value in zip(places, (row, s["start"], name)):
                            column.append(value)
            if size > RUN_BYTES:
                yield from flush()
                places, cold, hot, size = [array("q") for _ in range(3)], {}, {}, 0
        yield from flush()

    return C.stored(C.map_batches(fetched.select("row", "text", "twice", "segments"), work, PIECES))


def _text_of(suffix: bytes, before: int) -> bytes:
    cut = len(suffix) - before
    return suffix[cut:][::-1] + suffix[:cut]


def settle(items: list[tuple[int, bytes, bool]], groups: list[int], window: int):
    """(name, begin, stop) of the windows that occur twice in their group; items: name, text
    and whether the whole occurs twice."""
    data = np.frombuffer(b"".join(t for _, t, _ in items), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(t) for _, t, _ in items])])
    name = C.grams(data.astype(np.uint64) + C.GOLD, window)[C.within(first, window, data.size)]
    count = np.diff(first) - window + 1
    begin = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(items)), count)
    key = C.joined_name(name, np.array(groups, np.uint64)[owner] + C.GOLD)
    order = np.argsort(key, kind="stable")
    twin = np.zeros(key.size, bool)
    twin[1:] = key[order][1:] == key[order][:-1]
    twin[:-1] |= twin[1:]
    mask = np.zeros(key.size, bool)
    mask[order] = twin
    mask |= np.array([t for _, _, t in items], bool)[owner]
    item, low, high = R.intervals(mask, begin)
    return np.array([n for n, _, _ in items], np.int64)[item], low, high


def _merged(pieces: DataFrame, window: int, gram: int) -> DataFrame:
    """Windows that occur twice, by segment, of all ranges."""

    def work(batches):
        for table in R.grouped(batches, "range"):
            items, groups, held, size, group = [], [], {}, 0, 0
            runs = [decoded(bytes(r)) for r in table.column("data").to_pylist()]
            for (suffix, before, name, twice, _), same in chain(LoserTree(runs), [((b"", 0, 0, False, 0), 0)]):
                if same < gram and held:
                    for n, (text, double) in held.items():
                        items.append((n, text, double))
                        groups.append(group)
                        size += len(text)
                    held, group = {}, group + 1
                    if size > SLICE:
                        yield from _verdicts(items, groups, window)
                        items, groups, size = [], [], 0
                if suffix:
                    text, double = held.get(name) or (_text_of(suffix, before), False)
                    held[name] = (text, double or twice or name in held)
            if items:
                yield from _verdicts(items, groups, window)

    runs = pieces.filter(F.col("kind") == 1).select("range", "data")
    return C.map_batches(runs.repartition(F.col("range")).sortWithinPartitions("range"), work, VERDICT)


def _verdicts(items, groups, window):
    name, low, high = settle(items, groups, window)
    return C.to_batches({"segment": name, "begin": low, "stop": high})


def _frequent(pieces: DataFrame, window: int, gram: int) -> DataFrame:
    """The same for the segments of frequent anchors, by their windows' anchors of a longer gram."""
    hot = C.stored(pieces.filter(F.col("kind") == 2).groupBy("segment").agg(F.sum("size").alias("size"), F.min("data").alias("data")))
    whole = hot.filter(F.col("size") > 1).select("segment", F.lit(0).cast("bigint").alias("begin"),
                                                 (F.octet_length("data") - window + 1).cast("bigint").alias("stop"))
    if hot.isEmpty():
        return whole
    texts = hot.select(F.col("segment").alias("row"), F.col("data").alias("text"), (F.col("size") > 1).alias("twice"))
    gram = longer(gram, window)
    found = R.repeated(_anchors(texts, window, gram))
    if gram < window:
        alone = _matches(found, texts.join(R.lists(found), "row"), window, gram)
    else:  # the anchor is the window
        alone = found.filter(~F.col("twice")).select("row", F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("stop"))
    return whole.unionByName(alone.withColumnRenamed("row", "segment"))


def longer(gram: int, window: int) -> int:
    """The gram after this one: each halves the windows that can share an anchor."""
    return (gram + window + 1) // 2 if 4 * (window - gram) >= window else window


def _matches(found: DataFrame, fetched: DataFrame, window: int, gram: int) -> DataFrame:
    """(row, begin, stop) of the windows that occur twice; fetched: texts with their segments."""
    pieces = _pieces(fetched, _bounds(found), window, gram)
    places = pieces.filter(F.col("kind") == 0).select("segment", "row", "start")
    verdicts = _merged(pieces, window, gram).unionByName(_frequent(pieces, window, gram))
    return places.join(verdicts, "segment").select("row", (F.col("start") + F.col("begin")).alias("begin"),
                                                   (F.col("start") + F.col("stop")).alias("stop"))


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row, spans): where windows that repeat begin, as pieces [begin, stop) of starts, for
    keyed documents."""
    docs = docs.withColumn("twice", F.lit(False))
    found = R.repeated(_anchors(docs, window, gram))
    matches = _matches(found, R.with_text(docs, R.lists(found)), window, gram)
    return C.stored(matches.groupBy("row").agg(F.collect_set(F.struct("begin", "stop")).alias("spans")))


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def kept_parts(text: bytes, spans: list[dict], window: int) -> tuple[list[bytes], int]:
    """What is left of a text, and the number of maximal removed runs."""
    parts, at, runs = [], 0, 0
    for s in sorted(spans, key=lambda s: s["begin"]):
        a, b = s["begin"], s["stop"] + window - 1
        if a > at or not runs:
            parts.append(text[at:a])
            runs += 1
        at = max(at, b)
    parts.append(text[at:])
    return parts, runs


def _finished(rows: DataFrame, window: int, with_text: bool, sent=None) -> DataFrame:
    """The result for rows with spans; or, if a filter is given, for those outside it, which
    have none. The filter is tried here, as a step of its own would take a second worker."""
    def work(batches):
        for table, texts in C.slices(R.passing(batches, sent.value, False) if sent else batches, limit=SLICE):
            out = []
            for text, found in zip(texts, repeat(None) if sent else table.column("spans").to_pylist()):
                parts, runs = kept_parts(text, found or [], window)
                kept = b"".join(parts)
                out.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            n, removed, runs, sha, kept = map(list, zip(*out))
            more = {"kept": pa.array(kept, pa.binary())} if with_text else {}
            yield from C.to_batches({"doc_id": table.column("doc_id"), "n_bytes": pa.array(n, pa.int64()),
                                     "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()),
                                     "kept_sha256": pa.array(sha, pa.string()), **more})

    where = G.place_in_filter("row").alias("_place") if sent else "spans"
    return C.map_batches(rows.select("doc_id", "text", where), work, RESULT + ", kept binary" * with_text)


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256; the bytes
    that are left as well, if asked for. What is left may be no valid UTF-8."""
    docs = R.keyed(docs)
    found = spans(docs, window, gram)
    sent = R.sent_filter(found, "row")
    touched = R.filtered(docs, sent, "row", True).join(found, "row", "left")
    return _finished(touched, window, with_text).unionByName(_finished(docs, window, with_text, sent))
