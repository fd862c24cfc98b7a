"""Language identification with interpolated Kneser-Ney character models.

Every language has a model of order ORDER over the letters of its words, lower-cased, other
characters and word ends being one boundary sign. The highest order counts occurrences, the
lower ones distinct left neighbours; each order discounts its counts by n1 / (n1 + 2 n2) and
gives the rest to the order below, down to a uniform distribution. The probabilities of seen
n-grams and the weights of seen contexts lie in sorted arrays of their hashes, one for each
language and order. A text gets the language with the lowest cross-entropy per character.

Counts cover all texts that are learned from, and a model keeps every n-gram counted. The
numbers of n-grams seen once and twice, and the counts of single characters, come from whole
tables in Spark. The n-grams of a model are cut into parts by their last but one character,
which every n-gram and context of a place shares, so a part has all that its places need. Parts
are packed into shards of about SHARD_GRAMS n-grams, each a broadcast of its own. A task scores
the distinct words of a chunk of texts under one shard after the other and holds one at a time;
the driver too builds one at a time. A part with one such character is not cut further.

Rejection: a first fit leaves out the texts whose id hash is 0 modulo CALIBRATE; the
REJECT_BEYOND quantile of their cross-entropies under their own language is its limit. A text
beyond the limit of its best language is rejected (of no language learned). Languages without
such texts have no limit. The models that identify are then made from the counts of all texts.

Null texts and texts without a letter are `und` with score 0. Null languages are not learned;
with no language at all every text is `und`. Equal cross-entropies go to the language that
sorts first.
"""

from __future__ import annotations

import sys
from collections import Counter
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
#: N-grams of the highest order in a shard, and languages in it.
SHARD_GRAMS, SHARD_PARTS = 2_000_000, 64
CALIBRATE, REJECT_BEYOND = 16, 0.995
#: Distinct words that a task counts or remembers before it hands over or forgets them.
MEMO_WORDS = 200_000
#: Words of the texts that a task scores at once, and characters of distinct words.
CHUNK_WORDS, STRIP_CHARS = 4_000_000, 1_000_000
UNKNOWN = "und"
FOUND = "lang_best string, score double, cross_entropy double, rejected boolean"

BOUNDARY = 0x20
#: Beyond all code points.
END = 1 << 21


# --- characters -------------------------------------------------------------------------

def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)),
                       bool, 0x110000)


class Strip:
    """Words one after the other as code points, with ORDER - 1 boundary signs before each
    and one behind; at: the places to predict, word: the word of each place."""

    def __init__(self, words: list[str], letter: np.ndarray):
        pad = " " * (ORDER - 1)
        text = "".join([x for w in words for x in (pad, w, " ")])
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        real = letter[code] if code.size else np.zeros(0, bool)
        self.code = np.where(real, code, BOUNDARY).astype(np.uint64)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(size + ORDER - 1)
        word = np.repeat(np.arange(len(words)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(ends - size, size)
        # Letters, and the first sign behind a letter.
        keep = real[at] | real[np.maximum(at - 1, 0)] if at.size else np.zeros(0, bool)
        self.at, self.word, self.n = at[keep], word[keep], len(words)
        self.letters = np.bincount(word, real[at], len(words)) if at.size else np.zeros(len(words))

    def gram(self, n: int) -> np.ndarray:
        """Names of the n characters that end at each place."""
        out = self.code[self.at - n + 1] + C.U(n)
        for k in range(n - 2, -1, -1):
            out = C.joined_name(out, self.code[self.at - k])
        return out

    def context(self, n: int) -> np.ndarray:
        """Names of the n characters before each place."""
        if n == 0:
            return np.zeros(self.at.size, np.uint64)
        out = self.code[self.at - n] + C.U(n)
        for k in range(n - 1, 0, -1):
            out = C.joined_name(out, self.code[self.at - k])
        return out


def names(rows: np.ndarray) -> np.ndarray:
    """Names of n-grams given as rows of characters; the same as Strip gives."""
    if rows.shape[1] == 0:
        return np.zeros(len(rows), np.uint64)
    out = rows[:, 0] + C.U(rows.shape[1])
    for k in range(1, rows.shape[1]):
        out = C.joined_name(out, rows[:, k])
    return out


# --- models -----------------------------------------------------------------------------

def kneser_ney(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once else 0.5


class Model:
    """One language, or the part of it whose n-grams have some last but one characters: for
    each order the sorted names of n-grams with log probabilities, and the sorted names of
    contexts with log weights of the order below. For a part, the whole language's discounts
    by order and single characters with their counts are given."""

    def __init__(self, rows: np.ndarray, counts: np.ndarray, discounts: dict[int, float] | None = None,
                 single: tuple[np.ndarray, np.ndarray] | None = None):
        levels = {ORDER: (rows, counts.astype(np.float64))}
        for n in range(ORDER - 1, 0, -1):
            above = levels[n + 1][0][:, 1:]
            name = names(above)
            _, first, times = np.unique(name, return_index=True, return_counts=True)
            levels[n] = (above[first], times.astype(np.float64))
        if single is not None:
            levels[1] = (single[0].reshape(-1, 1), single[1].astype(np.float64))
        self.gram, self.logp, self.context, self.weight = {}, {}, {}, {}
        size = len(levels[1][0]) + 1
        below_name, below_p = None, np.array([1.0 / size])
        for n in range(1, ORDER + 1):
            part, count = levels[n]
            discount = discounts[n] if discounts else kneser_ney((count == 1).sum(), (count == 2).sum())
            head, place = np.unique(names(part[:, :-1]), return_inverse=True)
            total = np.bincount(place, count, head.size)
            kinds = np.bincount(place, minlength=head.size)
            weight = discount * kinds / total
            if n == 1:
                lower = below_p
            else:
                lower = below_p[np.searchsorted(below_name, names(part[:, 1:]))]
            p = np.maximum(count - discount, 0) / total[place] + weight[place] * lower
            name = names(part)
            order = np.argsort(name)
            below_name, below_p = name[order], p[order]
            self.gram[n], self.logp[n] = below_name, np.log(below_p)
            self.context[n], self.weight[n] = head, np.log(weight)
        self.floor = -np.log(size) + float(self.weight[1][0])

    def log_probabilities(self, strip: Strip, grams: dict, contexts: dict, todo: np.ndarray | None = None) -> np.ndarray:
        """Of all places, or of those in todo and 0 for the others."""
        out = np.zeros(strip.at.size)
        todo = np.arange(strip.at.size) if todo is None else todo
        for n in range(ORDER, 0, -1):
            name = grams[n][todo]
            place = np.minimum(np.searchsorted(self.gram[n], name), self.gram[n].size - 1)
            hit = self.gram[n][place] == name
            out[todo[hit]] += self.logp[n][place[hit]]
            todo = todo[~hit]
            if not todo.size:
                return out
            if n > 1:
                name = contexts[n - 1][todo]
                place = np.minimum(np.searchsorted(self.context[n], name), self.context[n].size - 1)
                seen = self.context[n][place] == name
                out[todo[seen]] += self.weight[n][place[seen]]
        out[todo] += self.floor
        return out


class Identifier:
    """The languages and their limits, and the shards of their models: broadcasts of lists of
    (number of the language, from and below which last but one character, model)."""

    def __init__(self, langs: list[str], shards: list, limits: dict[str, float]):
        self.langs, self.shards = langs, shards
        self.limits = np.array([limits.get(x, np.inf) for x in langs])

    def forget(self):
        for sent in self.shards:
            sent.unpersist()


class Scorer:
    """Texts of one task, held until they are scored together."""

    def __init__(self, identifier: Identifier):
        self.langs, self.shards, self.limits = identifier.langs, identifier.shards, identifier.limits
        self.letter = letters()
        self._clear()

    def _clear(self):
        self.number, self.rows, self.lists, self.held = C.Numbers(), [], [], 0

    def add(self, rows: pa.Table, texts: list[str]):
        """The answers to texts that are scored now, as tables."""
        self.rows.append(rows)
        for text in texts:
            words = text.lower().split()
            # Number 0, which scores nothing, keeps every list from being empty.
            self.lists.append(np.fromiter((0, *map(self.number.__getitem__, words)), np.int32, len(words) + 1))
            self.held += len(words) + 1
        if len(self.number) > MEMO_WORDS or self.held > CHUNK_WORDS:
            yield from self.flush()

    def flush(self):
        if self.lists:
            yield pa.concat_tables(self.rows), self._answers()
            self._clear()

    def _blocks(self):
        """(first number, words) of the distinct words, in blocks of about STRIP_CHARS."""
        words = self.number.fresh
        size = np.cumsum([0, *(len(w) + ORDER for w in words)])
        at = 0
        while at < len(words):
            to = max(at + 1, int(np.searchsorted(size, size[at] + STRIP_CHARS, "right")) - 1)
            yield at + 1, words[at:to]
            at = to

    def _answers(self) -> dict:
        n_words, n = len(self.number.fresh) + 1, len(self.lists)
        every = np.concatenate(self.lists)
        first = np.cumsum([0, *map(len, self.lists[:-1])])
        low, odds, best = np.full(n, np.inf), np.zeros(n), np.zeros(n, np.int64)
        places, letter, carry = np.zeros(n_words), np.zeros(n_words), None
        for number, sent in enumerate(self.shards):
            parts = sent.value
            sums = np.zeros((len(parts), n_words))
            for start, words in self._blocks():
                strip = Strip(words, self.letter)
                to = slice(start, start + strip.n)
                grams = {k: strip.gram(k) for k in range(1, ORDER + 1)}
                contexts = {k: strip.context(k) for k in range(1, ORDER)}
                before = strip.code[strip.at - 1]
                if number == 0:
                    places[to], letter[to] = np.bincount(strip.word, minlength=strip.n), strip.letters
                for row, (_, lo, hi, model) in zip(sums, parts):
                    todo = None if lo == 0 and hi == END else np.flatnonzero((before >= C.U(lo)) & (before < C.U(hi)))
                    row[to] = np.bincount(strip.word, model.log_probabilities(strip, grams, contexts, todo), strip.n)
            if number == 0:
                count = np.maximum(np.add.reduceat(places[every], first), 1)
                n_letters = np.add.reduceat(letter[every], first)
                weight = np.minimum(50, n_letters)
            for row, (lang, _, hi, _) in zip(sums, parts):
                if carry is not None:
                    row, carry = row + carry, None
                if hi < END:  # The rest of the language is in the next shard.
                    carry = row.copy()
                    continue
                entropy = -np.add.reduceat(row[every], first) / count
                less = entropy < low
                # Both sums are of exp(-weight * (entropy - low)) over the languages so far.
                apart = np.exp(-weight * np.abs(np.where(np.isinf(low), 0, low) - entropy))
                odds = np.where(np.isinf(low), 1, np.where(less, odds * apart + 1, odds + apart))
                low, best = np.where(less, entropy, low), np.where(less, lang, best)
            if len(self.shards) > 1:
                vars(sent).pop("_value", None)  # One shard in memory at a time; its file stays.
                parts = row = model = None
        known = n_letters > 0
        return {"lang_best": [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)],
                "score": np.where(known, 1 / odds, 0.0),
                "cross_entropy": pa.array(low, pa.float64(), mask=~known),
                "rejected": ~known | (low > self.limits[best])}


# --- learning ---------------------------------------------------------------------------

def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n, n_fit) of the highest order: counts over all texts, and over those that
    are not held back; docs: lang, text and held."""

    def work(batches):
        letter, counts, size = letters(), {}, 0

        def handed():
            for (lang, held), words in counts.items():
                strip = Strip(list(words), letter)
                if not strip.at.size:
                    continue
                name = strip.gram(ORDER)
                times = np.fromiter(words.values(), np.int64, len(words))[strip.word]
                order = np.argsort(name, kind="stable")
                new = np.ones(order.size, bool)
                new[1:] = name[order][1:] != name[order][:-1]
                start = np.flatnonzero(new)
                place = strip.at[order[start]]
                rows = np.stack([strip.code[place - k] for k in range(ORDER - 1, -1, -1)], 1).astype("<u4")
                gram = np.ascontiguousarray(rows).view(f"<U{ORDER}").ravel()
                n = np.add.reduceat(times[order], start)
                yield from C.to_batches({"lang": pa.array([lang] * gram.size, pa.string()),
                                         "gram": pa.array(gram.tolist(), pa.string()),
                                         "n": n, "n_fit": np.zeros_like(n) if held else n})

        for batch in batches:
            for *key, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "held", "text"))):
                words = counts.setdefault(tuple(key), Counter())
                before = len(words)
                words.update(text.lower().split())
                size += len(words) - before
            if size > MEMO_WORDS:
                yield from handed()
                counts, size = {}, 0
        yield from handed()

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", "held")
    return (C.map_batches(rows, work, "lang string, gram string, n bigint, n_fit bigint").groupBy("lang", "gram")
            .agg(F.sum("n").alias("n"), F.sum("n_fit").alias("n_fit")))


def shard_plan(pieces: list[tuple[str, int, int]]) -> list[list[tuple[str, int, int]]]:
    """Parts (lang, from, below which last but one character) for each shard; pieces: (lang,
    character, number of n-grams), each in one part. The parts of a language cover all
    characters, follow each other, and lie in different shards."""
    out, size, last = [], 0, None
    for lang, code, n in sorted(pieces):
        if not out or size + n > SHARD_GRAMS or lang != last and len(out[-1]) >= SHARD_PARTS:
            if out and lang == last:
                out[-1][-1] = (*out[-1][-1][:2], code)
            out.append([(lang, code if lang == last else 0, END)])
            size = 0
        elif lang != last:
            out[-1].append((lang, 0, END))
        size, last = size + n, lang
    return out


def _identifier(counts: DataFrame, limits: dict[str, float]) -> Identifier:
    """Models of all n-grams in counts (lang, gram, n)."""
    code = F.ascii(F.substring("gram", ORDER - 1, 1))
    pieces = [tuple(r) for r in counts.groupBy("lang", code.alias("code")).count().collect()]
    langs = sorted({lang for lang, _, _ in pieces})
    place = {lang: i for i, lang in enumerate(langs)}
    level, seen = counts, []
    for n in range(ORDER, 0, -1):
        if n < ORDER:
            level = level.groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count("*").alias("n"))
        seen.append(level.groupBy("lang").agg(F.lit(n).alias("order"), F.count_if(F.col("n") == 1).alias("once"),
                                              F.count_if(F.col("n") == 2).alias("twice")))
    discounts = {lang: {} for lang in langs}
    for r in reduce(DataFrame.union, seen).collect():
        discounts[r["lang"]][r["order"]] = kneser_ney(r["once"], r["twice"])
    single = {lang: ([], []) for lang in langs}
    for lang, gram, n in level.collect():
        single[lang][0].append(ord(gram))
        single[lang][1].append(n)
    single = {lang: (np.array(c, np.uint64), np.array(n, np.int64)) for lang, (c, n) in single.items()}
    shards = []
    for parts in shard_plan(pieces):
        wanted = reduce(or_, ((F.col("lang") == lang) & code.between(lo, hi - 1) for lang, lo, hi in parts))
        table, built = counts.filter(wanted).select("lang", "gram", "n").toArrow(), []
        for lang, lo, hi in parts:
            part = table.filter(pc.equal(table.column("lang"), lang))
            # Trailing boundary signs are no padding here; they are blanks.
            rows = np.array(part.column("gram").to_pylist(), f"<U{ORDER}").view("<u4").reshape(-1, ORDER).astype(np.uint64)
            built.append((place[lang], lo, hi, Model(rows, part.column("n").to_numpy(), discounts[lang], single[lang])))
        shards.append(counts.sparkSession.sparkContext.broadcast(built))
    return Identifier(langs, shards, limits)


def calibration() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATE)) == 0


def learn(docs: DataFrame) -> Identifier:
    """Models and limits from docs with doc_id, lang and text."""
    docs = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull())
    counts = C.stored(gram_counts(docs.withColumn("held", F.coalesce(calibration(), F.lit(False)))))
    fit = _identifier(counts.filter("n_fit > 0").select("lang", "gram", F.col("n_fit").alias("n")), {})
    limits = {}
    if fit.langs:
        tested = identified(docs.filter(calibration()), fit, ["lang"])
        limit = (tested.filter(F.col("cross_entropy").isNotNull() & (F.col("lang") == F.col("lang_best"))).groupBy("lang")
                 .agg(F.percentile_approx("cross_entropy", REJECT_BEYOND, 1000).alias("limit")).collect())
        limits = {r["lang"]: r["limit"] for r in limit}
        fit.forget()
    return _identifier(counts.select("lang", "gram", "n"), limits)


def identified(docs: DataFrame, identifier: Identifier, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs with the best language, score, cross-entropy and whether
    the language is rejected."""

    def work(batches):
        scorer = Scorer(identifier) if identifier.langs else None
        for rows, texts in C.slices(batches):
            if scorer:
                done = scorer.add(rows.select(keep), [t.decode() for t in texts])
            else:
                n = len(texts)
                done = [(rows, {"lang_best": [UNKNOWN] * n, "score": np.zeros(n), "cross_entropy": pa.nulls(n, pa.float64()),
                                "rejected": [True] * n})]
            for rows, found in done:
                yield from C.to_batches({**{k: rows.column(k) for k in keep}, **found})
        for rows, found in scorer.flush() if scorer else ():
            yield from C.to_batches({**{k: rows.column(k) for k in keep}, **found})

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return C.map_batches(docs.select(*dict.fromkeys([*keep, "text"])), work, f"{kinds}, {FOUND}")


def language(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """doc_id and lang, `und` where the best language is rejected."""
    return identified(docs, identifier, ["doc_id"]).select(
        "doc_id", F.when(F.col("rejected"), UNKNOWN).otherwise(F.col("lang_best")).alias("lang"), "score")
