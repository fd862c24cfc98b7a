"""Personal data with offset-preserving deobfuscation.

Base spans are found in the text as it stands, by linear scans that give what the patterns
below give: the leftmost matches of each kind that do not overlap; a match that fails its
check is dropped and not retried.

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), each part 255 at most
    card   [0-9]([\\x20-]?[0-9])+, 14 to 19 digits that pass Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9], 10 to 15 digits

A text that shows signs of disguise goes through a chain of transducers as well. Each turns a
text with the source span of every character into another such text: look-alike characters,
full-width forms and other scripts' digits become ASCII and invisible characters vanish; runs
of spelled digits become digits; "(at)", "[dot]" and "name at host dot com" become signs.
Spans found in the result lead back to spans of the source, and are added to the base spans
unless they lie inside one. A number beside a run may belong to it or not: the text is read
with it, without it, and with the run left as it stands, and of spans of one kind those inside
another are left out.

Positions are code points, ends exclusive. Null and empty texts have no spans. Rows are
treated one by one, so repeated rows and equal ids are results of their own.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
FOUND = ("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
         "spans string")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


# --- base spans -------------------------------------------------------------------------

def emails(text: str) -> list[Span]:
    """Every match holds one @: its left side reaches back to the last match at most."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, 0, host.end()))
            last = host.end()
        at = text.find("@", at + 1)
    return out


def addresses(text: str) -> list[Span]:
    """Four dotted numbers after each other, counted off from the left of a dotted chain."""
    out = []
    for chain in DOTTED.finditer(text):
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in four):
                out.append((at, 1, at + size))
            at += size + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def cards(text: str) -> list[Span]:
    out = []
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]


def base_spans(text: str) -> list[Span]:
    return sorted(emails(text) + addresses(text) + cards(text) + phones(text))


# --- transducers ------------------------------------------------------------------------

# Characters that look like an ASCII one, and that one.
LOOK_ALIKE = dict(zip("АВЕЅІЈКМНОРСТУХ"
                      "аеѕіјорсухһԁԛԝ"
                      "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
                      "αονρικ",
                      "ABESIJKMHOPCTYX" "aesijopcyxhdqw" "ABEZHIKMNOPTYX" "aovpik"))
# Characters that cannot be seen, and dashes, blanks, dots and signs that stand
# for ASCII ones.
INVISIBLE = "­᠎​‌‍⁠﻿"
SIGNS = {**dict.fromkeys("‐‑‒–—−﹣", "-"),
         **dict.fromkeys("      　", " "),
         **dict.fromkeys("․。｡", "."), "﹫": "@"}
# The digits' names in English, German, French and Spanish.
SPELLED = {word: str(i) for names in (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve")
    for i, word in enumerate(names.split())} | {"oh": "0", "zwo": "2"}
# Ends of host names that are taken in any worded form, words that are no end of
# one behind a worded sign, and names of the signs.
TOP = "com|org|net|edu|gov|mil|int|info|biz|io|co|dev|app|ai|me|eu|uk|us|de|at|ch|fr|es|it|nl|be|br|mx|ca|au|jp|cn|in|ru|pl"
PROSE = ("of|on|and|or|but|the|an|to|as|is|was|were|are|had|has|he|she|they|we|you|this|that|there|then|than|when|where|"
         "which|who|with|from|for|by|so|if|not|und|oder|der|die|das|et|ou|le|la|les|des|du|en|el|los|las")
AT, DOT = "at|arobase|arroba|klammeraffe|@", r"dot|punkt|point|punto|\."

_NAME = "|".join(sorted(SPELLED, key=len, reverse=True))
_MORE = rf"(?:(?:[\s,.-]+|\s+(?:{DOT})\s+)(?:{_NAME}|[0-9]++))+(?![^\W_])"
#: Digits and digits' names with blanks, hyphens, commas or dots between; RUNS: from any digits
#: on, or from a single digit or a name on. Those with LEAST_DIGITS and a name are taken.
RUNS = [re.compile(rf"(?<![^\W_])(?:plus[\s-]+)?(?:{_NAME}|{first}){_MORE}", re.I) for first in ("[0-9]++", "[0-9]")]
LEAST_DIGITS = 7
NAMED = re.compile(rf"(?<![^\W_])(?:{_NAME})(?![^\W_])", re.I)
RUN_PART = re.compile(rf"plus|{_NAME}|[0-9]+|(?:{DOT})", re.I)
NO_WORD = re.compile(r"[\W_]+")
BRACKETED = re.compile(rf"[(\[{{<]\s*(?:(?P<at>{AT})|(?P<dot>{DOT}))\s*[)\]}}>]", re.I)
_LABELS = rf"[A-Za-z0-9-]+(?:(?:\s+(?:{DOT})\s+|\.)[A-Za-z0-9-]+)"
#: Any letters end a host, but behind "at" not after "point" nor where an article is its first
#: label, as in prose; else the ends of TOP do.
WORDED = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:"
    rf"(?:(?P<prose>\s+at\s+)|\s+(?:{AT})\s+|@)(?!(?:the|an?|this|that|each|every|any|some|which)\s){_LABELS}*"
    rf"\s+(?:dot|punkt|punto|(?(prose)dot|point))\s+(?!(?:{PROSE})(?![A-Za-z0-9-]))[A-Za-z]{{2,}}(?![A-Za-z0-9-])|"
    rf"(?:\s+(?:{AT})\s+|@){_LABELS}*?\s+(?:dot|punkt|point|punto)\s+(?:{TOP})(?![A-Za-z0-9-]))", re.I)
WORDED_SIGN = re.compile(rf"\s+(?P<at>{AT})\s+|\s+(?P<dot>{DOT})\s+", re.I)
WORDED_HINT = re.compile(r"\s(?:dot|punkt|point|punto)\s", re.I)


class Tape:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str, start, end):
        self.text, self.start, self.end = text, start, end

    @classmethod
    def of(cls, text: str) -> Tape:
        place = np.arange(len(text))
        return cls(text, place, place + 1)

    def rewritten(self, changes: list[tuple[int, int, str]]) -> Tape:
        """Places [a, b) replaced by other text, each new character standing for all of the
        place; places are in order and do not overlap."""
        if not changes:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, new in changes:
            text += [self.text[at:a], new]
            start += [self.start[at:a], np.full(len(new), self.start[a])]
            end += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        text.append(self.text[at:])
        return Tape("".join(text), np.concatenate([*start, self.start[at:]]).astype(np.int64),
                    np.concatenate([*end, self.end[at:]]).astype(np.int64))

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


def plain(c: str) -> str:
    """The ASCII form of a disguised character, or the character."""
    if c in INVISIBLE:
        return ""
    if c in SIGNS:
        return SIGNS[c]
    if c in LOOK_ALIKE:
        return LOOK_ALIKE[c]
    if "\uff01" <= c <= "\uff5e":
        return chr(ord(c) - 0xFEE0)
    if not c.isascii() and unicodedata.category(c) in ("Nd", "No") and unicodedata.digit(c, None) is not None:
        return str(unicodedata.digit(c))
    if "\U0001d400" <= c <= "\U0001d7ff":
        return unicodedata.normalize("NFKC", c)
    return c


def disguised_characters() -> frozenset[str]:
    """The characters that plain() changes."""
    return frozenset(c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800)])
                     if plain(c) != c)


def characters(tape: Tape, disguised: frozenset[str]) -> Tape:
    return tape.rewritten([(i, i + 1, plain(c)) for i, c in enumerate(tape.text) if c in disguised])


def spells_digits(text: str) -> bool:
    """Whether a text has a word for a digit, which a run needs."""
    return not SPELLED.keys().isdisjoint(NO_WORD.split(text.lower()))


def spelled(tape: Tape, runs: re.Pattern) -> Tape:
    """Runs of digits, some of them spelled, become digits; "plus" and "dot" inside too."""
    changes = []
    for run in runs.finditer(tape.text):
        if not NAMED.search(run.group()):
            continue
        parts = RUN_PART.findall(run.group())
        if sum(len(p) if p[0].isdigit() else p.lower() in SPELLED for p in parts) < LEAST_DIGITS:
            continue
        at = run.start()
        for part in RUN_PART.finditer(tape.text, run.start(), run.end()):
            word = part.group().lower()
            if word[0].isdigit():
                new = word
            elif word == "plus":
                new = "+"
            else:
                new = SPELLED.get(word, ".")
            gap = tape.text[at:part.start()]
            if at > run.start() and gap:
                changes.append((at, part.start(), ""))
            changes.append((part.start(), part.end(), new))
            at = part.end()
    return tape.rewritten(changes)


def signs(tape: Tape) -> Tape:
    """Bracketed and worded "at" and "dot" become signs."""
    changes, text = [], tape.text
    for m in BRACKETED.finditer(text):
        a, b, last = m.start(), m.end(), changes[-1][1] if changes else 0
        while a > last and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        changes.append((a, b, "@" if m.group("at") else "."))
    tape, changes = tape.rewritten(changes), []
    if WORDED_HINT.search(tape.text):
        for m in WORDED.finditer(tape.text):
            changes += [(s.start(), s.end(), "@" if s.group("at") else ".")
                        for s in WORDED_SIGN.finditer(tape.text, m.start(), m.end())]
    return tape.rewritten(changes)


class Finder:
    """Base spans and spans behind disguises."""

    def __init__(self):
        self.disguised = disguised_characters()

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans, both in order."""
        base = base_spans(text)
        odd = not text.isascii() and not self.disguised.isdisjoint(set(text))
        if not (odd or spells_digits(text) or BRACKETED.search(text) or WORDED_HINT.search(text)):
            return base, base
        tape = Tape.of(text)
        if odd:
            tape = characters(tape, self.disguised)
        found, readings = set(), {tape.text: tape}
        for runs in RUNS:
            read = spelled(tape, runs)
            readings.setdefault(read.text, read)
        for tape in map(signs, readings.values()):
            if tape.text != text:
                found.update((*tape.source(a, b), kind) for a, kind, b in base_spans(tape.text))
        starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
        added, last = [], [0] * len(KINDS)
        for start, end, kind in sorted(found, key=lambda s: (s[0], -s[1])):
            before = bisect_right(starts, start)
            if end > last[kind] and (not before or reach[before - 1] < end):
                added.append((start, kind, end))
                last[kind] = end
        return base, sorted(base + added)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones as one, replaced by the name of its kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


# --- tables -----------------------------------------------------------------------------

def found(docs: DataFrame) -> DataFrame:
    """doc_id with the numbers of base spans, their digest and all spans as a list."""

    def work(batches):
        finder = Finder()
        for rows, texts in C.slices(batches):
            counts, digest, spans = [], [], []
            for text in texts:
                base, every = finder.spans(text.decode())
                kinds = [k for _, k, _ in base]
                counts.append([kinds.count(k) for k in range(len(KINDS))])
                digest.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            n = np.array(counts, np.int64).reshape(-1, len(KINDS))
            yield from C.to_batches({
                "doc_id": rows.column("doc_id"), **{f"n_{k}": n[:, i] for i, k in enumerate(KINDS)},
                "base_sha256": pa.array(digest, pa.string()), "spans": pa.array(spans, pa.string())})

    return C.map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, f"doc_id bigint, {FOUND}")


def clean(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; n_chars, where there is one, follows the
    text. Null texts stay null."""

    def work(batches):
        finder = Finder()
        for rows, texts in C.slices(batches):
            null = rows.column("text").is_null().to_pylist()
            new = [None if gone else masked(t, finder.spans(t)[1])
                   for gone, t in zip(null, (t.decode() for t in texts))]
            rows = rows.set_column(rows.column_names.index("text"), "text", pa.array(new, pa.string()))
            yield from rows.to_batches()

    out = C.map_batches(docs, work, StructType(docs.schema.fields))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return out.select(*docs.columns)
