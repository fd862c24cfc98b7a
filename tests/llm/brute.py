"""Plain versions of the operators' contracts, for small inputs."""

import base64
import hashlib
import re
import zlib
from collections import Counter

LAST = 1 << 63


def words(text, lower=False):
    text = (text or "").encode()
    return (text.lower() if lower else text).split()


def alnum(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def covered(starts, size, n):
    hit = set()
    for p in starts:
        hit.update(range(p, p + size))
    return [i in hit for i in range(n)]


def repeated_bytes(rows, window):
    count = Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[i:i + window] for i in range(len(data) - window + 1))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        hit = covered([i for i in range(len(data) - window + 1) if count[data[i:i + window]] > 1], window, len(data))
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        out.append((key, len(data), sum(hit), spans, sha(bytes(b for b, h in zip(data, hit) if not h))))
    return sorted(out, key=repr)


def repeated_words(rows, window):
    least = {}
    for key, text in rows:
        w, key = words(text), LAST if key is None else key
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least.get(g, key), key)
    out = []
    for key, text in rows:
        w, k = words(text), LAST if key is None else key
        hit = covered([i for i in range(len(w) - window + 1) if least[tuple(w[i:i + window])] < k], window, len(w))
        out.append((key, len(w), sum(hit), sha(b" ".join(x for x, h in zip(w, hit) if not h))))
    return sorted(out, key=repr)


def shingles(text):
    w = words(text, lower=True)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def jaccard(rows):
    """Components over rows with distinct ids."""
    sets = {key: shingles(text) for key, text in rows}
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((k, len(sets[k]), find(k)) for k in keys), key=repr)


def contamination(rows, items, window=13):
    found = {}
    for item, text in items:
        w = alnum(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            found.setdefault(tuple(w[p:p + n]), set()).add(str(item))
    sizes = {len(k) for k in found}
    out = []
    for key, text in rows:
        w, hit, names = alnum(text), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in found:
                    hit.update(range(p, p + n))
                    names |= found[tuple(w[p:p + n])]
        out.append((key, len(w), len(hit), len(names), sha(",".join(sorted(names)).encode()),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rule_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeat = sum(covered([i for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1], 8, len(w)))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat


KINDS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    """Base spans: (start, kind, end)."""
    out = []
    for kind, pattern in enumerate(KINDS):
        for m in re.finditer(pattern, text or ""):
            found = m.group()
            digits = re.sub("[^0-9]", "", found)
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in found.split("."))
                    or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def archive(rows, least=0):
    """Page records; rows: (page_id, html)."""
    first = {}
    for page, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in rows:
        data = (html or "").encode()
        to = first.get(html or "")
        again = len(data) >= least and to is not None and to != page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def runs(w, least=12):
    """(start, length, period) of the periodic runs of a list."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            x = w[i:j + q]
            if len(x) >= max(least, 2 * q) and all(x[d:] != x[:-d] for d in range(1, q)):
                out.append((i, len(x), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def woven(key, w):
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def periodic(rows, weave=True):
    out = []
    for key, text in rows:
        w = woven(key, words(text)) if weave else words(text)
        found = runs(w)
        gone = set()
        for s, n, q in found:
            gone.update(range(s + q, s + n))
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        out.append((key, len(found), *top, 1000 * top[1] // top[2] if found else None,
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
                    sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def nearest(rows, asks, k=20):
    """rows: (id, vector), distinct ids."""
    from math import isfinite
    use = [(i, v) for i, v in rows if i is not None and v and all(x is not None and isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in use:
        if asks(i):
            score = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in use if j != i)
            out[i] = [(j, -s) for s, j in score[:k]]
    return out


def conversations(rows):
    """Lists of (role, text) by conversation, with shared first turns."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def trie(convs):
    """The nodes, as the query returns them."""
    members, ends, kids = {}, {}, {}
    for c, s in sorted(convs.items()):
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(s[:d - 1]), set()).add(tuple(s[:d]))
        ends.setdefault(tuple(s), []).append(c)
    leaves, saved, out = {}, {}, []
    for n in sorted(members, key=len, reverse=True):
        below = kids.get(n, ())
        leaves[n] = sum(leaves[k] for k in below) or 1
        saved[n] = sum(saved[k] for k in below) + ((len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0)
        out.append((members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(below), leaves[n],
                    saved[n], sha(",".join(map(str, ends.get(n, ()))).encode())))
    return sorted(out, key=repr)
