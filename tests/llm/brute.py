"""Plain Python versions of the queries, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def edited(rows):
    """doc_id: (n_chars, edited_sha256, next text); distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, follow = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out[i] = (len(t), sha(t[: len(t) - cut] + follow[:cut]), follow)
    return out


def passages(rows, width=35):
    ws = [words(t) for _, t in rows]
    seen = Counter(tuple(w[j : j + width]) for w in ws for j in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, ws):
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if seen[tuple(w[j : j + width])] > 1:
                gone[j : j + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def byte_spans(rows, width=100):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, rows[k][1] or ""))
    seen, out = set(), [None] * len(rows)
    for k in order:
        t = (rows[k][1] or "").encode()
        gone = bytearray(len(t))
        for j in range(len(t) - width + 1):
            if t[j : j + width] in seen:
                gone[j : j + width] = b"\1" * width
            seen.add(t[j : j + width])
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out[k] = (rows[k][0], len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g)))
    return out


def rules(text):
    w = words(text)
    grams = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for j, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(j, j + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
    return counts, len(w) < 10 or 100 * len(covered) > 20 * len(w)


def near(rows):
    """doc_id: (n_shingles, component, kept); distinct ids."""
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    both = Counter((a, b) for ids in by.values() for k, a in enumerate(ids) for b in ids[:k])
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def spans(text):
    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if _valid(k, m[0])] for k, p in PII.items()]


def unigram(rows):
    tokens = [[*lower(t).encode().split(), None] for _, t in rows]
    count = Counter()
    for (i, _), w in zip(rows, tokens):
        if zlib.crc32(str(i).encode()) % 10:
            count.update(w)
    n, v = sum(count.values()), len(count)
    score = lambda w: sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
    return {i: (len(w), sum(count[x] > 0 for x in w), n, score(w)) for (i, _), w in zip(rows, tokens)}
