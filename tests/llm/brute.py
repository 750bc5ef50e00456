"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def held(doc_id, modulus):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == 0


def line_dedup(rows, least=10, chars=1, keep_first=False):
    """(doc_id, text) -> (doc_id, n_lines, n_dropped, kept text); by id with ``keep_first``."""
    if keep_first:
        rows, seen = sorted(rows), set()
    docs = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(WS).translate(LOWER)
            if len(key) >= chars:
                docs[key].add(doc)
    gone = {k for k, d in docs.items() if len(d) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            key = x.strip(WS).translate(LOWER)
            if key not in gone or keep_first and key not in seen:
                kept.append(x)
            if keep_first:
                seen.add(key)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(WS)]
    n = len(tokens)
    return (
        n,
        sum(map(len, tokens)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def shingles(text, size):
    w = words(text)
    if not w:
        return frozenset()
    size = min(size, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_classes(rows, size, percent=80):
    """(doc_id, text) -> (doc_id, n, component, kept); ids not NULL and unique."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    common = Counter()
    for members in holders.values():
        for i, a in enumerate(members):
            for b in members[:i]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return [(d, len(s), find(d), find(d) == d) for d, s in sets.items()]


def leaks(rows, items, size=5, similarity=0.8):
    """(doc_id, item_id, similarity) of every item in every window of its length.

    Windows may hang over the ends of a text.
    """
    out = []
    for doc, text in rows:
        w = words(text)
        grams = {tuple(w[i : i + k]) for k in range(1, size + 1) for i in range(len(w) - k + 1)}
        for item, item_text in items:
            v = words(item_text)
            width = min(size, len(v))
            want = Counter(tuple(v[i : i + width]) for i in range(len(v) - width + 1))
            if not v or not any(g in grams for g in want):
                continue
            best = 0.0
            for start in range(1 - len(v), len(w)):
                part = w[max(0, start) : start + len(v)]
                have = Counter(tuple(part[i : i + width]) for i in range(len(part) - width + 1))
                if have and any(g in want for g in have):
                    both = sum((have & want).values())
                    best = max(best, both / sum((have | want).values()))
            if best >= similarity:
                out.append((doc, item, best))
    return out
