"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text: str | None) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def order(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def repeats(rows, unit, span=50):
    """Per row: units, removed units and the digest of what is left."""
    units = [words(t) if unit == "word" else (t or "").encode() for _, t in rows]
    first: dict = {}
    for (i, _), u in zip(rows, units):
        for s in range(len(u) - span + 1):
            k = tuple(u[s:s + span])
            first[k] = min(order(i), first.get(k, order(i)))
    out = []
    for (i, _), u in zip(rows, units):
        gone = [False] * len(u)
        for s in range(len(u) - span + 1):
            if first[tuple(u[s:s + span])] < order(i):
                gone[s:s + span] = [True] * span
        left = [x for x, g in zip(u, gone) if not g]
        out.append((i, len(u), sum(gone), sha(b" ".join(left) if unit == "word" else bytes(left))))
    return out


def components(rows, n, percent):
    """Per row: set size and the smallest id reachable."""
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            parent[root(a)] = root(b)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(order(i), least.get(root(k), order(i)))
    result = [order(i) if not s else least[root(k)] for k, ((i, _), s) in enumerate(zip(rows, sets))]
    return [(i, len(s), None if c == order(None) else c) for (i, _), s, c in zip(rows, sets, result)]


def line_dedup(rows, min_chars=40, min_docs=5):
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r")).decode()
    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs.get(key(x), ())) < min_docs or order(i) == max(docs[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = [x.decode() for x in words(text)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def decontaminate(rows, items, n=10):
    windows = defaultdict(set)
    for item, t in items:
        w = TERM.findall(low(t))
        k = min(n, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[s:s + k])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w, hit, found = TERM.findall(low(t)), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit.update(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names).encode()), bool(hit)))
    return out
