"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def covered(n, width, hit):
    out = [False] * n
    for i in range(n - width + 1):
        if hit(i):
            out[i:i + width] = [True] * width
    return out


def substring_dedup(rows, width=200):
    data = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for (doc_id, _, _), d in zip(rows, data):
        gone = covered(len(d), width, lambda i, d=d: seen[d[i:i + width]] > 1)
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False] + gone))
        out.append((doc_id, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_window_dedup(rows, width=50):
    order = [(-1 if i is None else i, t) for i, t, _ in rows]
    first = {}
    for k, t in order:
        w = words(t)
        for i in range(len(w) - width + 1):
            key = hash(tuple(w[i:i + width]))
            first[key] = min(k, first.get(key, k))
    out = []
    for (doc_id, t, _), (k, _) in zip(rows, order):
        w = words(t)
        gone = covered(len(w), width, lambda i, w=w, k=k: first[hash(tuple(w[i:i + width]))] < k)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near_duplicates(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t, _ in rows:
        w = words((t or "").translate(lower))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    for i, (doc_id, _, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None and (least[r] is None or doc_id < least[r]):
            least[r] = doc_id
    out = []
    for i, (doc_id, _, _) in enumerate(rows):
        name = least[find(i)] if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), name, doc_id is not None and doc_id == name))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    found.sort()
    names = ("assign", "access", "hex")
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], ",".join(f"{names[k]}:{s}:{e}" for s, k, e in found)


def quality(text):
    w = words(text)
    t = text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen, dups = set(), 0
    for x in lines:
        dups += x in seen
        seen.add(x)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = sum(covered(len(w), 8, lambda i: grams[tuple(w[i:i + 8])] > 1))
    failed = len(w) < 20 or 100 * rep > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dups, rep, failed
