"""Plain Python versions of the operators, one small corpus at a time."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def repeats(rows, window):
    cut = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[j : j + window]) for _, w in cut for j in range(len(w) - window + 1))
    out = []
    for i, w in cut:
        gone = {j + k for j in range(len(w) - window + 1) if seen[tuple(w[j : j + window])] > 1 for k in range(window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def earlier(rows, window):
    rank = lambda i: 1 << 63 if i is None else i
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - window + 1):
            key = b[j : j + window]
            least[key] = min(least.get(key, rank(i)), rank(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - window + 1):
            if least[b[j : j + window]] < rank(i):
                gone[j : j + window] = b"\1" * window
        spans = sum(1 for j, x in enumerate(gone) if x and not (j and gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, y in zip(b, gone) if not y))))
    return out


def shingles(text):
    w = WORD.findall(fold(text))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    named = [i if not sets[k] else least.get(root(k)) for k, (i, _) in enumerate(rows)]
    return [(i, len(sets[k]), named[k], i == named[k]) for k, (i, _) in enumerate(rows)]


def leaks(rows, items, window=10):
    cut = [(str(i) if i is not None else "", TOKEN.findall(fold(t))) for i, t in items]
    known = {}
    for name, w in cut:
        n = min(len(w), window)
        for j in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[j : j + n]), set()).add(name)
    out = []
    for i, t in rows:
        w, hit, names = TOKEN.findall(fold(t)), set(), set()
        for n in {len(k) for k in known}:
            for j in range(len(w) - n + 1):
                if (key := tuple(w[j : j + n])) in known:
                    hit.update(range(j, j + n))
                    names |= known[key]
        out.append((i, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    three = Counter(zip(w, w[1:], w[2:]))
    repeated = {j + k for j, key in enumerate(zip(w, w[1:], w[2:])) if three[key] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def trie(rows):
    """Nodes of the rebuilt conversations, from (conv_id, turn, role, text) rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in under if len(q) == len(p) + 1]
        leaves = sum(1 for q in under if not any(r[: len(q)] == q and len(r) == len(q) + 1 for r in under))
        saved = sum((len(nodes[q]) - 1) * len(WORD.findall(q[-1][1])) for q in under if q)
        ends = ",".join(str(c) for c in sorted(members) if built[c] == p)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children), leaves, saved, sha(ends)))
    return out


def simhash(rows):
    marks = []
    for _, text in rows:
        w = WORD.findall(fold(text))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        marks.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, f"{marks[k]:016x}", least.get(root(k))) for k, (i, _) in enumerate(rows)]


def hard_negatives(rows):
    """From (vec_id, vector, label) rows with whole ids."""
    held = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a in {(i, label, tuple(v)) for i, label, v in held if i % 100 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a[2], v)), i, label) for i, label, v in held)
        positives = [(i, -s) for s, i, label in scored if label == a[1] and i != a[0]][:5]
        for p, top in positives:
            fit = [(i, -s) for s, i, label in scored if label != a[1] and 80 * top <= -100 * s <= 100 * top][:5]
            out += [(a[0], p, k + 1, i, top, s) for k, (i, s) in enumerate(fit)]
    return out
