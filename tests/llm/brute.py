"""Plain versions of the corpus operators, over lists of (doc_id, text)."""

import hashlib
import re
from collections import defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def line_dedup(rows, least=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least and i is not None:
                docs[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(docs.get(key(x), ())) > 1 and i != min(docs[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = list(nodes)
    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if find(a) != find(b) and linked(a, b):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {n: find(n) for n in nodes}


def shingle_set(text, k):
    w = words((text or "").translate(LOW))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_duplicates(rows, k=3, percent=85):
    sets = {i: shingle_set(t, k) for i, t in rows}
    link = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(
        sets[a] & sets[b]
    ) >= percent * len(sets[a] | sets[b])
    return {i: (len(sets[i]), c) for i, c in components(sets, link).items()}


def substrings(rows, length=50):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        for j in range(len(w) - length + 1):
            first.setdefault(tuple(w[j : j + length]), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for j in range(len(w) - length + 1):
            if i is not None and first[tuple(w[j : j + length])] < i:
                gone.update(range(j, j + length))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def repeated_bytes(rows, length=200):
    seen = defaultdict(int)
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for j in range(len(b) - length + 1):
            seen[b[j : j + length]] += 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and (not j or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for j, x in enumerate(b) if not gone[j])))
    return out


def secrets(text):
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(
        either(w) for w in ("password", "passwd", "secret", "token", "api")
    ).replace(either("api"), either("api") + "_?" + either("key"))
    kinds = {
        "assign": (f"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": ("(AKIA[A-Z0-9]+)", 1, 20),
        "hex": ("([0-9a-f]+)", 1, 24),
    }
    found = [
        (
            m.start(), k, kind, m.end()
        ) for k, (kind, (p, g, n)) in enumerate(kinds.items()) for m in re.finditer(p, text or "")
        if len(m[g]) >= n
    ]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def contaminated(rows, items, window=20, percent=80):
    """(doc_id, item_id) pairs, by comparing along every diagonal."""
    tokens = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
    out = set()
    for i, text in rows:
        for k, item in items:
            d, b = tokens(text), tokens(item)
            if i is None or k is None or len(b) < 5:
                continue
            w = min(window, len(b))
            for shift in range(w - len(b), len(d) - w + 1):
                lo, hi = max(0, shift), min(len(d), shift + len(b))
                same = [x == y for x, y in zip(d[lo:hi], b[lo - shift : hi - shift], strict=True)]
                if any(100 * sum(same[j : j + w]) >= percent * w for j in range(len(same) - w + 1)):
                    out.add((i, k))
                    break
    return out


def license_phrases(text):
    """(words, places, first, last, labels) of the fixed phrases."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = [
        (j, label) for p, label in phrases.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split()
    ]
    at = [j for j, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(
        sorted({label for _, label in found})
    )


def targets(sizes, weights=(5, 2, 1), times=3):
    """Words of each source that a mix of as many words as there are takes: what is above the cap is shared anew, until none is."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, free, left = {}, set(order), sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= times * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in free}
        out |= {s: times * sizes[s] for s in full}
        free -= full
        left -= sum(times * sizes[s] for s in full)
    return out
