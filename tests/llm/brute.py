"""Plain versions of the contracts, one row at a time."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DARK = re.compile("[^\x20\x09-\x0d]+")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def decontamination(docs, items, size=10):
    windows = defaultdict(set)
    for item_id, text in items:
        w = ALNUM.findall((text or "").translate(LOW))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(item_id)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = ALNUM.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def fingerprint(text, width=3):
    w = DARK.findall((text or "").translate(LOW))
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs, bits=3):
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                group[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [(d, f"{p:016x}", min(least[root(i)], default=None)) for i, ((d, _), p) in enumerate(zip(docs, prints, strict=True))]


def exact(docs):
    texts = [(t or "").translate(LOW) for _, t in docs]
    size, keep = Counter(texts), {}
    for (d, _), t in zip(docs, texts, strict=True):
        keep[t] = max(keep.get(t, d), d)
    return [(d, keep[t], size[t], d == keep[t], sha(t)) for (d, _), t in zip(docs, texts, strict=True)]


def repeats(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out
