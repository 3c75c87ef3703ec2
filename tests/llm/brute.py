"""Plain single-machine forms of the text operators, to hold results against."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def reach(nodes, links):
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fingerprint(text: str | None) -> int:
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs):
    marks = {d: fingerprint(t) for d, t in docs}
    ids = sorted(marks)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (marks[a] ^ marks[b]).bit_count() <= 2]
    roots = reach(ids, links)
    return {d: (f"{marks[d]:016x}", roots[d]) for d in ids}


def covered(sequences, length):
    """Flags of units covered by windows that start in a smaller document too."""
    owner = {}
    for doc in sorted(sequences):
        s = sequences[doc]
        for i in range(len(s) - length + 1):
            owner.setdefault(s[i : i + length], doc)
    flags = {}
    for doc, s in sequences.items():
        gone = np.zeros(len(s), bool)
        for i in range(len(s) - length + 1):
            if owner[s[i : i + length]] < doc:
                gone[i : i + length] = True
        flags[doc] = gone
    return flags


def suffix(docs, length=50):
    texts = {d: (t or "").encode() for d, t in docs}
    out = {}
    for doc, gone in covered(texts, length).items():
        kept = bytes(b for b, g in zip(texts[doc], gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[doc] = (len(texts[doc]), int(gone.sum()), runs, sha(kept))
    return out


def windows(docs, length=50):
    words = {d: tuple(WORD.findall(t or "")) for d, t in docs}
    out = {}
    for doc, gone in covered(words, length).items():
        kept = " ".join(w for w, g in zip(words[doc], gone) if not g)
        out[doc] = (len(words[doc]), int(gone.sum()), sha(kept.encode()))
    return out


def line_key(line: str) -> str:
    line = line.strip("\x20\x09\x0a\x0b\x0c\x0d")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def lines(docs, least=10):
    seen = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            seen[line_key(line)].add(doc)
    out = {}
    for doc, text in docs:
        parts = (text or "").split("\n")
        kept = [p for p in parts if not line_key(p) or len(seen[line_key(p)]) < least]
        out[doc] = (len(parts), len(parts) - len(kept), sha("\n".join(kept).encode()))
    return out


def neighbours(rows, nearest=20):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in zip(ids.tolist(), vectors):
        if i % 20 == 0:
            total = np.zeros(len(ids))
            for k in range(len(v)):
                total += v[k] * vectors[:, k]
            order = [j for j in np.lexsort((ids, -total)) if ids[j] != i][:nearest]
            out[i] = [(int(ids[j]), float(total[j])) for j in order]
    return out


def near_vectors(rows, threshold=0.95):
    ids = [i for i, _ in rows]
    unit = np.array([np.array(v, np.float64) / np.linalg.norm(v) for _, v in rows])
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    roots = reach(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    return {i: (int(near[k].sum()), roots[i]) for k, i in enumerate(ids)}


def goals(sizes, weights=(5, 2, 1)):
    """Targets by water filling; `sizes` in order of the sources' names."""
    weight = [weights[i % 3] for i in range(len(sizes))]
    held = [False] * len(sizes)
    while True:
        left = sum(sizes) - sum(3 * s for s, h in zip(sizes, held) if h)
        share = sum(w for w, h in zip(weight, held) if not h)
        goal = [3 * s if h else left * w / share for s, w, h in zip(sizes, weight, held)]
        over = [g > 3 * s and not h for g, s, h in zip(goal, sizes, held)]
        if not any(over):
            return goal
        held = [h or o for h, o in zip(held, over)]
        if all(held):
            return [3 * s for s in sizes]
