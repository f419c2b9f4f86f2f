"""Plain single-process versions of the corpus operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import html
import re
import zlib


def shingles(text, words=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, words=5, percent=75):
    """docs: {id: text}. -> {id: (n_shingles, component_id)}, by counting shared shingles of all pairs."""
    sets = {i: shingles(t, words) for i, t in docs.items()}
    where: dict = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    shared: dict = {}
    for ids in where.values():
        ids.sort()
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    root = closure(docs, links)
    return {i: (len(sets[i]), root[i]) for i in docs}


def remove_repeats(docs, length=50):
    """docs: {id: text}. -> {id: (n_bytes, n_removed, n_spans, kept bytes)}."""
    data = {i: (t or "").encode() for i, t in docs.items()}
    first: dict = {}
    for i in sorted(data):
        for p in range(len(data[i]) - length + 1):
            first.setdefault(data[i][p : p + length], i)
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), kept)
    return out


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def article(page: str) -> str:
    """The text of the test pages' one article element, cut by its tags."""
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    if not inside:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", inside[1])
    plain = (html.unescape(re.sub(r"<[^>]*(?:>|\Z)", lambda m: " " if m[0].startswith("<br") else "", b)) for b in blocks)
    return "\n\n".join(b for b in (" ".join(x.split()) for x in plain) if b)


def auc(pairs):
    """Chance that a positive scores above a negative; ties count half."""
    pairs = sorted(pairs)
    ranks, i = 0.0, 0
    pos = sum(y for _, y in pairs)
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        ranks += sum(y for _, y in pairs[i:j]) * (i + j + 1) / 2
        i = j
    neg = len(pairs) - pos
    return (ranks - pos * (pos + 1) / 2) / (pos * neg) if pos and neg else 1.0
