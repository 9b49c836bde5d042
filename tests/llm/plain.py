"""Plain versions of the operators, by their definitions, for small tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np


def u32(ids):
    return np.asarray(ids, "<u4").tobytes()


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def exact(rows):
    """rows: (doc_id, text). {doc_id: (keep_id, group_size)}"""
    import re

    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    return {k: (min(v), len(v)) for v in groups.values() for k in v}


def near(rows, percent, size=5):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        sets[key] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def repeats(rows, width=13):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    first, out = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first.setdefault(tuple(w[i : i + width]), key) < key:
                gone[i : i + width] = [True] * width
        out[key] = (len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def crc(ids):
    return zlib.crc32(u32(ids))
