"""Plain Python twins of the operators, and small tables to compare them on."""

import hashlib
from collections import Counter, defaultdict

import xxhash

SMALL = "/root/testdata/sf0.001"


def documents(spark, sf_dir=SMALL):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def least_reachable(nodes, linked):
    """Smallest node reachable, by node; ``linked`` gives pairs."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def without_repeats(rows, window=35):
    """(id, n_words, n_removed, kept words) by counting all windows."""
    counts = Counter()
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for _, w in split:
        counts.update(tuple(w[s : s + window]) for s in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if counts[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return out


def sha256(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
