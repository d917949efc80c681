"""Small document tables and the plain Python that the operators must agree with."""

import re
from collections import Counter, defaultdict

_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table of (doc_id, text) pairs."""
    full = [(i, t, "en", "src0", len(t) if t else None) for i, t in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(_ASCII_LOWER))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard_components(texts, percent=80):
    """Component numbers of all texts, by comparing each pair that shares a shingle."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for k, s in enumerate(sets):
        shared = Counter(o for x in s for o in holders[x] if o < k)
        for o, common in shared.items():
            if 100 * common >= percent * (len(s) + len(sets[o]) - common):
                a, b = find(k), find(o)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]
