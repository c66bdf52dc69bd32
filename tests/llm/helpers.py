"""Small tables with awkward rows, and brute-force versions of the operators."""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash


def docs(spark, texts, ids=None):
    """A documents table; ids default to 0, 1, 2, ..."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows(df):
    return [tuple(r) for r in df.collect()]


def repeats(texts, width):
    """Brute force: (n_words, removed word places, kept text) per text."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    windows = [[tuple(w[i:i + width]) for i in range(len(w) - width + 1)] for w in words]
    seen = Counter(x for ws in windows for x in ws)
    out = []
    for w, ws in zip(words, windows):
        gone = {i + j for i, x in enumerate(ws) if seen[x] > 1 for j in range(width)}
        out.append((len(w), sorted(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def bench_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(texts, items, width):
    """Brute force: (n_words, n_hit, sorted item ids) per text; items: (id, text)."""
    out = []
    for t in texts:
        w, hit, found = bench_words(t), set(), set()
        for key, text in items:
            v = bench_words(text)
            n = min(width, len(v))
            for window in {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i:i + n]) == window:
                        hit |= set(range(i, i + n))
                        found.add(str(key))
        out.append((len(w), len(hit), sorted(found)))
    return out


def simhash(text, width=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    k = min(width, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, bits):
    """Brute force components: smallest index reachable per index."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]
