"""Small tables and brute-force versions that the operators are held against."""

import hashlib
import zlib

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, parts=3):
    """A documents table of (doc_id, text) rows."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def prose(rng, n, vocabulary=400):
    words = ["".join(rng.choice(list("abcdefghilmnoprstuv"), rng.integers(2, 9))) for _ in range(vocabulary)]
    return " ".join(words[k] for k in rng.integers(vocabulary, size=n))


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def brute_repeats(texts, length):
    """(bytes, removed, spans, digest of the rest, rest) of each text, by counting every string of ``length`` bytes."""
    datas = [(t or "").encode() for t in texts]
    counts = {}
    for d in datas:
        for p in range(len(d) - length + 1):
            counts[d[p : p + length]] = counts.get(d[p : p + length], 0) + 1
    out = []
    for d in datas:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if counts[d[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(gone, prepend=False) & gone).sum())
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def word_shingles(text, n=5):
    import re

    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute_classes(rows, least=0.8):
    """Class (frozenset of row places) of each row: components of equal texts and of pairs of plain similarity ``least``."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [word_shingles(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            both = len(bags[a] & bags[b])
            if same or (both and both / (len(bags[a]) + len(bags[b]) - both) >= least):
                parent[find(a)] = find(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), set()).add(i)
    return [frozenset(groups[find(i)]) for i in range(len(rows))]
