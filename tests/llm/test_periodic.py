import hashlib
import re
import zlib
from fractions import Fraction

import hypothesis.strategies as st
import numpy as np
import pytest
from conftest import SF
from helpers import docs_of, prose
from hypothesis import given, settings

from tripledger.llm import periodic


def brute_lyndon(t):
    """Longest Lyndon prefix of each suffix: smaller than all its own proper suffixes."""
    out = []
    for i in range(len(t)):
        out.append(max(k for k in range(1, len(t) - i + 1) if all(t[i : i + k] < t[j : i + k] for j in range(i + 1, i + k))))
    return out


def brute_runs(words, least=24, times=3):
    """All runs, by trying every period on every stretch of equal words that far apart."""
    n, out = len(words), set()
    for p in range(1, n // times + 1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if length >= max(least, times * p):
                part = words[i : i + length]
                if not any(part[q:] == part[:-q] for q in range(1, p)):
                    out.add((i, length, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest(listed), digest(rest))


@given(st.lists(st.integers(0, 2), max_size=24))
@settings(max_examples=400, deadline=None)
def test_lyndon_lengths_of_short_texts(t):
    ranks = sorted(set(t))
    t = [ranks.index(c) for c in t]
    assert periodic.lyndon_lengths(t) == brute_lyndon(t)


@given(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 12), st.lists(st.integers(0, 2), max_size=30), st.lists(st.integers(0, 2), max_size=30))
@settings(max_examples=300, deadline=None)
def test_runs_of_small_alphabets(root, times, head, tail):
    t = [f"w{c}" for c in head + root * times + tail]
    joined = " ".join(t).encode()
    for least in (3, 9, 24):
        assert periodic.document_runs(joined, joined.split(), least) == brute_runs(t, least)


def test_long_nested_and_many_runs():
    rng = np.random.default_rng(5)
    inner = ["a"] * 9 + ["b"]
    nested = (inner * 4 + ["c"]) * 5
    texts = [nested, ["x"] * 5000, prose(rng, 300).split() * 4, prose(rng, 80).split() * 2, list("ab" * 40) + list("abc" * 40)]
    fibonacci = ["a", "b"]
    while len(fibonacci) < 600:
        fibonacci = fibonacci + fibonacci[: len(fibonacci) * 8 // 13]
    for t in [*texts, fibonacci[:600], sum(texts[:1] + texts[2:], [])]:
        joined = " ".join(t).encode()
        assert periodic.document_runs(joined, joined.split()) == brute_runs(t)


def test_rows_beside_brute_force(spark):
    rng = np.random.default_rng(6)
    line = prose(rng, 12)
    texts = [None, "", " \n\t ", "one", "w " * 23, "w " * 24, line + " " + " ".join([line] * 5), "é x y " * 30, prose(rng, 900)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "z " * 30), (6, texts[6]), (6, texts[6])]
    rows += [(1000 + i, prose(rng, int(rng.integers(1, 400)))) for i in range(60)]
    docs = docs_of(spark, rows)
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    for plant in (None, periodic.planted):
        got = sorted((tuple(r) for r in periodic.periodic_runs(docs, change=plant, with_text=False).collect()), key=order)
        assert got == sorted((brute_row(*r, plant) for r in rows), key=order)


def test_given_documents_beside_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in periodic.periodic_runs(docs, change=periodic.planted, with_text=False).collect())
    short = [r for r in rows if len((r[1] or "").split()) < 1500]
    assert [g for g in got if g[0] in {r[0] for r in short}] == sorted(brute_row(*r, True) for r in short)


def test_full_outputs_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 20 + "c", "r", 5)], "doc_id long, text string, runs string, start int")
    (row,) = periodic.periodic_runs(df).collect()
    assert row.collapsed == "a b c" and [tuple(r) for r in row.runs] == [(0, 40, 2)]
    assert periodic.periodic_runs(docs_of(spark, [])).collect() == []


def test_a_very_long_text():
    rng = np.random.default_rng(7)
    words = prose(rng, 150_000).encode().split() + [b"tail", b"end"] * 30_000
    runs = periodic.document_runs(b" ".join(words), words)
    assert runs and runs[-1][1:] == (60_000, 2) and len(b" ".join(words)) > 1_000_000


def test_few_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs_of(spark, []), times=2)
