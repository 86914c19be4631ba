from itertools import combinations

import numpy as np
from conftest import SF
from helpers import docs_of, prose

from tripledger.llm import decontaminate
from tripledger.llm.common import word_hashes

ITEMS = "item_id long, text string"


def brute(doc, item, least=13, agree=0.8):
    """Words of the longest overlap on any alignment, by trying every stretch."""
    d, t = word_hashes(doc or ""), word_hashes(item or "")
    best = 0
    for shift in range(-len(t) + 1, len(d)):
        first, last = max(0, -shift), min(len(t), len(d) - shift)
        same = np.concatenate([[0], np.cumsum(d[first + shift : last + shift] == t[first:last])])
        for i in range(len(same)):
            for j in range(len(same) - 1, i + best, -1):
                inside = same[j] - same[i]
                if inside >= agree * (j - i) and same[i + 1] > same[i] and same[j] > same[j - 1]:
                    best = j - i
                    break
    return best if best >= min(least, len(t)) and len(t) >= 8 and best else 0


def swapped(rng, text, every):
    words = text.split()
    for k in range(int(rng.integers(every)), len(words), every):
        words[k] = "other"
    return " ".join(words)


def test_planted_passages(spark):
    rng = np.random.default_rng(12)
    items = [prose(rng, n) for n in (30, 60, 45, 14, 9, 5)] + [None, ""]
    clean = [prose(rng, 300) for _ in range(6)]
    docs = [
        clean[0] + " " + items[0] + " " + clean[1], swapped(rng, items[1], 8), clean[2] + " " + swapped(rng, items[2], 10).upper() + ", " + clean[3],
        clean[4] + " " + items[3] + " " + items[4] + "! " + clean[5], items[0][:40] + clean[0], items[5] + " " + clean[1], None, "",
        " ".join(items[1].split()[20:36]) + " " + clean[2], *clean, items[0] + " " + clean[3] + " " + items[2] + " " + items[0],
    ]
    rows = list(enumerate(docs)) + [(1, docs[1]), (None, docs[0])]
    table = spark.createDataFrame(list(enumerate(items)) + [(0, items[0]), (None, items[1])], ITEMS)
    got = {(r.doc_id, r.item_id): r.n_words for r in decontaminate.contaminations(docs_of(spark, rows), table).collect()}
    want = {}
    for i, doc in rows:
        for k, item in [*enumerate(items), (None, items[1])]:
            n = brute(doc, item)
            if n:
                want[i, k] = n
    assert got == want
    kept = decontaminate.decontaminated(docs_of(spark, rows).selectExpr("*", "1 AS key", "2 AS __x"), table)
    dirty = {i for i, _ in want}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in enumerate(docs) if i not in dirty)


def test_benchmark_itself_and_real_documents(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = items.selectExpr("item_id AS doc_id", "text", "'en' AS lang")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(docs, items).collect()}
    assert got >= {(r.item_id, r.item_id) for r in items.collect()}
    real = spark.read.parquet(f"{SF}/documents.parquet")
    texts, passages = {r.doc_id: r.text for r in real.collect()}, {r.item_id: r.text for r in items.collect()}
    whole = {(d, i) for d, t in texts.items() for i, p in passages.items() if t and " ".join(p.split()) in " ".join(t.split())}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminations(real, items).collect()} >= whole


def test_longest_overlap_is_the_longest():
    rng = np.random.default_rng(1)
    for _ in range(300):
        same = rng.random(rng.integers(1, 40)) < rng.choice([0.5, 0.75, 0.9])
        i, j = decontaminate.longest_overlap(same, 0.8)
        sums = np.concatenate([[0], np.cumsum(same)])
        best = max((b - a for a in range(len(sums)) for b in range(a + 1, len(sums)) if sums[b] - sums[a] >= 0.8 * (b - a) - 1e-9), default=0)
        assert j - i == best and (not best or sums[j] - sums[i] >= 0.8 * best - 1e-9)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o")], ITEMS)
    assert decontaminate.contaminations(docs_of(spark, []), items).collect() == []
    assert decontaminate.contaminations(docs_of(spark, [(1, "a b")]), items.limit(0)).collect() == []
    assert decontaminate.decontaminated(docs_of(spark, [(1, "a b")]), items.limit(0)).count() == 1


def test_every_replacement_leaves_a_seed():
    """All overlaps of 8 to 25 words with a fifth of the words replaced, first and last word equal."""
    masks = [sum(1 << at for at, bit in enumerate(mask) if bit == "1") for mask in decontaminate.MASKS]
    for n in range(8, 26):
        whole = (1 << n) - 1
        left = np.array([whole - sum(1 << k for k in gone) for gone in combinations(range(1, n - 1), n // 5)])
        for mask in masks:
            for shift in range(n - mask.bit_length() + 1):
                left = left[left & (mask << shift) != mask << shift]
        assert not len(left), n


def test_replaced_words_of_short_overlaps(spark):
    rng = np.random.default_rng(31)
    around = prose(rng, 40)
    items, docs = [], []
    for n in (8, 10, 13, 15):
        item = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for gone in combinations(range(1, n - 1), n // 5):
            docs.append((n, around + " " + " ".join("other" if k in gone else w for k, w in enumerate(item)) + " " + around))
    rows = [(n * 1000 + i, text) for i, (n, text) in enumerate(docs)]
    got = decontaminate.contaminations(docs_of(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((r.doc_id, r.item_id, r.n_words) for r in got) == sorted((i, i // 1000, i // 1000) for i, _ in rows)


def test_short_items_as_a_whole(spark):
    table = spark.createDataFrame([(1, "Alpha beta"), (2, "alpha beta gamma delta eps zeta eta"), (3, "omega"), (4, "..."), (5, None)], ITEMS)
    rows = [(0, "x alpha, beta gamma delta eps zeta eta y"), (1, "the omega"), (2, "beta alpha gamma"), (3, None), (4, "...")]
    docs = docs_of(spark, rows)
    got = decontaminate.contaminations(docs, table, short_items=True).collect()
    assert sorted((r.doc_id, r.item_id, r.doc_word, r.n_words) for r in got) == [(0, 1, 1, 2), (0, 2, 1, 7), (1, 3, 1, 1)]
    assert sorted(r.doc_id for r in decontaminate.decontaminated(docs, table, short_items=True).collect()) == [2, 3, 4]
