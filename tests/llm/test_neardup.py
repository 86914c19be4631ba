import numpy as np
import pytest
from conftest import SF
from helpers import brute_classes, docs_of, prose

from tripledger.llm import neardup
from tripledger.llm.components import components


def edited(rng, text, share):
    words = text.split()
    for k in rng.choice(len(words), max(1, int(len(words) * share)), replace=False):
        words[k] = "changed" + str(rng.integers(1 << 30))
    return " ".join(words)


def family(rng, n, share, words=300):
    base = prose(rng, words)
    return [base] + [edited(rng, base, share) for _ in range(n)]


def classes_of(spark, rows, parts=3):
    """Class of each row as the set of its places, by text (rows of one text share a class) and ids."""
    got = neardup.near_duplicates(docs_of(spark, rows, parts)).collect()
    assert len(got) == len(rows)
    return got


def test_planted_families(spark):
    rng = np.random.default_rng(8)
    license_line = prose(rng, 40)
    texts = family(rng, 12, 0.01) + family(rng, 5, 0.02, 900) + [prose(rng, 200) + " " + license_line for _ in range(15)]
    texts += ["", None, "one two", "one two", "one three", "..."]
    rows = [(k * 3 + 1, t) for k, t in enumerate(texts)] + [(1, texts[0]), (0, texts[3]), (500, texts[0])]
    got = classes_of(spark, rows)
    want = brute_classes(rows)
    by_key = {}
    for r in got:
        by_key.setdefault(r.class_key, []).append(r)
    sizes = sorted(len(c) for c in set(want))
    assert sorted(len(v) for v in by_key.values()) == sizes
    smallest = {frozenset(c): min(rows[i][0] for i in c) for c in want}
    assert sorted((r.doc_id, r.class_id) for r in got) == sorted((rows[i][0], smallest[c]) for i, c in enumerate(want))
    # Every class has one representative; rows of equal id and text represent it together.
    assert all(len({r.doc_id for r in v if r.kept}) == 1 for v in by_key.values())


def test_same_classes_as_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {rows[i][0]: min(rows[k][0] for k in c) for i, c in enumerate(want)}


def test_chain_is_one_class(spark):
    rng = np.random.default_rng(4)
    words = prose(rng, 400).split()
    chain = []
    for k in range(6):  # neighbours are alike, the ends are not
        chain.append(" ".join(words))
        words[k * 30 : k * 30 + 30] = [f"new{k}{j}" for j in range(30)]
    got = classes_of(spark, list(enumerate(chain)))
    assert {r.class_id for r in got} == {0} and all(r.n_links >= 1 for r in got)


def test_filter_keeps_one_row_and_all_columns(spark):
    rng = np.random.default_rng(9)
    a, b = family(rng, 1, 0.005)
    rows = [(5, a, "x", {"k": 1}), (5, a, "y", None), (9, b, "z", None), (None, a, "n", None), (7, None, "e", None), (6, "", "f", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, key map<string,int>")
    got = neardup.without_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.root) for r in got.collect()) == [(5, a, "x"), (6, "", "f")]


def test_columns_of_any_name(spark):
    """Columns called like those that the operators add on their way come out as they went in."""
    rows = [(1, "some words of a text", "k1", 1, "s"), (2, "some words of a text", "k2", 2, "t"), (3, "x", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key string, __row int, kept_key string")
    got = sorted(tuple(r) for r in neardup.without_near_duplicates(docs).collect())
    assert got == [rows[0], rows[2]]


def test_empty_table(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).collect() == []
    assert neardup.without_near_duplicates(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("share", [0.01, 0.03, 0.1])
def test_samples_agree_as_often_as_texts_are_alike(share):
    rng = np.random.default_rng(6)
    frequencies = neardup.Frequencies(1000, np.ones(neardup.DF_SLOTS, np.int64))
    sampler = neardup.Sampler(400, 1)
    same, true = [], []
    for _ in range(12):
        base = prose(rng, 250, 2000)
        pair = [neardup.shingles(t) for t in (base, edited(rng, base, share))]
        bags = [(h, frequencies.weights(h, c)) for h, c in pair]
        same.append(np.mean(np.equal(*sampler.bands_of(bags))))
        true.append(neardup.similarity(*bags))
    assert abs(np.mean(same) - np.mean(true)) < 0.03


def test_similarity_is_weighted_jaccard():
    a = np.array([1, 2, 3], np.uint64), np.array([1.0, 2.0, 3.0])
    b = np.array([2, 3, 9], np.uint64), np.array([1.0, 4.0, 2.0])
    assert neardup.similarity(a, b) == pytest.approx((1 + 3) / (1 + 2 + 4 + 2))


def test_components(spark):
    links = [(b"a", b"b"), (b"c", b"b"), (b"d", b"c"), (b"x", b"y"), (b"y", b"x"), (b"q", b"q")] + [
        (b"%03d" % k, b"%03d" % (k + 1)) for k in range(40)
    ]
    got = {bytes(r.key): bytes(r.root) for r in components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    want = {**dict.fromkeys([b"a", b"b", b"c", b"d"], b"a"), b"x": b"x", b"y": b"x", **{b"%03d" % k: b"000" for k in range(41)}}
    assert got == want


def copies_of_copies(rng, n, words, edits):
    """Each text is an edited copy of a random earlier one."""
    texts = [prose(rng, words)]
    while len(texts) < n:
        made = texts[rng.integers(len(texts))].split()
        for k in rng.choice(words, rng.integers(1, edits + 1), replace=False):
            made[k] = "changed" + str(rng.integers(1 << 30))
        texts.append(" ".join(made))
    return texts


def true_pairs(texts, threshold=neardup.THRESHOLD):
    """All pairs (i < j) that are alike, by the weights that the operator gives these texts; no shingle occurs twice in a text."""
    found = [neardup.shingles(t) for t in texts]
    assert all((c == 1).all() for _, c in found)
    slots = np.zeros(neardup.DF_SLOTS, np.int64)
    for h, _ in found:
        slots[np.unique(neardup._slot(h))] += 1
    frequencies = neardup.Frequencies(len(texts), slots)
    known, place = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
    weights = frequencies.weights(known, np.ones(len(known)))
    owner = np.repeat(np.arange(len(texts)), [len(h) for h, _ in found])
    used = np.zeros((len(texts), len(known)), np.float32)
    used[owner, place] = 1
    both = (used * weights.astype(np.float32)) @ used.T
    total = np.diag(both)[:, None] + np.diag(both)[None] - both
    return np.argwhere(np.triu(both >= threshold * total, 1))


class Known:
    """A broadcast variable's value without a cluster."""

    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("seed", range(6))
def test_partners_share_a_prefix_beyond_the_lightest(seed):
    """x and y alike, r lighter and not alike with both: x and y meet again beyond r, wherever their edits fall."""
    rng = np.random.default_rng(seed)
    frequencies = neardup.Frequencies(1000, rng.integers(0, 900, neardup.DF_SLOTS))
    likeness = neardup.WeightedJaccard(Known(frequencies))
    base, pairs = prose(rng, 150) + " " + " ".join([prose(rng, 9)] * 3), 0
    for _ in range(150):
        x = edited(rng, base, float(rng.choice([0.005, 0.015, 0.03])))
        y = edited(rng, x, float(rng.choice([0.005, 0.015, 0.02])))
        r = edited(rng, " ".join(base.split()[: int(rng.integers(100, 177))]), float(rng.choice([0.005, 0.02, 0.04])))
        x, y, r = sorted((likeness.bag(t) for t in (x, y, r)), key=likeness.weight, reverse=True)
        if likeness.alike(x, y) and not (likeness.alike(x, r) and likeness.alike(y, r)):
            pairs += 1
            assert len(np.intersect1d(likeness.prefix_beyond(x, r), likeness.prefix_beyond(y, r)))
    assert pairs >= 20


def test_copies_of_copies(spark):
    rng = np.random.default_rng(21)
    texts = copies_of_copies(rng, 1500, 120, 5)
    pairs = true_pairs(texts)
    parent = list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for i, j in pairs:
        i, j = sorted((find(i), find(j)))
        parent[j] = i
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs_of(spark, list(enumerate(texts)))).collect()}
    lost = sum(got[i] != got[j] for i, j in pairs)
    assert lost == 0 and got == {k: find(k) for k in range(len(texts))}, (lost, len(pairs), len(set(got.values())), len({find(k) for k in got}))
