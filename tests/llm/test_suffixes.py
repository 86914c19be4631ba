import hypothesis.strategies as st
import numpy as np
import pytest
from helpers import brute_repeats, docs_of
from hypothesis import given, settings

from tripledger.llm import suffixes
from tripledger.llm.common import prefix_sums


def found(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in df.collect()}


def test_same_as_brute_force(spark):
    rng = np.random.default_rng(2)
    passage = "".join(rng.choice(list("abcd "), 420))
    texts = [
        None, "", "a" * 700, "ab" * 300 + "x" + "ab" * 200, "é" * 150, "q" * 199, "q" * 200,
        passage[:250] + "zz" + passage[1:260], "start " + passage + " end", passage, passage, "r" * 150 + passage[100:300] + "s" * 30,
        "".join(rng.choice(list("ab"), 3000)), "t" * 199 + "u" + "t" * 199,
    ]
    rows = list(enumerate(texts))
    got = found(suffixes.repeats(docs_of(spark, rows)))
    assert got == dict(zip(range(len(texts)), brute_repeats(texts, 200)))


def test_short_lengths_on_a_small_alphabet(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab"), n)) for n in rng.integers(0, 60, 40)] + ["ab" * 20, "ab" * 21, None]
    for length, anchor, block in ((12, 5, 4), (9, 9, 3), (16, 4, 16)):
        docs = docs_of(spark, list(enumerate(texts)))
        spans = suffixes.repeated_spans(docs, length, anchor, block)
        keys = {bytes(r.key): r.text for r in docs.select(suffixes.text_key().alias("key"), "text").collect()}
        masks = {}
        for r in spans.collect():
            n = len((keys[bytes(r.key)] or "").encode())
            mask = masks.setdefault(keys[bytes(r.key)], np.zeros(n, bool))
            if r.width < 0:
                mask[:] = True
            else:
                mask[r.start : r.start + r.width - 1 + length] = True
        for text, want in zip(texts, brute_repeats(texts, length)):
            mask = masks.get(text, np.zeros(want[0], bool))
            assert int(mask.sum()) == want[1], (length, text)


@given(st.text(st.sampled_from("ab"), min_size=30, max_size=80))
@settings(max_examples=60, deadline=None)
def test_anchors_depend_on_the_string_alone(text):
    data = np.frombuffer(text.encode(), np.uint8)
    other = np.frombuffer(b"ab" * 14, np.uint8)
    found = suffixes.runs_of([other, data, other], 20, 6)
    rank, name, start, width, back = (column[found[0] == 1] for column in found[1:])
    alone = suffixes.runs_of([data], 20, 6)
    assert all((a == b).all() for a, b in zip(alone[1:], (rank, name, start, width, back)))
    assert start[0] == 0 and (start[1:] == start[:-1] + width[:-1]).all() and start[-1] + width[-1] == len(data) - 19
    seen = {}
    for r, s, w, b in zip(rank, start, width, back):
        for p in range(s, s + w):
            assert seen.setdefault(text[p : p + 20], (r, s + b - p)) == (r, s + b - p)


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 50, 101).astype(np.uint64)
    for width in (1, 2, 7, 101):
        want = [values[i : i + width].min() for i in range(101 - width + 1)]
        assert suffixes.sliding_least(values, width).tolist() == want


def test_hashes_of_spans_are_of_their_bytes():
    data = np.frombuffer(b"abcabcab" * 5, np.uint8)
    sums = prefix_sums(data)
    at = lambda a, b: int(suffixes.hash_spans(sums, np.array([a]), np.array([b]))[0])
    assert at(0, 3) == at(8, 11) != at(1, 4)


@pytest.mark.parametrize("rows", [[], [(None, None), (None, "x" * 300), (1, "x" * 300)]])
def test_empty_tables_and_null_ids(spark, rows):
    got = suffixes.repeats(docs_of(spark, rows)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == ([] if not rows else [(0, 0), (300, 300), (300, 300)])


def test_other_columns_pass_through(spark):
    passage = "0123456789abcdefghij" * 11
    rows = [(1, "é" + passage + "one", "x", 1.5), (2, passage + "two", None, None), (3, None, "y", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, width double")
    got = {r.doc_id: tuple(r) for r in suffixes.without_repeats(docs).collect()}
    assert got == {1: (1, "éone", "x", 1.5), 2: (2, "two", None, None), 3: (3, None, "y", 2.0)}


def test_columns_of_any_name(spark):
    rows = [(1, "ab" * 200, "k", 1, "s"), (2, "ab" * 200, None, 2, "t"), (3, "x", "q", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key string, __spans int, repeated string")
    got = {r.doc_id: tuple(r) for r in suffixes.without_repeats(docs).collect()}
    assert got == {1: (1, "", "k", 1, "s"), 2: (2, "", None, 2, "t"), 3: rows[2]}
