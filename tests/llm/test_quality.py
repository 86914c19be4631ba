from collections import Counter

import numpy as np
from helpers import docs_of, prose

from tripledger.llm import quality


def brute(text):
    space = " \t\n\v\f\r"
    words, word = [], ""
    for c in (text or "") + " ":
        if c in space:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = sum(
        any(0 <= s <= len(words) - 3 and windows[tuple(words[s : s + 3])] > 1 for s in (i - 2, i - 1, i)) for i in range(len(words))
    )
    lines = [x for x in (text or "").split("\n") if any(c not in space for c in x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * inside > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), inside, failed


def test_features_and_verdicts(spark):
    rng = np.random.default_rng(5)
    good = prose(rng, 400)
    noise = " ".join("".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 6)) for _ in range(3000))
    # Under half of the words repeat in windows, but more than a quarter of the chunks.
    half = prose(rng, 2000, 3000) + "\n" + "\n".join(f"{k} the same {k} words in" for k in range(2500))
    texts = [None, "", " \t\n", good, (good[:300] + "\n") * 30, "word " * 500, noise, half, "a # b\n\n a # b\n a # b c", "é\u0085x " * 60]
    got = {r.doc_id: r for r in quality.quality_rules(docs_of(spark, list(enumerate(texts)) + [(3, good)])).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), i
        assert not (r.base_failed and r.kept)
    assert got[3].kept and got[3].reason is None
    assert [got[i].kept for i in (0, 1, 2, 4, 5, 6)] == [False] * 6
    assert got[6].reason == "incompressible" and got[0].reason == "base"
    assert got[7].reason in ("repetitive", "chunks") and not got[7].kept


def test_length_bands():
    bands = quality.Bands()
    squeeze = lambda data: data[: int(len(data) * 0.3)]
    verdict = lambda n: quality.band_verdict(b"x" * n, bands, squeeze)[3]
    # A ratio of 0.3 is too low for a short text and fine for a longer one.
    assert [verdict(n) for n in (0, 1000, 3000, 10_000, 40_000)] == ["empty", "repetitive", None, None, None]


def test_real_documents(spark):
    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.quality_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])


def test_filter_passes_columns_through(spark):
    good = prose(np.random.default_rng(6), 200)
    rows = [(1, good, "a", {"k": 1}), (None, good, None, None), (2, None, "b", None), (3, "short", "c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words map<string,int>")
    got = quality.keep_good(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text == good, r.kept) for r in got.collect()) == [(0, True, None), (1, True, "a")]
    assert quality.keep_good(docs.limit(0)).collect() == [] and quality.quality_rules(docs.limit(0)).collect() == []


def test_verdict_on_labelled_documents(spark):
    """The method's own verdict, on rows that pass the base rule: texts labelled bad fall, those labelled good stay."""
    from conftest import SF

    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = quality.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).where("NOT base_failed").join(labels, "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    wrong, found = sum(not r.kept for r in good), sum(not r.kept for r in bad)
    assert good and bad and wrong <= len(good) // 1000 and found >= len(bad) / 2, (wrong, len(good), found, len(bad))


def test_other_scripts_have_wide_limits():
    assert quality.bands_for("ordinary text", b"ordinary text") is quality.ORDINARY
    for text in ("обычный текст", "普通的文字"):
        assert quality.bands_for(text, text.encode()) == quality.Bands()


def test_limits_that_are_asked_for_hold():
    text = "plain words of an ordinary text " * 4
    for bands in (quality.Bands(), quality.Bands(chunk_bytes=64), quality.ORDINARY):
        assert quality.bands_for(text, text.encode(), bands) is bands
    assert quality.bands_for(text, text.encode()) is quality.ORDINARY
