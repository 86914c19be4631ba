"""Language, toxicity and main text: accuracy on rows never learned from, and what goes in."""

import numpy as np
import pytest
from helpers import docs_of, is_held_out, prose

from tripledger.llm import html, language, toxicity

SF = "/root/testdata/sf0.1"


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 3000")
    got = language.language_id(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(truth) and all(r.held_out == is_held_out(r.doc_id) for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_needs_text_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    hidden = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id AS string)) % 5 = 0, 'zz', lang) AS lang")
    a = {r.doc_id: (r.lang_pred, r.score) for r in language.language_id(docs).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in language.language_id(hidden).collect()}


def test_language_of_odd_rows(spark):
    rows = [(1, "the cat sat on the mat " * 20), (2, "le chat est sur la table " * 20), (11, None), (None, "12 34 !"), (12, ""), (None, "the cat")]
    docs = spark.createDataFrame([(i, t, {1: "en", 2: "fr"}.get(i), 0.5) for i, t in rows], "doc_id long, text string, lang string, score double")
    assert not is_held_out(1) and not is_held_out(2)
    got = {(r.doc_id, r.lang_pred, r.held_out) for r in language.language_id(docs).collect()}
    assert got == {(1, "en", False), (2, "fr", False), (11, "und", is_held_out(11)), (None, "und", True), (12, "und", is_held_out(12)), (None, "en", True)}
    assert language.language_id(docs.limit(0)).collect() == []
    nothing = language.language_id(docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def brute_phrases(text, learned):
    """Greedy parse by searching: a phrase grows while it occurs in ``learned``."""
    count, phrase = 1, ""
    for c in text:
        if phrase + c in learned:
            phrase += c
        else:
            count, phrase = count + 1, c if c in learned else ""
    return count


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(2)
    sample = [("a", prose(rng, 60)), ("b", prose(rng, 80)), ("b", prose(rng, 30))]
    parser = language.Parser(sample)
    texts = [prose(rng, 40), sample[0][1][:200], "zzz qq", sample[1][1]]
    for k, lang in enumerate(parser.langs):
        learned = "".join(t + " " for one, t in sample if one == lang)
        want = [sum(brute_phrases(t[i : i + language.BLOCK], learned) for i in range(0, len(t), language.BLOCK)) for t in texts]
        assert parser.phrases([parser.alphabet.symbols(t) for t in texts])[k].tolist() == want


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.toxicity(docs, labels).collect(), {r.doc_id: r.toxic for r in labels.collect()}


def test_toxicity_of_held_out_rows(scored):
    rows, truth = scored
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    hit = [r.predicted for r in held if truth[r.doc_id] == 1]
    alarm = [r.predicted for r in held if truth[r.doc_id] == 0]
    assert np.mean(hit) > 0.75 and np.mean(alarm) < 0.02


def test_pairs_are_learned():
    """Two terms that are harmless alone: only a machine with interactions can tell."""
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        words = ["insult"] * int(a) + ["group"] * int(b) + prose(rng, 6, 30).split()
        rows.append(toxicity.terms_of(" ".join(words)))
        labels.append(int(a == b))  # no additive weights can express this
    labels = np.array(labels)
    model = toxicity.fit(rows[:1200], labels[:1200], epochs=40)
    assert ((model.logits(rows[1200:]) > 0) == labels[1200:]).mean() > 0.9


def test_logits_are_pair_sums():
    model = toxicity.Machine(0.3, np.array([2, 5, 9], np.int32), np.array([1.0, -2.0, 0.5]), np.array([[1.0, 2.0], [0.5, -1.0], [3.0, 0.0]]))
    row = np.array([2, 4, 9], np.int32)
    x = 1 / np.sqrt(3)
    assert model.logits([row, np.zeros(0, np.int32)]).tolist() == pytest.approx([0.3 + x * 1.5 + x * x * 3.0, 0.3])


def test_toxicity_of_odd_rows(spark):
    docs = docs_of(spark, [(1, "idiot"), (1, "idiot"), (2, None), (None, "x"), (3, "")]).selectExpr("*", "1 AS score", "2 AS toxic")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    assert len(toxicity.toxicity(docs, labels).collect()) == 5
    assert all(r.score < 1e-9 for r in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def article_of(page):
    import html as std
    import re

    inside = re.search(r"<article>(.*)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inside[1] if inside else "")
    texts = (" ".join(std.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", b))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_main_text_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    truth = {r.page_id: article_of(r.html) for r in pages.collect()}
    odd = [(-1, "u", None), (-2, None, ""), (-3, "u", "<<p <b"), (-4, "u", "<p>&lt;x&gt; &eacute;&nbsp;\n y"), (-4, "u", "<p>&lt;x&gt; &eacute;&nbsp;\n y")]
    more = spark.createDataFrame(odd, "page_id long, url string, html string")
    rows = html.main_text(pages.unionByName(more).selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    got = {r.page_id: r.text for r in rows if r.page_id >= 0}
    wrong = [k for k in truth if got[k] != truth[k]]
    assert len(wrong) <= 1, wrong
    assert all(r.n_chars == len(r.text) for r in rows) and len(rows) == len(truth) + 5
    assert {r.text for r in rows if r.page_id in (-1, -2)} == {""}
    assert html.main_text(pages.limit(0)).collect() == []


def test_blocks_of_markup():
    page = (
        "<head><title>t</title><style>p{}</style></head><body><script>var a='<p>no</p>'</script><!-- c --><p>One <b>bo<i>ld</b></i>"
        "<p>two&amp;<br>lines &copy<ul><li>a<li>b <a href=x>c</a></ul><div class='Cookie-notice' id=x1>d<p>e</div>f<table><tr><td>g<td>h</table>"
    )
    found = [(b.text, b.path) for b in html.blocks_of(page)]
    assert [t for t, _ in found] == ["One bold", "two& lines ©", "a", "b c", "d", "e", "f", "g", "h"]
    assert found[5][1] == ["<body>", "<div>", "cookie", "notice", "x", "<p>"] and found[6][1] == ["<body>"]


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    network = html.Network.fresh(5, 3)
    network.w = {k: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for k, v in network.w.items()}
    pages = [rng.normal(size=(n, 5)) for n in (4, 2, 1)]
    labels = [rng.integers(0, 2, len(p)).astype(float) for p in pages]

    def loss():
        total = 0.0
        logits = network.logits(pages)[0]
        for k, label in enumerate(labels):
            z = logits[: len(label), k]
            total += (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * label).sum()
        return total / sum(map(len, labels))

    found = network.gradients(pages, labels)
    for name, w in network.w.items():
        for place in zip(*(rng.integers(0, s, 4) for s in w.shape)):
            old = w[place]
            w[place] = old + 1e-3
            up = loss()
            w[place] = old - 1e-3
            down = loss()
            w[place] = old
            assert found[name][place] == pytest.approx((up - down) / 2e-3, abs=2e-4), name


def test_large_alphabets(spark):
    """Two languages of a thousand letters each, which share none of the common ones, beside one of few letters."""
    rng = np.random.default_rng(12)
    ranges = {"ja": [*range(0x3041, 0x3090), *range(0x6000, 0x63A0)], "zh": list(range(0x4E00, 0x51E8))}
    rows = []
    for k in range(240):
        lang = ("en", "ja", "zh")[k % 3]
        text = prose(rng, 60, 4000) if lang == "en" else "".join(chr(c) for c in rng.choice(ranges[lang], 150))
        rows.append((k, text, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.language_id(docs).collect()
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in got if r.held_out]) == 1
    assert language.language_id(spark.createDataFrame([(1, "漢字", None)], docs.schema)).first().lang_pred == "und"


def test_telling_words_may_come_last():
    """All words of a block are in its vector, however long it is, and shown elements are left to the network."""
    long = " ".join(f"w{k}" for k in range(200))
    a, b = (html.vectors(html.blocks_of(f"<p>{long} {end}</p>"))[0] for end in ("subscribe", "whatever"))
    assert (a != b).any()
    assert [b.text for b in html.blocks_of("<article><p>sum <math>x+y</math> end</p></article>")] == ["sum x+y end"]
