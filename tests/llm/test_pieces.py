import random

import pytest
import sentencepiece
from conftest import SF
from helpers import docs_of

from tripledger.llm import pieces

HARD = [
    "", " ", "a", "a" * 50, "hello  world\n\n  x\ty", "éàü ñ 漢字かな 🎉🎉 x", "   ", "!!!!!!!!!!", "<s>abc</s> <unk><0x0A>", "." * 40,
    "0000000000012345678", "\u0000\u0001", "ﬁ ﬀ ½", "e\u0301", " lead and trail ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def machine():
    return pieces.Transducer(pieces.Vocabulary.read(pieces.MODEL))


def test_same_ids_as_the_library(machine, library):
    draw = random.Random(3)
    letters = "abcdefgeeeettttaaaooinshr  .,!0123é-_'\"AB\n▁"
    texts = HARD + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(draw.choice("ab ") for _ in range(draw.randint(1, 60))) for _ in range(800)]
    for text in texts:
        ids = machine.encode(text)
        assert ids == library.encode(text), text
        assert machine.decode(ids) == text.replace("▁", " ")


def test_real_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = pieces.encode_documents(docs).collect()
    assert all(r.ids == library.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip for r in rows)
    back = pieces.decode_documents(spark.createDataFrame([(r.doc_id, r.ids) for r in rows], "doc_id long, ids array<int>"))
    assert {r.doc_id: r.text for r in back.collect()} == texts


def test_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, None), (None, "x y"), (2, ""), (2, ""), (3, "a▁b")]
    docs = docs_of(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_pieces", "3 AS round_trip")
    got = sorted(((r.doc_id or 0, r.ids, r.round_trip) for r in pieces.encode_documents(docs).collect()))
    assert got == [(0, library.encode("x y"), True), (1, [], True), (2, [], True), (2, [], True), (3, library.encode("a▁b"), False)]
    assert pieces.encode_documents(docs.limit(0)).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [r.text for r in pieces.decode_documents(null).collect()] == [""]


def test_unigram_vocabularies_take_the_lightest_path():
    vocabulary = pieces.Vocabulary(
        ("<unk>", "<0x62>", "▁", "a", "aa", "▁a", "▁aa"), (0, 0, -1.0, -1.0, -1.2, -1.1, -3.0), (2, 6, 1, 1, 1, 1, 1), False, True
    )
    machine = pieces.Transducer(vocabulary)
    spell = lambda text: [vocabulary.pieces[i] for i in machine.encode(text)]
    assert spell("aa") == ["▁a", "a"] and spell("aaa") == ["▁a", "aa"] and spell("ab") == ["▁a", "<0x62>"]
