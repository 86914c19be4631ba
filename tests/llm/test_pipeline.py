"""The five stages in a row against brute force, and each stage's rows of its own input."""

import sentencepiece
from conftest import SF
from helpers import brute_classes, brute_repeats, docs_of
from test_decontaminate import brute as overlap

import corpus_pipeline
from tripledger.llm import pieces, quality


def test_same_rows_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    squeeze = quality.zstandard.ZstdCompressor(level=3).compress
    rows = [(r.doc_id, r.text) for r in docs.collect() if quality.judge(r.text or "", None, squeeze)[6]]
    classes = brute_classes(rows)
    rows = [rows[i] for i, c in enumerate(classes) if rows[i][0] == min(rows[k][0] for k in c)]
    rest = brute_repeats([t for _, t in rows], 200)
    rows = [(i, r[4].decode("utf-8", "ignore")) for (i, _), r in zip(rows, rest)]
    # An overlap of 13 words of which 80 % agree holds 4 neighbours of the item; other texts need no full comparison.
    rows = [(i, t) for i, t in rows if not any(shares(t, w) and overlap(t, w) for w in items)]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {i: library.encode(t) for i, t in rows}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < docs.count()


def shares(text, item, n=4):
    words = "".join(c if c.isalnum() else " " for c in item.lower()).split()
    plain = " " + " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()) + " "
    return any(" " + " ".join(words[i : i + n]) + " " in plain for i in range(len(words) - n + 1))


def test_stages_pass_odd_rows_and_columns(spark):
    rows = [(None, None), (1, ""), (2, "a"), (2, "a"), (3, "word " * 3000)]
    docs = docs_of(spark, rows).selectExpr("*", "1 AS key", "2 AS kept", "3 AS root")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == table.columns, name
                assert [f.dataType for f in out.schema] == [f.dataType for f in table.schema], name
            assert out.count() <= len(rows)
