"""From raw documents to token ids: quality, near copies, repeated strings, benchmark passages, encoding.

Each stage is one operator of ``tripledger.llm`` and works on all that its predecessor kept:

1. quality: documents outside the compression bands (or of too few or too repetitive words) go;
2. near copies: one document of each group stays, that of the smallest id;
3. repeated strings: bytes covered by a repeated 200-byte string are cut out of the text, ``n_chars`` follows;
   a document that consists of such bytes alone stays with an empty text;
4. benchmark passages: documents that overlap a benchmark item go;
5. encoding: piece ids of what is left, and whether they decode to the text.

Stages 1 to 4 return the columns of their input, extra columns included. Null and empty texts fall to stage 1. An empty table passes
through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm import decontaminate, neardup, pieces, quality, suffixes
from tripledger.llm.common import prepare, stored
from tripledger.session import read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.without_near_duplicates(docs)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    kept = suffixes.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[f"`{c}`" for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, read_table(prepare(spark), sf_dir, "benchmark"), short_items=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pieces.encode_documents(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("minhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeated_strings),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", encoded),
]

# Compression ratios, sampled hashes and piece ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
