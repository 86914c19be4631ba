"""Registered queries of the numbered operators, each over its whole table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripledger.llm import chat, decontaminate, html, jaccard, language, neardup, periodic, pieces, quality, sharding, suffixes, toxicity, whitening
from tripledger.llm.common import documents, prepare
from tripledger.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARD_BYTES = 1 << 20


def query(name: str, sql: str | None = None):
    def wrap(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return wrap


@query("op3_quality_rules")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(documents(spark, folder))


@query("op4_chat_formatting", chat.ORACLE)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(prepare(spark), folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.formatted(chat.events_of(rows.unionByName(chat.trap(spark)))))


@query("op7_sharding", sharding.oracle(SHARD_BYTES))
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.extendible_shards(documents(spark, folder), SHARD_BYTES)


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), read_table(spark, folder, "labels"))


@query("op10_language_id")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_id(documents(spark, folder))


@query("op8_sentencepiece")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, folder))


@query("op6_decontamination")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminations(documents(spark, folder), read_table(spark, folder, "benchmark"), short_items=True)


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, folder))


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeats(documents(spark, folder), with_rest=False)


@query("op2_html_extraction")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(read_table(prepare(spark), folder, "pages"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(prepare(spark), folder, "embeddings"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.periodic_runs(documents(spark, folder), change=periodic.planted, with_text=False)


@query("op12_ngram_jaccard_join")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, folder))
