"""Plan shape: scans, shuffles, pushed filters, and a hot key that holds a third of the rows."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog import standins
from catalog.standins import RULES
from tripledger.operators import contributions, shaping
from tripledger.plans import banks, issuers, production, summary
from tripledger.sources import raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return standins.pipeline_tables(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def enriched(tables):
    return production.enrich_settlement(
        tables[summary.SETTLEMENT], tables[summary.REVERSALS], tables[summary.MERCHANTS], tables[summary.TRANSACTIONS], RULES
    )


def test_issuers_share_two_shuffles(tables):
    text = plan(issuers.issuer_contributions(tables, RULES, bounded=True))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("FileScan parquet") == 12
    assert "Expand" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_reversal_join_is_dropped_and_production_read_once(tables):
    text = plan(production.production_contributions(enriched(tables), RULES))
    assert "reversal_trx_id" not in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert sum("gmv" in s for s in scans) == 1


def test_distinct_count_reuses_the_join_partitioning(tables, no_broadcast):
    text = plan(production.production_contributions(enriched(tables), RULES))
    groups = re.findall(r"Exchange hashpartitioning\(([^)]*)", text)
    assert not any("slice" in g and "trx" in g for g in groups)


def test_period_filter_reaches_the_scan(tables):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan(enriched(tables)))


def test_each_statement_is_scanned_once(tables):
    text = plan(banks.bank_contributions(tables, RULES))
    assert text.count("FileScan parquet") == 5  # four statements and the merchant names
    assert "Cartesian" not in text


def test_statements_are_read_for_the_period_only(spark, tables, tmp_path):
    landed = {}
    for name in (banks.BCA_FILE, banks.BNI_FILE, banks.BTN_FILE, banks.MANDIRI_FILE, banks.MANDIRI_REPORT):
        tables[name].limit(20).write.parquet(f"{tmp_path}/{name}")
        landed[name] = spark.read.parquet(f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(banks.bank_contributions(landed, RULES, bounded=True))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for column in ("transaction_date", "post_date", "postdate"):
        assert re.search(rf"PushedFilters: \[[^\n]*GreaterThanOrEqual\({column},", text), column
    # BNI's posting time is text: it is bounded right above the parse.
    assert sum("Filter" in line and ">= 1994-12-01" in line for line in text.splitlines()) >= 4


def test_hot_key(spark, no_broadcast):
    """A third of the rows share one transaction id and one merchant: results stay whole."""
    rows = 30_000
    settlement = spark.range(rows).select(
        F.expr("timestamp_ntz'2001-03-01 10:00:00'").alias("txn_date"),
        F.lit("OVO").alias("issuer"),
        F.expr("if(id % 3 = 0, 1L, id)").alias("account_id"),
        *[F.lit("x").alias(c) for c in ("merchant_id", "merch_name", "internal_ref_field", "issuer_ref_field", "issuer_txn_ref", "terminal_id")],
        F.lit("Customer Purchase").alias("txn_type"),
        F.expr("if(id % 3 = 0, 0L, id)").alias("credit_trans_trx_id"),
        F.lit(1).cast("decimal(18,2)").alias("amt"),
    )
    merchants = spark.range(rows).select(F.col("id").alias("account_id"), F.lit("v").alias("vendor_type"), F.lit("r").alias("referral_code_acquisition"))
    transactions = spark.range(rows).select(
        F.col("id").cast("string").alias("trx_id"), F.lit("ON US").alias("onus_offus"), F.expr("timestamp_ntz'2001-03-01 00:00:00'").alias("trx_date")
    )
    none = spark.range(0).select(F.col("id").alias("trx_id"))
    frame = production.enrich_settlement(settlement, none, merchants, transactions, RULES)
    row = production.production_contributions(frame, RULES).first()
    assert (row.yti_traffic, row.yti_trx_amount) == (rows - rows // 3 + 1, rows)


def test_measure_spreads_one_group(spark):
    rows = spark.range(10_000).repartition(4).select(
        F.expr("date_add(date'2024-01-01', cast(id % 1 as int))").alias("receival_date"),
        F.expr("if(id < 0, 'A', 'B')").alias("bank"), F.expr("if(id < 0, 'q', 'r')").alias("remarks"),
        F.col("id").alias("trx"), F.lit(1).cast("decimal(18,2)").alias("gross"), F.lit(1).cast("decimal(18,2)").alias("net"),
    )
    first = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan(contributions.measure(rows, "yti")))
    assert any("trx" in keys for keys in first)


def test_leading_rows_are_limited_before_the_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\nb\nc\n")
    rows = shaping.drop_leading(raw.read_lines(spark, str(tmp_path)), 1)
    text = plan(rows)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_marks_of_counted_files_are_sent_to_the_rows(spark, tmp_path, no_broadcast, monkeypatch):
    """The rows of files that a reader has counted stay where they are; marks of too many files, or too large, are not sent."""
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text("b,a\n1,x\n")
    rows = raw.read_cells(spark, str(tmp_path))
    for shaped in (shaping.drop_header(rows), shaping.take_header(rows), shaping.trim_trailing_empty(rows)):
        text = plan(shaped)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert sorted(r.cells for r in shaping.drop_header(rows).collect()) == [["1", "x"], ["1", "x\ny"]]
    monkeypatch.setattr(raw, "SENT", 2 * raw.MARK)
    assert "BroadcastHashJoin" in plan(shaping.drop_header(rows)) and "SortMergeJoin" in plan(shaping.take_header(rows))
