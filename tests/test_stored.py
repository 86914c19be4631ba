"""Landed tables by day and tables stored by key: what the plans leave out."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from catalog import standins
from tripledger.plans import banks, issuers, landed_days, production, summary
from tripledger.sources import bucketed, commits, loader


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """All landed tables of 40 rows each, by day and in one piece."""
    folder, out = tmp_path_factory.mktemp("days"), {}
    for table in landed_days.DAY_COLUMNS:
        frame = standins.statement(spark, SF, table) if table in standins.STATEMENTS else standins.report(spark, SF, table)
        frame = frame.limit(40).cache()
        rows, columns = landed_days.partition(frame, table)
        loader.write_table(rows, f"{folder}/{table}", partition_by=columns)
        out[table] = commits.landed(spark, f"{folder}/{table}"), frame
    return out


def test_every_landed_scan_is_cut_by_day(spark, by_day):
    rules = standins.RULES.but(report_months=24)
    tables = landed_days.since({n: t for n, (t, _) in by_day.items()}, rules)
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        for view in (issuers.issuer_contributions, banks.bank_contributions):
            scans = [line for line in plan(view(tables, rules, True)).split("== Physical Plan ==")[1].splitlines() if "FileScan parquet" in line]
            assert scans and all(re.search(r"PartitionFilters: \[[^\]]*landed_day", s) for s in scans if "trading_name" not in s or "trxdate" in s.lower())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_results_are_those_of_whole_tables(spark, by_day):
    for months in (24, 60):
        rules = standins.RULES.but(report_months=months)
        near = landed_days.since({n: t for n, (t, _) in by_day.items()}, rules)
        whole = {n: t for n, (_, t) in by_day.items()}
        for view in (issuers.issuer_contributions, banks.bank_contributions):
            own, all_of = dict(near), dict(whole)
            if view is banks.bank_contributions:
                own[banks.MANDIRI_REPORT] = whole[banks.MANDIRI_REPORT]
            assert view(own, rules, True).exceptAll(view(all_of, rules, True)).isEmpty() and view(all_of, rules, True).exceptAll(view(own, rules, True)).isEmpty()


def test_rows_without_a_day_stay(spark, tmp_path):
    rows = spark.sql("SELECT date'2001-01-01' AS transaction_date, 1 AS v UNION ALL SELECT NULL, 2 UNION ALL SELECT date'1990-01-01', 3")
    table = banks.BCA_FILE
    loader.write_table(landed_days.by_day(rows, table), str(tmp_path / "t"), partition_by=[landed_days.LANDED_DAY])
    got = landed_days.since({table: commits.landed(spark, str(tmp_path / "t"))}, standins.RULES)[table]
    assert sorted(r.v for r in got.collect()) == [1, 2] and got.columns == ["transaction_date", "v"]


def test_bucketed_tables_join_in_place(spark, tmp_path):
    tables = standins.production_tables(standins.merchant_payments(spark, SF), spark, SF)
    settlement = bucketed.save_bucketed(production.text_id(tables[summary.SETTLEMENT]), "test_settlement", production.TEXT_ID, 4, str(tmp_path))
    transactions = bucketed.save_bucketed(tables[summary.TRANSACTIONS], "test_transactions", "trx_id", 4, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = production.join_transactions(settlement, transactions, standins.RULES)
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        plain = production.join_transactions(tables[summary.SETTLEMENT], tables[summary.TRANSACTIONS], standins.RULES)
        assert "Exchange" in plan(plain)
        count = joined.groupBy("trx").agg(F.count("*").alias("n"))
        assert "Exchange" not in plan(count) and count.agg(F.sum("n")).first()[0] == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("test_settlement", "test_transactions"):
            spark.sql(f"DROP TABLE {name}")
