"""Landed tables in one folder per day, so that a report reads the days of its period and lists no others.

The day comes from each table's raw posting or transaction column when the table is loaded; BNI's statement shows it as text,
which is parsed there once instead of in every report. ``since`` puts a filter on the day, wide enough for days that
cut-offs and banks shift, in front of a report's own filters: these stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.operators import timing
from tripledger.plans import banks
from tripledger.plans.rules import ReconRules

LANDED_DAY = "landed_day"
# No rule moves a row by more days than that.
SLACK_DAYS = 7

# Raw column of the day of each landed table that reports read.
DAY_COLUMNS = {
    "recon_kredivo_report": "transaction_date",
    "recon_indodana_report": "transaction_date",
    "recon_ovo_report": "transactiondate",
    "recon_shopeepay_report": "create_time",
    "recon_mandiri_bank_report": "trxdate",
    "recon_bni_bank_report": "trx_datetime",
    "recon_issuer_bca_bank_file_report": "payment_date",
    "recon_issuer_btn_bank_file_report": "transaction_date",
    "recon_issuer_ottopay_bank_file_report": "transaction_time",
    "recon_linkaja_mcd_report": "transaction_date",
    "recon_linkaja_expansion_report": "transaction_date",
    "recon_linkaja_msme_report": "transaction_date",
    banks.BCA_FILE: "transaction_date",
    banks.BTN_FILE: "post_date",
    banks.MANDIRI_FILE: "postdate",
    banks.BNI_FILE: "post_date",
}


def landed_day(table: str) -> Column:
    column = F.col(DAY_COLUMNS[table])
    return (timing.parse_post_date(column) if table == banks.BNI_FILE else column).cast("date")


def by_day(df: DataFrame, table: str) -> DataFrame:
    """Rows with their day, brought together by it; a day with very many rows is split over several tasks at run time."""
    return df.withColumn(LANDED_DAY, landed_day(table)).hint("rebalance", LANDED_DAY)


def partition(df: DataFrame, table: str) -> tuple[DataFrame, tuple[str, ...]]:
    """For ``loader.load_all``: tables that reports read go by day, others in one piece."""
    return (by_day(df, table), (LANDED_DAY,)) if table in DAY_COLUMNS else (df, ())


def since(tables: Mapping[str, DataFrame], rules: ReconRules) -> dict[str, DataFrame]:
    """The tables without days before the period; rows without a day stay. Tables that are not landed by day stay as they are.

    Names of Mandiri merchants come from the whole report, so the bank view's use of it is not cut.
    """
    start = F.date_sub(timing.period_start(rules.as_of, rules.report_months).cast("date"), SLACK_DAYS)
    day = F.col(LANDED_DAY)
    return {name: df.where((day >= start) | day.isNull()).drop(LANDED_DAY) if LANDED_DAY in df.columns else df for name, df in tables.items()}
