"""The reconciliation report: three views on one date spine, with gaps and lost contributions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.contributions import on_spine, union_contributions, unmatched, with_gaps
from tripledger.operators import timing
from tripledger.operators.spine import date_spine
from tripledger.plans.banks import MANDIRI_REPORT, bank_contributions
from tripledger.plans.issuers import issuer_contributions
from tripledger.plans.landed_days import since
from tripledger.plans.production import enrich_settlement, production_contributions
from tripledger.plans.rules import ReconRules

# Names of the four production inputs.
SETTLEMENT, REVERSALS = "settlement_report_hourly", "reversal_trx_reference"
MERCHANTS, TRANSACTIONS = "merchants", "transactions"


def all_contributions(
    tables: Mapping[str, DataFrame], rules: ReconRules, bounded: bool = False
) -> DataFrame:
    # Tables that are landed by day are read for the period only.
    near = since(tables, rules) if bounded else tables
    enriched = enrich_settlement(
        tables[SETTLEMENT], tables[REVERSALS], tables[MERCHANTS], tables[TRANSACTIONS], rules
    )
    return union_contributions(
        [
            production_contributions(enriched, rules),
            issuer_contributions(near, rules, bounded),
            bank_contributions({**near, MANDIRI_REPORT: tables[MANDIRI_REPORT]}, rules, bounded),
        ]
    )


def recon_summary(
    spark: SparkSession, tables: Mapping[str, DataFrame], rules: ReconRules, ordered: bool = True
) -> DataFrame:
    """One row per (day, issuer, segment) up to the day before ``as_of``, newest first."""
    spine = date_spine(spark, rules.as_of, rules.report_months).where(
        F.col("receival_date") < F.lit(rules.as_of)
    )
    report = on_spine(spine, all_contributions(tables, rules, bounded=True))
    return report.orderBy(F.desc("receival_date")) if ordered else report


def recon_gaps(
    spark: SparkSession, tables: Mapping[str, DataFrame], rules: ReconRules, zero_filled: bool = False
) -> DataFrame:
    return with_gaps(recon_summary(spark, tables, rules, ordered=False), zero_filled)


def unmatched_contributions(
    spark: SparkSession, tables: Mapping[str, DataFrame], rules: ReconRules
) -> DataFrame:
    """Money and traffic of the period that the report does not show, per (date, bank, remarks).

    Days before the period belong to earlier reports. Rows without a date belong to none and are shown.
    """
    spine = date_spine(spark, rules.as_of, rules.report_months).where(
        F.col("receival_date") < F.lit(rules.as_of)
    )
    start = timing.period_start(rules.as_of, rules.report_months).cast("date")
    day = F.col("receival_date")
    given = all_contributions(tables, rules, bounded=True).where((day >= start) | day.isNull())
    return unmatched(spine, given)
