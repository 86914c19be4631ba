"""Issuer view (B, D, F): twelve reports, each projected to (KEYS, trx, gross, net), one aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.operators import classify, contributions, timing
from tripledger.plans.rules import EXPANSION, MCD_AM, MCD_PM, MSME_AM, MSME_PM, ReconRules
from tripledger.schemas import MONEY, RATE

NET_TYPE = "decimal(24,6)"


def _rows(
    df: DataFrame,
    day: Column,
    bank: str,
    remarks: Column | str,
    trx: str,
    gross: Column | str,
    net: Column | str | None,
) -> DataFrame:
    def amount(c: Column | str | None, to: str) -> Column:
        return (F.col(c) if isinstance(c, str) else F.lit(None) if c is None else c).cast(to)

    return df.select(
        day.alias("receival_date"),
        F.lit(bank).alias("bank"),
        (F.lit(remarks) if isinstance(remarks, str) else remarks).alias("remarks"),
        F.col(trx).alias("trx"),
        amount(gross, MONEY).alias("gross"),
        amount(net, NET_TYPE).alias("net"),
    )


def _recent(df: DataFrame, column: str, rules: ReconRules) -> DataFrame:
    return df.where(timing.in_last_months(F.col(column), rules.as_of, rules.report_months))


def kredivo(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df.where(F.col("status") == "Settled"), "transaction_date", rules)
    segment = classify.segment_exact(F.col("store_name"), rules.kredivo_stores, rules.kredivo_default)
    day = timing.date_part(F.col("transaction_date"))
    return _rows(df, day, "Kredivo", segment, "transaction_id", "amount", None)


def indodana(df: DataFrame, rules: ReconRules) -> DataFrame:
    purchase = F.col("transaction_type") == "Purchase"
    return _rows(
        _recent(df, "transaction_date", rules),
        timing.date_part(F.col("transaction_date")),
        "INDODANA",
        "INDODANA",
        "transidmerchant",
        classify.signed(purchase, F.col("amount")),
        classify.signed(purchase, F.col("pay_to_merchant")),
    )


def ovo(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df.where(F.col("transactiontype") != "Void"), "transactiondate", rules)
    day = timing.date_part(F.col("transactiondate"))
    return _rows(df, day, "OVO", "OVO", "merchantinvoice", "transactionamount", "nettsettlement")


def shopeepay(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df.where(F.col("transaction_type") == "Payment"), "create_time", rules)
    day = timing.date_part(F.col("create_time"))
    return _rows(
        df, day, "ShopeePay", "ShopeePay", "transaction_id", "transaction_amount", "settlement_amount"
    )


def mandiri(df: DataFrame, rules: ReconRules) -> DataFrame:
    segment = classify.segment_like(F.upper("trading_name"), rules.mandiri_names, "ELSE")
    df = _recent(df, "trxdate", rules)
    return _rows(df, F.col("trxdate"), "Mandiri", segment, "reff_id", "amount", "net_amount")


def bni(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df.where(F.col("status") == "success"), "trx_datetime", rules)
    segment = F.concat(
        F.lit("OTO - "), classify.segment_like(F.upper("nama_merchant"), rules.bni_names, "MSME")
    )
    day = timing.date_part(F.col("trx_datetime"))
    return _rows(df, day, "BNI", segment, "bill_number", "nominal", "net_amount")


def bca(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df, "payment_date", rules)
    day = timing.date_part(F.col("payment_date"))
    return _rows(df, day, "BCA", "BCA", "reference_no", "base_amount", "nett")


def btn(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _recent(df, "transaction_date", rules)
    amount = F.col("amount").cast(MONEY)
    net = amount - amount * F.lit(rules.btn_rate).cast(RATE)
    return _rows(
        df, F.col("transaction_date"), "BTN", "BTN", "retrieval_reference_number", amount, net
    )


def ottopay(df: DataFrame, rules: ReconRules) -> DataFrame:
    ts = F.col("transaction_time")
    df = _recent(df.where(F.col("payment_status") == "Success"), "transaction_time", rules)
    day = timing.cutoff_shift(ts, rules.cutoffs.get("OTTOPAY"))
    return _rows(df, day, "OTTOPAY", "OTTOPAY", "issuer_rrn", "gross_amount", "nett_amount")


def _linkaja_batch(df: DataFrame, am: str, pm: str, rules: ReconRules) -> DataFrame:
    df = df.withColumn(
        "ts", timing.combine_date_time(F.col("transaction_date"), F.col("transaction_time"))
    )
    ts = F.col("ts")
    return _rows(
        df,
        timing.cutoff_shift(ts, rules.cutoffs.get("LINKAJA")),
        "LinkAja",
        timing.batch_label(ts, am, pm, rules.batch_hours),
        "ref_no",
        "transaction_amount",
        "net_amount",
    )


def _genuine(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("chargebackoriginalbusinesstransactionid").isNull()
        & classify.not_like_or_null(F.col("remark"), "FORCE CREDIT")
    )


def linkaja_mcd(df: DataFrame, rules: ReconRules) -> DataFrame:
    if rules.linkaja_company is not None:
        df = df.where(F.col("company_code") == rules.linkaja_company)
    return _linkaja_batch(df, MCD_AM, MCD_PM, rules)


def linkaja_expansion(df: DataFrame, rules: ReconRules) -> DataFrame:
    if rules.linkaja_expansion_mid is not None:
        df = df.where(F.col("mid") != rules.linkaja_expansion_mid)
    df = _recent(_genuine(df), "transaction_date", rules)
    day = F.col("transaction_date")
    return _rows(df, day, "LinkAja", EXPANSION, "ref_no", "transaction_amount", "net_amount")


def linkaja_msme(df: DataFrame, rules: ReconRules) -> DataFrame:
    df = _genuine(df.where(classify.not_in(F.col("mid"), rules.linkaja_msme_mids)))
    return _linkaja_batch(df, MSME_AM, MSME_PM, rules)


# Report name -> landed table and projection.
REPORTS: dict[str, tuple[str, Callable[[DataFrame, ReconRules], DataFrame]]] = {
    "kredivo": ("recon_kredivo_report", kredivo),
    "indodana": ("recon_indodana_report", indodana),
    "ovo": ("recon_ovo_report", ovo),
    "shopeepay": ("recon_shopeepay_report", shopeepay),
    "mandiri": ("recon_mandiri_bank_report", mandiri),
    "bni": ("recon_bni_bank_report", bni),
    "bca": ("recon_issuer_bca_bank_file_report", bca),
    "btn": ("recon_issuer_btn_bank_file_report", btn),
    "ottopay": ("recon_issuer_ottopay_bank_file_report", ottopay),
    "linkaja_mcd": ("recon_linkaja_mcd_report", linkaja_mcd),
    "linkaja_expansion": ("recon_linkaja_expansion_report", linkaja_expansion),
    "linkaja_msme": ("recon_linkaja_msme_report", linkaja_msme),
}
# Raw date column of the reports whose own rules carry no period filter.
UNBOUNDED = {"linkaja_mcd": "transaction_date", "linkaja_msme": "transaction_date"}


def issuer_rows(
    tables: Mapping[str, DataFrame], rules: ReconRules, bounded: bool = False
) -> DataFrame:
    """Row-level issuer frames of all reports at hand, as one UNION ALL.

    ``bounded`` adds the period filter, one day wider for the cut-off, to reports without one: the
    spine would drop those days anyway, and the scan need not read them.
    """
    frames = []
    for name, (table, project) in REPORTS.items():
        if table in tables:
            df = tables[table]
            if bounded and name in UNBOUNDED:
                df = df.where(
                    timing.in_last_months(
                        F.col(UNBOUNDED[name]), rules.as_of, rules.report_months, slack_days=1
                    )
                )
            frames.append(project(df, rules))
    return reduce(lambda a, b: a.unionByName(b), frames)


def issuer_contributions(
    tables: Mapping[str, DataFrame], rules: ReconRules, bounded: bool = False
) -> DataFrame:
    """One aggregation for all reports: (bank, remarks) never overlap between two reports."""
    return contributions.measure(issuer_rows(tables, rules, bounded), "issuer")
