"""Stand-ins: the given star-schema tables read as payments, issuer reports and bank statements.

Every stand-in maps whole tables. ``payments`` is one row per order line; ``merchant_payments`` adds
the merchant (customer) of its order. A report or statement is a projection of those rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.classify import RateRule, SegmentRule
from tripledger.plans import banks, issuers, summary
from tripledger.plans.rules import BankWords, ReconRules
from tripledger.schemas import conform
from tripledger.session import read_table, shuffles_dropped, written_once

# The report covers the whole of the given tables: 84 months before this day.
AS_OF = date(2001, 12, 1)
MONTHS = 84

BANKS = [
    "SHOPEEPAY",
    "OVO",
    "OTTOPAY",
    "MANDIRI",
    "LINKAJA",
    "KREDIVO",
    "INDODANA",
    "BTN",
    "BNI",
    "BCA",
]

RULES = ReconRules(
    as_of=AS_OF,
    report_months=MONTHS,
    onus_months=60,
    migration="1998-07-01 00:00:00",
    excluded_accounts=(-1,),
    segments=(
        SegmentRule("MANDIRI", "referral_code_acquisition", (("AUTOMOBILE", "MCD"), ("BUILDING", "FM")), "ELSE"),
        SegmentRule(
            "BNI",
            "vendor_type",
            (("AUTOMOBILE", "MCD"), ("BUILDING", "FM"), ("FURNITURE", "HERO")),
            "MSME",
        ),
        SegmentRule(
            "KREDIVO",
            "vendor_type",
            (("AUTOMOBILE", "MCD"), ("BUILDING", "FM"), ("FURNITURE", "HERO")),
            "Willfitness / Other",
        ),
        SegmentRule("LINKAJA", "vendor_type", (("AUTOMOBILE", "MCD"), ("MACHINERY", "EXPANSION")), "MSME"),
        SegmentRule("OTTOPAY", "vendor_type", (), "OTTOPAY"),
        SegmentRule("INDODANA", "vendor_type", (("HOUSEHOLD", "Retail"),), "INDODANA"),
        # Categories that the remarks of these issuers do not name: one group each.
        *(SegmentRule(i, "vendor_type", (("AUTOMOBILE", "MCD"), ("BUILDING", "FM")), "Other") for i in ("SHOPEEPAY", "OVO", "BCA", "BTN")),
    ),
    rates=(
        RateRule("OTTOPAY", "0.0054", "0.0035"),
        RateRule("INDODANA", "0.0063", "0.0042"),
        RateRule("KREDIVO", "0.0230", "0.0230"),
    ),
    kredivo_stores={"MCD STORE": "MCD", "FM MART": "FM", "HERO MARKET": "HERO"},
    mandiri_names=(("MCD", "MCD"), ("FM", "FM")),
    bni_names=(("MCD", "MCD"), ("HERO", "HERO"), ("FM", "FM")),
    linkaja_company="MCD-CO",
    linkaja_expansion_mid="M-50",
    linkaja_msme_mids=("M-50", "M-49"),
    bank_words=BankWords(),
    bni_groups=(
        ("BNI CAT", "Category", (("MCD", "MCD"), ("FM", "FM"))),
        ("BNI QR", "OTO", (("MCD", "MCD"), ("HERO", "HERO"), ("FM", "FM"), ("MSME", "MSME"))),
    ),
    kredivo_codes=(("MCD", "MCD"), ("FM", "FM"), ("HERO", "HERO")),
    linkaja_threshold=40_000,
)

_ISSUER = "element_at(array({}), cast(l_suppkey % 10 as int) + 1)".format(", ".join(f"'{b}'" for b in BANKS))


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: id, moment, issuer, amount and a few descriptive columns."""
    seconds = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 86400"
    gmv = "cast(l_extendedprice as decimal(18,2))"
    return (
        read_table(spark, folder, "lineitem")
        .selectExpr(
            "l_orderkey as order_id",
            "l_orderkey * 10 + l_linenumber as trx_id",
            "l_partkey as part_id",
            "l_suppkey as supp",
            f"l_shipdate + make_dt_interval(0, 0, 0, {seconds}) as ts",
            f"{_ISSUER} as issuer",
            f"{gmv} as gmv",
            f"case when l_tax > 0.075 then {gmv} + 100 else {gmv} end as gross",
            "cast(l_quantity as int) as qty",
            "cast(round(l_discount * 100) as int) as disc",
            "l_returnflag as flag",
            "l_linestatus as line_status",
        )
        .withColumn("net", F.expr("cast(round(gross * cast(0.993 as decimal(5,4)), 2) as decimal(18,2))"))
    )


def merchant_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments with the account and segment of the order's customer."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    accounts = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("c_mktsegment").alias("segment"),
    )
    return payments(spark, folder).join(accounts, "order_id")


def described(rows: DataFrame) -> DataFrame:
    """Merchant payments with the texts and posting values their reports and statements show."""
    return rows.selectExpr(
        "*",
        f"{STORE} as store",
        f"{MID} as mid",
        f"{TRADING} as trading",
        f"{DESCRIPTION} as description",
        f"{POSTED} as posted",
        f"{PAID} as paid",
    )


def staged_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Merchant payments written once to the shared scratch folder, one directory per issuer.

    The report reads twelve reports, four statements and production from it; each reads only its
    issuers' directories.
    """

    def write(path):
        with shuffles_dropped(spark):
            described(merchant_payments(spark, folder)).write.mode("overwrite").partitionBy("issuer").parquet(path)

    return spark.read.parquet(written_once(spark, f"payments/{folder.strip('/').replace('/', '_')}", write))


# Store words by segment; the other segments trade under their own name.
WORD = (
    "case segment when 'AUTOMOBILE' then 'Mcd' when 'BUILDING' then 'Fm' "
    "when 'FURNITURE' then 'Hero' else 'Msme' end"
)
STORE = (
    "case segment when 'AUTOMOBILE' then 'Mcd Store' when 'BUILDING' then 'Fm Mart' "
    "when 'FURNITURE' then 'Hero Market' else concat('Corner ', segment) end"
)
TRADING = f"case when flag = 'R' then 'Toko Else' else concat('Toko ', {WORD}, ' ', line_status) end"
MID = "concat('M', lpad(cast(account_id as string), 10, '0'))"
# Remark and charge-back marks of the wallet reports.
REMARK = "case when qty <= 15 then null when qty = 16 then 'Force Credit by ops' else 'ok' end"
CHARGEBACK = "case when qty = 17 then cast(trx_id as string) end"
MID_BY_QTY = "case when qty = 18 then null else concat('M-', cast(qty as string)) end"
# A clock text that is missing on some rows.
CLOCK = "case when qty = 19 then null else date_format(ts, 'HH:mm:ss') end"

# Landed table -> projection of payments; tables marked True need the merchant columns.
REPORTS: dict[str, tuple[bool, list[str]]] = {
    "recon_kredivo_report": (
        True,
        [
            "ts as Transaction_Date",
            "cast(trx_id as string) as Transaction_ID",
            "gross as Amount",
            "case when disc = 10 then 'Cancelled' else 'Settled' end as Status",
            "store as Store_Name",
        ],
    ),
    "recon_indodana_report": (
        False,
        [
            "ts as TRANSACTION_DATE",
            "cast(trx_id as string) as TRANSIDMERCHANT",
            "gross as AMOUNT",
            "net as PAY_TO_MERCHANT",
            "case when flag = 'R' then 'Refund' when qty = 20 then null else 'Purchase' end as TRANSACTION_TYPE",
        ],
    ),
    "recon_ovo_report": (
        False,
        [
            "cast(trx_id as string) as merchantinvoice",
            "ts as transactiondate",
            "case when disc = 10 then 'Void' when qty = 20 then null else 'Sale' end as transactiontype",
            "gross as transactionamount",
            "net as nettsettlement",
        ],
    ),
    "recon_shopeepay_report": (
        False,
        [
            "cast(trx_id as string) as transaction_id",
            "case when flag = 'R' then 'Refund' else 'Payment' end as transaction_type",
            "gross as transaction_amount",
            "net as settlement_amount",
            "ts as create_time",
        ],
    ),
    "recon_mandiri_bank_report": (
        True,
        [
            "mid as MID",
            "trading as trading_name",
            "cast(ts as date) as TRXDATE",
            "date_format(ts, 'HH:mm:ss') as TRXTIME",
            "cast(trx_id as string) as reff_id",
            "gross as amount",
            "net as net_amount",
        ],
    ),
    "recon_bni_bank_report": (
        True,
        [
            "cast(trx_id as string) as bill_number",
            "mid",
            f"concat('Outlet ', {WORD}) as nama_merchant",
            "gross as nominal",
            "net as net_amount",
            "ts as trx_datetime",
            "case when disc = 10 then 'failed' else 'success' end as status",
        ],
    ),
    "recon_issuer_bca_bank_file_report": (
        False,
        ["cast(trx_id as string) as reference_no", "ts as payment_date", "gross as base_amount", "net as nett"],
    ),
    "recon_issuer_btn_bank_file_report": (
        False,
        [
            "cast(ts as date) as transaction_date",
            "date_format(ts, 'HH:mm:ss') as transaction_time",
            "cast(trx_id as string) as retrieval_reference_number",
            "gross as amount",
        ],
    ),
    "recon_issuer_ottopay_bank_file_report": (
        False,
        [
            "cast(trx_id as string) as issuer_rrn",
            "ts as transaction_time",
            "gross as gross_amount",
            "net as nett_amount",
            "case when disc = 10 then 'Failed' else 'Success' end as payment_status",
        ],
    ),
    "recon_linkaja_mcd_report": (
        False,
        [
            "cast(ts as date) as transaction_date",
            f"{CLOCK} as transaction_time",
            "cast(trx_id as string) as ref_no",
            "case when disc = 10 then 'OTHER' else 'MCD-CO' end as company_code",
            "gross as transaction_amount",
            "net as net_amount",
        ],
    ),
    "recon_linkaja_expansion_report": (
        False,
        [
            "cast(ts as date) as transaction_date",
            "cast(trx_id as string) as ref_no",
            f"{MID_BY_QTY} as mid",
            "gross as transaction_amount",
            "net as net_amount",
            f"{REMARK} as remark",
            f"{CHARGEBACK} as chargebackoriginalbusinesstransactionid",
        ],
    ),
    "recon_linkaja_msme_report": (
        False,
        [
            "cast(ts as date) as transaction_date",
            f"{CLOCK} as transaction_time",
            "cast(trx_id as string) as ref_no",
            f"{MID_BY_QTY} as mid",
            "gross as transaction_amount",
            "net as net_amount",
            f"{REMARK} as remark",
            f"{CHARGEBACK} as chargebackoriginalbusinesstransactionid",
        ],
    ),
}

# Bank lines: posted a day later; on the first of a month the bank keeps a fee of 10.
POSTED = "ts + interval '1' day"
PAID = "case when day(ts) = 1 then net - 10 else net end"
# The remittance text names the issuer and segment; some lines name a second issuer, and some are in
# small letters, which only the case-insensitive routes see.
KEYWORD = (
    "case issuer when 'SHOPEEPAY' then 'SHOPEE' when 'OVO' then 'OVO' when 'OTTOPAY' then 'OTTOPAY' "
    "when 'MANDIRI' then 'MANDIRI' when 'LINKAJA' then 'LINKAJA' when 'KREDIVO' then 'KREDIVO' "
    "when 'INDODANA' then 'INDODANA' when 'BTN' then 'BTN SETTLEMENT' "
    "when 'BNI' then case when qty = 21 then 'BNI CAT' else 'BNI QR' end else 'BCA SETTLEMENT' end"
)
DESCRIPTION_PLAIN = f"concat('TRF ', {KEYWORD}, ' ', upper({WORD}), case when qty = 25 then ' VIA OVO' else '' end)"
DESCRIPTION = f"case when qty = 13 then lower({DESCRIPTION_PLAIN}) else {DESCRIPTION_PLAIN} end"

STATEMENTS: dict[str, list[str]] = {
    banks.BTN_FILE: ["posted as post_date", "description", "paid as amount_credit"],
    banks.BCA_FILE: [
        "cast(posted as date) as transaction_date",
        "description",
        "cast(null as string) as branch",
        "paid as transaction_amount",
    ],
    banks.BNI_FILE: [
        "date_format(posted, case when day(posted) % 2 = 0 then 'dd/MM/yy HH.mm' "
        "else 'dd/MM/yy HH.mm.ss' end) as post_date",
        "description",
        "paid as credit",
    ],
    banks.MANDIRI_FILE: [
        "posted as postdate",
        "concat(mid, case when qty = 22 then ' OTHER' else ' QRIS SETTLEMENT' end) as remarks",
        "paid as credit_amount",
    ],
}
# Which issuers pay into which bank account.
ACCOUNT_OF = {
    banks.BTN_FILE: ["BTN"],
    banks.BCA_FILE: ["OVO", "OTTOPAY", "KREDIVO", "INDODANA", "BCA"],
    banks.BNI_FILE: ["SHOPEEPAY", "BNI"],
    banks.MANDIRI_FILE: ["MANDIRI"],
}


def report(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All payments read as one issuer's report."""
    needs_merchant, columns = REPORTS[table]
    rows = described(merchant_payments(spark, folder)) if needs_merchant else payments(spark, folder)
    return conform(rows.selectExpr(*columns), table)


def statement(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All payments read as lines of one bank's statement."""
    return conform(described(merchant_payments(spark, folder)).selectExpr(*STATEMENTS[table]), table)


def production_tables(rows: DataFrame, spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four production inputs. Customers in debt are not in the merchant master."""
    settlement = rows.selectExpr(
        "ts as txn_date",
        "issuer",
        "account_id",
        "account_id as merchant_id",
        "segment as merch_name",
        "case when flag = 'R' then 'E-money Reversal' when qty = 23 then 'Adjustment' "
        "else 'Customer Purchase' end as txn_type",
        "concat('INT', cast(trx_id as string)) as internal_ref_field",
        "concat('ISS', cast(trx_id as string)) as issuer_ref_field",
        "cast(order_id as string) as issuer_txn_ref",
        "trx_id as credit_trans_trx_id",
        "part_id as terminal_id",
        "gmv as amt",
    )
    customers = read_table(spark, folder, "customer")
    merchants = customers.where("c_acctbal >= 0").selectExpr(
        "c_custkey as account_id", "c_mktsegment as vendor_type", "c_mktsegment as referral_code_acquisition"
    )
    transactions = rows.groupBy("trx_id").agg(
        F.expr("case when max(cast(line_status = 'O' as int)) = 1 then 'OFF US' else 'ON US' end").alias("onus_offus"),
        F.max("ts").alias("trx_date"),
    )
    return {
        summary.SETTLEMENT: settlement,
        summary.REVERSALS: rows.where("flag = 'R'").select("trx_id"),
        summary.MERCHANTS: merchants,
        summary.TRANSACTIONS: transactions.withColumn("trx_id", F.col("trx_id").cast("string")),
    }


def pipeline_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All inputs of the full report: each payment belongs to one issuer's report and one statement."""
    rows = staged_payments(spark, folder)
    tables = production_tables(rows, spark, folder)
    category = "case segment when 'AUTOMOBILE' then 'mcd' when 'MACHINERY' then 'expansion' else 'msme' end"
    for name, (table, _) in issuers.REPORTS.items():
        own = f"issuer = '{name.split('_')[0].upper()}'"
        if name.startswith("linkaja"):
            own += f" and {category} = '{name.split('_')[1]}'"
        tables[table] = rows.where(own).selectExpr(*REPORTS[table][1])
    for table, columns in STATEMENTS.items():
        paid_here = "issuer in ({})".format(", ".join(f"'{i}'" for i in ACCOUNT_OF[table]))
        if table in (banks.BCA_FILE, banks.BNI_FILE):
            sign = "=" if table == banks.BCA_FILE else "<>"
            paid_here += f" or (issuer = 'LINKAJA' and {category} {sign} 'expansion')"
        tables[table] = rows.where(paid_here).selectExpr(*columns)
    return tables
