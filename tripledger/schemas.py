"""Declared schemas: the 18 landed tables, the contribution row and the report row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

NUMERIC = "decimal(38,9)"  # landed amounts
RATE_LANDED = "decimal(18,10)"  # landed rates
MONEY = "decimal(18,2)"  # amounts inside the pipeline
RATE = "decimal(5,4)"  # rates inside the pipeline

# Type names of the declared load schemas and the Spark type each lands as.
# A clock time lands as zero-padded HH:mm:ss text, which sorts and compares correctly.
LANDED_TYPE = {
    "STRING": "string",
    "NUMERIC": NUMERIC,
    "FLOAT64": RATE_LANDED,
    "INTEGER": "bigint",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIME": "string",
}


@dataclass(frozen=True)
class LandedTable:
    """One landed table: name, folder of its normalised files, declared columns in file order."""

    name: str
    folder: str
    declared: str

    @property
    def columns(self) -> list[tuple[str, str]]:
        pairs = (part.split() for part in self.declared.split(","))
        return [(name, LANDED_TYPE[kind]) for name, kind in pairs]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))


# The load registry (table, folder below the project root, columns and declared types).
_REGISTRY = [
    LandedTable(
        "recon_linkaja_mcd_report",
        "issuer/linkaja/mcd",
        "transaction_date DATE, transaction_time TIME, ref_no STRING, company_code STRING, mid STRING, "
        "merchant_name STRING, transaction_amount NUMERIC, mdr FLOAT64, net_amount NUMERIC, status STRING, "
        "remark STRING",
    ),
    LandedTable(
        "recon_linkaja_expansion_report",
        "issuer/linkaja/expansion",
        "transaction_date DATE, ref_no STRING, mid STRING, merchant_name STRING, transaction_amount NUMERIC, "
        "net_amount NUMERIC, remark STRING, chargebackoriginalbusinesstransactionid STRING",
    ),
    LandedTable(
        "recon_linkaja_msme_report",
        "issuer/linkaja/msme",
        "transaction_date DATE, transaction_time TIME, ref_no STRING, mid STRING, merchant_name STRING, "
        "transaction_amount NUMERIC, net_amount NUMERIC, remark STRING, "
        "chargebackoriginalbusinesstransactionid STRING",
    ),
    LandedTable(
        "recon_bca_bank_file_report",
        "bank/bca/bank_file",
        "transaction_date DATE, description STRING, branch STRING, transaction_amount NUMERIC, type_trx STRING, "
        "total_amount NUMERIC",
    ),
    LandedTable(
        "recon_bni_bank_file_report",
        "bank/bni/bank_file",
        "post_date STRING, value_date STRING, branch STRING, journal_no STRING, description STRING, "
        "debit NUMERIC, credit NUMERIC",
    ),
    LandedTable(
        "recon_bni_bank_report",
        "bank/bni/bank_report",
        "bill_number STRING, mid STRING, nama_merchant STRING, nominal NUMERIC, net_amount NUMERIC, "
        "trx_datetime DATETIME, status STRING",
    ),
    LandedTable(
        "recon_mdr_master",
        "master/mdr",
        "issuer STRING, merchant_type STRING, mdr_rate FLOAT64, effective_date DATE",
    ),
    LandedTable(
        "recon_indodana_report",
        "issuer/indodana",
        "NO INTEGER, MERCHANT_NAME STRING, TRANSACTION_DATE DATETIME, TRANSIDMERCHANT STRING, "
        "CUSTOMER_NAME STRING, AMOUNT NUMERIC, FEE NUMERIC, TAX NUMERIC, MERCHANT_SUPPORT NUMERIC, "
        "PAY_TO_MERCHANT NUMERIC, PAY_OUT_DATE DATETIME, TRANSACTION_TYPE STRING, TENURE STRING",
    ),
    LandedTable(
        "recon_kredivo_report",
        "issuer/kredivo",
        "Name STRING, Transaction_Date DATETIME, User_ID STRING, Settlement_Date DATE, Cancellation_Date DATE, "
        "Order_ID STRING, Transaction_ID STRING, Amount NUMERIC, Type STRING, Status STRING, Source STRING, "
        "Store_ID STRING, Store_Name STRING",
    ),
    LandedTable(
        "recon_ovo_report",
        "issuer/ovo",
        "merchantinvoice STRING, transactiondate DATETIME, transactiontype STRING, transactionamount NUMERIC, "
        "nettsettlement NUMERIC, status STRING",
    ),
    LandedTable(
        "recon_shopeepay_report",
        "issuer/shopeepay",
        "transaction_id STRING, transaction_type STRING, transaction_amount NUMERIC, settlement_amount NUMERIC, "
        "create_time DATETIME, status STRING",
    ),
    LandedTable(
        "recon_mandiri_bank_report",
        "bank/mandiri/bank_report",
        "NMID STRING, MID STRING, trading_name STRING, TRXDATE DATE, TRXTIME TIME, reff_id STRING, "
        "amount NUMERIC, net_amount NUMERIC",
    ),
    LandedTable(
        "recon_mandiri_bank_file_report",
        "bank/mandiri/bank_file",
        "AccountNo NUMERIC, Ccy STRING, postdate DATETIME, remarks STRING, Additional_Desc STRING, "
        "credit_amount NUMERIC, debit_amount NUMERIC, close_balance NUMERIC",
    ),
    LandedTable(
        "recon_issuer_bca_bank_file_report",
        "issuer/bca",
        "reference_no STRING, payment_date DATETIME, base_amount NUMERIC, nett NUMERIC, status STRING",
    ),
    LandedTable(
        "recon_btn_bank_file_mutation",
        "bank/btn/mutation_file",
        "post_date DATETIME, post_time TIME, eff_date DATETIME, eff_time TIME, description STRING, "
        "amount_debit NUMERIC, amount_credit NUMERIC, balance NUMERIC, reference_no STRING",
    ),
    LandedTable(
        "recon_issuer_btn_bank_file_report",
        "issuer/btn",
        "transaction_date DATE, transaction_time TIME, retrieval_reference_number STRING, merchant_id STRING, "
        "amount NUMERIC, mdr STRING, status STRING",
    ),
    LandedTable(
        "recon_issuer_ottopay_bank_file_report",
        "issuer/ottopay",
        "issuer_rrn STRING, transaction_time DATETIME, gross_amount NUMERIC, nett_amount NUMERIC, "
        "payment_status STRING",
    ),
    LandedTable(
        "recon_ottopay_dashboard_report",
        "issuer/ottopay/dashboard",
        "Order_ID STRING, Invoice_Number STRING, Payment_Method STRING, Transaction_Date DATETIME, "
        "Store_Name STRING, Status_Transaction STRING, Status_Invoice STRING, Gross_Amount NUMERIC, "
        "Reference_Number STRING",
    ),
]
TABLES: dict[str, LandedTable] = {t.name: t for t in _REGISTRY}

# The common flat row and the report row.
KEYS = ["receival_date", "bank", "remarks"]
METRICS = [
    "yti_traffic",
    "yti_trx_amount",
    "yti_settlement_amount",
    "issuer_traffic",
    "issuer_trx_amount",
    "issuer_settlement_amount",
    "amount_received",
]
CONTRIBUTION = KEYS + METRICS
REPORT = ["receival_date", "issuer_name", "bank", "remarks"] + METRICS
METRIC_TYPE = "decimal(38,6)"


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project by name (case ignored) to a landed schema; columns the frame lacks become typed NULLs."""
    have = {c.lower(): f"`{c}`" for c in df.columns}
    return df.selectExpr(
        *[f"cast({have.get(n.lower(), 'null')} as {t}) as `{n}`" for n, t in TABLES[table].columns]
    )
