"""Source formatters: raw files of one source to its normalised columns, all files in one job.

A formatter takes raw rows (see ``sources.raw``) and yields ``file``, ``pos`` and text columns under
the fixed names of the source. ``READERS`` says how each source's files are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.functions import amounts, dates, text, times
from tripledger.operators import shaping
from tripledger.operators.shaping import cell, named
from tripledger.schemas import TABLES
from tripledger.sources import files, raw

# Normalised column names per source, in file order.
BTN = [
    "transaction_date",
    "transaction_time",
    "retrieval_reference_number",
    "merchant_id",
    "customer_name",
    "amount",
    "mdr",
    "status",
]
BCA = ["REFERENCE_NO", "PARTNER_REFERENCE_NO", "PAYMENT_DATE", "BASE_AMOUNT", "NETT", "STATUS"]
BNI = {
    "No": "No",
    "Bill_Number": "Bill Number",
    "Aggregator_Name": "Aggregator Name",
    "Nama_Merchant": "Nama Merchant",
    "Merchant_PAN": "Merchant PAN",
    "MID": "MID",
    "Reff_ID": "Reff ID",
    "QR_Method": "QR Method",
    "Tipe_QR": "Tipe QR",
    "Tipe_Transaksi": "Tipe Transaksi",
    "Nama_Issuer": "Nama Issuer",
    "Customer_PAN": "Customer PAN",
    "Nama_Customer": "Nama Customer",
    "Jenis_Pembayaran": "Jenis Pembayaran",
    "Nama_Acquirer": "Nama Acquirer",
    "Nominal": "Nominal",
    "Amount_MDR": "Amount MDR",
    "Net_Amount": "Net Amount",
    "TRX_Datetime": "TRX Datetime",
    "Status": "Status",
    "Settlement_Status": "Settlement Status",
    "Source_Of_Fund": "Source Of Fund",
    "Additional_Data": "Additional Data",
    "Promo_Code": "Promo Code",
    "Switcher_Name": "Switcher Name",
}
MANDIRI = [
    "NMID",
    "MID",
    "Merchant_Official",
    "Trading_Name",
    "Bank_Account",
    "Bank_Account_Name",
    "TRXDATE",
    "TRXTIME",
    "Issuer_Name",
    "TID",
    "Refference_Number",
    "Reff_ID/Invoice_No",
    "AMOUNT",
    "MDR_Amount",
    "NET_AMOUNT",
]
SHOPEEPAY = [
    "Merchant_Host",
    "Partner_Merchant_ID",
    "Merchant/Store_Name",
    "Transaction_Type",
    "Merchant_Scope",
    "Transaction_ID",
    "Reference_ID",
    "Parent_ID",
    "External_Reference_ID",
    "Issuer_Identifier",
    "Transaction_Amount",
    "Fee_(MDR)",
    "Settlement_Amount",
    "Terminal_ID",
    "Create_Time",
    "Update_Time",
    "Adjustment_Reason",
    "Entity_ID",
    "Fee_(Cofunding)",
    "Reward_Amount",
    "Reward_Type",
    "Promo_Type",
    "Payment_Method",
    "Currency_Code",
    "Voucher_Promotion_Event_Name",
    "Fee_(Withdrawal)",
    "Fee_(Handling)",
]
INDODANA = [
    "NO",
    "MERCHANT_NAME",
    "TRANSACTION_DATE",
    "TRANSIDMERCHANT",
    "CUSTOMER_NAME",
    "AMOUNT",
    "FEE",
    "TAX",
    "MERCHANT_SUPPORT",
    "PAY_TO_MERCHANT",
    "PAY_OUT_DATE",
    "TRANSACTION_TYPE",
    "TENURE",
]
KREDIVO = [
    "Name",
    "Transaction_Date",
    "User_ID",
    "Settlement_Date",
    "Cancellation_Date",
    "Order_ID",
    "Transaction_ID",
    "Amount",
    "Type",
    "Status",
    "Source",
    "Store_ID",
    "Store_Name",
]
LINKAJA = [
    "transaction_date",
    "transaction_time",
    "ref_no",
    "company_code",
    "mid",
    "merchant_name",
    "transaction_amount",
    "mdr",
    "net_amount",
    "status",
    "remark",
    "chargebackoriginalbusinesstransactionid",
]
OTTOPAY_MOMENT, OTTOPAY_DAYS, OTTOPAY_CLOCK = 0, (22, 38), 23
OTTOPAY = ["transaction_time", "issuer_rrn", "gross_amount", "nett_amount", "payment_status"]
DASHBOARD = [
    "Order_ID",
    "Invoice_Number",
    "Payment_Method",
    "Payment_Type",
    "Transaction_Date",
    "Store_Name",
    "Status_Transaction",
    "Status_Invoice",
    "Gross_Amount",
    "Customer_Name",
    "Customer_Email",
    "Customer_Phone",
    "Reference_Number",
    "Expired_Date",
    "Refund_ID",
    "Refund_RRN",
    "Refund_Amount",
]
NOBU = [
    "transaction_date",
    "transaction_time",
    "invoice_number",
    "ref_no",
    "approval_code",
    "mpan",
    "store_name",
    "nmid",
    "tid",
    "qris_type",
    "transaction_nominal",
    "fee_amount",
    "mdr",
    "net_amount",
    "issuer",
    "status",
    "merchant_transaction_number",
    "ext_merchant_transaction_number",
]
BRI = [
    "no",
    "mid",
    "tid",
    "nama_merchant",
    "tgl_trx",
    "jam_trx",
    "tgl_setl",
    "card_number",
    "remark_rk",
    "amt_setl",
    "amt_trx",
    "rate",
    "disc_amt",
    "net_amt",
    "tipe",
    "principle",
    "issuer",
    "aprv_code_reff_num",
    "partner_reff_no",
    "batch_num",
    "amtnonfare",
    "tgl_rk",
]
BANK_BCA = ["Transaction_Date", "Description", "Branch", "Transaction_Amount", "Type_Trx", "Total_Amount"]
BANK_BTN = [
    "No.",
    "Post_Date",
    "Post_Time",
    "Eff_Date",
    "Eff_Time",
    "Description",
    "Amount_Debit",
    "Amount_Credit",
    "Balance",
    "Reference_No",
]
BANK_BNI = {
    "Post_Date": "Post Date",
    "Value_Date": "Value Date",
    "Branch": "Branch",
    "Journal_No": "Journal No.",
    "Description": "Description",
    "Debit": "Debit",
    "Credit": "Credit",
}
BANK_MANDIRI = [
    "AccountNo",
    "Ccy",
    "Post_Date",
    "Remarks",
    "Additional_Desc",
    "Credit_Amount",
    "Debit_Amount",
    "Close_Balance",
]

# Column of all cells whose header name is in no list, for sources that pass every column on.
REST = "unlisted"

Change = Callable[[Column], Column]


def rejected(raw_cell: Column, value: Column) -> Column:
    """True for a filled cell that became NULL: a day that does not exist, an id that is no number."""
    return (F.trim(raw_cell) != "") & value.isNull()


def changed(df: DataFrame, changes: dict[str, Change], checked: Sequence[str] = ()) -> DataFrame:
    """Apply cell normalisers by column name, in one projection.

    ``checked`` columns may turn NULL; ``rejected`` then names the first one that did.
    """
    new = {c: change(F.col(f"`{c}`")).cast("string") for c, change in changes.items()}
    flag = F.coalesce(*[F.when(rejected(F.col(f"`{c}`"), new[c]), c) for c in checked]) if checked else None
    return df.select(
        *[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns],
        *([flag.alias("rejected")] if checked else []),
    )


def _each(names: Sequence[str], change: Change) -> dict[str, Change]:
    return dict.fromkeys(names, change)


def fmt_btn(rows: DataFrame, columns: Sequence[str] = BTN) -> DataFrame:
    named_rows = shaping.by_name(shaping.take_header(rows, case="lower"), {c: c for c in columns}, REST)
    return changed(
        named_rows,
        {
            "transaction_date": dates.day_btn,
            "transaction_time": times.clock_btn,
            "retrieval_reference_number": lambda c: text.pad_id(c, 12),
            "merchant_id": text.merchant_number,
            "customer_name": F.trim,
            "mdr": amounts.dash_as_zero,
        },
    )


def fmt_bca(rows: DataFrame, columns: Sequence[str] = BCA) -> DataFrame:
    named_rows = shaping.by_name(shaping.take_header(rows, case="upper"), {c: c for c in columns}, REST)
    return changed(
        named_rows,
        {"PAYMENT_DATE": dates.moment_text_bca, "PARTNER_REFERENCE_NO": amounts.reference_number},
    )


def fmt_bni(rows: DataFrame) -> DataFrame:
    return shaping.by_name(shaping.take_header(rows, verbatim=True), BNI)


def fmt_mandiri(lines: DataFrame) -> DataFrame:
    """The body is found on the plain lines, so that only its lines are parsed, and once."""
    filled = shaping.drop_leading(lines, 5).where(F.trim("line") != "")
    total = F.upper(raw.first_cell(F.col("line"), F.col("sep"))).contains(shaping.TOTAL)
    body = shaping.between(filled, F.lit(True), total)
    table = shaping.by_position(raw.trimmed_cells_of(body), MANDIRI)

    def clean(c: Column) -> Column:
        return amounts.strip_grouping(text.strip_quotes(c))

    own = {"TRXDATE": dates.day_mandiri, "TRXTIME": times.clock_mandiri}
    return changed(
        table,
        {c: (lambda v, f=own.get(c): clean(f(v) if f else v)) for c in MANDIRI},
        checked=["TRXDATE"],
    )


def fmt_shopeepay(rows: DataFrame) -> DataFrame:
    table = shaping.by_position(shaping.drop_header(rows), SHOPEEPAY)
    return changed(
        table,
        _each(SHOPEEPAY, text.drop_double_quotes)
        | _each(
            ["Reference_ID", "External_Reference_ID", "Terminal_ID"],
            lambda c: text.drop_double_quotes(text.mark_as_text(c)),
        )
        | _each(["Create_Time", "Update_Time"], dates.moment_text)
        | {"Fee_(Withdrawal)": lambda c: F.lit("")},
    )


def fmt_indodana(rows: DataFrame) -> DataFrame:
    table = shaping.by_name(shaping.take_header(rows, case="upper"), {c: c for c in INDODANA})
    return changed(
        table,
        _each(
            ["TRANSACTION_DATE", "PAY_OUT_DATE"], lambda c: dates.moment_text(dates.without_offset(c))
        )
        | _each(
            ["AMOUNT", "FEE", "TAX", "MERCHANT_SUPPORT", "PAY_TO_MERCHANT"], amounts.amount_or_zero
        )
        | {"CUSTOMER_NAME": text.first_line_name},
    )


def fmt_kredivo(rows: DataFrame) -> DataFrame:
    """The fourteenth cell, which some files have, is dropped."""
    body = shaping.drop_cell(shaping.drop_header(rows), 13)
    return changed(
        shaping.by_position(body, KREDIVO),
        _each(KREDIVO, text.drop_double_quotes) | {"Amount": amounts.number_if_numeric},
    )


def fmt_linkaja(rows: DataFrame, columns: Sequence[str] = LINKAJA) -> DataFrame:
    body = shaping.take_header(rows, case="lower", until=shaping.is_checksum())
    return shaping.by_name(body, {c: c for c in columns}, REST)


def fmt_ottopay(rows: DataFrame, columns: Sequence[str] = OTTOPAY) -> DataFrame:
    """Dates and clocks sit at fixed places; the columns are then taken by header name."""
    body = shaping.take_header(rows)
    places = {OTTOPAY_MOMENT: dates.moment_otto, OTTOPAY_CLOCK: times.clock_otto}
    places |= dict.fromkeys(OTTOPAY_DAYS, dates.day_otto)

    def clean(c: Column, i: Column) -> Column:
        value = c
        for place, change in places.items():
            value = F.when(i == place, change(c)).otherwise(value)
        return value

    return shaping.by_name(body.withColumn("cells", F.transform("cells", clean)), {c: c for c in columns}, REST)


def fmt_ottopay_dashboard(rows: DataFrame) -> DataFrame:
    body = shaping.take_header(rows, case="lower")
    table = shaping.by_position(shaping.insert_if_missing(body, "status_invoice", 7), DASHBOARD)

    def moment(c: Column) -> Column:
        return text.blank_if_null(dates.as_moment(dates.moment_id(c)))

    return changed(
        table,
        _each(["Transaction_Date", "Expired_Date"], moment)
        | _each(["Gross_Amount", "Refund_Amount"], amounts.amount_from_digits),
    )


def fmt_nobu(rows: DataFrame) -> DataFrame:
    table = shaping.by_position(shaping.drop_cell(shaping.drop_header(rows), 0), NOBU)
    return changed(
        table,
        {
            "transaction_date": dates.day_nobu,
            "approval_code": lambda c: text.pad_id(c, 6),
            "mdr": amounts.fee_rate,
        },
        checked=["transaction_date"],
    )


def fmt_bri(rows: DataFrame) -> DataFrame:
    body = shaping.take_header(shaping.resplit_single_column(rows), case="upper", drop='[\\uFEFF"]')
    body = shaping.insert_if_missing(body, "JAM_TRX", 5)
    body = shaping.insert_if_missing(body, "TGL_RK", 21)
    ids = ["no", "mid", "tid"]
    money = ["amt_setl", "amt_trx", "rate", "disc_amt", "net_amt", "amtnonfare"]

    def whole_id(c: Column) -> Column:
        return F.coalesce(text.whole_number_text(F.regexp_replace(c, r"[.,\s]", "")), F.lit("0"))

    return changed(
        shaping.by_position(body, BRI),
        _each(["tgl_trx", "tgl_setl", "tgl_rk"], dates.day_bri)
        | _each(["card_number", "partner_reff_no", "batch_num"], text.plain_text)
        | _each(ids, whole_id)
        | _each(money, amounts.grouped_amount)
        | {
            "jam_trx": times.clock_bri,
            "aprv_code_reff_num": lambda c: text.pad_id(text.plain_text(c), 6),
        },
    )


def fmt_bank_bca(rows: DataFrame) -> DataFrame:
    body = shaping.min_columns(shaping.between(rows, shaping.is_header(), shaping.is_footer()), 5)
    amount, kind = amounts.amount_and_type(cell(3))
    posted = dates.day_bank_bca(cell(0))
    return body.select(
        "file",
        "pos",
        posted.alias("Transaction_Date"),
        cell(1).alias("Description"),
        cell(2).alias("Branch"),
        amounts.strip_grouping(amount).alias("Transaction_Amount"),
        kind.alias("Type_Trx"),
        amounts.strip_grouping(cell(4)).alias("Total_Amount"),
        F.when(rejected(cell(0), posted), "Transaction_Date").alias("rejected"),
    )


def fmt_bank_btn(rows: DataFrame) -> DataFrame:
    table = shaping.by_position(shaping.numeric_run(shaping.drop_empty(rows)), BANK_BTN)
    return changed(
        table,
        _each(["Post_Date", "Eff_Date"], dates.day_bank_btn)
        | _each(["Post_Time", "Eff_Time"], times.clock_bank_btn),
    )


def fmt_bank_bni(rows: DataFrame) -> DataFrame:
    body = shaping.drop_blank_key(shaping.take_header(rows, verbatim=True))
    return changed(
        shaping.by_name(body, BANK_BNI), _each(["Post_Date", "Value_Date"], dates.moment_text)
    )


def fmt_bank_mandiri(rows: DataFrame) -> DataFrame:
    body = shaping.header_and_tail_off(rows)
    return changed(
        shaping.by_position(body, BANK_MANDIRI),
        {"AccountNo": amounts.account_number, "Post_Date": dates.moment_text},
        checked=["AccountNo"],
    )


@dataclass(frozen=True)
class Source:
    """How one source is read and formatted, and the landed tables it fills.

    ``run`` takes the files of a path that the caller has chosen, but no left-overs; ``run_folder`` takes the source's own
    files out of a folder. Names are judged when the scan is planned, so other files are not opened.
    """

    read: Callable[..., DataFrame]
    format: Callable[[DataFrame], DataFrame]
    tables: tuple[str, ...] = ()

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        return self.format(self.read(spark, path, accept=files.not_left_over))

    def run_folder(self, spark: SparkSession, folder: str) -> DataFrame:
        name = next(n for n, source in SOURCES.items() if source is self)
        return self.format(self.read(spark, folder, accept=lambda c: files.accepted(name, c)))


def _cells(sep: str = ",") -> Callable[..., DataFrame]:
    return lambda spark, path, accept=None: raw.read_cells(spark, path, sep, accept=accept)


def _mandiri_lines(spark: SparkSession, path: str, accept: raw.Accept | None = None) -> DataFrame:
    return raw.with_separator(raw.read_lines(spark, path, accept=accept), raw.detect_whole_file)


def _naive_cells(spark: SparkSession, path: str, accept: raw.Accept | None = None) -> DataFrame:
    return raw.naive_cells_of(raw.read_lines(spark, path, accept=accept))


SOURCES: dict[str, Source] = {
    "btn": Source(
        raw.read_detected, fmt_btn, ("recon_issuer_btn_bank_file_report",)
    ),
    "bca": Source(
        raw.read_detected, fmt_bca, ("recon_issuer_bca_bank_file_report",)
    ),
    "bni": Source(_cells(), fmt_bni, ("recon_bni_bank_report",)),
    "mandiri": Source(_mandiri_lines, fmt_mandiri, ("recon_mandiri_bank_report",)),
    "shopeepay": Source(_cells(), fmt_shopeepay, ("recon_shopeepay_report",)),
    "indodana": Source(
        raw.read_unquoted_detected, fmt_indodana, ("recon_indodana_report",)
    ),
    "kredivo": Source(_cells(), fmt_kredivo, ("recon_kredivo_report",)),
    "linkaja": Source(
        _cells(),
        fmt_linkaja,
        ("recon_linkaja_mcd_report", "recon_linkaja_expansion_report", "recon_linkaja_msme_report"),
    ),
    "ottopay": Source(_cells(), fmt_ottopay, ("recon_issuer_ottopay_bank_file_report",)),
    "ottopay_dashboard": Source(
        _cells(), fmt_ottopay_dashboard, ("recon_ottopay_dashboard_report",)
    ),
    "nobu": Source(_cells(), fmt_nobu),
    "bri": Source(_cells(), fmt_bri),
    "bank_bca": Source(_cells(), fmt_bank_bca, ("recon_bca_bank_file_report",)),
    "bank_btn": Source(_naive_cells, fmt_bank_btn, ("recon_btn_bank_file_mutation",)),
    "bank_bni": Source(_cells(), fmt_bank_bni, ("recon_bni_bank_file_report",)),
    "bank_mandiri": Source(
        _cells(";"), fmt_bank_mandiri, ("recon_mandiri_bank_file_report",)
    ),
}

# Landed columns whose normalised name differs.
ALIASES = {
    "recon_mandiri_bank_file_report": {"postdate": "Post_Date"},
    "recon_mandiri_bank_report": {"reff_id": "Reff_ID/Invoice_No"},
}


def for_load(df: DataFrame, table: str, with_rejected: bool = False) -> DataFrame:
    """Normalised text columns in the order of a landed table, by name; absent columns are blank.

    ``with_rejected`` adds the name of the cell that could not be normalised, for ``loader.land``.
    """
    have = {c.lower(): c for c in df.columns}
    alias = ALIASES.get(table, {})
    columns = [
        (F.col(f"`{have[key]}`") if (key := alias.get(n, n).lower()) in have else F.lit(None))
        .cast("string")
        .alias(n)
        for n, _ in TABLES[table].columns
    ]
    if with_rejected:
        columns.append((F.col("rejected") if "rejected" in df.columns else F.lit(None).cast("string")).alias("rejected"))
    return df.select(*columns)
