"""The sixteen source formatters over raw files rendered from the payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck
from catalog.rawfiles import rendered
from catalog.registry import add
from tripledger.plans import formatters

SEP = "if({k} % 2 = 0, ';', ',')"
HEAD_SEP, ROW_SEP = SEP.format(k="file_key"), SEP.format(k="supp")
DAY, NOW = "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%Y-%m-%d %H:%M:%S')"
MINUTE, CLOCK = "strftime(ts, '%Y-%m-%d %H:%M:00')", "strftime(ts, '%H:%M:%S')"
SQL_ID = "CAST(trx_id AS VARCHAR)"
ID = "cast(trx_id as string)"
GMV, SQL_GMV = "cast(gmv as string)", "CAST(gmv AS VARCHAR)"


def fmt(pattern):
    return f"date_format(ts, '{pattern}')"


def pick(*values, key="trx_id"):
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {key} % {len(values)} {cases} end"


def row(sep, *cells):
    return f"concat_ws({sep}, {', '.join(cells)})"


def words(sep, text):
    return row(sep, *[f"'{w.strip()}'" for w in text.split(",")])


def quoted(cell):
    return f"concat('\"', {cell}, '\"')"


RAW: dict[str, dict] = {}


def formatter(name, record, head=(), foot=(), out=None):
    """``out``: result column -> (normalised column, expected value in DuckDB SQL)."""
    RAW[name] = {"record": record, "head": head, "foot": foot}

    def run(spark, folder):
        table = formatters.SOURCES[name].run(spark, raw_path(spark, folder, name))
        return table.select(*[F.col(f"`{c}`").alias(o) for o, (c, _) in out.items()])

    wanted = ", ".join(f"{sql} AS {o}" for o, (_, sql) in out.items())
    add(f"fmt_{name}", run, f"WITH {duck.PAY} SELECT {wanted} FROM pay")


def raw_path(spark, folder, name):
    spec = RAW[name]
    return rendered(spark, folder, name, spec["record"], spec["head"], spec["foot"])


formatter(
    "btn",
    row(
        ROW_SEP,
        pick(fmt("yyyy-MM-dd HH:mm:ss"), fmt("d/M/yyyy"), fmt("yyyy/M/d")),
        pick(fmt("HH:mm:ss"), fmt("HHmmss"), fmt("H.m.s"), "'25:10:00'"),
        ID,
        "concat('00', order_id)",
        quoted("concat(' Budi, ', qty, if(qty = 7, char(10), ''), '; ')"),
        GMV,
        "if(qty < 10, '-', '0.7')",
        "'Paid'",
    ),
    head=[
        words(
            HEAD_SEP,
            "Transaction Date,Transaction  Time,Retrieval Reference Number,Merchant ID,Customer Name,Amount,MDR,Status",
        )
    ],
    out={
        "day": ("transaction_date", DAY),
        "clock": ("transaction_time", f"CASE WHEN trx_id % 4 = 3 THEN '23:10:00' ELSE {CLOCK} END"),
        "rrn": ("retrieval_reference_number", f"lpad({SQL_ID}, 12, '0')"),
        "merchant": ("merchant_id", "CAST(order_id AS VARCHAR)"),
        "customer": ("customer_name", "'Budi, ' || qty || CASE WHEN qty = 7 THEN chr(10) ELSE '' END || ';'"),
        "amount": ("amount", SQL_GMV),
        "mdr": ("mdr", "CASE WHEN qty < 10 THEN '0' ELSE '0.7' END"),
        "status": ("status", "'Paid'"),
    },
)

formatter(
    "bca",
    row(
        ROW_SEP,
        ID,
        quoted(pick("format_number(trx_id, 0)", "concat('N', trx_id)", "''")),
        pick(fmt("M/d/yy h:mm a"), fmt("M/d/yyyy H:mm"), fmt("yyyy-MM-dd HH:mm")),
        GMV,
        "cast(net as string)",
        "'Success'",
    ),
    head=[words(HEAD_SEP, "REFERENCE NO,PARTNER REFERENCE NO,PAYMENT DATE,BASE AMOUNT,NETT,STATUS")],
    out={
        "ref": ("REFERENCE_NO", SQL_ID),
        "partner": ("PARTNER_REFERENCE_NO", f"CASE WHEN trx_id % 3 = 0 THEN {SQL_ID} ELSE '' END"),
        "paid_at": ("PAYMENT_DATE", "strftime(ts, '%Y/%m/%d %H:%M:00')"),
        "amount": ("BASE_AMOUNT", SQL_GMV),
        "nett": ("NETT", "CAST(net AS VARCHAR)"),
        "status": ("STATUS", "'Success'"),
    },
)

formatter(
    "bni",
    row(
        "','",
        "if(disc = 10, 'failed', 'success')",
        ID,
        quoted("concat('Warung \"\"', issuer, '\"\", cabang ', qty)"),
        "concat('M', supp)",
        GMV,
        "cast(net as string)",
        fmt("yyyy-MM-dd HH:mm:ss"),
    ),
    head=["'Status,Bill Number,Nama Merchant,MID,Nominal,Net Amount,TRX Datetime'"],
    out={
        "bill": ("Bill_Number", SQL_ID),
        "merchant": ("Nama_Merchant", "'Warung \"' || issuer || '\", cabang ' || qty"),
        "mid": ("MID", "'M' || supp"),
        "nominal": ("Nominal", SQL_GMV),
        "nett": ("Net_Amount", "CAST(net AS VARCHAR)"),
        "at": ("TRX_Datetime", NOW),
        "status": ("Status", "CASE WHEN disc = 10 THEN 'failed' ELSE 'success' END"),
        "promo": ("Promo_Code", "''"),
    },
)

_MANDIRI_BLANKS = ["'off'", "''", "''"]
formatter(
    "mandiri",
    row(
        ROW_SEP,
        "concat(\"'N\", supp, \"'\")",
        quoted("concat('M', order_id)"),
        "'official'",
        quoted("concat(' Toko, ', issuer, ' ')"),
        "''",
        "''",
        pick(fmt("d/M/yyyy"), fmt("yyyy-MM-dd"), "'n/a'"),
        pick(fmt("HHmmss"), fmt("HH:mm"), fmt("HH.mm.ss")),
        "'issuer'",
        "'T1'",
        "'R1'",
        ID,
        quoted("format_number(gmv * 1000, 2)"),
        "'0'",
        quoted("format_number(net, 2)"),
    ),
    head=[
        "'Merchant settlement'",
        "''",
        "'Period'",
        f"concat('File', {HEAD_SEP}, file_key)",
        "'Rows'",
        "''",
        words(HEAD_SEP, ",".join(f"H{i}" for i in range(15))),
    ],
    foot=[f"concat('Grand total', repeat({HEAD_SEP}, 14))", f"concat('N1', repeat({HEAD_SEP}, 14))"],
    out={
        "nmid": ("NMID", "'N' || supp"),
        "mid": ("MID", "'M' || order_id"),
        "name": ("Trading_Name", "'Toko, ' || issuer"),
        "day": ("TRXDATE", f"CASE WHEN trx_id % 3 = 2 THEN '' ELSE {DAY} END"),
        "clock": ("TRXTIME", f"CASE WHEN trx_id % 3 = 1 THEN strftime(ts, '%H:%M:00') ELSE {CLOCK} END"),
        "ref": ("Reff_ID/Invoice_No", SQL_ID),
        "amount": ("AMOUNT", "CAST(CAST(gmv * 1000 AS BIGINT) AS VARCHAR) || '.00'"),
        "nett": ("NET_AMOUNT", "CAST(net AS VARCHAR)"),
    },
)

_SHOPEE = ["''"] * 27
_SHOPEE[2] = quoted("concat('Toko', char(10), issuer, ', ', qty)")
_SHOPEE[3] = "if(flag = 'R', 'Refund', 'Payment')"
_SHOPEE[5], _SHOPEE[6], _SHOPEE[10], _SHOPEE[12] = ID, "concat('00', order_id)", GMV, "cast(net as string)"
_SHOPEE[13] = "if(qty < 10, '', concat('T', qty))"
_SHOPEE[14] = pick(fmt("yyyy-MM-dd HH:mm:ss"), fmt("M/d/yyyy H:mm:ss"), "'pending'")
_SHOPEE[25] = "'9'"
formatter(
    "shopeepay",
    row("','", *_SHOPEE),
    head=[words("','", ",".join(f"H{i}" for i in range(27)))],
    out={
        "name": ("Merchant/Store_Name", "'Toko' || chr(10) || issuer || ', ' || qty"),
        "kind": ("Transaction_Type", "CASE WHEN flag = 'R' THEN 'Refund' ELSE 'Payment' END"),
        "trx": ("Transaction_ID", SQL_ID),
        "reference": ("Reference_ID", "'''00' || order_id"),
        "external": ("External_Reference_ID", "''"),
        "amount": ("Transaction_Amount", SQL_GMV),
        "settled": ("Settlement_Amount", "CAST(net AS VARCHAR)"),
        "terminal": ("Terminal_ID", "CASE WHEN qty < 10 THEN '' ELSE '''T' || qty END"),
        "created": ("Create_Time", f"CASE WHEN trx_id % 3 = 2 THEN 'pending' ELSE {NOW} END"),
        "withdrawal": ("Fee_(Withdrawal)", "''"),
    },
)

formatter(
    "indodana",
    row(
        ROW_SEP,
        "cast(qty as string)",
        quoted("concat('Merchant ', issuer)"),
        pick(f"concat({fmt('yyyy-MM-dd HH:mm:ss')}, ' +07:00')", fmt("yyyy-MM-dd HH:mm:ss"), "'n/a'"),
        quoted(ID),
        "concat(' Ani ', qty, ' ')",
        pick(GMV, "'bad'", "''"),
        "'1'",
        "cast(net as string)",
        "if(flag = 'R', 'Refund', 'Purchase')",
    ),
    head=[
        words(
            HEAD_SEP,
            '"no","Merchant Name","transaction date",TransIdMerchant,Customer Name,AMOUNT,FEE,PAY TO MERCHANT,TRANSACTION TYPE',
        ),
    ],
    out={
        "no": ("NO", "CAST(qty AS VARCHAR)"),
        "merchant": ("MERCHANT_NAME", "'Merchant ' || issuer"),
        "at": ("TRANSACTION_DATE", f"CASE WHEN trx_id % 3 = 2 THEN 'n/a' ELSE {NOW} END"),
        "trx": ("TRANSIDMERCHANT", SQL_ID),
        "customer": ("CUSTOMER_NAME", "'Ani ' || qty"),
        "amount": (
            "AMOUNT",
            f"CASE WHEN trx_id % 3 = 0 THEN {SQL_GMV} || '0000000' ELSE '0.000000000' END",
        ),
        "nett": ("PAY_TO_MERCHANT", "CAST(net AS VARCHAR) || '0000000'"),
        "kind": ("TRANSACTION_TYPE", "CASE WHEN flag = 'R' THEN 'Refund' ELSE 'Purchase' END"),
        "tenure": ("TENURE", "''"),
    },
)

_KREDIVO = ["concat('Name ', qty)", fmt("yyyy-MM-dd HH:mm:ss"), "''", "''", "''", "cast(order_id as string)", ID,
            "concat('0', cast(gmv as string))", "'Type'", "if(disc = 10, 'Cancelled', 'Settled')", "''", "''",
            quoted("concat('Toko \"\"', issuer, '\"\"')")]
formatter(
    "kredivo",
    row("','", *_KREDIVO, "if(supp % 2 = 0, 'extra', null)"),
    head=[f"concat('{','.join(f'H{i}' for i in range(13))}', if(file_key % 2 = 0, ',H13', ''))"],
    out={
        "name": ("Name", "'Name ' || qty"),
        "at": ("Transaction_Date", NOW),
        "order_ref": ("Order_ID", "CAST(order_id AS VARCHAR)"),
        "trx": ("Transaction_ID", SQL_ID),
        "amount": ("Amount", "rtrim(rtrim(CAST(gmv AS VARCHAR), '0'), '.')"),
        "status": ("Status", "CASE WHEN disc = 10 THEN 'Cancelled' ELSE 'Settled' END"),
        "store": ("Store_Name", "'Toko ' || issuer"),
    },
)

formatter(
    "linkaja",
    row(
        "','", fmt("yyyy-MM-dd"), fmt("HH:mm:ss"), ID, "'MCD-CO'", "concat('M-', qty)",
        quoted("concat('Kedai ', issuer, ', ', qty)"), GMV, "cast(net as string)", "if(qty = 16, 'FORCE CREDIT', '')",
    ),
    head=["'Transaction Date,Transaction Time,Ref No,Company Code,MID,Merchant Name,Transaction Amount,Net Amount,Remark'"],
    foot=["'Sample Checksum,abc,,,,,,,'", "'2024-01-01,10:00:00,junk,,,,,,'"],
    out={
        "day": ("transaction_date", DAY),
        "clock": ("transaction_time", CLOCK),
        "ref": ("ref_no", SQL_ID),
        "company": ("company_code", "'MCD-CO'"),
        "mid": ("mid", "'M-' || qty"),
        "merchant": ("merchant_name", "'Kedai ' || issuer || ', ' || qty"),
        "amount": ("transaction_amount", SQL_GMV),
        "remark": ("remark", "CASE WHEN qty = 16 THEN 'FORCE CREDIT' ELSE '' END"),
        "chargeback": ("chargebackoriginalbusinesstransactionid", "''"),
    },
)

_OTTO = ["''"] * 39
_OTTO[0] = pick(fmt("M/d/yyyy H:mm:ss"), fmt("yyyy-MM-dd HH:mm:ss"), fmt("yyyy/MM/dd HH:mm:ss"))
_OTTO[1], _OTTO[2], _OTTO[3] = ID, GMV, "cast(net as string)"
_OTTO[4] = "if(disc = 10, 'Failed', 'Success')"
_OTTO[22] = pick(fmt("M/d/yyyy"), fmt("yyyy-MM-dd"), fmt("yyyy/MM/dd"))
_OTTO[23] = pick(fmt("H:m:s"), fmt("HH:mm:ss"))
_OTTO[38] = pick(fmt("yyyy-MM-dd"), fmt("M/d/yyyy H:mm"))
_OTTO_NAMES = ["transaction time", "issuer rrn", "gross amount", "nett amount", "payment status"] + [
    f"H{i}" for i in range(5, 39)
]
RAW["ottopay"] = {"record": row("','", *_OTTO), "head": [words("','", ",".join(_OTTO_NAMES))], "foot": ()}


def _ottopay(spark, folder):
    rows = formatters.SOURCES["ottopay"].read(spark, raw_path(spark, folder, "ottopay"))
    table = formatters.fmt_ottopay(rows, [*formatters.OTTOPAY, "H22", "H23", "H38"])
    return table.select(
        F.col("transaction_time").alias("at"),
        F.col("issuer_rrn").alias("rrn"),
        F.col("gross_amount").alias("gross"),
        F.col("payment_status").alias("status"),
        F.col("H22").alias("day"),
        F.col("H23").alias("clock"),
        F.col("H38").alias("settled_day"),
    )


add(
    "fmt_ottopay",
    _ottopay,
    f"WITH {duck.PAY} SELECT {NOW} AS at, {SQL_ID} AS rrn, {SQL_GMV} AS gross, CASE WHEN disc = 10 THEN 'Failed' ELSE 'Success' END "
    f"AS status, {DAY} AS day, {CLOCK} AS clock, {DAY} AS settled_day FROM pay",
)

_DASH_A = [ID, "concat('INV', trx_id)", "'QRIS'", "'static'",
           pick(fmt("d/M/yyyy H.mm"), fmt("dd-MM-yyyy HH:mm:ss"), fmt("d/M/yy")), "'Store'", "'Paid'"]
_DASH_B = ["concat('Rp ', format_number(gmv, 2))", "'Ani'", "''", "''", "concat('0', order_id)", "''", "''", "''", "''"]
_DASH_HEAD = "Order_ID,Invoice_Number,Payment_Method,Payment_Type,Transaction_Date,Store_Name,Status_Transaction"
_DASH_TAIL = "Gross_Amount,Customer_Name,Customer_Email,Customer_Phone,Reference_Number,Expired_Date,Refund_ID,Refund_RRN,Refund_Amount"
formatter(
    "ottopay_dashboard",
    row("','", *_DASH_A, "if(supp % 2 = 0, 'Open', null)", quoted(_DASH_B[0]), *_DASH_B[1:]),
    head=[f"concat_ws(',', '{_DASH_HEAD}', if(file_key % 2 = 0, 'Status_Invoice', null), '{_DASH_TAIL}')"],
    out={
        "order_ref": ("Order_ID", SQL_ID),
        "invoice": ("Invoice_Number", f"'INV' || {SQL_ID}"),
        "at": (
            "Transaction_Date",
            f"CASE trx_id % 3 WHEN 0 THEN {MINUTE} WHEN 1 THEN {NOW} ELSE strftime(ts, '%Y-%m-%d 00:00:00') END",
        ),
        "status_invoice": ("Status_Invoice", "CASE WHEN supp % 2 = 0 THEN 'Open' ELSE '' END"),
        "gross": ("Gross_Amount", "CAST(gmv AS VARCHAR) || '0000000'"),
        "reference": ("Reference_Number", "'0' || order_id"),
        "expired": ("Expired_Date", "''"),
        "refund": ("Refund_Amount", "'0.000000000'"),
    },
)

formatter(
    "nobu",
    row(
        "','", "'1'", pick(fmt("d/M/yyyy"), fmt("yyyy-MM-dd"), fmt("dd-MM-yyyy HH:mm"), "'tba'"), fmt("HH:mm:ss"),
        "concat('INV', trx_id)", ID, "cast(qty as string)", "'mpan'", quoted("concat('Toko ', issuer)"), "'nmid'", "'tid'",
        "'static'", GMV, "'10'", pick("'0.7%'", quoted("'0,7'"), "'0.007'", "'free'"), "cast(net as string)", "issuer",
        "'Success'", "'m'", "'e'",
    ),
    head=[words("','", "NO," + ",".join(f"H{i}" for i in range(18)))],
    out={
        "day": ("transaction_date", f"CASE WHEN trx_id % 4 = 3 THEN 'tba' ELSE {DAY} END"),
        "clock": ("transaction_time", CLOCK),
        "ref": ("ref_no", SQL_ID),
        "approval": ("approval_code", "lpad(CAST(qty AS VARCHAR), 6, '0')"),
        "store": ("store_name", "'Toko ' || issuer"),
        "amount": ("transaction_nominal", SQL_GMV),
        "mdr": ("mdr", "['0.007', '0.7', '0.007', 'free'][trx_id % 4 + 1]"),
        "last": ("ext_merchant_transaction_number", "'e'"),
    },
)

_BRI_FRONT = [
    "cast(qty as string)", "concat('000', supp)", "'12'", "'Toko'",
    pick(fmt("yyyyMMdd"), fmt("d/M/yyyy"), fmt("yyyy-MM-dd"), fmt("dd.MM.yyyy")),
]
_BRI_BACK = [
    fmt("yyyyMMdd"), "concat(qty, 'E+12')", "'remark'", GMV, GMV, "'0.7'", "'0'", "cast(net as string)", "'tipe'",
    "'principle'", "issuer", "cast(qty as string)", "concat(' ', trx_id)", "'B1'", "'n/a'",
]
_BRI_WITH = "supp % 3 = 0"
_BRI_ROW = (
    f"concat_ws(',', {', '.join(_BRI_FRONT)}, if({_BRI_WITH}, {fmt('H.mm.ss')}, null), {', '.join(_BRI_BACK)}, "
    f"if({_BRI_WITH}, {fmt('dd/MM/yyyy')}, null))"
)
_BRI_HEAD_A = "NO,MID,TID,NAMA_MERCHANT,TGL_TRX"
_BRI_HEAD_B = (
    "TGL_SETL,CARD_NUMBER,REMARK_RK,AMT_SETL,AMT_TRX,RATE,DISC_AMT,NET_AMT,TIPE,PRINCIPLE,ISSUER,"
    "APRV_CODE,PARTNER_REFF_NO,BATCH_NUM,AMTNONFARE"
)
_ONE_CELL = "if({k} % 3 = 2, concat('\"', {v}, '\"'), {v})"
formatter(
    "bri",
    _ONE_CELL.format(k="supp", v=_BRI_ROW),
    head=[
        _ONE_CELL.format(
            k="file_key",
            v=f"concat_ws(',', '{_BRI_HEAD_A}', if(file_key % 3 = 0, 'JAM_TRX', null), '{_BRI_HEAD_B}', if(file_key % 3 = 0, 'TGL_RK', null))",
        )
    ],
    out={
        "mid": ("mid", "CAST(supp AS VARCHAR)"),
        "day": ("tgl_trx", DAY),
        "clock": ("jam_trx", f"CASE WHEN {_BRI_WITH} THEN {CLOCK} ELSE '' END"),
        "settled": ("tgl_setl", DAY),
        "card": ("card_number", "CAST(CAST(qty AS BIGINT) * 1000000000000 AS VARCHAR)"),
        "amount": ("amt_trx", "CAST(gmv AS VARCHAR) || '0000000'"),
        "issuer": ("issuer", "issuer"),
        "approval": ("aprv_code_reff_num", "lpad(CAST(qty AS VARCHAR), 6, '0')"),
        "partner": ("partner_reff_no", SQL_ID),
        "nonfare": ("amtnonfare", "'0.000000000'"),
        "posted": ("tgl_rk", f"CASE WHEN {_BRI_WITH} THEN {DAY} ELSE '' END"),
    },
)

formatter(
    "bank_bca",
    row(
        "','", pick(fmt("dd/MM/yyyy"), fmt("d-M-yyyy"), "'PEND'"),
        quoted("concat('TRF ', issuer, ', ', trx_id)"), "'0000'",
        quoted("concat(format_number(gmv, 2), if(flag = 'R', ' DB', ' CR'))"), quoted("format_number(net, 2)"),
    ),
    head=[
        "'Informasi Rekening'", "'No. rekening,:,123'", "'Saldo Awal,:,1'",
        "'Tanggal Transaksi,Keterangan,Cabang,Jumlah,Saldo'",
    ],
    foot=["'Saldo Awal,:,100.00,,'", "'Mutasi Debet,:,1,,'", "'01/01/2024,after the footer,0000,1 CR,1'"],
    out={
        "day": ("Transaction_Date", f"CASE WHEN trx_id % 3 = 2 THEN 'PEND' ELSE {DAY} END"),
        "description": ("Description", f"'TRF ' || issuer || ', ' || {SQL_ID}"),
        "branch": ("Branch", "'0000'"),
        "amount": ("Transaction_Amount", SQL_GMV),
        "kind": ("Type_Trx", "CASE WHEN flag = 'R' THEN 'DB' ELSE 'CR' END"),
        "balance": ("Total_Amount", "CAST(net AS VARCHAR)"),
    },
)

formatter(
    "bank_btn",
    row(
        "','", "if(qty = 9, '', cast(qty as string))", pick(fmt("d/M/yyyy"), fmt("yyyy/MM/dd")), pick(fmt("HH:mm:ss"), fmt("h:mm:ss a")),
        fmt("yyyy-MM-dd"), fmt("H:mm"), "concat('TRF ', issuer)", "'0'", GMV, "'0'", "concat('00', trx_id)",
    ),
    head=["'Bank statement'", "'Account : 123'", "''", "'No.,Post Date,Post Time'"],
    foot=["'   '", "'Total,1'", "'2,2024-01-02,,,,after the run,0,0,0,0'"],
    out={
        "no": ("No.", "CASE WHEN qty = 9 THEN '' ELSE CAST(qty AS VARCHAR) END"),
        "day": ("Post_Date", DAY),
        "clock": ("Post_Time", CLOCK),
        "eff_day": ("Eff_Date", DAY),
        "eff_clock": ("Eff_Time", "strftime(ts, '%H:%M:00')"),
        "description": ("Description", "'TRF ' || issuer"),
        "credit": ("Amount_Credit", SQL_GMV),
        "reference": ("Reference_No", f"'00' || {SQL_ID}"),
    },
)

formatter(
    "bank_bni",
    row(
        "','", pick(fmt("dd/MM/yy HH.mm"), fmt("dd/MM/yy HH.mm.ss"), fmt("yyyy-MM-dd HH:mm:ss")), fmt("M/d/yyyy H:mm"),
        "'001'", ID, quoted("concat('TRF, ', issuer)"), "''", GMV,
    ),
    head=["'Post Date,Value Date,Branch,Journal No.,Description,Debit,Credit'"],
    foot=["',,,,,,'", "',ghost,,,,,1'"],
    out={
        "posted": (
            "Post_Date",
            f"CASE trx_id % 3 WHEN 0 THEN strftime(ts, '%d/%m/%y %H.%M') WHEN 1 THEN strftime(ts, '%d/%m/%y %H.%M.%S') ELSE {NOW} END",
        ),
        "value_date": ("Value_Date", MINUTE),
        "journal": ("Journal_No", SQL_ID),
        "description": ("Description", "'TRF, ' || issuer"),
        "debit": ("Debit", "''"),
        "credit": ("Credit", SQL_GMV),
    },
)

formatter(
    "bank_mandiri",
    row(
        "';'", quoted("format_number(order_id, 0)"), "'IDR'", pick(fmt("yyyy-MM-dd HH:mm:ss"), fmt("M/d/yyyy H:mm:ss"), "'?'"),
        quoted("concat('QRIS; ', issuer, char(10), 'line two')"), "''", GMV, "'0'", "cast(net as string)",
    ),
    head=["'A;B;C;D;E;F;G;H'"],
    foot=["';;;;;;;'", "'  ;;;;;;;'"],
    out={
        "account": ("AccountNo", "CAST(order_id AS VARCHAR)"),
        "posted": ("Post_Date", f"CASE WHEN trx_id % 3 = 2 THEN '?' ELSE {NOW} END"),
        "remarks": ("Remarks", "'QRIS; ' || issuer || chr(10) || 'line two'"),
        "credit": ("Credit_Amount", SQL_GMV),
        "balance": ("Close_Balance", "CAST(net AS VARCHAR)"),
    },
)
