"""Readers, file shaping, manifests, sinks and typed loads over files rendered from the payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck, standins
from catalog.formats import SQL_GMV, SQL_ID, raw_path
from catalog.registry import query
from catalog.standins import payments, read_table
from tripledger.operators import shaping
from tripledger.operators.shaping import cell, named
from tripledger.plans import banks, formatters, issuers
from tripledger.schemas import TABLES, conform
from tripledger.session import scratch_root, written_once
from tripledger.sources import files, loader, raw, sinks

PAY = f"WITH {duck.PAY}"


def file_key():
    return F.regexp_extract("file", r"file_key=(\d+)", 1).cast("bigint").alias("file_key")


def source_rows(name):
    return lambda spark, folder: formatters.SOURCES[name].read(spark, raw_path(spark, folder, name))


def mandiri_cells(lines):
    return raw.trimmed_cells_of(lines)


# Readers -----------------------------------------------------------------------------------------

_SEPS = "SELECT DISTINCT l_suppkey AS file_key, CASE WHEN l_suppkey % 2 = 0 THEN ';' ELSE ',' END AS sep FROM lineitem"


@query("detect_delim_first_line", _SEPS)
def _(spark, folder):
    lines = raw.read_lines(spark, raw_path(spark, folder, "btn"))
    return raw.detect_first_line(lines).select(file_key(), "sep")


@query("detect_delim_whole", _SEPS)
def _(spark, folder):
    lines = raw.read_lines(spark, raw_path(spark, folder, "mandiri"))
    return raw.detect_whole_file(lines).select(file_key(), "sep")


@query(
    "read_comma",
    f"{PAY} SELECT {SQL_ID} AS trx, 'Toko' || chr(10) || issuer || ', ' || qty AS name, {SQL_GMV} AS amount FROM pay "
    "UNION ALL SELECT 'H5', 'H2', 'H10' FROM (SELECT DISTINCT l_suppkey FROM lineitem)",
)
def _(spark, folder):
    rows = raw.read_cells(spark, raw_path(spark, folder, "shopeepay"))
    return rows.select(cell(5).alias("trx"), cell(2).alias("name"), cell(10).alias("amount"))


@query(
    "read_semicolon",
    f"{PAY} SELECT 'QRIS; ' || issuer || chr(10) || 'line two' AS remarks, {SQL_GMV} AS amount FROM pay "
    "UNION ALL SELECT unnest(['D', '', '']), unnest(['F', '', '']) FROM (SELECT DISTINCT l_suppkey FROM lineitem)",
)
def _(spark, folder):
    rows = raw.read_cells(spark, raw_path(spark, folder, "bank_mandiri"), ";")
    return rows.select(cell(3).alias("remarks"), cell(5).alias("amount"))


@query(
    "read_naive_split",
    f"""{PAY} SELECT l_suppkey AS file_key, unnest(['Bank statement', 'Account : 123', '', 'No.', '   ', 'Total', '2']) AS first_cell,
      unnest([1, 1, 1, 3, 1, 2, 10]) AS width FROM (SELECT DISTINCT l_suppkey FROM lineitem)
      UNION ALL SELECT supp, CASE WHEN qty = 9 THEN '' ELSE CAST(qty AS VARCHAR) END, 10 FROM pay""",
)
def _(spark, folder):
    rows = raw.naive_cells_of(raw.read_lines(spark, raw_path(spark, folder, "bank_btn")))
    return rows.select(file_key(), cell(0).alias("first_cell"), "width")


@query(
    "read_quoted_line",
    f"{PAY} SELECT 'N' || supp AS nmid, 'Toko, ' || issuer AS name, {SQL_ID} AS ref FROM pay",
)
def _(spark, folder):
    rows = mandiri_cells(source_rows("mandiri")(spark, folder)).where((F.col("width") == 15) & (cell(8) == "issuer"))
    return rows.select(cell(0).alias("nmid"), cell(3).alias("name"), cell(11).alias("ref"))


_NAMES = [
    ("bank_bca", "concat('BCA_BankFile-', trx_id, '.csv')", "'BCA_BankFile-' || trx_id || '.csv'"),
    ("bank_btn", "concat('SingleTransactionInquiry_temp', trx_id, '.csv')", "'SingleTransactionInquiry_temp' || trx_id || '.csv'"),
    ("indodana", "concat('~$', trx_id, '.CSV')", "'~$' || trx_id || '.CSV'"),
    ("other", "concat('SingleTransactionInquiry.', trx_id, '.xlsx')", "'SingleTransactionInquiry.' || trx_id || '.xlsx'"),
]


def _file_names(spark, folder):
    shapes = " ".join(f"when {i} then {e}" for i, (_, e, _) in enumerate(_NAMES))
    return payments(spark, folder).select("trx_id", F.expr(f"case trx_id % 4 {shapes} end").alias("name"))


_SQL_NAMES = f"{PAY}, n AS (SELECT trx_id, CASE trx_id % 4 " + " ".join(
    f"WHEN {i} THEN {s}" for i, (_, _, s) in enumerate(_NAMES)
) + " END AS name FROM pay)"


@query(
    "select_files",
    f"{_SQL_NAMES} SELECT 'bank_bca' AS source, name FROM n WHERE name LIKE 'BCA%' UNION ALL SELECT 'bank_btn', name FROM n "
    "WHERE name LIKE 'Single%' AND name NOT LIKE '%temp%' UNION ALL SELECT 'indodana', name FROM n WHERE lower(name) LIKE '%.csv' "
    "AND name NOT LIKE '~$%' UNION ALL SELECT 'btn', name FROM n WHERE lower(name) LIKE '%.csv'",
)
def _(spark, folder):
    listed = _file_names(spark, folder)
    frames = [
        files.select_files(listed, s).select(F.lit(s).alias("source"), "name")
        for s in ("bank_bca", "bank_btn", "indodana", "btn")
    ]
    return frames[0].unionAll(frames[1]).unionAll(frames[2]).unionAll(frames[3])


@query(
    "file_label",
    f"{_SQL_NAMES} SELECT trx_id, regexp_replace(name, '\\.[^./]+$', '') AS stem, regexp_replace(name, '\\.[^./]+$', '') || '_formatted.csv' AS formatted, "
    "replace(name, '-', '_') || '.csv' AS underscored FROM n",
)
def _(spark, folder):
    name = F.col("name")
    return _file_names(spark, folder).select(
        "trx_id",
        files.stem(name).alias("stem"),
        files.output_name(name, "_formatted").alias("formatted"),
        files.underscored_name(name).alias("underscored"),
    )


@query(
    "file_date_range",
    f"""{PAY}, r AS (SELECT supp AS file_key, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b, count(*) AS row_count FROM pay GROUP BY 1)
      SELECT file_key, CAST(a AS VARCHAR) AS first_day, CAST(b AS VARCHAR) AS last_day, row_count,
      CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '_sampai_' || b END AS label, 'report_' || b || '.csv' AS latest FROM r""",
)
def _(spark, folder):
    table = formatters.SOURCES["btn"].run(spark, raw_path(spark, folder, "btn"))
    ranges = files.date_ranges(table, F.col("transaction_date").try_cast("date"))
    return ranges.select(
        file_key(), "first_day", "last_day", "row_count", "label",
        files.latest_day_name("report_", F.col("last_day")).alias("latest"),
    )


# Shaping -----------------------------------------------------------------------------------------


def _shape(name, source, use, sql):
    @query(name, sql)
    def _(spark, folder):
        return use(source_rows(source)(spark, folder))


_shape(
    "trim_leading_rows",
    "mandiri",
    lambda lines: mandiri_cells(shaping.drop_leading(lines, 5)).select(file_key(), cell(0).alias("first_cell")),
    f"""{PAY} SELECT supp AS file_key, 'N' || supp AS first_cell FROM pay
      UNION ALL SELECT l_suppkey, unnest(['', 'H0', 'Grand total', 'N1']) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
)
_BCA_DAY = "CASE trx_id % 3 WHEN 0 THEN strftime(ts, '%d/%m/%Y') WHEN 1 THEN day(ts) || '-' || month(ts) || '-' || year(ts) ELSE 'PEND' END"
_shape(
    "seek_header",
    "bank_bca",
    lambda rows: shaping.seek_header(rows).select(file_key(), cell(0).alias("first_cell")),
    f"""{PAY} SELECT supp AS file_key, {_BCA_DAY} AS first_cell FROM pay UNION ALL
      SELECT l_suppkey, unnest(['Saldo Awal', 'Mutasi Debet', '01/01/2024']) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
)
_shape(
    "cut_footer",
    "bank_bca",
    lambda rows: shaping.cut_footer(shaping.seek_header(rows)).select(file_key(), cell(1).alias("description")),
    f"{PAY} SELECT supp AS file_key, 'TRF ' || issuer || ', ' || trx_id AS description FROM pay",
)
_shape(
    "cut_total",
    "mandiri",
    lambda lines: shaping.cut_total(mandiri_cells(shaping.drop_leading(lines, 7))).select(file_key(), cell(11).alias("ref")),
    f"{PAY} SELECT supp AS file_key, {SQL_ID} AS ref FROM pay",
)
_shape(
    "cut_checksum",
    "linkaja",
    lambda rows: shaping.cut_checksum(rows).select(file_key(), cell(2).alias("ref")),
    f"{PAY} SELECT supp AS file_key, {SQL_ID} AS ref FROM pay UNION ALL SELECT DISTINCT l_suppkey, 'Ref No' FROM lineitem",
)
_shape(
    "numeric_run",
    "bank_btn",
    lambda rows: shaping.numeric_run(shaping.drop_empty(rows)).select(
        file_key(), cell(0).alias("no"), cell(9).alias("reference")
    ),
    f"""{PAY} , s AS (SELECT *, min(CASE WHEN qty <> 9 THEN trx_id END) OVER (PARTITION BY supp) AS first_numbered FROM pay)
      SELECT supp AS file_key, CASE WHEN qty = 9 THEN '' ELSE CAST(qty AS VARCHAR) END AS no, '00' || trx_id AS reference FROM s
      WHERE trx_id >= first_numbered""",
)
_shape(
    "trim_trailing_empty",
    "bank_mandiri",
    lambda rows: shaping.trim_trailing_empty(rows).select(file_key(), cell(5).alias("credit")),
    f"{PAY} SELECT supp AS file_key, {SQL_GMV} AS credit FROM pay UNION ALL SELECT DISTINCT l_suppkey, 'F' FROM lineitem",
)
_shape(
    "drop_blank_key",
    "bank_bni",
    lambda rows: shaping.drop_blank_key(rows).select(file_key(), cell(3).alias("journal")),
    f"{PAY} SELECT supp AS file_key, {SQL_ID} AS journal FROM pay UNION ALL SELECT DISTINCT l_suppkey, 'Journal No.' FROM lineitem",
)
_shape(
    "min_columns",
    "bank_bca",
    lambda rows: shaping.min_columns(rows, 5).select(file_key(), cell(1).alias("second")),
    f"""{PAY} SELECT supp AS file_key, 'TRF ' || issuer || ', ' || trx_id AS second FROM pay UNION ALL
      SELECT l_suppkey, unnest(['Keterangan', ':', ':', 'after the footer']) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
)
_shape(
    "header_by_position",
    "nobu",
    lambda rows: shaping.by_position(shaping.drop_header(rows), ["no", *formatters.NOBU]).select("ref_no", "issuer"),
    f"{PAY} SELECT {SQL_ID} AS ref_no, issuer FROM pay",
)
_shape(
    "header_rename",
    "bank_bni",
    lambda rows: shaping.by_name(shaping.take_header(rows, verbatim=True), formatters.BANK_BNI).select(
        "Journal_No", "Description", "Credit"
    ),
    f"""{PAY} SELECT {SQL_ID} AS Journal_No, 'TRF, ' || issuer AS Description, {SQL_GMV} AS Credit FROM pay
      UNION ALL SELECT unnest(['', '']), '', unnest(['', '1']) FROM (SELECT DISTINCT l_suppkey FROM lineitem)""",
)
_shape(
    "project_by_map",
    "bni",
    lambda rows: shaping.by_name(shaping.take_header(rows, verbatim=True), formatters.BNI).select(
        "Bill_Number", "MID", "Nominal", "Promo_Code"
    ),
    f"{PAY} SELECT {SQL_ID} AS Bill_Number, 'M' || supp AS MID, {SQL_GMV} AS Nominal, '' AS Promo_Code FROM pay",
)
_shape(
    "anti_column_shift",
    "ottopay_dashboard",
    lambda rows: shaping.insert_if_missing(shaping.take_header(rows, case="lower"), "status_invoice", 7).select(
        cell(0).alias("order_ref"), cell(7).alias("status_invoice"), cell(9).alias("customer"), cell(12).alias("reference")
    ),
    f"""{PAY} SELECT {SQL_ID} AS order_ref, CASE WHEN supp % 2 = 0 THEN 'Open' ELSE '' END AS status_invoice, 'Ani' AS customer,
      '0' || order_id AS reference FROM pay""",
)
_shape(
    "drop_by_index",
    "nobu",
    lambda rows: shaping.drop_cell(shaping.drop_header(rows), 0).select(cell(3).alias("ref"), cell(14).alias("issuer")),
    f"{PAY} SELECT {SQL_ID} AS ref, issuer FROM pay",
)
_shape(
    "resplit_single_column",
    "bri",
    lambda rows: shaping.take_header(shaping.resplit_single_column(rows), case="upper").select(
        named("PARTNER_REFF_NO").alias("partner"), named("MID").alias("mid"), F.trim(named("AMT_TRX")).alias("amount")
    ).withColumn("partner", F.trim("partner")),
    f"{PAY} SELECT {SQL_ID} AS partner, '000' || supp AS mid, {SQL_GMV} AS amount FROM pay",
)


@query("blank_column", f"{PAY} SELECT trx_id, '' AS issuer, flag FROM pay")
def _(spark, folder):
    return formatters.changed(
        payments(spark, folder).select("trx_id", "issuer", "flag"), {"issuer": lambda c: F.lit("")}
    )


@query(
    "normalize_header",
    "SELECT l_orderkey AS ORDER_KEY, l_suppkey AS SUPP_KEY, l_returnflag AS FLAG FROM lineitem",
)
def _(spark, folder):
    raw_names = [' order  key', '"supp key" ', "\ufeffFlag"]
    table = read_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    cells = [shaping.header_cell(F.lit(n), case="upper", drop='["\ufeff]').alias(f"c{i}") for i, n in enumerate(raw_names)]
    return table.toDF(*spark.range(1).select(*cells).first())


# Sinks and loads -----------------------------------------------------------------------------------


def _fresh(spark, name):
    import uuid

    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


_NASTY = "concat('a;b, \"', issuer, '\"', char(10), qty)"
_SQL_NASTY = "'a;b, \"' || issuer || '\"' || chr(10) || qty"


def _roundtrip(sep):
    def run(spark, folder):
        table = payments(spark, folder).select(
            F.col("trx_id").cast("string").alias("trx"), F.expr(_NASTY).alias("name"), F.lit("").alias("blank")
        )
        path = _fresh(spark, "sink")
        sinks.write_delimited(table, path, sep)
        rows = shaping.take_header(raw.read_cells(spark, path, sep), verbatim=True)
        return shaping.by_name(rows, {c: c for c in table.columns}).select("trx", "name", "blank")

    return run


for _name, _sep in (("sink_semicolon_roundtrip", ";"), ("sink_comma_roundtrip", ",")):
    query(_name, f"{PAY} SELECT {SQL_ID} AS trx, {_SQL_NASTY} AS name, '' AS blank FROM pay")(_roundtrip(_sep))

OVO = "recon_ovo_report"
_OVO_SQL = """SELECT CAST(trx_id AS VARCHAR) AS merchantinvoice, strftime(ts, '%Y-%m-%d %H:%M:%S') AS transactiondate,
  CASE WHEN disc = 10 THEN 'Void' WHEN qty = 20 THEN NULL ELSE 'Sale' END AS transactiontype, CAST(gross AS DOUBLE) AS transactionamount,
  CAST(net AS DOUBLE) AS nettsettlement, CAST(NULL AS VARCHAR) AS status FROM pay"""


def _text_table(df):
    """A typed frame as the text cells of a normalised file."""
    cells = [
        (F.date_format(c, "yyyy-MM-dd HH:mm:ss") if t == "timestamp_ntz" else F.col(c).cast("string")).alias(c)
        for c, t in df.dtypes
    ]
    return df.select(*cells)


def normalised(spark, folder, table):
    """Folder with the normalised files of one landed table, written once."""
    frame = extra_table(spark, folder, table) or standin(spark, folder, table)
    return written_once(
        spark,
        f"normalised/{folder.strip('/').replace('/', '_')}/{TABLES[table].folder}",
        lambda p: sinks.write_delimited(_text_table(frame), p, compression="gzip"),
    )


def standin(spark, folder, table):
    """A report or statement; payments are joined with their merchants once for all tables that show them."""
    needs_merchant, columns = standins.REPORTS.get(table) or (True, standins.STATEMENTS[table])
    rows = standins.staged_payments(spark, folder) if needs_merchant else payments(spark, folder)
    return conform(rows.selectExpr(*columns), table)


def extra_table(spark, folder, table):
    """Stand-ins of the two tables that are loaded but not reconciled."""
    if table == "recon_mdr_master":
        return conform(
            payments(spark, folder).selectExpr(
                "issuer", "flag as merchant_type", "disc / 100 as mdr_rate", "cast(ts as date) as effective_date"
            ),
            table,
        )
    if table == "recon_ottopay_dashboard_report":
        return conform(
            payments(spark, folder).selectExpr(
                "cast(trx_id as string) as Order_ID", "ts as Transaction_Date", "gmv as Gross_Amount",
                "cast(order_id as string) as Reference_Number",
            ),
            table,
        )
    return None


@query("load_delimited", f"{PAY} {_OVO_SQL}")
def _(spark, folder):
    return loader.load_strict(spark, normalised(spark, folder, OVO), OVO)


@query("load_skip_header", f"{PAY} {_OVO_SQL}")
def _(spark, folder):
    """Three leading rows per file instead of one."""
    rows = _text_table(standins.report(spark, folder, OVO))
    cells = F.concat_ws(";", *[F.coalesce(F.col(c), F.lit("")) for c in rows.columns])
    key = F.expr("right(merchantinvoice, 1)")
    body = rows.select(key.alias("part"), F.lit(1).alias("section"), cells.alias("value"))
    head = body.select("part").distinct().select(
        "part", F.lit(0).alias("section"), F.explode(F.array(F.lit("report"), F.lit(""), F.lit(";".join(rows.columns)))).alias("value")
    )
    path = _fresh(spark, "three-headers")
    ordered = body.unionByName(head).repartition("part").sortWithinPartitions("part", "section")
    ordered.select("part", "value").write.partitionBy("part").text(path)
    return loader.load_strict(spark, f"{path}/*", OVO, header_rows=3, quoted_newlines=False)


@query(
    "load_quoted_newlines",
    f"{PAY} SELECT {SQL_ID} AS Order_ID, 'Toko; ' || issuer || chr(10) || qty AS Store_Name, CAST(gmv AS DOUBLE) AS Gross_Amount FROM pay",
)
def _(spark, folder):
    table = "recon_ottopay_dashboard_report"
    frame = conform(
        payments(spark, folder).selectExpr(
            "cast(trx_id as string) as Order_ID", "concat('Toko; ', issuer, char(10), qty) as Store_Name", "gmv as Gross_Amount"
        ),
        table,
    )
    path = _fresh(spark, "newlines")
    sinks.write_delimited(_text_table(frame), path)
    return loader.load_strict(spark, path, table).select("Order_ID", "Store_Name", "Gross_Amount")


@query(
    "load_glob",
    f"{PAY} SELECT {SQL_ID} AS merchantinvoice FROM pay WHERE flag <> 'R'",
)
def _(spark, folder):
    """A wildcard reads its own level only: the sub-folder's files stay out."""
    rows = _text_table(standins.report(spark, folder, OVO))
    path = _fresh(spark, "glob")
    refund = F.col("flag") == "R"
    flagged = payments(spark, folder).select(F.col("trx_id").cast("string").alias("merchantinvoice"), "flag")
    for part, target in ((flagged.where(~refund), path), (flagged.where(refund), f"{path}/dashboard")):
        wide = part.select("merchantinvoice", *[F.lit("").alias(c) for c in rows.columns[1:]])
        sinks.write_delimited(wide, target, mode="append")
    return loader.load_strict(spark, f"{path}/*.csv", OVO).select("merchantinvoice")


_BAD_OVO = (
    "concat_ws(';', trx_id, if(qty = 1, 'yesterday', date_format(ts, 'yyyy-MM-dd HH:mm:ss')), 'Sale', "
    "if(qty = 2, '12,5', cast(gmv as string)), '1', if(qty = 3, 'x;y', 'ok'))"
)


@query(
    "load_quarantine",
    f"""{PAY} SELECT CASE qty WHEN 1 THEN 'transactiondate' WHEN 2 THEN 'transactionamount' WHEN 3 THEN 'row width' ELSE 'good' END AS outcome,
      count(*) AS row_count, CAST(sum(CASE WHEN qty > 3 THEN gmv END) AS DOUBLE) AS amount FROM pay GROUP BY 1""",
)
def _(spark, folder):
    path = _fresh(spark, "bad-rows")
    payments(spark, folder).select(F.expr(_BAD_OVO).alias("value")).write.text(path)
    # Each written file starts with a data row, so the files are given a header of their own.
    headed = f"{path}-headed"
    lines = raw.read_lines(spark, path)
    body = lines.select(F.md5("file").alias("part"), "pos", F.col("line").alias("value"))
    head = body.select("part").distinct().select(
        "part", F.lit(-1).cast("bigint").alias("pos"), F.lit("h1;h2;h3;h4;h5;h6").alias("value")
    )
    ordered = body.unionByName(head).repartition("part").sortWithinPartitions("part", "pos")
    ordered.select("part", "value").write.partitionBy("part").text(headed)
    good, bad = loader.load_with_quarantine(spark, f"{headed}/*", OVO)
    outcomes = good.select(F.lit("good").alias("outcome"), F.col("transactionamount").alias("amount")).unionByName(
        bad.select(F.col("fault").alias("outcome"), F.lit(None).cast("decimal(38,9)").alias("amount"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("row_count"), F.sum("amount").alias("amount"))


@query(
    "write_modes",
    f"""{PAY}, n AS (SELECT flag, count(*) AS row_count FROM pay GROUP BY 1) SELECT 'truncate' AS disposition, flag, row_count FROM n
      UNION ALL SELECT 'append', flag, row_count * 2 FROM n UNION ALL SELECT 'empty', flag, row_count FROM n""",
)
def _(spark, folder):
    rows = payments(spark, folder).select("trx_id", "flag")
    paths = {d: _fresh(spark, f"mode-{d}") for d in ("truncate", "append", "empty")}
    for disposition, path in paths.items():
        for _ in range(1 if disposition == "empty" else 2):
            loader.write_table(rows, path, disposition)
    try:
        loader.write_table(rows, paths["empty"], "empty")
    except ValueError:
        pass  # a table with rows refuses the second write, so its count stays single
    frames = [spark.read.parquet(p).select(F.lit(d).alias("disposition"), "flag") for d, p in paths.items()]
    both = frames[0].unionAll(frames[1]).unionAll(frames[2])
    return both.groupBy("disposition", "flag").agg(F.count("*").alias("row_count"))


@query(
    "load_registry",
    "SELECT unnest([" + ", ".join(f"'{t}'" for t in TABLES) + "]) AS table_name, (SELECT count(*) FROM lineitem) AS row_count",
)
def _(spark, folder):
    """All 18 tables: normalised files written, loaded several at a time, counted."""
    for table in TABLES:
        normalised(spark, folder, table)
    project = normalised(spark, folder, "recon_mdr_master").removesuffix("/master/mdr")
    loader.load_all(spark, project, project.replace("normalised", "warehouse"))
    return loader.row_counts(loader.all_tables(spark, project.replace("normalised", "warehouse")))


@query(
    "raw_to_issuer_bca",
    f"""{PAY} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS receival_date, 'BCA' AS bank, 'BCA' AS remarks, COUNT(DISTINCT trx_id) AS issuer_traffic,
      CAST(SUM(gmv) AS DOUBLE) AS issuer_trx_amount, CAST(SUM(net) AS DOUBLE) AS issuer_settlement_amount FROM pay GROUP BY 1""",
)
def _(spark, folder):
    """One source through all stages: raw files, normalised files, typed load, issuer view."""
    table = "recon_issuer_bca_bank_file_report"
    text_rows = formatters.SOURCES["bca"].run(spark, raw_path(spark, folder, "bca"))
    path = _fresh(spark, "stages")
    sinks.write_delimited(formatters.for_load(text_rows, table), path)
    landed = loader.load_strict(spark, path, table)
    return issuers.issuer_contributions({table: landed}, standins.RULES)


@query(
    "raw_to_bank_bca",
    f"""{PAY} SELECT CAST(CASE WHEN trx_id % 3 = 2 THEN NULL ELSE CAST(ts AS DATE) - 1 END AS VARCHAR) AS receival_date, issuer AS bank,
      CAST(SUM(gmv) AS DOUBLE) AS amount_received FROM pay WHERE issuer IN ('OVO', 'INDODANA') GROUP BY 1, 2""",
)
def _(spark, folder):
    """Bank lines through all stages. Pending lines have no date: the load sets them aside, and they
    are summed without one."""
    table = banks.BCA_FILE
    text_rows = formatters.SOURCES["bank_bca"].run(spark, raw_path(spark, folder, "bank_bca"))
    path = _fresh(spark, "stages")
    sinks.write_delimited(formatters.for_load(text_rows, table), path)
    good, pending = loader.load_with_quarantine(spark, path, table)
    undated = pending.select(
        F.lit(None).cast("date").alias("transaction_date"),
        "description",
        F.lit(None).cast("string").alias("branch"),
        F.col("transaction_amount").try_cast("decimal(38,9)").alias("transaction_amount"),
    )
    lines = good.select(*undated.columns).unionByName(undated)
    view = banks.bank_contributions({table: lines}, standins.RULES)
    return view.where(F.col("bank").isin("OVO", "INDODANA")).select("receival_date", "bank", "amount_received")
