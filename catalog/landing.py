"""Loads that cannot lose data, selected files, rejects, named sinks: over files rendered from the payments."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalog import duck, standins
from catalog.files import _OVO_SQL, OVO, PAY, SQL_ID, normalised
from catalog.rawfiles import rendered
from catalog.recon import _ENRICHED, with_
from catalog.registry import query
from catalog.standins import payments
from tripledger.operators.shaping import cell
from tripledger.plans import banks, formatters, landed_days, production, summary
from tripledger.session import scratch_root
from tripledger.sources import bucketed, commits, files, loader, raw, sinks

STATEMENT_HEAD = ["'Informasi Rekening'", "'Saldo Awal,:,1'", "'Tanggal Transaksi,Keterangan,Cabang,Jumlah,Saldo'"]
STATEMENT_FOOT = ["'Saldo Awal,:,100.00,,'", "'01/01/2024,after the footer,0000,1 CR,1'"]


def _fresh(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "read_stray_quote",
    f"""{PAY} SELECT {SQL_ID} AS trx, '"Toko" ' || issuer AS name, '"x"y' AS mark, CASE WHEN qty % 2 = 0 THEN 'q"' || qty ELSE 'a' || chr(10) || 'b' END AS note
      FROM pay""",
)
def _(spark, folder):
    """Cells that begin with a quote but are text, beside quoted ones and some that run over a line end."""
    note = "if(qty % 2 = 0, concat('\"q\"\"', qty, '\"'), concat('\"a', char(10), 'b\"'))"
    record = f"concat_ws(',', trx_id, concat('\"Toko\" ', issuer), '\"x\"y', {note})"
    rows = raw.read_cells(spark, rendered(spark, folder, "stray", record))
    return rows.select(cell(0).alias("trx"), cell(1).alias("name"), cell(2).alias("mark"), cell(3).alias("note"))


@query(
    "write_refused",
    f"""{PAY}, o AS ({_OVO_SQL}), n AS (SELECT transactiontype, count(*) AS row_count FROM o GROUP BY 1)
      SELECT d AS disposition, TRUE AS refused, transactiontype, row_count FROM n, (VALUES ('append'), ('empty'), ('truncate')) v(d)""",
)
def _(spark, folder):
    """A load with a bad row is refused, whatever the disposition, and the table stays as it was."""
    good, bad = normalised(spark, folder, OVO), _fresh(spark, "refused")
    line = "concat_ws(';', trx_id, if(qty = 1, 'yesterday', '2024-01-01 00:00:00'), 'Sale', 1, 1, 'ok')"
    lines = payments(spark, folder).select(F.expr(line).alias("value"))
    lines.write.text(bad)
    frames = []
    for disposition in ("append", "empty", "truncate"):
        target = _fresh(spark, f"kept-{disposition}")
        loader.write_table(loader.load_strict(spark, good, OVO), target, keep_replaced=True)
        try:
            loader.write_table(loader.load_strict(spark, bad, OVO, header_rows=0), target, disposition, keep_replaced=True)
            refused = False
        except (PySparkException, ValueError):
            refused = True
        table = commits.landed(spark, target)
        frames.append(table.select(F.lit(disposition).alias("disposition"), F.lit(refused).alias("refused"), "transactiontype"))
    both = frames[0].unionAll(frames[1]).unionAll(frames[2])
    return both.groupBy("disposition", "refused", "transactiontype").agg(F.count("*").alias("row_count"))


@query(
    "read_selected_files",
    f"{PAY} SELECT 'TRF ' || issuer || ', ' || trx_id AS description, CAST(gmv AS VARCHAR) AS amount FROM pay WHERE supp % 2 = 0",
)
def _(spark, folder):
    """A source's own files out of a folder with lock files, files under conversion and others."""
    record = "concat_ws(',', date_format(ts, 'dd/MM/yyyy'), concat('\"TRF ', issuer, ', ', trx_id, '\"'), '0000', concat('\"', format_number(gmv, 2), ' CR\"'), '1')"
    names = ["BCA_BankFile-{}.csv", "~$BCA_BankFile-{}.csv", "BCA_BankFile-{}.csv", "BCA_BankFile_temp-{}.csv", "BCA_BankFile-{}.csv", "Other-{}.csv"]
    cases = " ".join("when {} then concat('{}', file_key, '{}')".format(i, *n.split("{}")) for i, n in enumerate(names))
    shown = rendered(spark, folder, "selected", record, STATEMENT_HEAD, STATEMENT_FOOT, f"case file_key % {len(names)} {cases} end")
    table = formatters.SOURCES["bank_bca"].run_folder(spark, shown)
    return table.select(F.col("Description").alias("description"), F.col("Transaction_Amount").alias("amount"))


@query(
    "sink_named_files",
    f"""{PAY}, r AS (SELECT supp, strftime(min(ts), '%d%m%Y') AS a, strftime(max(ts), '%d%m%Y') AS b, count(*) AS n FROM pay GROUP BY 1)
      SELECT 'BTN_' || CASE WHEN a = b THEN a ELSE a || '-' || b END || '.csv' AS name, CAST(sum(n) AS BIGINT) AS row_count FROM r GROUP BY 1""",
)
def _(spark, folder):
    """Every input file written under a name made of the days of its rows; the names and rows that a reader of the folder finds."""
    record = "concat_ws(',', trx_id, cast(ts as date), gmv)"
    rows = raw.read_cells(spark, rendered(spark, folder, "named", record))
    table = rows.select("file", "pos", cell(0).alias("trx"), cell(1).alias("day"), cell(2).alias("amount"))
    ranges = files.date_ranges(table, F.col("day").try_cast("date"))
    names = ranges.select("file", files.range_name("BTN_", F.col("first_day"), F.col("last_day")).alias("name"))
    out = _fresh(spark, "named")
    sinks.write_named(table, names, out)
    back = spark.read.options(header=True, sep=";").csv(out).select(F.col("_metadata.file_name").alias("name"))
    # Parts of one output count together.
    return back.groupBy(F.regexp_replace("name", r"\.\d+\.csv$", ".csv").alias("name")).agg(F.count("*").alias("row_count"))


@query(
    "land_rejects",
    f"""{PAY} SELECT CASE trx_id % 3 WHEN 0 THEN 'landed' WHEN 1 THEN 'Transaction_Date' ELSE 'transaction_date' END AS outcome,
      count(*) AS row_count, CAST(sum(gmv) AS DOUBLE) AS amount FROM pay GROUP BY 1""",
)
def _(spark, folder):
    """Days that do not exist (told by the formatter) and texts that are no days (told by the load) end in quarantine."""
    day = "case trx_id % 3 when 0 then date_format(ts, 'dd/MM/yyyy') when 1 then '31/02/2024' else 'PEND' end"
    record = f"concat_ws(',', {day}, 'x', '0000', concat('\"', format_number(gmv, 2), ' CR\"'), '1')"
    table, target, quarantine = banks.BCA_FILE, _fresh(spark, "landed"), _fresh(spark, "quarantine")
    shown = rendered(spark, folder, "rejects", record, STATEMENT_HEAD, STATEMENT_FOOT)
    loader.land(formatters.for_load(formatters.SOURCES["bank_bca"].run(spark, shown), table, with_rejected=True), table, target, quarantine)
    good = commits.landed(spark, target).select(F.lit("landed").alias("outcome"), F.col("transaction_amount").alias("amount"))
    bad = commits.landed(spark, quarantine).select(F.col("fault").alias("outcome"), F.col("transaction_amount").cast("decimal(38,9)").alias("amount"))
    return good.unionAll(bad).groupBy("outcome").agg(F.count("*").alias("row_count"), F.sum("amount").alias("amount"))


_WORDS = "CASE issuer WHEN 'BCA' THEN 'BCA SETTLEMENT' ELSE issuer END || ' ' || ['MCD', 'FM', 'HERO', 'OTHER'][qty % 4 + 1]"


@query(
    "raw_to_bank_bca_all",
    f"""{PAY}, t AS (SELECT CAST(CASE WHEN trx_id % 3 = 2 THEN NULL ELSE CAST(ts AS DATE) - 1 END AS VARCHAR) AS receival_date, gmv, issuer,
        'TRF ' || {_WORDS} AS d FROM pay),
      r AS (SELECT receival_date, 'LinkAja' AS bank, 'Expansion (D-1)' AS remarks, gmv FROM t WHERE d LIKE '%LINKAJA%'
        UNION ALL SELECT receival_date, 'OVO', 'OVO', gmv FROM t WHERE d LIKE '%OVO%'
        UNION ALL SELECT receival_date, 'INDODANA', 'INDODANA', gmv FROM t WHERE d LIKE '%INDODANA%'
        UNION ALL SELECT receival_date, 'BCA', 'BCA', gmv FROM t WHERE d LIKE '%BCA SETTLEMENT%'
        UNION ALL SELECT receival_date, 'OTTOPAY', 'OTTOPAY', gmv FROM t WHERE d LIKE '%OTTOPAY%'
        UNION ALL SELECT receival_date, 'Kredivo', CASE WHEN d LIKE '%MCD%' THEN 'MCD' WHEN d LIKE '%FM%' THEN 'FM'
          WHEN d LIKE '%HERO%' THEN 'HERO' ELSE 'Willfitness / Other' END, gmv FROM t WHERE d LIKE '%KREDIVO%')
      SELECT receival_date, bank, remarks, CAST(sum(gmv) AS DOUBLE) AS amount_received FROM r GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    """All six routes of the statement, from raw files to the view; pending lines are set aside by the load and summed without a day."""
    words = "concat(if(issuer = 'BCA', 'BCA SETTLEMENT', issuer), ' ', element_at(array('MCD', 'FM', 'HERO', 'OTHER'), qty % 4 + 1))"
    day = "case trx_id % 3 when 0 then date_format(ts, 'dd/MM/yyyy') when 1 then date_format(ts, 'd-M-yyyy') else 'PEND' end"
    record = f"concat_ws(',', {day}, concat('TRF ', {words}), '0000', concat('\"', format_number(gmv, 2), ' CR\"'), '1')"
    table, target, quarantine = banks.BCA_FILE, _fresh(spark, "landed"), _fresh(spark, "quarantine")
    shown = rendered(spark, folder, "routes", record, STATEMENT_HEAD, STATEMENT_FOOT)
    loader.land(formatters.for_load(formatters.SOURCES["bank_bca"].run(spark, shown), table, with_rejected=True), table, target, quarantine)
    good = commits.landed(spark, target)
    pending = commits.landed(spark, quarantine).select(
        F.lit(None).cast("date").alias("transaction_date"), "description", F.lit(None).cast("string").alias("branch"),
        F.col("transaction_amount").try_cast("decimal(38,9)").alias("transaction_amount"),
    )
    lines = good.select(*pending.columns).unionByName(pending)
    return banks.bank_contributions({table: lines}, standins.RULES).select("receival_date", "bank", "remarks", "amount_received")


@query(
    "dedupe_mandiri_lines",
    f"""WITH {duck.MPAY}, {duck.LINES.format(name='once', source='mpay')}, twice AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE qty % 3 = 0
        UNION ALL SELECT * FROM once WHERE qty % 9 = 0), {duck.NAMES.format(source='mpay')}, {duck.FILE_MANDIRI.format(lines='twice')}
      SELECT mid, remarks, count(*) AS line_count, CAST(sum(amount_received) AS DOUBLE) AS amount_received FROM file_mandiri GROUP BY 1, 2""",
)
def _(spark, folder):
    """A statement that holds a third of its lines twice and a ninth three times."""
    once = standins.statement(spark, folder, banks.MANDIRI_FILE)
    third = standins.described(standins.merchant_payments(spark, folder)).where("qty % 3 = 0")
    extra = [standins.conform(r.selectExpr(*standins.STATEMENTS[banks.MANDIRI_FILE]), banks.MANDIRI_FILE) for r in (third, third.where("qty % 9 = 0"))]
    rows = banks.file_mandiri(once.unionAll(extra[0]).unionAll(extra[1]), standins.report(spark, folder, banks.MANDIRI_REPORT), standins.RULES)
    return rows.groupBy("mid", "remarks").agg(F.count("*").alias("line_count"), F.sum("amount_received").alias("amount_received"))


_LATE = "mpay WHERE ts + INTERVAL 1 DAY >= DATE '1999-12-01'"


@query(
    "landed_days",
    f"""WITH {duck.MPAY}, {duck.LINES.format(name='bni_lines', source=_LATE)},
      r AS ({duck.bank('bni', '', 'bni_lines', '')} UNION ALL {duck.bank('shopeepay', '', 'bni_lines', '')}
        UNION ALL SELECT receival_date, 'LinkAja', {duck.HOUR_LABEL}, SUM(paid) FROM bni_lines WHERE description LIKE '%LINKAJA%' GROUP BY 1, 2, 3)
      SELECT CAST(receival_date AS VARCHAR) AS receival_date, bank, remarks, CAST(amount_received AS DOUBLE) AS amount_received FROM r""",
)
def _(spark, folder):
    """A statement landed in a folder per day; a report over 24 months reads the folders of its period."""
    rules, table = standins.RULES.but(report_months=24), banks.BNI_FILE
    rows, columns = landed_days.partition(standins.statement(spark, folder, table), table)
    target = _fresh(spark, "days")
    loader.write_table(rows, target, partition_by=columns)
    return banks.bank_contributions(landed_days.since({table: commits.landed(spark, target)}, rules), rules, bounded=True)


@query("prod_settlement_bucketed", with_(duck.SETTLEMENT, "SELECT * FROM settlement", _ENRICHED))
def _(spark, folder):
    """The settlement report and the transactions stored by their text id."""
    tables = standins.production_tables(standins.merchant_payments(spark, folder), spark, folder)
    mark = uuid.uuid4().hex
    settlement = bucketed.save_bucketed(production.text_id(tables[summary.SETTLEMENT]), f"settlement_{mark}", production.TEXT_ID, 16)
    transactions = bucketed.save_bucketed(tables[summary.TRANSACTIONS], f"transactions_{mark}", "trx_id", 16)
    frame = production.enrich_settlement(settlement, tables[summary.REVERSALS], tables[summary.MERCHANTS], transactions, standins.RULES)
    return frame.select(*_ENRICHED)
