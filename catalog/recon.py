"""Queries of the reconciliation itself: sources, spine, union, report, gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck, standins
from catalog.registry import add, query
from catalog.standins import RULES, payments, pipeline_tables, report, statement
from tripledger.operators import contributions, spine
from tripledger.plans import banks, issuers, production, summary

_SIDE = {
    "yti": {"receival_date": "d", "bank": "s", "remarks": "s", "yti_traffic": "s", "yti_trx_amount": "n",
            "yti_settlement_amount": "n"},
    "issuer": {"receival_date": "d", "bank": "s", "remarks": "s", "issuer_traffic": "s",
               "issuer_trx_amount": "n", "issuer_settlement_amount": "n"},
    "bank": {"receival_date": "d", "bank": "s", "remarks": "s", "amount_received": "n"},
}


def production_inputs(spark, folder):
    return standins.production_tables(standins.merchant_payments(spark, folder), spark, folder)


def enriched(spark, folder):
    t = production_inputs(spark, folder)
    return production.enrich_settlement(
        t[summary.SETTLEMENT], t[summary.REVERSALS], t[summary.MERCHANTS], t[summary.TRANSACTIONS], RULES
    )


def with_(ctes: str, select: str, columns: dict[str, str]) -> str:
    return f"WITH {ctes} SELECT {duck.show(columns)} FROM ({select})"


# Production row level and per issuer.
_ENRICHED = {
    "txn_date": "d", "txn_time": "s", "adjusted_date": "d", "issuer": "s", "account_id": "s",
    "referral_code_acquisition": "s", "txn_type": "s", "merchant_category": "s", "remarks_time_split": "s",
    "txn_ref": "s", "credit_trans_trx_id": "s", "onus_offus": "s", "mdr": "n", "gmv": "n",
}


@query("prod_settlement", with_(duck.SETTLEMENT, "SELECT * FROM settlement", _ENRICHED))
def _(spark, folder):
    return enriched(spark, folder).select(*_ENRICHED)


def _production(rule_index):
    rule = RULES.production[rule_index]
    return lambda spark, folder: production.production_contributions(
        enriched(spark, folder), RULES.but(production=(rule,))
    )


_PROD_ORDER = [
    "ottopay", "shopeepay", "ovo", "indodana", "kredivo", "mandiri", "bni", "bca", "btn", "linkaja_mcd",
    "linkaja_expansion", "linkaja_msme",
]
for _i, _name in enumerate(_PROD_ORDER):
    add(f"prod_{_name}", _production(_i), with_(duck.SETTLEMENT, duck.yti(_name), _SIDE["yti"]))


# Issuer reports: every payment read as that issuer's report.
def _issuer(name):
    table = issuers.REPORTS[name][0]
    return lambda spark, folder: issuers.issuer_contributions({table: report(spark, folder, table)}, RULES)


for _name in issuers.REPORTS:
    add(f"issuer_{_name}", _issuer(_name), with_(duck.MPAY, duck.issuer(_name, "mpay"), _SIDE["issuer"]))


# Bank statements, row level.
_LINES = duck.MPAY + ",\n" + duck.LINES.format(name="lines", source="mpay")


@query(
    "file_bank_btn",
    with_(
        _LINES,
        "SELECT posted AS trx_date, receival_date, description, paid AS amount_received FROM lines",
        {"trx_date": "t", "receival_date": "d", "description": "s", "amount_received": "n"},
    ),
)
def _(spark, folder):
    return banks.file_btn(statement(spark, folder, banks.BTN_FILE)).drop("upper")


@query(
    "file_bank_bca",
    with_(
        _LINES,
        "SELECT receival_date AS trx_date, receival_date, description, CAST(NULL AS VARCHAR) AS branch, "
        "paid AS amount_received FROM lines",
        {"trx_date": "d", "receival_date": "d", "description": "s", "branch": "s", "amount_received": "n"},
    ),
)
def _(spark, folder):
    return banks.file_bca(statement(spark, folder, banks.BCA_FILE)).drop("upper")


@query(
    "file_bank_bni",
    with_(
        _LINES,
        f"SELECT {duck.BNI_TS} AS trx_datetime, receival_date, description, {duck.BNI_CLASS} AS remarks, "
        "paid AS amount_received FROM lines",
        {"trx_datetime": "t", "receival_date": "d", "description": "s", "remarks": "s", "amount_received": "n"},
    ),
)
def _(spark, folder):
    return banks.file_bni(statement(spark, folder, banks.BNI_FILE), RULES).drop("upper")


_MANDIRI = ",\n".join([_LINES, duck.NAMES.format(source="mpay"), duck.FILE_MANDIRI.format(lines="lines")])


def mandiri_lines(spark, folder):
    return banks.file_mandiri(
        statement(spark, folder, banks.MANDIRI_FILE), report(spark, folder, banks.MANDIRI_REPORT), RULES
    )


add(
    "file_bank_mandiri",
    mandiri_lines,
    with_(
        _MANDIRI,
        "SELECT * FROM file_mandiri",
        {"trx_datetime": "t", "receival_date": "d", "mid": "s", "remarks": "s", "remark": "s", "amount_received": "n"},
    ),
)


@query(
    "file_bank_linkaja",
    with_(
        _LINES,
        f"SELECT receival_date, {duck.HOUR_LABEL} AS remarks, paid AS amount_received FROM lines "
        "WHERE description LIKE '%LINKAJA%' UNION ALL SELECT receival_date - 1, 'Expansion (D-1)', paid FROM lines "
        "WHERE description LIKE '%LINKAJA%'",
        {"receival_date": "d", "remarks": "s", "amount_received": "n"},
    ),
)
def _(spark, folder):
    bni = banks.file_bni(statement(spark, folder, banks.BNI_FILE), RULES)
    bca = banks.file_bca(statement(spark, folder, banks.BCA_FILE))
    rows = banks.routed(bni, banks.bni_routes(RULES)).unionByName(banks.routed(bca, banks.bca_routes(RULES)))
    return rows.where(F.col("bank") == "LinkAja").drop("bank")


# Bank contributions: every payment is a line of that bank's statement.
_FILE_OF = {
    "shopeepay": [banks.BNI_FILE], "bni": [banks.BNI_FILE], "linkaja": [banks.BNI_FILE, banks.BCA_FILE],
    "ovo": [banks.BCA_FILE], "indodana": [banks.BCA_FILE], "bca": [banks.BCA_FILE], "ottopay": [banks.BCA_FILE],
    "kredivo": [banks.BCA_FILE], "btn": [banks.BTN_FILE], "mandiri": [banks.MANDIRI_FILE],
}
_BANK_LABEL = {
    "shopeepay": "ShopeePay", "bni": "BNI", "linkaja": "LinkAja", "ovo": "OVO", "indodana": "INDODANA",
    "bca": "BCA", "ottopay": "OTTOPAY", "kredivo": "Kredivo", "btn": "BTN", "mandiri": "Mandiri",
}


def _bank(name):
    def run(spark, folder):
        tables = {t: statement(spark, folder, t) for t in _FILE_OF[name]}
        if name == "mandiri":
            tables[banks.MANDIRI_REPORT] = report(spark, folder, banks.MANDIRI_REPORT)
        rows = banks.bank_rows(tables, RULES).where(F.col("bank") == _BANK_LABEL[name])
        return contributions.received(rows)

    return run


for _name in duck.BANKS:
    add(f"bank_{_name}", _bank(_name), with_(_MANDIRI, duck.bank(_name, "lines", "lines", "lines"), _SIDE["bank"]))


# Spine, stubs, union, report.
_KEYS = {"receival_date": "d", "bank": "s", "remarks": "s"}
_METRICS = dict.fromkeys(duck.METRICS, "n")
_FINAL = duck.final_ctes()


def payment_days(spark, folder):
    """Traffic per day of the payments: what a spine is laid over."""
    return payments(spark, folder).groupBy(F.col("ts").cast("date").alias("receival_date")).agg(
        F.count("*").alias("traffic")
    )


@query(
    "date_spine",
    f"WITH {duck.PAY}, {duck.SPINE}, days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS traffic FROM pay GROUP BY 1) "
    "SELECT CAST(receival_date AS VARCHAR) AS receival_date, bank, remark, issuer_name, traffic "
    "FROM date_array LEFT JOIN days ON receival_date = day",
)
def _(spark, folder):
    dense = spine.date_spine(spark, RULES.as_of, RULES.report_months)
    return dense.join(payment_days(spark, folder), "receival_date", "left").select(
        "receival_date", "bank", "remark", "issuer_name", "traffic"
    )


@query(
    "date_series",
    "WITH spans AS (SELECT o_orderpriority AS grp, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b "
    "FROM orders GROUP BY 1) SELECT grp, CAST(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) "
    "AS receival_date FROM spans",
)
def _(spark, folder):
    day = F.col("o_orderdate").cast("date")
    spans = standins.read_table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("grp")).agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    return spans.select("grp", spine.daily(F.col("first"), F.col("last")).alias("receival_date"))


@query(
    "dim_inline",
    "WITH " + duck.PAY + ", dim(bank, remark) AS (VALUES "
    + ", ".join(f"('{b}', '{r}')" for b, r in duck.PAIRS)
    + "), t AS (SELECT issuer, count(*) AS traffic, CAST(sum(gmv) AS DOUBLE) AS amount FROM pay GROUP BY 1) "
    "SELECT bank, remark, traffic, amount FROM dim LEFT JOIN t ON upper(bank) = issuer",
)
def _(spark, folder):
    dim = spine.with_pairs(spark.range(1)).select("bank", "remark")
    totals = payments(spark, folder).groupBy("issuer").agg(
        F.count("*").alias("traffic"), F.sum("gmv").alias("amount")
    )
    return dim.join(totals, F.upper("bank") == totals.issuer, "left").drop("issuer")


@query(
    "cross_stub",
    f"WITH {duck.PAY}, days AS (SELECT DISTINCT CAST(ts AS DATE) AS receival_date FROM pay) "
    "SELECT CAST(receival_date AS VARCHAR) AS receival_date, bank, remarks, CAST(NULL AS DOUBLE) AS amount_received "
    "FROM days CROSS JOIN (VALUES ('BNI', 'OTO - MSME'), ('BNI', 'OTO - MCD'), ('BNI', 'OTO - HERO'), "
    "('BNI', 'OTO - FM'), ('Mandiri', 'FM'), ('Mandiri', 'MCD'), ('Mandiri', 'ELSE')) v(bank, remarks)",
)
def _(spark, folder):
    days = payment_days(spark, folder)
    stubs = spine.cross_stub(days, "BNI", spine.REMARKS_BNI).unionByName(
        spine.cross_stub(days, "Mandiri", spine.REMARKS_MANDIRI)
    )
    return contributions.as_contribution(stubs).select("receival_date", "bank", "remarks", "amount_received")


@query(
    "union_contributions",
    f"WITH {_FINAL} SELECT {duck.show(_KEYS | _METRICS)} FROM final WHERE COALESCE({', '.join(duck.METRICS)}) IS NOT NULL",
)
def _(spark, folder):
    return summary.all_contributions(pipeline_tables(spark, folder), RULES)


_REPORT = {"receival_date": "d", "issuer_name": "s", "bank": "s", "remarks": "s"} | _METRICS


@query("recon_summary", with_(_FINAL, duck.SUMMARY, _REPORT))
def recon_summary(spark, folder):
    return summary.recon_summary(spark, pipeline_tables(spark, folder), RULES)


_GAPS = {
    "gap_traffic": "yti_traffic - issuer_traffic",
    "gap_trx_amount": "yti_trx_amount - issuer_trx_amount",
    "gap_received_vs_issuer": "amount_received - issuer_settlement_amount",
    "gap_received_vs_yti": "amount_received - yti_settlement_amount",
}


def _gap_sql(zero: bool) -> str:
    def side(e: str) -> str:
        return " - ".join(f"COALESCE({p}, 0)" for p in e.split(" - ")) if zero else e

    gaps = ", ".join(f"{side(e)} AS {n}" for n, e in _GAPS.items())
    balanced = " AND ".join(f"COALESCE({e} = 0, FALSE)" for e in _GAPS.values())
    status = (
        "CASE WHEN yti_traffic IS NULL AND issuer_traffic IS NULL AND amount_received IS NULL THEN 'no data' "
        "WHEN yti_traffic IS NULL OR issuer_traffic IS NULL OR amount_received IS NULL THEN 'incomplete' "
        f"WHEN {balanced} THEN 'balanced' ELSE 'gap' END AS status"
    )
    return with_(
        _FINAL,
        f"SELECT *, {gaps}, {status} FROM ({duck.SUMMARY})",
        _REPORT | dict.fromkeys(_GAPS, "n") | {"status": "s"},
    )


@query("recon_gaps", _gap_sql(False))
def _(spark, folder):
    return summary.recon_gaps(spark, pipeline_tables(spark, folder), RULES)


@query("recon_gaps_zero_filled", _gap_sql(True))
def _(spark, folder):
    return summary.recon_gaps(spark, pipeline_tables(spark, folder), RULES, zero_filled=True)


@query(
    "unmatched_contributions",
    with_(
        _FINAL,
        "SELECT receival_date, bank, remarks, "
        + ", ".join(f"SUM(ROUND({m})) AS {m}" for m in duck.METRICS)
        + f" FROM final f WHERE COALESCE({', '.join(duck.METRICS)}) IS NOT NULL AND NOT EXISTS (SELECT 1 FROM date_array d "
        f"WHERE d.receival_date < {duck.AS_OF} AND d.receival_date = f.receival_date "
        "AND d.issuer_name = f.bank || ' - ' || f.remarks) "
        f"AND (f.receival_date >= {duck.START} OR f.receival_date IS NULL) GROUP BY 1, 2, 3",
        _KEYS | _METRICS,
    ),
)
def _(spark, folder):
    return summary.unmatched_contributions(spark, pipeline_tables(spark, folder), RULES)


@query(
    "spine_left_join",
    with_(
        _FINAL,
        "SELECT d.receival_date, d.issuer_name, SUM(ROUND(issuer_traffic)) AS issuer_traffic, "
        "SUM(ROUND(issuer_trx_amount)) AS issuer_trx_amount FROM date_array d LEFT JOIN ("
        + "\nUNION ALL ".join(f"({duck.issuer(n, f'mpay WHERE {duck.own_rows(n)}')})" for n in duck.ISSUERS)
        + ") f ON d.receival_date = f.receival_date AND d.issuer_name = f.bank || ' - ' || f.remarks GROUP BY 1, 2",
        {"receival_date": "d", "issuer_name": "s", "issuer_traffic": "n", "issuer_trx_amount": "n"},
    ),
)
def _(spark, folder):
    tables = pipeline_tables(spark, folder)
    groups = contributions.as_contribution(issuers.issuer_contributions(tables, RULES))
    dense = spine.date_spine(spark, RULES.as_of, RULES.report_months)
    return contributions.on_spine(dense, groups).select(
        "receival_date", "issuer_name", "issuer_traffic", "issuer_trx_amount"
    )
