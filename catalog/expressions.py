"""Single operators of the reconciliation: predicates, classifications, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck, standins
from catalog.recon import _LINES, _MANDIRI, production_inputs, with_
from catalog.registry import add, query
from catalog.standins import RULES, merchant_payments, payments, read_table, report, statement
from tripledger.operators import classify, contributions, spine, timing
from tripledger.plans import banks, production, summary
from tripledger.schemas import KEYS, MONEY, RATE

EVENTS = "WITH e AS (SELECT * FROM events)"
PAY = f"WITH {duck.PAY}"
MPAY = f"WITH {duck.MPAY}"
LINES = f"WITH {_LINES}"


def events(spark, folder):
    return read_table(spark, folder, "events")


def lines(spark, folder):
    return banks.file_bca(statement(spark, folder, banks.BCA_FILE))


# Time rules, on the event stream (true times of day).
@query(
    "date_part",
    f"{EVENTS} SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%H:%M:%S') AS clock FROM e",
)
def _(spark, folder):
    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id", timing.date_part(ts).alias("day"), timing.time_part(ts).alias("clock")
    )


@query(
    "cutoff_shift",
    f"""{EVENTS} SELECT event_id,
      CAST(CASE WHEN CAST(ts AS TIME) >= '23:30:00' THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS VARCHAR) AS late_shift,
      CAST(CASE WHEN event_type = 'click' AND CAST(ts AS TIME) >= '22:00:00' THEN CAST(ts AS DATE) + 1
        WHEN event_type = 'view' AND CAST(ts AS TIME) >= '23:30:00' THEN CAST(ts AS DATE) + 1
        ELSE CAST(ts AS DATE) END AS VARCHAR) AS by_type FROM e""",
)
def _(spark, folder):
    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id",
        timing.cutoff_shift(ts, "23:30:00").alias("late_shift"),
        timing.cutoff_shift_by(F.col("event_type"), ts, {"click": "22:00:00", "view": "23:30:00"}).alias("by_type"),
    )


@query(
    "batch_label_prod",
    f"""{EVENTS} SELECT event_id, CASE WHEN event_type = 'purchase' THEN CASE WHEN CAST(ts AS TIME) >= '22:00:00'
      OR CAST(ts AS TIME) < '10:00:00' THEN 'AM Batch (22:00-09:59)' ELSE 'PM Batch (10:00-21:59)' END END AS batch FROM e""",
)
def _(spark, folder):
    label = timing.batch_label(F.col("ts"), "AM Batch (22:00-09:59)", "PM Batch (10:00-21:59)")
    return events(spark, folder).select(
        "event_id", F.when(F.col("event_type") == "purchase", label).alias("batch")
    )


@query(
    "batch_label_issuer",
    f"""{EVENTS} SELECT event_id, CASE WHEN hour(ts) >= 22 OR hour(ts) < 10 THEN 'MCD AM (22.00-09.59)' ELSE 'MCD PM (10.00-21.59)' END AS mcd,
      CASE WHEN hour(ts) >= 22 OR hour(ts) < 10 THEN 'MSME AM (22.00-09.59)' ELSE 'MSME PM (10.00-21.59)' END AS msme FROM e""",
)
def _(spark, folder):
    from tripledger.plans.rules import MCD_AM, MCD_PM, MSME_AM, MSME_PM

    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id",
        timing.batch_label(ts, MCD_AM, MCD_PM).alias("mcd"),
        timing.batch_label(ts, MSME_AM, MSME_PM).alias("msme"),
    )


@query(
    "hour_threshold_label",
    f"""{EVENTS} SELECT event_id, CASE WHEN hour(ts) BETWEEN 10 AND 21 THEN
        CASE WHEN value < 20 THEN 'MCD AM (22.00-09.59)' ELSE 'MSME AM (22.00-09.59)' END
      ELSE CASE WHEN value < 20 THEN 'MCD PM (10.00-21.59)' ELSE 'MSME PM (10.00-21.59)' END END AS remarks FROM e""",
)
def _(spark, folder):
    return events(spark, folder).select(
        "event_id", timing.hour_threshold_label(F.col("ts"), F.col("value"), 20).alias("remarks")
    )


@query("bank_d1_shift", f"{LINES} SELECT trx_id, CAST(receival_date - 1 AS VARCHAR) AS receival_date FROM lines")
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder))
    day = timing.bank_day_shift(timing.date_part(F.col("posted")))
    return rows.select("trx_id", day.alias("receival_date"))


@query(
    "rolling_window_filter",
    f"""{PAY} SELECT '9 months' AS period, trx_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM pay
      WHERE CAST(ts AS DATE) >= DATE '1998-11-30' - INTERVAL 9 MONTH AND CAST(ts AS DATE) < DATE '1998-11-30'
      UNION ALL SELECT '6 months', trx_id, CAST(CAST(ts AS DATE) AS VARCHAR) FROM pay
      WHERE CAST(ts AS DATE) >= DATE '1998-08-31' - INTERVAL 6 MONTH AND CAST(ts AS DATE) < DATE '1998-08-31'""",
)
def _(spark, folder):
    from datetime import date

    rows = payments(spark, folder)

    def window(name, as_of, months):
        return rows.where(
            timing.in_last_months(F.col("ts"), as_of, months) & (F.col("ts").cast("date") < F.lit(as_of))
        ).select(F.lit(name).alias("period"), "trx_id", timing.date_part(F.col("ts")).alias("day"))

    return window("9 months", date(1998, 11, 30), 9).unionAll(window("6 months", date(1998, 8, 31), 6))


@query(
    "combine_date_time",
    f"""{PAY} SELECT trx_id, CASE WHEN qty IN (19, 20) THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment FROM pay""",
)
def _(spark, folder):
    clock = F.expr("case when qty = 19 then null when qty = 20 then '25:61:00' else date_format(ts, 'HH:mm:ss') end")
    return payments(spark, folder).select(
        "trx_id", timing.combine_date_time(F.col("ts").cast("date"), clock).alias("moment")
    )


_POST_SHAPES = (
    "case qty % 4 when 0 then date_format(ts, 'dd/MM/yy HH.mm') when 1 then date_format(ts, 'dd/MM/yy HH.mm.ss') "
    "when 2 then date_format(ts, 'yyyy-MM-dd HH:mm:ss') else 'pending' end"
)


@query(
    "parse_two_formats",
    f"""{PAY} SELECT trx_id, CASE qty % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:00') WHEN 3 THEN NULL
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS posted FROM pay""",
)
def _(spark, folder):
    return payments(spark, folder).select(
        "trx_id", timing.parse_post_date(F.expr(_POST_SHAPES)).alias("posted")
    )


@query(
    "regex_predicate",
    f"{PAY} SELECT trx_id, qty % 4 = 0 AS short_form FROM pay",
)
def _(spark, folder):
    return payments(spark, folder).select(
        "trx_id", timing.is_post_date_without_seconds(F.expr(_POST_SHAPES)).alias("short_form")
    )


# Classification.
def _settlement_sql(select):
    return f"WITH {duck.SETTLEMENT} {select}"


def _with_merchants(spark, folder):
    t = production_inputs(spark, folder)
    return production.join_merchant(t[summary.SETTLEMENT], t[summary.MERCHANTS])


@query(
    "merchant_segment",
    _settlement_sql("SELECT credit_trans_trx_id AS trx_id, merchant_category AS segment FROM settlement"),
)
def _(spark, folder):
    rows = _with_merchants(spark, folder).where("master_account_id is not null")
    return rows.select(
        F.col("credit_trans_trx_id").alias("trx_id"),
        classify.merchant_segment(F.col("issuer"), RULES.segments).alias("segment"),
    )


@query(
    "mdr_rate",
    f"""{PAY} SELECT trx_id, CAST(CASE issuer WHEN 'OTTOPAY' THEN CASE WHEN line_status = 'O' AND qty <> 20 THEN 0.0054 ELSE 0.0035 END
      WHEN 'INDODANA' THEN CASE WHEN line_status = 'O' AND qty <> 20 THEN 0.0063 ELSE 0.0042 END WHEN 'KREDIVO' THEN 0.023 ELSE 0.007 END AS DOUBLE) AS mdr FROM pay""",
)
def _(spark, folder):
    flag = F.expr("case when qty = 20 then null when line_status = 'O' then 'OFF US' else 'ON US' end")
    return payments(spark, folder).select(
        "trx_id", classify.mdr_rate(F.col("issuer"), flag, RULES.rates, RULES.default_rate).alias("mdr")
    )


@query(
    "ref_by_date",
    _settlement_sql("SELECT credit_trans_trx_id AS trx_id, txn_ref FROM settlement"),
)
def _(spark, folder):
    rows = _with_merchants(spark, folder).where("master_account_id is not null")
    ref = production.txn_ref(
        F.col("txn_date"), F.col("internal_ref_field"), F.col("issuer_ref_field"), RULES.migration
    )
    return rows.select(F.col("credit_trans_trx_id").alias("trx_id"), ref.alias("txn_ref"))


@query(
    "segment_exact",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MCD' WHEN 'BUILDING' THEN 'FM' ELSE 'Other' END AS segment
      FROM customer""",
)
def _(spark, folder):
    rows = read_table(spark, folder, "customer")
    shop = F.initcap("c_mktsegment")
    return rows.select(
        "c_custkey", classify.segment_exact(shop, {"AUTOMOBILE": "MCD", "building": "FM"}, "Other").alias("segment")
    )


@query(
    "segment_like",
    """SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%RED%' OR upper(p_name) LIKE '%BLUE%' THEN 'Colour' WHEN upper(p_name) LIKE '%RING%' THEN 'Ring'
      ELSE 'ELSE' END AS segment FROM part""",
)
def _(spark, folder):
    name = F.upper("p_name")
    cases = [(classify.like_any(name, ["red", "blue"]), "Colour"), (classify.like_any(name, ["RING"]), "Ring")]
    return read_table(spark, folder, "part").select(
        "p_partkey", classify.first_match(cases, "ELSE").alias("segment")
    )


@query("desc_classify", f"{LINES} SELECT trx_id, {duck.BNI_CLASS} AS remarks FROM lines")
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder))
    return rows.select("trx_id", classify.nested_words(F.upper("description"), RULES.bni_groups).alias("remarks"))


@query(
    "desc_route",
    f"{LINES} "
    + " UNION ALL ".join(
        f"SELECT CAST(receival_date - 1 AS VARCHAR) AS receival_date, '{b}' AS bank, {r} AS remarks, CAST(paid AS DOUBLE) AS amount_received "
        f"FROM lines WHERE {w}"
        for b, r, w in [
            ("LinkAja", "'Expansion (D-1)'", "description LIKE '%LINKAJA%'"),
            ("OVO", "'OVO'", "UPPER(description) LIKE '%OVO%'"),
            ("INDODANA", "'INDODANA'", "UPPER(description) LIKE '%INDODANA%'"),
            ("BCA", "'BCA'", "UPPER(description) LIKE '%BCA SETTLEMENT%'"),
            ("OTTOPAY", "'OTTOPAY'", "UPPER(description) LIKE '%OTTOPAY%'"),
            ("Kredivo", duck.KREDIVO_SEG, "UPPER(description) LIKE '%KREDIVO%'"),
        ]
    ),
)
def _(spark, folder):
    return banks.routed(lines(spark, folder), banks.bca_routes(RULES))


@query("desc_filter_cs", f"{LINES} SELECT trx_id, description FROM lines WHERE description LIKE '%LINKAJA%'")
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder))
    route = classify.Route("LinkAja", "LINKAJA", F.lit("any"), F.col("ts").cast("date"), ignore_case=False)
    hit = route.hit(F.col("description"), F.upper("description"))
    return rows.where(hit.isNotNull()).select("trx_id", "description")


@query(
    "segment_desc",
    f"{LINES} SELECT trx_id, {duck.KREDIVO_SEG} AS remarks FROM lines",
)
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder))
    segment = classify.segment_like(F.upper("description"), RULES.kredivo_codes, RULES.kredivo_default)
    return rows.select("trx_id", segment.alias("remarks"))


@query("left_key", f"{LINES} SELECT trx_id, left(rem, 11) AS mid FROM lines")
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder)).withColumn(
        "remarks", F.expr(standins.STATEMENTS[banks.MANDIRI_FILE][1].removesuffix(" as remarks"))
    )
    return rows.select("trx_id", F.left("remarks", F.lit(11)).alias("mid"))


@query(
    "compose_label",
    f"{PAY} SELECT trx_id, issuer || ' - ' || CASE WHEN qty = 20 THEN NULL ELSE flag END AS issuer_name FROM pay",
)
def _(spark, folder):
    remark = F.expr("case when qty = 20 then null else flag end")
    return payments(spark, folder).select("trx_id", spine.label(F.col("issuer"), remark).alias("issuer_name"))


# Predicates with SQL's NULL rules, counted per issuer and day over all rows.
_TEXT = {
    "mid": ("case when qty = 18 then null else concat('M-', cast(qty as string)) end", "CASE WHEN qty = 18 THEN NULL ELSE 'M-' || qty END"),
    "remark": (standins.REMARK, "CASE WHEN qty <= 15 THEN NULL WHEN qty = 16 THEN 'Force Credit by ops' ELSE 'ok' END"),
    "chargeback": (standins.CHARGEBACK, "CASE WHEN qty = 17 THEN CAST(trx_id AS VARCHAR) END"),
    "status": ("case when disc = 10 then 'Cancelled' when disc = 9 then 'settled' else 'Settled' end",
               "CASE WHEN disc = 10 THEN 'Cancelled' WHEN disc = 9 THEN 'settled' ELSE 'Settled' END"),
}


def _predicate(name, column, condition, sql_condition):
    spark_text, duck_text = _TEXT[column]

    def run(spark, folder):
        rows = payments(spark, folder).withColumn("v", F.expr(spark_text))
        return rows.where(condition(F.col("v"))).select("trx_id", "v")

    add(name, run, f"{PAY} SELECT trx_id, v FROM (SELECT *, {duck_text} AS v FROM pay) WHERE {sql_condition}")


_predicate("exclude_list", "mid", lambda c: classify.not_in(c, ["M-49", "M-50"]), "v NOT IN ('M-49', 'M-50')")
_predicate("exclude_list_empty", "mid", lambda c: classify.not_in(c, []), "TRUE")
_predicate("not_equal_null", "mid", lambda c: c != "M-50", "v <> 'M-50'")
_predicate(
    "not_like_or_null",
    "remark",
    lambda c: classify.not_like_or_null(c, "FORCE CREDIT"),
    "(UPPER(v) NOT LIKE '%FORCE CREDIT%' OR v IS NULL)",
)
_predicate("is_null_filter", "chargeback", lambda c: c.isNull(), "v IS NULL")
_predicate("status_filter", "status", lambda c: c == "Settled", "v = 'Settled'")


# Amounts.
_R = "CAST(0.0054 AS DECIMAL(5,4))"


@query(
    "net_of_mdr",
    f"{PAY} SELECT trx_id, CAST(gmv - gmv * {_R} AS DOUBLE) AS net, CAST(gmv * (1 - {_R}) AS DOUBLE) AS kept, CAST(gmv * {_R} AS DOUBLE) AS fee FROM pay",
)
def _(spark, folder):
    rate, gmv = F.lit("0.0054").cast(RATE), F.col("gmv")
    kept = gmv * (F.lit(1).cast(RATE) - rate)
    return payments(spark, folder).select(
        "trx_id",
        production.net_of(gmv, rate).alias("net"),
        kept.alias("kept"),
        (gmv * rate).alias("fee"),
    )


_TYPE = "case when flag = 'R' then 'Refund' when qty = 20 then null else 'Purchase' end"


@query(
    "signed_amount",
    f"{PAY} SELECT trx_id, CAST(CASE WHEN {_TYPE} = 'Purchase' THEN gmv ELSE -gmv END AS DOUBLE) AS amount FROM pay",
)
def _(spark, folder):
    return payments(spark, folder).select(
        "trx_id", classify.signed(F.expr(_TYPE) == "Purchase", F.col("gmv")).alias("amount")
    )


@query(
    "round_metric",
    f"""{PAY} SELECT trx_id, CAST(round(half) AS DOUBLE) AS up, CAST(round(-half) AS DOUBLE) AS down FROM
      (SELECT trx_id, CAST(floor(gmv) AS DECIMAL(18,2)) + CAST(0.5 AS DECIMAL(18,2)) AS half FROM pay)""",
)
def _(spark, folder):
    half = (F.floor("gmv").cast(MONEY) + F.lit("0.5").cast(MONEY)).cast(MONEY)
    return payments(spark, folder).select(
        "trx_id", contributions.whole(half).alias("up"), contributions.whole(-half).alias("down")
    )


# Joins.


def _reversal_sql(distinct):
    reversals = f"reversals AS (SELECT {distinct} trx_id FROM mpay WHERE flag = 'R')"
    return (
        f"WITH {duck.MPAY}, {reversals} SELECT s.trx_id, b.trx_id AS reversal_trx_id FROM mpay s "
        "LEFT JOIN reversals b ON s.trx_id = b.trx_id"
    )


def _reversal(unique):
    def run(spark, folder):
        t = production_inputs(spark, folder)
        joined = production.join_reversal(t[summary.SETTLEMENT], t[summary.REVERSALS], unique)
        return joined.select(F.col("credit_trans_trx_id").alias("trx_id"), "reversal_trx_id")

    return run


add("join_reversal", _reversal(True), _reversal_sql("DISTINCT"))
add("join_reversal_fanout", _reversal(False), _reversal_sql(""))


@query(
    "join_merchant",
    f"""{MPAY} SELECT trx_id, mpay.account_id, sm.c_custkey AS master_account_id, sm.c_mktsegment AS vendor_type FROM mpay
      LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) sm ON mpay.account_id = sm.c_custkey""",
)
def _(spark, folder):
    return _with_merchants(spark, folder).select(
        F.col("credit_trans_trx_id").alias("trx_id"), "account_id", "master_account_id", "vendor_type"
    )


@query(
    "join_transactions",
    f"""{MPAY}, transactions AS (SELECT CAST(trx_id AS VARCHAR) AS trx_id,
        CASE WHEN max(line_status) = 'O' THEN 'OFF US' ELSE 'ON US' END AS onus_offus, max(ts) AS trx_date FROM mpay GROUP BY mpay.trx_id)
      SELECT s.trx_id, st.onus_offus FROM mpay s LEFT JOIN (SELECT * FROM transactions WHERE CAST(trx_date AS DATE) >= {duck.ONUS_START}) st
      ON CAST(s.trx_id AS VARCHAR) = st.trx_id""",
)
def _(spark, folder):
    t = production_inputs(spark, folder)
    joined = production.join_transactions(t[summary.SETTLEMENT], t[summary.TRANSACTIONS], RULES)
    return joined.select(F.col("credit_trans_trx_id").alias("trx_id"), "onus_offus")


@query(
    "join_mandiri_names",
    f"WITH {_MANDIRI} SELECT mid, remarks, COUNT(*) AS line_count, CAST(SUM(amount_received) AS DOUBLE) AS amount_received "
    "FROM file_mandiri GROUP BY 1, 2",
)
def _(spark, folder):
    joined = banks.file_mandiri(
        statement(spark, folder, banks.MANDIRI_FILE), report(spark, folder, banks.MANDIRI_REPORT), RULES
    )
    return joined.groupBy("mid", "remarks").agg(
        F.count("*").alias("line_count"), F.sum("amount_received").alias("amount_received")
    )


# Aggregates.
def by_day():
    return [
        F.col("ts").cast("date").alias("receival_date"),
        F.col("issuer").alias("bank"),
        F.col("flag").alias("remarks"),
    ]


def measured(spark, folder, net):
    """The three measures per day, issuer and flag; columns that a query does not take are not computed."""
    net = F.col(net) if isinstance(net, str) else net
    rows = payments(spark, folder).select(*by_day(), F.col("trx_id").alias("trx"), F.col("gmv").alias("gross"), net.alias("net"))
    return contributions.measure(rows, "yti")


_BY_DAY_SQL = "CAST(CAST(ts AS DATE) AS VARCHAR) AS receival_date, issuer AS bank, flag AS remarks"


@query("traffic_distinct", f"{PAY} SELECT {_BY_DAY_SQL}, COUNT(DISTINCT trx_id) AS traffic FROM pay GROUP BY 1, 2, 3")
def _(spark, folder):
    return measured(spark, folder, "net").select(*KEYS, F.col("yti_traffic").alias("traffic"))


@query("sum_amount", f"{PAY} SELECT {_BY_DAY_SQL}, CAST(SUM(gmv) AS DOUBLE) AS amount FROM pay GROUP BY 1, 2, 3")
def _(spark, folder):
    return measured(spark, folder, "net").select(*KEYS, F.col("yti_trx_amount").alias("amount"))


@query(
    "sum_net",
    f"{PAY} SELECT {_BY_DAY_SQL}, CAST(SUM(gmv - (gmv * {_R})) AS DOUBLE) AS net FROM pay GROUP BY 1, 2, 3",
)
def _(spark, folder):
    net = production.net_of(F.col("gmv"), F.lit("0.0054").cast(RATE))
    return measured(spark, folder, net).select(*KEYS, F.col("yti_settlement_amount").alias("net"))


_PTYPE = "case when flag = 'R' then 'E-money Reversal' when qty = 23 then 'Adjustment' else 'Customer Purchase' end"
_P_MINUS_R = duck.signed_sum(f"({_PTYPE})")


@query(
    "purchase_minus_reversal",
    f"{PAY} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS receival_date, issuer AS bank, CAST({_P_MINUS_R} AS DOUBLE) AS amount "
    "FROM pay GROUP BY 1, 2",
)
def _(spark, folder):
    amount = production.purchase_minus_reversal(F.expr(_PTYPE), F.col("gmv"))
    return payments(spark, folder).groupBy(*by_day()[:2]).agg(F.sum(amount).alias("amount"))


_RATE_SQL = "CAST(CASE WHEN line_status = 'O' THEN 0.0054 ELSE 0.0035 END AS DECIMAL(5,4))"


@query(
    "group_by_rate",
    f"""{PAY}, t AS (SELECT *, {_RATE_SQL} AS mdr FROM pay) SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS receival_date, issuer AS bank,
      COUNT(DISTINCT trx_id) AS yti_traffic, CAST({_P_MINUS_R} AS DOUBLE) AS yti_trx_amount,
      CAST(({_P_MINUS_R}) * (1 - mdr) AS DOUBLE) AS yti_settlement_amount FROM t GROUP BY 1, 2, mdr""",
)
def _(spark, folder):
    rate = F.expr("cast(case when line_status = 'O' then 0.0054 else 0.0035 end as decimal(5,4))")
    gross = production.purchase_minus_reversal(F.expr(_PTYPE), F.col("gmv"))
    rows = payments(spark, folder).select(
        *by_day()[:2],
        F.col("issuer").alias("remarks"),
        F.col("trx_id").alias("trx"),
        gross.alias("gross"),
        production.net_of(gross, rate).alias("net"),
        rate.alias("mdr"),
    )
    return contributions.measure(rows, "yti", ["mdr"]).drop("remarks")


@query(
    "sum_of_rounded",
    f"""{PAY}, part AS (SELECT CAST(ts AS DATE) AS receival_date, issuer, flag, line_status, SUM(CASE WHEN issuer <> 'OVO' THEN gmv END) AS part
      FROM pay GROUP BY 1, 2, 3, 4) SELECT CAST(receival_date AS VARCHAR) AS receival_date, issuer AS bank,
      CAST(SUM(ROUND(part)) AS DOUBLE) AS amount_received FROM part GROUP BY 1, 2""",
)
def _(spark, folder):
    partial = payments(spark, folder).groupBy(*by_day(), "line_status").agg(
        F.sum(F.expr("case when issuer <> 'OVO' then gmv end")).alias("amount_received")
    )
    return contributions.sum_of_rounded(
        contributions.as_contribution(partial), ["receival_date", "bank"]
    ).select("receival_date", "bank", "amount_received")


@query(
    "dedupe_rows",
    f"{LINES} SELECT DISTINCT strftime(posted, '%Y-%m-%d %H:%M:%S') AS posted, rem AS remarks, CAST(paid AS DOUBLE) AS amount FROM lines",
)
def _(spark, folder):
    rows = standins.described(merchant_payments(spark, folder)).withColumn(
        "remarks", F.expr(standins.STATEMENTS[banks.MANDIRI_FILE][1].removesuffix(" as remarks"))
    )
    return rows.select("posted", "remarks", F.col("paid").alias("amount")).distinct()
