"""Time rules, classification and NULL logic at their boundaries."""

from datetime import date

import pytest
from conftest import day, moment, money
from pyspark.sql import functions as F

from tripledger.operators import classify, contributions, spine, timing
from tripledger.operators.classify import RateRule, SegmentRule
from tripledger.plans import issuers, production
from tripledger.plans.rules import ProductionRule, ReconRules


def column(spark, values, expr, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


MOMENTS = [moment(f"2024-01-31 {t}") for t in ("09:59:59", "10:00:00", "21:59:59", "22:00:00", "23:29:59", "23:30:00")] + [None]


def test_cutoffs(spark):
    late = column(spark, MOMENTS, lambda c: timing.cutoff_shift(c, "23:30:00"), "timestamp_ntz")
    assert late == [day("2024-01-31")] * 5 + [day("2024-02-01"), None]
    early = column(spark, MOMENTS, lambda c: timing.cutoff_shift(c, "22:00:00"), "timestamp_ntz")
    assert early == [day("2024-01-31")] * 3 + [day("2024-02-01")] * 3 + [None]
    by = column(
        spark, MOMENTS, lambda c: timing.cutoff_shift_by(F.lit("A"), c, {"A": "22:00:00", "B": "23:30:00"}), "timestamp_ntz"
    )
    assert by == early


def test_batches(spark):
    labels = column(spark, MOMENTS, lambda c: timing.batch_label(c, "AM", "PM"), "timestamp_ntz")
    assert labels == ["AM", "PM", "PM", "AM", "AM", "AM", "PM"]


def test_post_dates(spark):
    texts = ["31/12/99 23.59", "01/01/24 00.00.01", "2024-01-02 03:04:05", "31/02/24 10.00", "x", None]
    got = column(spark, texts, timing.parse_post_date, "string")
    assert got == [moment("1999-12-31 23:59:00"), moment("2024-01-01 00:00:01"), moment("2024-01-02 03:04:05"), None, None, None]


def test_period_is_clamped_at_month_end(spark):
    rows = spark.createDataFrame([(moment("2024-02-28"),), (moment("2024-02-29"),)], "t timestamp_ntz")
    kept = rows.where(timing.in_last_months(F.col("t"), date(2024, 8, 31), 6)).collect()
    assert [r.t for r in kept] == [moment("2024-02-29")]


def test_null_logic(spark):
    values = ["a", "b", None]

    def keep(condition):
        rows = spark.createDataFrame([(v,) for v in values], "v string")
        return [r.v for r in rows.where(condition(F.col("v"))).collect()]

    assert keep(lambda c: classify.not_in(c, ["a"])) == ["b"]
    assert keep(lambda c: classify.not_in(c, [])) == values
    assert keep(lambda c: classify.not_like_or_null(c, "A")) == ["b", None]
    assert column(spark, values, lambda c: classify.signed(c == "a", F.lit(5)), "string") == [5, -5, -5]
    assert column(spark, values, lambda c: spine.label(F.lit("x"), c), "string") == ["x - a", "x - b", None]


def test_segments_and_rates(spark):
    rules = (SegmentRule("I", "vendor_type", (("V1", "MCD"),), "ELSE"),)
    rows = spark.createDataFrame([("I", "V1"), ("I", "V2"), ("I", None), ("J", "V1")], "issuer string, vendor_type string")
    got = [r.s for r in rows.select(classify.merchant_segment(F.col("issuer"), rules).alias("s")).collect()]
    assert got == ["MCD", "ELSE", "ELSE", "Unknown"]
    rate = classify.mdr_rate(F.col("issuer"), F.col("flag"), (RateRule("I", "0.0054", "0.0035"),), "0.0070")
    flags = spark.createDataFrame([("I", "OFF US"), ("I", "ON US"), ("I", None), ("J", "OFF US")], "issuer string, flag string")
    assert [str(r.r) for r in flags.select(rate.alias("r")).collect()] == ["0.0054", "0.0035", "0.0035", "0.0070"]
    exact = classify.segment_exact(F.col("issuer"), {"i": "hit"}, "miss")
    assert [r.x for r in flags.select(exact.alias("x")).collect()] == ["hit"] * 3 + ["miss"]


def test_purchase_minus_reversal(spark):
    kinds = ["Customer Purchase", "E-money Reversal", "Adjustment", None]
    got = column(spark, kinds, lambda c: production.purchase_minus_reversal(c, F.lit(money(5)).cast("decimal(18,2)")), "string")
    assert got == [money(5), money(-5), money(0), money(0)]


def test_sum_of_rounded_partials(spark):
    rows = spark.createDataFrame(
        [(day("2024-01-01"), "B", "r", money(x)) for x in (0.5, 0.5, 1.4)], "receival_date date, bank string, remarks string, amount_received decimal(18,2)"
    )
    total = contributions.sum_of_rounded(contributions.as_contribution(rows), ["bank"]).first()
    assert total.amount_received == 3 and total.yti_traffic is None
    assert rows.agg(contributions.whole(F.sum("amount_received"))).first()[0] == 2


def test_categories_that_remarks_do_not_name_are_one_group(spark):
    rows = [("OVO", "a", 1, "10.40"), ("OVO", "b", 1, "10.40"), ("KREDIVO", "a", 1, "3"), ("KREDIVO", "b", 1, "4")]
    enriched = spark.createDataFrame(rows, "issuer string, merchant_category string, trx int, gmv string").selectExpr(
        "*", "date '2024-01-05' AS adjusted_date", "cast(null AS string) AS remarks_time_split", "1 AS account_id", "'Customer Purchase' AS txn_type",
        "cast(0.01 AS decimal(5,4)) AS mdr",
    ).withColumn("gmv", F.col("gmv").cast("decimal(18,2)"))
    got = production.production_contributions(enriched, ReconRules(as_of=date(2024, 6, 1))).collect()
    assert sorted((r.bank, r.remarks, r.yti_traffic, r.yti_trx_amount) for r in got) == [
        ("Kredivo", "a", 1, money(3)), ("Kredivo", "b", 1, money(4)), ("OVO", "OVO", 1, money("20.80")),
    ]


def test_rules_name_each_case_once():
    with pytest.raises(ValueError, match="OVO / any category"):
        ReconRules(as_of=date(2024, 6, 1), production=(ProductionRule("OVO", "OVO"), ProductionRule("OVO", "Other")))


def test_issuers_follow_the_cutoffs_of_the_rules(spark):
    rows = spark.createDataFrame([("1", moment("2024-01-05 22:30:00"))], "issuer_rrn string, transaction_time timestamp_ntz").selectExpr(
        "*", "'Success' AS payment_status", "1 AS gross_amount", "1 AS nett_amount"
    )
    rules = ReconRules(as_of=date(2024, 6, 1))
    late = rules.but(cutoffs={"OTTOPAY": "22:00:00"})
    none = rules.but(cutoffs={})
    days = [issuers.ottopay(rows, r).first().receival_date for r in (rules, late, none)]
    assert days == [day("2024-01-05"), day("2024-01-06"), day("2024-01-05")]
    hours = column(spark, MOMENTS, lambda c: timing.batch_label(c, "AM", "PM", ("23:00:00", "10:00:00")), "timestamp_ntz")
    assert hours == ["AM", "PM", "PM", "PM", "AM", "AM", "PM"]
