"""The report on small hand-made contributions and on the smallest tables."""

from datetime import date

from conftest import SF, day, money
from pyspark.sql import functions as F

from catalog import standins
from tripledger.operators import contributions, spine
from tripledger.plans import production, summary
from tripledger.schemas import METRICS

AS_OF = date(2024, 3, 31)


def given(spark):
    rows = [
        (day("2024-03-01"), "BCA", "BCA", money(10.4)),
        (day("2024-03-01"), "BCA", "BCA", money(0.5)),
        (day("2024-03-02"), "Kredivo", "Other", money(7)),
        (day("2024-03-02"), "BCA", None, money(3)),
        (day("2020-01-01"), "BCA", "BCA", money(9)),
    ]
    frame = spark.createDataFrame(rows, "receival_date date, bank string, remarks string, amount_received decimal(18,2)")
    return contributions.as_contribution(frame)


def test_spine_is_dense(spark):
    dense = spine.date_spine(spark, AS_OF, 1)
    days = (AS_OF - date(2024, 2, 29)).days + 1
    assert dense.count() == days * 23 == dense.distinct().count()
    assert "Cartesian" not in dense._jdf.queryExecution().executedPlan().toString()


def test_one_row_per_spine_key_and_nothing_lost(spark):
    dense = spine.date_spine(spark, AS_OF, 1)
    report = contributions.on_spine(dense, given(spark)).cache()
    assert report.count() == dense.count()
    hit = report.where("amount_received is not null").collect()
    assert [(r.issuer_name, r.amount_received) for r in hit] == [("BCA - BCA", 11)]
    lost = contributions.unmatched(dense, given(spark))
    matched = report.agg(F.sum("amount_received")).first()[0]
    everything = contributions.sum_of_rounded(given(spark), []).first().amount_received
    assert matched + lost.agg(F.sum("amount_received")).first()[0] == everything


def test_same_as_left_join(spark):
    dense = spine.date_spine(spark, AS_OF, 1)
    label = spine.label(F.col("bank"), F.col("remarks"))
    totals = contributions.sum_of_rounded(given(spark).withColumn("issuer_name", label), ["receival_date", "issuer_name"])
    joined = dense.join(totals, ["receival_date", "issuer_name"], "left").select(
        "receival_date", "issuer_name", "bank", F.col("remark").alias("remarks"), *METRICS
    )
    report = contributions.on_spine(dense, given(spark))
    assert report.exceptAll(joined).isEmpty() and joined.exceptAll(report).isEmpty()


def test_stubs_change_nothing(spark):
    dense = spine.date_spine(spark, AS_OF, 1)
    days = dense.select("receival_date")
    stubs = spine.cross_stub(days, "BNI", spine.REMARKS_BNI).unionByName(
        spine.cross_stub(days, "Mandiri", spine.REMARKS_MANDIRI)
    )
    with_stubs = contributions.union_contributions([given(spark), stubs])
    a, b = contributions.on_spine(dense, given(spark)), contributions.on_spine(dense, with_stubs)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_gaps_and_status(spark):
    names = "yti_traffic int, issuer_traffic int, yti_trx_amount int, issuer_trx_amount int, amount_received int, issuer_settlement_amount int, yti_settlement_amount int"
    rows = spark.createDataFrame([(1, 1, 9, 9, 8, 8, 8), (2, 1, 9, 9, 8, 8, 8), (2, None, 9, None, 8, None, 8), (None,) * 7], names)
    plain = contributions.with_gaps(rows).collect()
    assert [r.status for r in plain] == ["balanced", "gap", "incomplete", "no data"]
    assert [r.gap_traffic for r in plain] == [0, 1, None, None]
    assert [r.gap_traffic for r in contributions.with_gaps(rows, True).collect()] == [0, 1, 2, 0]


def test_reversal_listed_twice(spark):
    settled = spark.createDataFrame([(1, "x"), (2, "y")], "credit_trans_trx_id long, v string")
    listed = spark.createDataFrame([(1,), (1,)], "trx_id long")
    assert production.join_reversal(settled, listed).count() == 2
    assert production.join_reversal(settled, listed, unique=False).count() == 3


def test_excluded_accounts_drop_only_their_rule(spark):
    rules = (production.ProductionRule("A", "A", excluded_accounts=(7,)), production.ProductionRule("B", "B"))
    rows = spark.createDataFrame([("A", 7), ("A", 8), ("A", None), ("B", 7), ("B", None), ("C", 1)], "issuer string, account_id long")
    numbered = rows.withColumn("merchant_category", F.lit("m")).withColumn("n", production.rule_number(rules))
    assert [r.n for r in numbered.collect()] == [None, 1, None, 2, 2, None]


def test_hidden_rate_key_rounds_each_slice(spark):
    rows = spark.createDataFrame(
        [(day("2024-03-01"), "B", "r", "1", money(0.5), money(0.5), "a"), (day("2024-03-01"), "B", "r", "1", money(0.5), money(0.5), "b")],
        "receival_date date, bank string, remarks string, trx string, gross decimal(18,2), net decimal(18,2), slice string",
    )
    groups = contributions.measure(rows, "yti", ["slice"])
    assert groups.count() == 2
    total = contributions.sum_of_rounded(contributions.as_contribution(groups), ["bank"]).first()
    assert (total.yti_traffic, total.yti_trx_amount) == (2, 2)


def test_report_is_repeatable(spark):
    tables = standins.pipeline_tables(spark, SF)
    first = summary.recon_summary(spark, tables, standins.RULES, ordered=False)
    second = summary.recon_summary(spark, tables, standins.RULES, ordered=False)
    assert first.exceptAll(second).isEmpty() and first.count() == second.count()
