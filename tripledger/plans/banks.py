"""Bank view (G): each statement is scanned once; its lines are routed to issuers, then summed once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.operators import classify, contributions, timing
from tripledger.operators.classify import Route
from tripledger.plans.rules import EXPANSION, ReconRules
from tripledger.schemas import KEYS, MONEY

BTN_FILE = "recon_btn_bank_file_mutation"
BCA_FILE = "recon_bca_bank_file_report"
BNI_FILE = "recon_bni_bank_file_report"
MANDIRI_FILE = "recon_mandiri_bank_file_report"
MANDIRI_REPORT = "recon_mandiri_bank_report"


def _in_period(posted: Column, rules: ReconRules) -> Column:
    """Lines of the period, and lines without a date, which no period can claim."""
    return timing.in_last_months(posted, rules.as_of, rules.report_months) | posted.isNull()


def _day_before(day: str = "receival_date") -> Column:
    return timing.bank_day_shift(F.col(day))


def file_btn(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("post_date").alias("trx_date"),
        timing.date_part(F.col("post_date")).alias("receival_date"),
        "description",
        F.upper("description").alias("upper"),
        F.col("amount_credit").cast(MONEY).alias("amount_received"),
    )


def file_bca(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("transaction_date").alias("trx_date"),
        F.col("transaction_date").cast("date").alias("receival_date"),
        "description",
        F.upper("description").alias("upper"),
        "branch",
        F.col("transaction_amount").cast(MONEY).alias("amount_received"),
    )


def file_mandiri(statement: DataFrame, report: DataFrame, rules: ReconRules) -> DataFrame:
    """Settlement lines with the segment of the merchant id that starts the remittance text.

    Lines are made distinct before the join and names are reduced to distinct (id, segment) pairs:
    the result equals the distinct of the joined rows, with far less to join. A merchant id with
    names in two segments yields a row for each.
    """
    lines = (
        statement.where(F.col("remarks").contains(rules.bank_words.mandiri_settlement))
        .select(
            F.col("postdate").alias("trx_datetime"),
            F.col("remarks").alias("remark"),
            F.col("credit_amount").cast(MONEY).alias("amount_received"),
        )
        .distinct()
        .withColumn("mid", F.left("remark", F.lit(11)))
    )
    names = report.select(
        F.col("mid").alias("report_mid"),
        classify.segment_like(F.upper("trading_name"), rules.mandiri_names, "ELSE").alias("remarks"),
    ).distinct()
    return lines.join(names, lines.mid == names.report_mid, "left").select(
        "trx_datetime",
        timing.date_part(F.col("trx_datetime")).alias("receival_date"),
        "mid",
        F.coalesce("remarks", F.lit("ELSE")).alias("remarks"),
        "remark",
        "amount_received",
    )


def file_bni(df: DataFrame, rules: ReconRules, bounded: bool = False) -> DataFrame:
    posted = df.select(
        timing.parse_post_date(F.col("post_date")).alias("trx_datetime"),
        "description",
        F.upper("description").alias("upper"),
        F.col("credit").cast(MONEY).alias("amount_received"),
    )
    if bounded:
        posted = posted.where(_in_period(F.col("trx_datetime"), rules))
    return posted.select(
        "trx_datetime",
        timing.date_part(F.col("trx_datetime")).alias("receival_date"),
        "description",
        "upper",
        classify.nested_words(F.col("upper"), rules.bni_groups).alias("remarks"),
        "amount_received",
    )


def bni_routes(rules: ReconRules) -> list[Route]:
    """Routes of the BNI statement: LinkAja batches (no day shift, case-sensitive) and ShopeePay."""
    words = rules.bank_words
    return [
        Route(
            "LinkAja",
            words.linkaja_bni,
            timing.hour_threshold_label(
                F.col("trx_datetime"), F.col("amount_received"), rules.linkaja_threshold
            ),
            F.col("receival_date"),
            ignore_case=False,
        ),
        Route("ShopeePay", words.shopeepay, F.lit("ShopeePay"), _day_before()),
    ]


def bca_routes(rules: ReconRules) -> list[Route]:
    words = rules.bank_words
    kredivo = classify.segment_like(F.col("upper"), rules.kredivo_codes, rules.kredivo_default)
    return [
        Route("LinkAja", words.linkaja_bca, F.lit(EXPANSION), _day_before(), ignore_case=False),
        Route("OVO", words.ovo, F.lit("OVO"), _day_before()),
        Route("INDODANA", words.indodana, F.lit("INDODANA"), _day_before()),
        Route("BCA", words.bca, F.lit("BCA"), _day_before()),
        Route("OTTOPAY", words.ottopay, F.lit("OTTOPAY"), _day_before()),
        Route("Kredivo", words.kredivo, kredivo, _day_before()),
    ]


def btn_routes(rules: ReconRules) -> list[Route]:
    return [Route("BTN", rules.bank_words.btn, F.lit("BTN"), _day_before())]


def own_segment(df: DataFrame, bank: str) -> DataFrame:
    """Lines that already carry their segment: shift the day, drop the unclassified."""
    return df.where(F.col("remarks") != "Other").select(
        _day_before().alias("receival_date"), F.lit(bank).alias("bank"), "remarks", "amount_received"
    )


def routed(lines: DataFrame, routes: list[Route], *extra: Column) -> DataFrame:
    """Lines (with their description in upper case as ``upper``) sent to the issuers they pay."""
    hits = [*extra, *(r.hit(F.col("description"), F.col("upper")) for r in routes)]
    return classify.explode_hits(lines, hits, "amount_received")


def bni_lines(df: DataFrame, rules: ReconRules, bounded: bool = False) -> DataFrame:
    """All uses of the BNI statement in one pass: its own segments plus the routed issuers."""
    own = F.when(
        F.col("remarks") != "Other", classify.target(_day_before(), "BNI", F.col("remarks"))
    )
    return routed(file_bni(df, rules, bounded), bni_routes(rules), own)


# Raw posting column of each statement. BNI's is text and is bounded once it is parsed.
POSTED = {BCA_FILE: "transaction_date", BTN_FILE: "post_date", MANDIRI_FILE: "postdate"}


def bank_rows(
    tables: Mapping[str, DataFrame], rules: ReconRules, bounded: bool = False
) -> DataFrame:
    """Row-level (KEYS, amount) of all statements at hand, as one UNION ALL.

    ``bounded`` adds the period filter: lines posted before the period pay for days before it, as a posting date is
    shifted back or kept, never moved ahead. The names of Mandiri merchants come from the whole report.
    """
    amount = "amount_received"

    def statement(name: str) -> DataFrame:
        df = tables[name]
        if bounded and name in POSTED:
            df = df.where(_in_period(F.col(POSTED[name]), rules))
        return df

    frames = []
    if BCA_FILE in tables:
        frames.append(routed(file_bca(statement(BCA_FILE)), bca_routes(rules)))
    if BNI_FILE in tables:
        frames.append(bni_lines(statement(BNI_FILE), rules, bounded))
    if BTN_FILE in tables:
        frames.append(routed(file_btn(statement(BTN_FILE)), btn_routes(rules)))
    if MANDIRI_FILE in tables:
        mandiri = file_mandiri(statement(MANDIRI_FILE), tables[MANDIRI_REPORT], rules)
        frames.append(
            mandiri.select(
                _day_before().alias("receival_date"), F.lit("Mandiri").alias("bank"), "remarks", amount
            )
        )
    return reduce(lambda a, b: a.unionByName(b), [f.select(*KEYS, amount) for f in frames])


def bank_contributions(
    tables: Mapping[str, DataFrame], rules: ReconRules, bounded: bool = False
) -> DataFrame:
    return contributions.received(bank_rows(tables, rules, bounded))
