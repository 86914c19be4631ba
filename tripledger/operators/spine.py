"""Dense date spine: one row per day and (issuer, segment) pair."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.timing import period_start

# The (bank, remark) pairs of the report, in report order.
ISSUER_PAIRS = [
    ("ShopeePay", "ShopeePay"),
    ("OVO", "OVO"),
    ("OTTOPAY", "OTTOPAY"),
    ("Mandiri", "MCD"),
    ("Mandiri", "FM"),
    ("Mandiri", "ELSE"),
    ("LinkAja", "MSME PM (10.00-21.59)"),
    ("LinkAja", "MSME AM (22.00-09.59)"),
    ("LinkAja", "MCD PM (10.00-21.59)"),
    ("LinkAja", "MCD AM (22.00-09.59)"),
    ("LinkAja", "Expansion (D-1)"),
    ("Kredivo", "Willfitness / Other"),
    ("Kredivo", "MCD"),
    ("Kredivo", "HERO"),
    ("Kredivo", "FM"),
    ("INDODANA", "INDODANA"),
    ("HANA", "HANA"),
    ("BTN", "BTN"),
    ("BNI", "OTO - MSME"),
    ("BNI", "OTO - MCD"),
    ("BNI", "OTO - HERO"),
    ("BNI", "OTO - FM"),
    ("BCA", "BCA"),
]
# Remark lists that must always appear.
REMARKS_BNI = ["OTO - MSME", "OTO - MCD", "OTO - HERO", "OTO - FM"]
REMARKS_MANDIRI = ["FM", "MCD", "ELSE"]


def label(bank: Column, remark: Column) -> Column:
    """Spine label; NULL when either part is NULL, so such rows never reach the report."""
    return F.concat(bank, F.lit(" - "), remark)


def inline_pairs(pairs: Sequence[tuple[str, str]]) -> Column:
    """A short literal list as one array column, to be exploded next to the rows it multiplies."""
    return F.array(
        *[F.struct(F.lit(b).alias("bank"), F.lit(r).alias("remark")) for b, r in pairs]
    )


def with_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]] = tuple(ISSUER_PAIRS)) -> DataFrame:
    """Each input row once per pair. A generator over a literal: no join and no shuffle."""
    return (
        df.withColumn("pair", F.explode(inline_pairs(pairs)))
        .select(*df.columns, "pair.*")
        .withColumn("issuer_name", label(F.col("bank"), F.col("remark")))
    )


def daily(first: Column, last: Column) -> Column:
    """Every day from first to last, both included."""
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))


def date_spine(
    spark: SparkSession,
    as_of: date,
    months: int,
    pairs: Sequence[tuple[str, str]] = tuple(ISSUER_PAIRS),
) -> DataFrame:
    days = spark.range(1).select(daily(period_start(as_of, months), F.lit(as_of)).alias("receival_date"))
    return with_pairs(days, pairs)


def cross_stub(days: DataFrame, bank: str, remarks: Sequence[str]) -> DataFrame:
    """(day, bank, remark) keys of a segment list; the metrics of such a stub are all NULL."""
    return days.select(
        "receival_date",
        F.lit(bank).alias("bank"),
        F.explode(F.array(*[F.lit(r) for r in remarks])).alias("remarks"),
    )
