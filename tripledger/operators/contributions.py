"""Contribution rows: measures per (date, bank, remarks), their union, and the report on the spine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.operators.spine import label
from tripledger.schemas import KEYS, METRIC_TYPE, METRICS

SIDES = {"yti": METRICS[0:3], "issuer": METRICS[3:6]}


def measure(rows: DataFrame, side: str, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Traffic, gross and net of row-level (KEYS, trx, gross, net) frames, in one aggregation.

    Extra keys split the groups but are not shown (rounding and distinct counts happen per slice).
    The distinct count first aggregates by key and id, so one hot key spreads over its ids.
    """
    traffic, gross, net = SIDES[side]
    return (
        rows.groupBy(*KEYS, *extra_keys)
        .agg(
            F.countDistinct("trx").alias(traffic),
            F.sum("gross").alias(gross),
            F.sum("net").alias(net),
        )
        .drop(*extra_keys)
    )


def received(rows: DataFrame) -> DataFrame:
    """Money received per (date, bank, remarks)."""
    return rows.groupBy(*KEYS).agg(F.sum("amount_received").alias("amount_received"))


def as_contribution(df: DataFrame) -> DataFrame:
    """The ten-column flat row; measures the frame does not carry are typed NULLs."""
    return df.selectExpr(
        *KEYS,
        *[f"cast({m if m in df.columns else 'null'} as {METRIC_TYPE}) as {m}" for m in METRICS],
    )


def union_contributions(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), [as_contribution(f) for f in frames])


def whole(amount: Column) -> Column:
    """Half away from zero, to whole units."""
    return F.round(amount, 0)


def sum_of_rounded(contributions: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sum of rounded partials (not the rounded sum); a group without any value stays NULL."""
    return contributions.groupBy(*keys).agg(*[F.sum(whole(F.col(m))).alias(m) for m in METRICS])


def on_spine(spine: DataFrame, contributions: DataFrame) -> DataFrame:
    """Left join of the spine with the contributions on (date, label), summed per spine row.

    Written as one aggregation over spine rows and contributions together, keeping the groups that
    hold a spine row. A join would first sum and shuffle both sides, and its not-null conditions on
    the label would be pushed into every scan, where they repeat the whole classification per row.
    """
    here = F.lit(True)
    dense = spine.select(
        "receival_date",
        "issuer_name",
        "bank",
        F.col("remark").alias("remarks"),
        *[F.lit(None).cast(METRIC_TYPE).alias(m) for m in METRICS],
        here.alias("in_spine"),
    )
    given = contributions.select(
        "receival_date",
        label(F.col("bank"), F.col("remarks")).alias("issuer_name"),
        "bank",
        "remarks",
        *METRICS,
        F.lit(None).cast("boolean").alias("in_spine"),
    )
    spine_only = [
        F.max(F.when(F.col("in_spine"), F.struct("bank", "remarks"))).alias("pair")
    ]
    totals = dense.unionByName(given).groupBy("receival_date", "issuer_name").agg(
        *spine_only, *[F.sum(whole(F.col(m))).alias(m) for m in METRICS]
    )
    return totals.where(F.col("pair").isNotNull()).select(
        "receival_date", "issuer_name", "pair.bank", "pair.remarks", *METRICS
    )


def unmatched(spine: DataFrame, contributions: DataFrame) -> DataFrame:
    """Contributions that no spine row takes up: what the exact join would lose without a trace."""
    keyed = contributions.withColumn("issuer_name", label(F.col("bank"), F.col("remarks")))
    keys = spine.select("receival_date", "issuer_name")
    lost = keyed.join(keys, ["receival_date", "issuer_name"], "left_anti")
    return sum_of_rounded(lost, KEYS)


# Gap name, minuend, subtrahend (A-B, C-D, G-F, G-E).
GAPS = [
    ("gap_traffic", "yti_traffic", "issuer_traffic"),
    ("gap_trx_amount", "yti_trx_amount", "issuer_trx_amount"),
    ("gap_received_vs_issuer", "amount_received", "issuer_settlement_amount"),
    ("gap_received_vs_yti", "amount_received", "yti_settlement_amount"),
]


def with_gaps(report: DataFrame, zero_filled: bool = False) -> DataFrame:
    """Gap columns; NULL if a side is missing unless zero-filled. ``status`` names what is missing."""

    def side(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) if zero_filled else F.col(name)

    sides = ["yti_traffic", "issuer_traffic", "amount_received"]
    complete = reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in sides])
    empty = reduce(lambda a, b: a & b, [F.col(s).isNull() for s in sides])
    balanced = reduce(
        lambda a, b: a & b, [F.coalesce(F.col(a) == F.col(b), F.lit(False)) for _, a, b in GAPS]
    )
    return report.select(
        "*",
        *[(side(a) - side(b)).alias(name) for name, a, b in GAPS],
        F.when(empty, "no data")
        .when(~complete, "incomplete")
        .when(balanced, "balanced")
        .otherwise("gap")
        .alias("status"),
    )
