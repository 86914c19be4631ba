"""Production view (A, C, E): enrich the settlement report once, aggregate once.

The enriched frame feeds all issuers through one CASE classification and one aggregation, rather
than one filter and aggregation per issuer, so the largest table is scanned and joined a single time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.operators import classify, contributions, timing
from tripledger.plans.rules import ProductionRule, ReconRules
from tripledger.schemas import MONEY


# The transaction id as text, by which the settlement report meets the transactions.
TEXT_ID = "trx"


def text_id(settlement: DataFrame) -> DataFrame:
    """The settlement with its text id; one that was stored with it (``sources.bucketed``) keeps that column."""
    return settlement if TEXT_ID in settlement.columns else settlement.withColumn(TEXT_ID, F.col("credit_trans_trx_id").cast("string"))


def join_reversal(settlement: DataFrame, reversals: DataFrame, unique: bool = True) -> DataFrame:
    """Left join to the reversal reference. The reference is made unique on its key, so that a
    transaction listed twice does not count twice; ``unique=False`` keeps the fan-out."""
    keys = reversals.select(F.col("trx_id").alias("reversal_trx_id"))
    keys = keys.distinct() if unique else keys
    return settlement.join(keys, settlement.credit_trans_trx_id == keys.reversal_trx_id, "left")


def join_merchant(settlement: DataFrame, merchants: DataFrame) -> DataFrame:
    """Left join to the merchant master. No broadcast hint: the master's size is not known here, and
    the optimizer broadcasts it whenever its measured size is below the limit."""
    master = merchants.select(
        F.col("account_id").alias("master_account_id"), "vendor_type", "referral_code_acquisition"
    )
    return settlement.join(master, settlement.account_id == master.master_account_id, "left")


def join_transactions(
    settlement: DataFrame, transactions: DataFrame, rules: ReconRules
) -> DataFrame:
    """Left join to the transactions of the on/off-us lookback; the id is compared as text.

    The text id stays in the frame as ``trx``: rows are then already partitioned by it, and the
    distinct count of ids needs no shuffle of its own.
    """
    recent = transactions.where(
        timing.in_last_months(F.col("trx_date"), rules.as_of, rules.onus_months)
    ).select(F.col("trx_id").alias("st_trx_id"), "onus_offus")
    keyed = text_id(settlement)
    return keyed.join(recent, keyed[TEXT_ID] == recent.st_trx_id, "left")


def txn_ref(ts: Column, internal: Column, issuer: Column, migration: str) -> Column:
    return F.when(ts < F.lit(migration).cast(timing.NTZ), internal).otherwise(issuer)


def enrich_settlement(
    settlement: DataFrame,
    reversals: DataFrame,
    merchants: DataFrame,
    transactions: DataFrame,
    rules: ReconRules,
) -> DataFrame:
    """Row-level production frame: adjusted date, segment, batch, reference, rate and amount."""
    ts, issuer = F.col("txn_date"), F.col("issuer")
    in_scope = settlement.where(classify.not_in(issuer, rules.excluded_issuers)).where(
        timing.in_last_months(ts, rules.as_of, rules.report_months)
    )
    joined = join_transactions(
        join_merchant(join_reversal(in_scope, reversals), merchants), transactions, rules
    ).where(classify.not_in(F.col("master_account_id"), rules.excluded_accounts))
    split = F.when(
        issuer.isin(list(rules.time_split_issuers)),
        timing.batch_label(ts, "AM Batch (22:00-09:59)", "PM Batch (10:00-21:59)", rules.batch_hours),
    )
    return joined.select(
        timing.date_part(ts).alias("txn_date"),
        timing.time_part(ts).alias("txn_time"),
        timing.cutoff_shift_by(issuer, ts, rules.cutoffs).alias("adjusted_date"),
        issuer,
        F.col("master_account_id").alias("account_id"),
        "merchant_id",
        "merch_name",
        "referral_code_acquisition",
        "txn_type",
        classify.merchant_segment(issuer, rules.segments).alias("merchant_category"),
        split.alias("remarks_time_split"),
        txn_ref(ts, F.col("internal_ref_field"), F.col("issuer_ref_field"), rules.migration).alias("txn_ref"),
        "issuer_txn_ref",
        "credit_trans_trx_id",
        "trx",
        "terminal_id",
        "onus_offus",
        classify.mdr_rate(issuer, F.col("onus_offus"), rules.rates, rules.default_rate).alias("mdr"),
        F.col("amt").cast(MONEY).alias("gmv"),
    )


def net_of(gross: Column, rate: Column) -> Column:
    return gross - gross * rate


def purchase_minus_reversal(txn_type: Column, amount: Column) -> Column:
    """Purchases count up, reversals count down, any other type counts zero."""
    return (
        F.when(txn_type == "Customer Purchase", amount)
        .when(txn_type == "E-money Reversal", -amount)
        .otherwise(F.lit(0).cast(MONEY))
    )


def rule_number(rules: Sequence[ProductionRule]) -> Column:
    """Which rule a row falls under (from 1), NULL for none: by issuer and category, or issuer alone."""
    issuer, category = F.col("issuer"), F.col("merchant_category")
    by_category = {f"{r.issuer}|{r.category}": i for i, r in enumerate(rules, 1) if r.category}
    by_issuer = {r.issuer: i for i, r in enumerate(rules, 1) if not r.category}
    number = F.coalesce(
        classify.lookup(by_category, classify.pair_key(issuer, category)),
        classify.lookup(by_issuer, issuer),
    ).cast("int")
    barred = classify.any_of(
        (number == i) & ~classify.not_in(F.col("account_id"), r.excluded_accounts)
        for i, r in enumerate(rules, 1)
        if r.excluded_accounts
    )
    listed = [r for r in rules if r.excluded_accounts]
    return F.when(F.coalesce(~barred, F.lit(False)), number) if listed else number


def _remarks(rules: Sequence[ProductionRule]) -> Column:
    """Remark by the kind of the applied rule; fixed labels are looked up by rule number."""
    rule, category, split = F.col("rule"), F.col("merchant_category"), F.col("remarks_time_split")

    def kind(name: str) -> Column:
        return rule.isin([i for i, r in enumerate(rules, 1) if r.remarks == name])

    def pick(place: int) -> Column:
        return F.element_at(F.array(*[F.lit(r.labels[place] if r.labels else r.bank) for r in rules]), rule)

    return (
        F.when(kind("category"), category)
        .when(kind("prefixed"), F.concat(F.lit("OTO - "), category))
        .when(kind("batch"), F.when(split.startswith("AM"), pick(0)).when(split.startswith("PM"), pick(-1)))
        .otherwise(pick(0))
    )


def classify_production(enriched: DataFrame, rules: ReconRules) -> DataFrame:
    """Row-level contribution rows (KEYS, trx, gross, net, slice), all issuers in one pass.

    ``slice`` is a hidden group key: the rule, and the rate where amounts are netted per rate, so that
    each of these groups is counted and rounded by itself. The categories of one rule are one group
    unless its remarks name them.
    """
    listed = rules.production
    netted = F.col("rule").isin([i for i, r in enumerate(listed, 1) if r.netting])
    gmv = F.col("gmv")
    return (
        enriched.withColumn("rule", rule_number(listed))
        .where(F.col("rule").isNotNull())
        .select(
            F.col("adjusted_date").alias("receival_date"),
            F.element_at(F.array(*[F.lit(r.bank) for r in listed]), F.col("rule")).alias("bank"),
            _remarks(listed).alias("remarks"),
            "trx",
            F.when(netted, purchase_minus_reversal(F.col("txn_type"), gmv)).otherwise(gmv).alias("gross"),
            "mdr",
            F.struct("rule", F.when(netted, F.col("mdr")).alias("rate")).alias("slice"),
        )
        .withColumn("net", net_of(F.col("gross"), F.col("mdr")).cast("decimal(24,6)"))
        .drop("mdr")
    )


def production_contributions(enriched: DataFrame, rules: ReconRules) -> DataFrame:
    return contributions.measure(classify_production(enriched, rules), "yti", ["slice"])
