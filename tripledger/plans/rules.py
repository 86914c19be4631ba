"""Business rules as data. Every plan takes one ``ReconRules``; nothing is edited inside a query."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date

from tripledger.operators.classify import RateRule, SegmentRule

# Batch labels of the report.
MCD_AM, MCD_PM = "MCD AM (22.00-09.59)", "MCD PM (10.00-21.59)"
MSME_AM, MSME_PM = "MSME AM (22.00-09.59)", "MSME PM (10.00-21.59)"
EXPANSION = "Expansion (D-1)"


@dataclass(frozen=True)
class ProductionRule:
    """How one production issuer (or one of its categories) becomes contributions.

    ``remarks`` is ``fixed`` (the bank name), ``category``, ``prefixed`` (``OTO - `` + category),
    ``batch`` (AM/PM label pair in ``labels``) or ``label`` (the single label in ``labels``).
    ``netting`` sums purchases minus reversals per fee rate instead of plain amounts.
    """

    issuer: str
    bank: str
    remarks: str = "fixed"
    category: str | None = None
    labels: tuple[str, ...] = ()
    netting: bool = False
    excluded_accounts: tuple = ()


@dataclass(frozen=True)
class BankWords:
    """Keywords that route bank lines to issuers."""

    mandiri_settlement: str = "QRIS SETTLEMENT"
    linkaja_bni: str = "LINKAJA"
    linkaja_bca: str = "LINKAJA"
    shopeepay: str = "SHOPEE"
    ovo: str = "OVO"
    indodana: str = "INDODANA"
    bca: str = "BCA SETTLEMENT"
    ottopay: str = "OTTOPAY"
    btn: str = "BTN SETTLEMENT"
    kredivo: str = "KREDIVO"


@dataclass(frozen=True)
class ReconRules:
    as_of: date
    report_months: int = 9
    onus_months: int = 6
    migration: str = "2024-01-01 00:00:00"
    excluded_issuers: tuple[str, ...] = ()
    excluded_accounts: tuple = ()
    cutoffs: dict[str, str] = field(default_factory=lambda: {"OTTOPAY": "23:30:00", "LINKAJA": "22:00:00"})
    time_split_issuers: tuple[str, ...] = ("LINKAJA",)
    # Begin and end of the AM batch, which runs over midnight.
    batch_hours: tuple[str, str] = ("22:00:00", "10:00:00")
    segments: tuple[SegmentRule, ...] = ()
    rates: tuple[RateRule, ...] = ()
    default_rate: str = "0.0070"
    production: tuple[ProductionRule, ...] = (
        ProductionRule("OTTOPAY", "OTTOPAY", "category", netting=True),
        ProductionRule("SHOPEEPAY", "ShopeePay"),
        ProductionRule("OVO", "OVO"),
        ProductionRule("INDODANA", "INDODANA", "category", netting=True),
        ProductionRule("KREDIVO", "Kredivo", "category"),
        ProductionRule("MANDIRI", "Mandiri", "category"),
        ProductionRule("BNI", "BNI", "prefixed"),
        ProductionRule("BCA", "BCA"),
        ProductionRule("BTN", "BTN"),
        ProductionRule("LINKAJA", "LinkAja", "batch", "MCD", (MCD_AM, MCD_PM)),
        ProductionRule("LINKAJA", "LinkAja", "label", "EXPANSION", (EXPANSION,)),
        ProductionRule("LINKAJA", "LinkAja", "batch", "MSME", (MSME_AM, MSME_PM)),
    )
    kredivo_stores: dict[str, str] = field(default_factory=dict)
    kredivo_default: str = "Willfitness / Other"
    mandiri_names: tuple[tuple[str, str], ...] = ()
    bni_names: tuple[tuple[str, str], ...] = ()
    btn_rate: str = "0.0070"
    linkaja_company: str | None = None
    linkaja_expansion_mid: str | None = None
    linkaja_msme_mids: tuple[str, ...] = ()
    bank_words: BankWords = BankWords()
    bni_groups: tuple[tuple[str, str, tuple[tuple[str, str], ...]], ...] = ()
    kredivo_codes: tuple[tuple[str, str], ...] = ()
    linkaja_threshold: int = 10_000_000

    def __post_init__(self):
        cases = [(r.issuer, r.category) for r in self.production]
        twice = sorted({f"{i} / {c or 'any category'}" for i, c in cases if cases.count((i, c)) > 1})
        if twice:
            raise ValueError(f"more than one production rule for {', '.join(twice)}")

    def but(self, **changes) -> ReconRules:
        return replace(self, **changes)
