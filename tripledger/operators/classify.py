"""Classification from rule data: segments, rates, labels and bank description routes.

Rules are short tuples of plain values. They compile to one CASE expression each, so a row is
classified in the scan stage without a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.schemas import RATE


def first_match(cases: Iterable[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """CASE over (condition, value) pairs; the first true condition wins."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        return default if isinstance(default, Column) else F.lit(default)
    return chain.otherwise(default)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def like_any(upper: Column, words: Sequence[str]) -> Column:
    """Contains any of the words. The text comes in upper case, so that it is folded only once."""
    return any_of(upper.contains(w.upper()) for w in words)


def segment_exact(text: Column, names: Mapping[str, str], default: str) -> Column:
    """Segment by whole name, case ignored on both sides (a rule value in capitals still matches)."""
    return first_match(((F.lower(text) == n.lower(), seg) for n, seg in names.items()), default)


def segment_like(upper: Column, words: Sequence[tuple[str, str]], default: str) -> Column:
    """Segment by contained word of an upper-case text, in rule order."""
    return first_match(((like_any(upper, [w]), seg) for w, seg in words), default)


@dataclass(frozen=True)
class SegmentRule:
    """Segments of one issuer: which merchant attribute decides, its values, and the default."""

    issuer: str
    attribute: str
    segments: tuple[tuple[str, str], ...]
    default: str = "Other"


def lookup(table: Mapping[str, str | int], key: Column) -> Column:
    """Value of a key in a small literal table, NULL if absent.

    A table scales to more rules than a CASE with a branch each, whose compiled stage would soon be
    too large for the virtual machine to optimise.
    """
    if not table:
        return F.lit(None)
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def pair_key(first: Column, second: Column) -> Column:
    return F.concat(first, F.lit("|"), second)


def merchant_segment(issuer: Column, rules: Sequence[SegmentRule], unknown: str = "Unknown") -> Column:
    """Segment by issuer, then by that issuer's merchant attribute."""
    attributes = sorted({r.attribute for r in rules})
    deciding = first_match(
        (
            (issuer.isin([r.issuer for r in rules if r.attribute == a]), F.col(a))
            for a in attributes
        ),
        F.lit(None).cast("string"),
    )
    segments = {f"{r.issuer}|{value}": segment for r in rules for value, segment in r.segments}
    return F.coalesce(
        lookup(segments, pair_key(issuer, deciding)),
        lookup({r.issuer: r.default for r in rules}, issuer),
        F.lit(unknown),
    )


@dataclass(frozen=True)
class RateRule:
    """Fee rate of one issuer; a flat rate has the same value on both sides."""

    issuer: str
    off_us: str
    on_us: str


def mdr_rate(issuer: Column, onus_offus: Column, rules: Sequence[RateRule], default: str) -> Column:
    """Fee rate by issuer and on/off-us flag. An unknown flag takes the on-us rate."""

    def rate(value: str) -> Column:
        return F.lit(value).cast(RATE)

    return first_match(
        (
            (
                issuer == r.issuer,
                rate(r.on_us)
                if r.on_us == r.off_us
                else F.when(onus_offus == "OFF US", rate(r.off_us)).otherwise(rate(r.on_us)),
            )
            for r in rules
        ),
        rate(default),
    )


def nested_words(
    upper: Column, groups: Sequence[tuple[str, str, Sequence[tuple[str, str]]]], other: str = "Other"
) -> Column:
    """Two-level description class: (word, prefix, inner words); inner default is ``<prefix> - Other``."""
    return first_match(
        (
            (
                like_any(upper, [word]),
                F.concat(F.lit(f"{prefix} - "), segment_like(upper, inner, "Other")),
            )
            for word, prefix, inner in groups
        ),
        other,
    )


@dataclass(frozen=True)
class Route:
    """Bank lines that pay one issuer: keyword in the description, target bank label, remark."""

    bank: str
    word: str
    remark: Column
    day: Column
    ignore_case: bool = True

    def hit(self, description: Column, upper: Column) -> Column:
        """(receival_date, bank, remarks) when the line pays this issuer, else NULL."""
        found = upper.contains(self.word.upper()) if self.ignore_case else description.contains(self.word)
        return F.when(found, target(self.day, self.bank, self.remark))


def target(day: Column, bank: str, remark: Column) -> Column:
    return F.struct(
        day.alias("receival_date"), F.lit(bank).alias("bank"), remark.alias("remarks")
    )


def explode_hits(df: DataFrame, hits: Sequence[Column], *keep: str) -> DataFrame:
    """One output row per (bank line, non-NULL hit), in one pass over the bank file.

    A line that names two issuers counts for both, as separate filters per issuer would. The array
    is exploded as it is and its NULLs dropped after, which keeps the stage compiled.
    """
    exploded = df.select(F.explode(F.array(*hits)).alias("hit"), *keep)
    return exploded.where(F.col("hit").isNotNull()).select("hit.*", *keep)


def not_in(value: Column, excluded: Sequence) -> Column:
    """NOT IN with SQL's NULL rule; an empty list keeps every row."""
    return ~value.isin(list(excluded)) if excluded else F.lit(True)


def not_like_or_null(text: Column, word: str) -> Column:
    return ~F.upper(text).contains(word) | text.isNull()


def signed(flag: Column, amount: Column) -> Column:
    """Amount with its sign: positive when the flag holds, negative otherwise (also when unknown)."""
    return F.when(flag, amount).otherwise(-amount)
