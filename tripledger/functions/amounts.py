"""Amount cells: grouped digits, fee rates, casts that never fail the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.text import blank_if_null
from tripledger.schemas import NUMERIC

# Fixed value: what counts as a grouped number.
GROUPED = r"^\d{1,3}([.,]\d{3})+([.,]\d+)?$"
# A mark and the three digits of its group.
GROUP = r"[.,](\d{3})(?!\d)"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
LEADING_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+))"
LEADING_INTEGER = r"^\s*([+-]?\d+)"


def _zero() -> Column:
    return F.lit(0).cast(NUMERIC)


def number_text(c: Column) -> Column:
    """Canonical text of a number: no leading or trailing zeros; NULL if it is not one."""
    whole = c.try_cast("decimal(38,0)").cast("string")
    fraction = F.regexp_replace(c.try_cast("decimal(38,10)").cast("string"), r"0+$", "")
    fraction = F.regexp_replace(fraction, r"\.$", "")
    return F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), whole).when(c.rlike(NUMBER), fraction)


def leading_number(c: Column) -> Column:
    """Longest numeric prefix of the text, NULL if there is none."""
    return F.nullif(F.regexp_extract(c, LEADING_NUMBER, 1), F.lit(""))


def dash_as_zero(c: Column) -> Column:
    """Fee cell: dash or blank is zero."""
    text = blank_if_null(F.trim(c))
    return F.when(text.isin("-", ""), "0").otherwise(text)


def reference_number(c: Column) -> Column:
    """Numeric references: grouping commas out; blank stays, text that is no number becomes blank."""
    return F.when(c == "", c).when(
        c.isNotNull(), blank_if_null(number_text(F.replace(c, F.lit(","))))
    )


def strip_grouping(c: Column) -> Column:
    """Remove group marks only where the whole value is a grouped number."""
    return F.when(c.rlike(GROUPED), F.regexp_replace(c, GROUP, "$1")).otherwise(c)


def amount_or_zero(c: Column) -> Column:
    """Plain number or zero; a value with grouping commas is not a plain number."""
    return F.coalesce(F.when(c.rlike(NUMBER), c.try_cast(NUMERIC)), _zero())


def grouped_amount(c: Column) -> Column:
    """Number with or without group marks; zero if it is none."""
    return amount_or_zero(strip_grouping(F.trim(c)))


def amount_from_digits(c: Column) -> Column:
    """Amount from the digits, dots and minus signs of the text; zero if they form no number."""
    return F.coalesce(F.regexp_replace(c, "[^0-9.-]", "").try_cast(NUMERIC), _zero())


def number_if_numeric(c: Column) -> Column:
    return F.coalesce(number_text(c), c)


def fee_rate(c: Column) -> Column:
    """Fee as a fraction with at most ten decimals: ``0.7%``, ``0,7`` and ``0.007`` are accepted."""
    text = F.trim(c)
    number = leading_number(F.replace(F.replace(text, F.lit("%")), F.lit(","), F.lit("."))).try_cast(
        "decimal(28,12)"
    )
    rate = F.when(text.contains("%"), number / 100).otherwise(number)
    return F.coalesce(number_text(F.round(rate, 10).cast("decimal(38,10)").cast("string")), text)


def integer_without_marks(c: Column) -> Column:
    """Integer after removing dots, commas and spaces, zero if none: ``1000.50`` becomes 100050."""
    digits = F.regexp_extract(F.regexp_replace(c, r"[.,\s]", ""), LEADING_INTEGER, 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def account_number(c: Column) -> Column:
    """Account number without grouping commas; NULL if it does not start with a number."""
    return number_text(leading_number(F.replace(c, F.lit(","))))


def amount_and_type(c: Column) -> tuple[Column, Column]:
    """``1,000.50 CR`` as amount text and type; the type is blank if missing."""
    parts = F.split(F.trim(c), " ")
    return F.get(parts, F.lit(0)), blank_if_null(F.get(parts, F.lit(1)))
