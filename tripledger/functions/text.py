"""Text cells: padding, quoting, sanitising, header names."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_DIGITS = r"^\d+$"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a costly expression once and use it many times.

    Repeating it in every CASE branch would run its regular expressions again in each and could
    outgrow the size limit of a compiled stage.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def pad_left(c: Column, width: int) -> Column:
    """Zero-pad short text; longer text and blank text stay (``lpad`` alone would cut them)."""
    return F.when(F.length(c).between(1, width - 1), F.lpad(c, width, "0")).otherwise(c)


def pad_id(c: Column, width: int) -> Column:
    """Reference numbers as text: trimmed, zero-padded, NULL as blank."""
    return pad_left(blank_if_null(F.trim(c)), width)


def count_char(c: Column, char: str) -> Column:
    """Occurrences of one character; 0 for NULL."""
    return F.coalesce(F.length(c) - F.length(F.replace(c, F.lit(char))), F.lit(0))


def whole_number_text(c: Column) -> Column:
    """Digits without leading zeros, exact up to 38 digits."""
    return c.try_cast("decimal(38,0)").cast("string")


def merchant_number(c: Column) -> Column:
    """All-digit ids as plain numbers, anything else as trimmed text."""
    text = F.trim(c)
    return F.when(text.rlike(ALL_DIGITS), F.coalesce(whole_number_text(text), text)).otherwise(text)


def plain_text(c: Column) -> Column:
    """Ids that a spreadsheet may show in scientific notation: digits in full, else trimmed text."""
    text = F.trim(c)
    number = F.when(
        text.rlike(r"^\d+(\.\d+)?[eE]\+?\d+$"), text.try_cast("decimal(38,0)").cast("string")
    )
    return blank_if_null(F.coalesce(number, text))


def mark_as_text(c: Column) -> Column:
    """Leading apostrophe on non-empty ids, so that a spreadsheet keeps them as text."""
    return F.when(c != "", F.concat(F.lit("'"), c)).otherwise(c)


def unmark_text(c: Column) -> Column:
    return F.regexp_replace(c, "^'", "")


def drop_double_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def strip_quotes(c: Column) -> Column:
    """No double quotes anywhere, no apostrophes at the ends, trimmed."""
    return F.trim(F.btrim(drop_double_quotes(c), F.lit("'")))


def first_line_name(c: Column) -> Column:
    """Names that carry a separator or line breaks: first ``;`` part on one line."""
    return F.trim(F.regexp_replace(F.split_part(c, F.lit(";"), F.lit(1)), r"[\r\n]+", " "))


def header_names(
    names: Sequence[str], case: str | None = None, drop: str = "", joiner: str | None = "_"
) -> list[str]:
    """Header cells as column names: unwanted characters out, trimmed, inner spaces joined."""
    cleaned = [re.sub(f"[{re.escape(drop)}]", "", n or "") if drop else (n or "") for n in names]
    cleaned = [n.strip() for n in cleaned]
    if joiner is not None:
        cleaned = [re.sub(r"\s+", joiner, n) for n in cleaned]
    return [n.upper() if case == "upper" else n.lower() if case == "lower" else n for n in cleaned]
