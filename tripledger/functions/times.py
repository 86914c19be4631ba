"""Clock cells to ``HH:mm:ss`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.dates import (
    AFTERNOON,
    TWELVE_WITH_MARK,
    moment_otto,
    padded,
    seconds_clock,
)
from tripledger.functions.text import blank_if_null
from tripledger.operators.timing import NTZ


def _held(part: Column, most: int) -> Column:
    """Two digits of a part, held at the limit; a number too long to read is over it."""
    return F.lpad(F.least(F.coalesce(part.try_cast("int"), F.lit(most)), F.lit(most)).cast("string"), 2, "0")


def clock_btn(c: Column) -> Column:
    """Issuer BTN clock: dots or colons, digits only; out-of-range parts are held at the limit.

    One part is HHMMSS; two parts are hours and MMSS (``12:30`` is read as 12:00:30). The text is split once, and parts are cut by
    their places.
    """
    digits = F.regexp_replace(F.trim(c), "[^0-9.:]+", "")
    parts = F.split(F.btrim(F.regexp_replace(digits, "[.:]+", ":"), F.lit(":")), ":")
    count = F.size(parts)
    first, second, third = (F.get(parts, F.lit(i)) for i in range(3))
    six, four = F.lpad(F.substring(first, 1, 6), 6, "0"), F.lpad(F.substring(second, 1, 4), 4, "0")

    def cut(at_six: int, two_parts: Column, own: Column, most: int) -> Column:
        return _held(F.when(count == 1, F.substring(six, at_six, 2)).when(count == 2, two_parts).otherwise(own), most)

    clock = F.concat_ws(
        ":",
        cut(1, first, first, 23),
        cut(3, F.substring(four, 1, 2), second, 59),
        cut(5, F.substring(four, 3, 2), third, 59),
    )
    return F.when(c.isNull(), "").otherwise(clock)


def clock_mandiri(c: Column) -> Column:
    """Six digits are HHMMSS, four are HHMM; anything else stays."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return (
        F.when(F.length(digits) == 6, F.regexp_replace(digits, "(..)(..)(..)", "$1:$2:$3"))
        .when(F.length(digits) == 4, F.regexp_replace(digits, "(..)(..)", "$1:$2:00"))
        .otherwise(c)
    )


CLOCK = r"^(\d{2}):(\d{2})(?::(\d{2}))?$"


def clock_otto(c: Column) -> Column:
    """OttoPay clock: padded parts, missing seconds are zero; the clock of a date-time; else unchanged."""
    text = F.trim(c)
    clock = F.regexp_replace(F.regexp_replace(padded(text), CLOCK, "$1:$2:$3"), ":$", ":00")
    return blank_if_null(
        F.when(text.rlike(r"^\d{1,2}:\d{1,2}(:\d{1,2})?$"), clock)
        .when(text.contains(" "), F.split_part(moment_otto(text), F.lit(" "), F.lit(2)))
        .otherwise(text)
    )


def clock_bri(c: Column) -> Column:
    """BRI clock: fraction of a day, colons, dots, HHMMSS or HMMSS; else unchanged."""
    text = F.trim(c)
    return blank_if_null(
        F.when(text.rlike(r"^0?\.\d+$"), seconds_clock(F.round(text.try_cast("double") * 86400)))
        .when(text.rlike(r"^\d{1,2}([:.])\d{2}\1\d{2}$"), padded(F.replace(text, F.lit("."), F.lit(":"))))
        .when(text.rlike(r"^\d{5,6}$"), F.regexp_replace(F.lpad(text, 6, "0"), "(..)(..)(..)", "$1:$2:$3"))
        .otherwise(text)
    )


BANK_CLOCK = r"^(\d{2}:\d{2})(:\d{2})?\s*(?:AM|PM)?$"


def clock_bank_btn(c: Column) -> Column:
    """Statement clock in 24- or 12-hour form; what cannot be read stays."""
    ready = F.regexp_replace(padded(F.upper(F.trim(c))), TWELVE_WITH_MARK, "$1" + "00$2")
    moment = F.concat(F.lit("1970-01-01 "), F.regexp_replace(ready, BANK_CLOCK, "$1$2")).try_cast(NTZ)
    moment = F.when(ready.rlike(AFTERNOON), moment + F.expr("INTERVAL '12' HOUR")).otherwise(moment)
    return blank_if_null(F.coalesce(F.date_format(moment, "HH:mm:ss"), c))
