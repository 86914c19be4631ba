"""Date and date-time cells in the many shapes the sources use.

A shape is a pattern over text whose lone digits were padded to two (``5/3/2024`` is read as
``05/03/2024``) and the replacement that puts it in ISO order. Calendar dates that do not exist
(31 February) become NULL where the source builds a date, and pass through where it only moves text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.text import bind, blank_if_null
from tripledger.operators.timing import NTZ, century

DAY, MINUTE = "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
SERIAL = r"^\d+(\.\d+)?$"
# Free-form text, upper case and padded: a date, then optionally a clock and a half-day mark.
FREE = r"^(.*?)(?:[ T,]+(\d{2}:\d{2}(?::\d{2})?)(?:[.]\d+)?\s*(AM|PM)?)?$"
WEEKDAY = r"^(MON|TUE|WED|THU|FRI|SAT|SUN)[A-Z]*,? +"
ZONE = r" (GMT|UTC).*$"
MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
# Date forms; month first where both readings are possible.
FREE_DAYS = [
    (r"^(\d{4})[/-](\d{2})[/-](\d{2})$", "$1-$2-$3"),
    (r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$1-$2"),
]
MONTH_NAME_FIRST = r"^([A-Z]{3})[A-Z]* (\d{2}),? (\d{4})$"
MONTH_NAME_SECOND = r"^(\d{2})[ -]([A-Z]{3})[A-Z]*[ -](\d{4})$"


def padded(c: Column) -> Column:
    """Single digits that stand alone, padded to two."""
    return F.regexp_replace(c, r"(?<!\d)(\d)(?!\d)", "0$1")


ISO_MOMENT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def reshape(
    text: Column,
    shapes: Sequence[tuple[str, str]],
    otherwise: Column,
    strict: bool = False,
    result: str = ISO_DAY,
) -> Column:
    """The padded (if strict: the given) text rewritten by the shape that fits, else the given value.

    Shapes exclude each other and leave other text alone, so they run as one chain of replacements
    and the outcome is tested once; a CASE would repeat the padding and matching in every branch.
    """
    moved = text if strict else padded(text)
    for pattern, target in shapes:
        moved = F.regexp_replace(moved, pattern, target)
    return F.coalesce(F.nullif(F.regexp_extract(moved, result, 0), F.lit("")), otherwise)


def iso_moment(text: Column) -> Column:
    return text.try_cast(NTZ)


def month_number(name: Column) -> Column:
    """Two-digit month of a three-letter name; out of range for an unknown name."""
    return F.lpad(F.floor((F.position(name, F.lit(MONTHS)) + 2) / 3).cast("string"), 2, "0")


def with_clock(day: Column, clock: Column, half: Column) -> Column:
    """Timestamp of an ISO day, a clock (blank is midnight) and a half-day mark (blank for none)."""
    moment = iso_moment(F.concat_ws(" ", day, F.nullif(clock, F.lit(""))))
    hour = F.substring(clock, 1, 2).try_cast("int")
    ahead = F.when((half == "PM") & (hour < 12), F.expr("INTERVAL '12' HOUR")).when(
        (half == "AM") & (hour == 12), F.expr("INTERVAL '-12' HOUR")
    )
    return F.when(half == "", moment).otherwise(
        moment + F.coalesce(ahead, F.expr("INTERVAL '0' HOUR"))
    )


def _free_parts(text: Column) -> Column:
    return F.struct(
        F.regexp_extract(text, FREE, 1).alias("day"),
        F.regexp_extract(text, FREE, 2).alias("clock"),
        F.regexp_extract(text, FREE, 3).alias("half"),
    )


def _free_day(day: Column) -> Column:
    def named(pattern: str, month: int, number: int) -> Column:
        parts = [F.regexp_extract(day, pattern, i) for i in (3, month, number)]
        return F.concat_ws("-", parts[0], month_number(parts[1]), parts[2])

    return (
        F.when(day.rlike(MONTH_NAME_FIRST), named(MONTH_NAME_FIRST, 1, 2))
        .when(day.rlike(MONTH_NAME_SECOND), named(MONTH_NAME_SECOND, 2, 1))
        .otherwise(reshape(day, FREE_DAYS, otherwise=F.lit(None), strict=True))
    )


def free_moment(c: Column) -> Column:
    """Timestamp without zone of a free-form text, NULL if no form fits."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), WEEKDAY, ""), ZONE, "")

    def read(parts: Column) -> Column:
        return bind(
            _free_day(parts["day"]),
            lambda day: F.when(day.isNotNull(), with_clock(day, parts["clock"], parts["half"])),
        )

    return bind(padded(bare), lambda text: bind(_free_parts(text), read))


def as_day(moment: Column) -> Column:
    return F.date_format(moment, DAY)


def as_moment(moment: Column, pattern: str = MINUTE) -> Column:
    return F.date_format(moment, pattern)


def year_from(text: Column, first_of_1900s: int) -> Column:
    """Year number of a two- or four-digit year; the pivot differs between sources."""
    n = text.try_cast("int")
    return F.when(n < 100, century(n, first_of_1900s)).otherwise(n)


def serial_day(serial: Column) -> Column:
    """Date of a spreadsheet day number."""
    return F.date_add(F.lit("1899-12-30").cast("date"), serial.try_cast("double").cast("int"))


def seconds_clock(seconds: Column) -> Column:
    """Seconds of a day as ``HH:mm:ss``, held inside the day."""
    s = F.least(F.greatest(seconds, F.lit(0)), F.lit(86399)).cast("int")
    hours, minutes = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int")
    return F.format_string("%02d:%02d:%02d", hours, minutes, s % 60)


def serial_moment_text(c: Column) -> Column:
    """Date-time text of a spreadsheet serial; the fraction rounds to whole seconds."""
    serial = c.try_cast("double")
    fraction = F.round((serial - F.floor(serial)) * 86400)
    return F.concat(serial_day(serial).cast("string"), F.lit(" "), seconds_clock(fraction))


# Wallet and bank sources ---------------------------------------------------------------------

YEAR_FIRST = r"^(\d{4})[/-](\d{2})[/-](\d{2})$"
DAY_FIRST = r"^(\d{2})[/-](\d{2})[/-](\d{4})$"


def day_btn(c: Column) -> Column:
    """Issuer BTN: time part dropped, year or day first; other text stays."""
    text = F.regexp_extract(F.trim(c), r"^[^T ]*", 0)
    return blank_if_null(
        reshape(text, [(YEAR_FIRST, "$1-$2-$3"), (DAY_FIRST, "$3-$2-$1")], otherwise=text)
    )


BCA_FORM = r"^(\d{1,2})/(\d{1,2})/(\d{1,2}|\d{4})\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*(?:AM|PM)?$"
BCA_ISO = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})[ T](\d{1,2}):(\d{1,2})(?::(\d{1,2}))?.*$"
HALF_DAY = r"\s\d{1,2}:[0-9:]+\s*(AM|PM)$"
# Half-day marks count only up to twelve o'clock; twelve itself is hour zero of its half.
TWELVE_WITH_MARK = r"(^|\s)12(:[0-9:]+\s*(?:AM|PM))$"
AFTERNOON = r"(^|\s)(0\d|1[01]):[0-9:]+\s*PM$"


def moment_bca(c: Column) -> Column:
    """Issuer BCA: month first with an optional half-day mark, or year first, or free form.

    Either shape is brought to six numbers by one replacement; the moment is made of numbers, not read from text again.
    """
    text = F.upper(F.trim(c))
    form, iso = text.rlike(BCA_FORM), text.rlike(BCA_ISO)
    spaced = F.when(form, F.regexp_replace(text, BCA_FORM, "$3 $1 $2 $4 $5 $6")).when(iso, F.regexp_replace(text, BCA_ISO, "$1 $2 $3 $4 $5 $6"))
    parts = F.split(spaced, " ")
    year, month, day, hour, minute, second = (F.get(parts, F.lit(i)).try_cast("int") for i in range(6))
    year = F.when(F.length(F.get(parts, F.lit(0))) > 2, year).otherwise(century(year, 71))
    half = F.when(text.endswith("M"), F.regexp_extract(text, HALF_DAY, 1)).otherwise("")
    hour = F.when((half != "") & (hour == 12), 0).otherwise(hour)
    hour = hour + F.when((half == "PM") & (hour < 12), 12).otherwise(0)
    # A sixtieth second would be taken for the next minute.
    second = F.coalesce(F.when(second < 60, second), F.when(F.get(parts, F.lit(5)) == "", 0))
    known = F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))
    return F.coalesce(known, F.when(~(form | iso), free_moment(c)))


def moment_text_bca(c: Column) -> Column:
    return F.coalesce(as_moment(moment_bca(c), "yyyy/MM/dd HH:mm:ss"), c)


def _checked(iso_day: Column) -> Column:
    """ISO day text, NULL if that day does not exist."""
    return iso_day.try_cast("date").cast("string")


def day_mandiri(c: Column) -> Column:
    """Issuer Mandiri: day or year first; other text becomes blank, blank stays."""
    text = F.trim(c)
    shaped = reshape(text, [(DAY_FIRST, "$3-$2-$1"), (YEAR_FIRST, "$1-$2-$3")], otherwise=F.lit(""))
    return F.when(text.rlike(r"^(\d{4}[/-]\d{1,2}[/-]\d{1,2}|\d{1,2}[/-]\d{1,2}[/-]\d{4})$"), _checked(shaped)).otherwise("")


def moment_text(c: Column) -> Column:
    """Free-form moment as ``yyyy-MM-dd HH:mm:ss``; what cannot be read stays."""
    return F.coalesce(as_moment(free_moment(c)), c)


def without_offset(c: Column, offset: str = " +07:00") -> Column:
    """Local time without its written offset."""
    return F.replace(c, F.lit(offset))


OTTO_STRICT = [
    (r"^(\d{4})[/-](\d{2})[/-](\d{2})\s+(\d{2}:\d{2}:\d{2})$", "$1-$2-$3 $4"),
    (r"^(\d{4})[/-](\d{2})[/-](\d{2})\s+(\d{2}:\d{2})$", "$1-$2-$3 $4:00"),
]
OTTO_MONTH_FIRST = [
    (r"^(\d{2})[/-](\d{2})[/-](\d{4})\s+(\d{2}:\d{2}:\d{2})$", "$3-$1-$2 $4"),
    (r"^(\d{2})[/-](\d{2})[/-](\d{4})\s+(\d{2}:\d{2})$", "$3-$1-$2 $4:00"),
]


def moment_otto(c: Column) -> Column:
    """OttoPay date-time text: ISO, month first, slashed ISO, spreadsheet serial; else single-spaced."""
    text = F.trim(c)
    month_first = reshape(text, OTTO_MONTH_FIRST, otherwise=F.lit(None), result=ISO_MOMENT)
    shaped = reshape(text, OTTO_STRICT, otherwise=month_first, strict=True, result=ISO_MOMENT)
    serial = F.when(text.rlike(SERIAL) & (text.try_cast("double") > 59), serial_moment_text(text))
    return blank_if_null(F.coalesce(shaped, serial, F.regexp_replace(text, r"\s+", " ")))


# Day first only where the first number cannot be a month; a clock behind the date is dropped.
OTTO_DAYS = [
    (r"^(1[3-9]|[2-9]\d)[/-](\d{2})[/-](\d{4})$", "$3-$2-$1"),
    (r"^(\d{2})[/-](\d{2})[/-](\d{4})$", "$3-$1-$2"),
]


def day_otto(c: Column) -> Column:
    """OttoPay date: ISO, month first, slashed ISO; the date of a date-time; else unchanged."""
    text = F.trim(c)
    slashed = F.regexp_replace(text, r"^(\d{4})/(\d{2})/(\d{2})$", "$1-$2-$3")
    plain = F.when(text.contains(" "), F.split_part(moment_otto(text), F.lit(" "), F.lit(1)))
    shaped = F.when(text.rlike(r"^\d{1,2}[/-]"), reshape(text, OTTO_DAYS, otherwise=F.lit(None)))
    return blank_if_null(F.coalesce(shaped, plain, slashed))


ID_FORM = r"^(\d{2})[/-](\d{2})[/-](\d{2}|\d{4})(?:\s+(\d{2})[.:](\d{2})(?:[.:](\d{2}))?)?$"


def moment_id(c: Column) -> Column:
    """Dashboard moment: day first with optional clock, spreadsheet serial, or free form; else NULL."""
    text = F.trim(c)
    ready = padded(text)
    formed = F.regexp_replace(ready, ID_FORM, "$3-$2-$1 $4:$5:$6")
    formed = F.regexp_replace(formed, r"^([7-9]\d)-", "19$1-")
    formed = F.regexp_replace(formed, r"^(\d{2})-", "20$1-")
    serial = F.to_timestamp_ntz(F.lit("1899-12-30 00:00:00")) + F.make_dt_interval(
        secs=F.floor(F.round(text.try_cast("double") * 86400, 3)).cast("decimal(18,6)")
    )
    return (
        F.when(ready.rlike(ID_FORM), iso_moment(F.rtrim(formed, F.lit(": "))))
        .when(text.rlike(SERIAL), serial)
        .otherwise(free_moment(text))
    )


NOBU_SHAPES = [
    (r"^(\d{2})[ /-](\d{2})[ /-](\d{4})(?:[ /-].*)?$", "$3-$2-$1"),
    (r"^(\d{4})[ /-](\d{2})[ /-](\d{2})(?:[ /-].*)?$", "$1-$2-$3"),
]


def day_nobu(c: Column) -> Column:
    """Nobu date: day or year first, anything after the date ignored; else free form; else unchanged."""
    text = F.trim(c)
    shaped = reshape(text, NOBU_SHAPES, otherwise=F.lit(None))
    numeric = text.rlike(r"^(\d{4}[ /-]\d{1,2}[ /-]\d{1,2}|\d{1,2}[ /-]\d{1,2}[ /-]\d{4})([ /-]|$)")
    return F.when(numeric, _checked(shaped)).otherwise(
        F.coalesce(as_day(free_moment(text)), text)
    )


BRI_SHAPES = [
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{2})[/.-](\d{2})[/.-](\d{4})$", "$3-$2-$1"),
    (r"^(\d{4})[/.](\d{2})[/.](\d{2})$", "$1-$2-$3"),
    (r"^(\d{2})[/.-](\d{2})[/.-](\d{2})$", "20$3-$2-$1"),
]


def day_bri(c: Column) -> Column:
    """BRI date: ISO, compact, day first with 4- or 2-digit year, dotted, serial; else free form or unchanged."""
    text = F.trim(c)
    shaped = reshape(text, BRI_SHAPES, otherwise=F.lit(None))
    serial = F.when(text.rlike(r"^\d{5}$"), serial_day(text).cast("string"))
    return blank_if_null(
        F.when(text.rlike(ISO_DAY), text).otherwise(
            F.coalesce(shaped, serial, as_day(free_moment(text)), text)
        )
    )


def day_bank_bca(c: Column) -> Column:
    """Statement date, day first. A day that does not exist is NULL; other text stays."""
    shaped = reshape(c, [(DAY_FIRST, "$3-$2-$1")], otherwise=F.lit(None))
    return F.when(c.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{4}$"), _checked(shaped)).otherwise(c)


BANK_BTN_SHAPES = [
    (r"^(\d{2})/(\d{2})/(\d{4})$", "$3-$2-$1"),
    (r"^(\d{4})/(\d{2})/(\d{2})$", "$1-$2-$3"),
]


def day_bank_btn(c: Column) -> Column:
    shaped = reshape(c, BANK_BTN_SHAPES, otherwise=F.lit(None))
    return blank_if_null(F.coalesce(shaped, as_day(free_moment(c)), c))
