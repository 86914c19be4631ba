"""Time rules: cut-offs, batch windows, bank day shift, reporting period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
# Names of the two batches of a day.
BATCHES = ("AM (22.00-09.59)", "PM (10.00-21.59)")


def clock_seconds(text: str) -> int:
    hours, minutes, seconds = (int(p) for p in text.split(":"))
    return hours * 3600 + minutes * 60 + seconds


def second_of_day(ts: Column) -> Column:
    """Time part of a timestamp as whole seconds: compares like a clock time, stays an int."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def time_part(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def date_part(ts: Column) -> Column:
    return ts.cast("date")


def at_or_after(ts: Column, clock: str) -> Column:
    seconds = clock_seconds(clock)
    return F.hour(ts) >= seconds // 3600 if seconds % 3600 == 0 else second_of_day(ts) >= seconds


def _rest_of_day(clock: str) -> Column:
    """Time from the cut-off to midnight."""
    return F.expr(f"INTERVAL '{86400 - clock_seconds(clock)}' SECOND")


def cutoff_shift(ts: Column, clock: str | None) -> Column:
    """Receival date: at or after the cut-off belongs to the next day; without one the date stays.

    Moving the clock ahead by the rest of the day makes the cut-off the day boundary.
    """
    return date_part(ts + _rest_of_day(clock)) if clock else date_part(ts)


def cutoff_shift_by(issuer: Column, ts: Column, cutoffs: Mapping[str, str]) -> Column:
    """Cut-off per issuer; an issuer without a rule keeps its calendar date."""
    ahead = F.expr("INTERVAL '0' SECOND")
    for name, clock in cutoffs.items():
        ahead = F.when(issuer == name, _rest_of_day(clock)).otherwise(ahead)
    return date_part(ts + ahead)


def overnight(ts: Column, night: str = "22:00:00", morning: str = "10:00:00") -> Column:
    """True in the AM batch, which runs over midnight."""
    return at_or_after(ts, night) | ~at_or_after(ts, morning)


def batch_label(ts: Column, am: str, pm: str, hours: Sequence[str] = ("22:00:00", "10:00:00")) -> Column:
    return F.when(overnight(ts, *hours), am).otherwise(pm)


def hour_threshold_label(
    ts: Column, amount: Column, threshold: int, first: int = 10, last: int = 21
) -> Column:
    """Receipts by hour window and amount: money that arrives in the daytime settles the AM batch."""
    merchant = F.when(amount < threshold, "MCD").otherwise("MSME")
    batch = F.when(F.hour(ts).between(first, last), BATCHES[0]).otherwise(BATCHES[1])
    return F.concat_ws(" ", merchant, batch)


def bank_day_shift(day: Column, days: int = 1) -> Column:
    """Banks pay the day after: shift a posting date back to the transaction date."""
    return F.date_sub(day, days)


def period_start(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def in_last_months(moment: Column, as_of: date, months: int, slack_days: int = 0) -> Column:
    """Rolling period filter on a raw date or timestamp column.

    It compares the column itself with one folded literal, so that the filter reaches the scan.
    ``slack_days`` widens it for columns whose date is shifted later.
    """
    start = F.date_sub(period_start(as_of, months), slack_days)
    return moment >= start.cast(NTZ)


def century(two_digits: Column, first_of_1900s: int) -> Column:
    """Full year of a two-digit year: from the pivot on 19xx, below it 20xx."""
    n = two_digits.cast("int")
    return F.when(n >= first_of_1900s, n + 1900).otherwise(n + 2000)


# Fixed value: the pattern of a posting time, dd/MM/yy HH.mm with optional seconds; any character may separate the clock parts.
POST_DATE = r"^\d{2}/\d{2}/\d{2} \d{2}.\d{2}(.\d{2})?$"


def is_post_date_without_seconds(text: Column) -> Column:
    """The short form ends with the minutes, which its length tells."""
    return text.rlike(POST_DATE) & (F.length(text) == 14)


def parse_post_date(text: Column) -> Column:
    """Bank posting time: ``dd/MM/yy HH.mm``, ``dd/MM/yy HH.mm.ss`` or already ISO; else NULL.

    The form has fixed places, so its parts are cut by position once the pattern has matched.
    """

    def two(start: int) -> Column:
        return F.substring(text, start, 2)

    year = century(two(7).try_cast("int"), 69).cast("string")
    seconds = F.when(F.length(text) == 17, two(16)).otherwise("00")
    iso = F.concat_ws(":", F.concat_ws("-", year, two(4), F.concat_ws(" ", two(1), two(10))), two(13), seconds)
    return F.when(text.rlike(POST_DATE), iso.try_cast(NTZ)).otherwise(text.try_cast(NTZ))


def combine_date_time(day: Column, clock: Column) -> Column:
    """Timestamp of a date and a clock text; NULL if either is missing or bad."""
    return F.concat(day.cast("string"), F.lit(" "), clock).try_cast(NTZ)
