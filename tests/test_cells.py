"""Each cell normaliser against a literal table: every branch, blank, NULL and near misses."""

import pytest
from pyspark.sql import functions as F

from tripledger.functions import amounts, dates, text, times

CASES = {
    "pad2": (lambda c: text.pad_left(c, 2), {"5": "05", "12": "12", "123": "123", "": "", None: None}),
    "pad_rrn": (lambda c: text.pad_id(c, 12), {" 123 ": "000000000123", "1234567890123": "1234567890123", "": "", None: ""}),
    "count": (lambda c: text.count_char(c, ";").cast("string"), {"a;b;": "2", "": "0", None: "0"}),
    "mid": (text.merchant_number, {" 007 ": "7", "A7": "A7", "": "", None: None}),
    "plain": (text.plain_text, {"1.5E3": "1500", " x ": "x", None: "", "12": "12"}),
    "mark": (text.mark_as_text, {"1": "'1", "": "", None: None}),
    "unmark": (text.unmark_text, {"'1": "1", "1": "1"}),
    "quotes": (text.strip_quotes, {"''a\"b'": "ab", " 'x' ": "'x'", "": ""}),
    "name": (text.first_line_name, {"a\r\nb ;c": "a b", "": "", " x ": "x"}),
    "dash": (amounts.dash_as_zero, {"-": "0", " ": "0", None: "0", "0.7": "0.7"}),
    "ref": (amounts.reference_number, {"1,234": "1234", "x": "", "": "", None: None, "007": "7", "1.50": "1.5"}),
    "group": (amounts.strip_grouping, {"1,234.56": "1234.56", "1.234.567": "1234567", "1234": "1234", "12,34": "12,34", "1,234 IDR": "1,234 IDR"}),
    "rate": (amounts.fee_rate, {"0.7%": "0.007", "0,7": "0.7", "70 %": "0.7", "": "", "free": "free", "1": "1"}),
    "int": (lambda c: amounts.integer_without_marks(c).cast("string"), {"1000.50": "100050", "12x": "12", "x": "0", "": "0", None: "0", "-5": "-5"}),
    "account": (amounts.account_number, {"1,234": "1234", "0012": "12", "x": None}),
    "zero": (lambda c: amounts.amount_or_zero(c).cast("decimal(10,2)").cast("string"), {"12.5": "12.50", "1,000": "0.00", "": "0.00", None: "0.00", "-3": "-3.00"}),
    "digits": (lambda c: amounts.amount_from_digits(c).cast("decimal(10,2)").cast("string"), {"Rp 1,000.5": "1000.50", "1.000.5": "0.00", None: "0.00"}),
    "day_btn": (dates.day_btn, {"2024-03-05": "2024-03-05", "2024/3/5": "2024-03-05", "5-3-2024": "2024-03-05", "5/3/2024 10:00": "2024-03-05", "5.3.2024": "5.3.2024", "": "", None: ""}),
    "bca": (
        dates.moment_text_bca,
        {
            "3/5/24 1:05 PM": "2024/03/05 13:05:00", "3/5/24 12:05 AM": "2024/03/05 00:05:00", "3/5/24 12:05 pm": "2024/03/05 12:05:00",
            "3/5/70 1:05": "2070/03/05 01:05:00", "3/5/71 1:05": "1971/03/05 01:05:00", "3/5/2024 13:30 PM": "2024/03/05 13:30:00",
            "2024-3-5T9:05:07": "2024/03/05 09:05:07", "Mar 5, 2024": "2024/03/05 00:00:00", "x": "x", "": "", None: None, "13/5/24 1:05": "13/5/24 1:05",
            "3/5/2024 12:30": "2024/03/05 12:30:00",
        },
    ),
    "mandiri": (dates.day_mandiri, {"5/3/2024": "2024-03-05", "2024-3-5": "2024-03-05", "05/03/24": "", "31/02/2024": None, "": ""}),
    "free": (
        dates.moment_text,
        {
            "2024-03-05": "2024-03-05 00:00:00", "2024-03-05T10:11:12": "2024-03-05 10:11:12", "3/5/2024 1:02 PM": "2024-03-05 13:02:00",
            "Tue, 5 Mar 2024 10:11:12 GMT": "2024-03-05 10:11:12", "Tue Mar 05 2024 10:11:12": "2024-03-05 10:11:12", "5 March 2024": "2024-03-05 00:00:00",
            "Foo 5, 2024": "Foo 5, 2024", "2/30/2024": "2/30/2024", "": "", None: None,
        },
    ),
    "otto": (
        dates.moment_otto,
        {
            "2024-03-05 10:11": "2024-03-05 10:11:00", "3/5/2024 1:2:3": "2024-03-05 01:02:03", "3-5-2024 1:2": "2024-03-05 01:02:00",
            "2024/03/05 10:11:12": "2024-03-05 10:11:12", "45356.5": "2024-03-05 12:00:00", "59": "59", "a   b": "a b", "2024-3-5 10:11": "2024-3-5 10:11", None: "",
        },
    ),
    "otto_day": (dates.day_otto, {"2024-03-05": "2024-03-05", "3/5/2024": "2024-03-05", "13/5/2024": "2024-05-13", "2024/03/05": "2024-03-05", "3/5/2024 1:00": "2024-03-05", "x": "x", None: ""}),
    "id": (
        lambda c: dates.as_moment(dates.moment_id(c)),
        {
            "5/3/24 9.05": "2024-03-05 09:05:00", "5-3-1999 9:05:07": "1999-03-05 09:05:07", "5/3/70": "1970-03-05 00:00:00", "5/3/69": "2069-03-05 00:00:00",
            "45356.25": "2024-03-05 06:00:00", "31/2/2024": None, "": None, "x": None, "2024-03-05 10:00:00": "2024-03-05 10:00:00",
        },
    ),
    "nobu": (dates.day_nobu, {"5/3/2024": "2024-03-05", "2024-03-05 10:00": "2024-03-05", "5 3 2024": "2024-03-05", "30/02/2024": None, "Mar 5, 2024": "2024-03-05", "x": "x"}),
    "bri": (dates.day_bri, {"2024-03-05": "2024-03-05", "20240305": "2024-03-05", "5.3.2024": "2024-03-05", "2024.3.5": "2024-03-05", "5/3/99": "2099-03-05", "45356": "2024-03-05", "x": "x", "": "", None: ""}),
    "bank_bca": (dates.day_bank_bca, {"05/03/2024": "2024-03-05", "5-3-2024": "2024-03-05", "31/04/2024": None, "PEND": "PEND", "05/03/24": "05/03/24"}),
    "bank_btn": (dates.day_bank_btn, {"5/3/2024": "2024-03-05", "2024/3/5": "2024-03-05", "2024-03-05": "2024-03-05", "x/y": "x/y", "": "", None: ""}),
    "clock_btn": (
        times.clock_btn,
        {"9.5.7": "09:05:07", "93015": "09:30:15", "12:30": "12:00:30", "12:3045": "12:30:45", "99:99:99": "23:59:59", "1234567": "12:34:56", "": "00:00:00", None: "", "007:1:2": "07:01:02", "1:2:3:4": "01:02:03"},
    ),
    "clock_mandiri": (times.clock_mandiri, {"093015": "09:30:15", "0930": "09:30:00", "930": "930", None: None}),
    "clock_otto": (times.clock_otto, {"9:5": "09:05:00", "09:05:07": "09:05:07", "3/5/2024 9:05": "09:05:00", "x": "x", None: ""}),
    "clock_bri": (times.clock_bri, {"0.5": "12:00:00", "9:05:07": "09:05:07", "9.05.07": "09:05:07", "93015": "09:30:15", "093015": "09:30:15", "9:05.07": "9:05.07", "": "", None: ""}),
    "clock_bank": (times.clock_bank_btn, {"9:05": "09:05:00", "1:05:07 pm": "13:05:07", "12:00 AM": "00:00:00", "12:00 PM": "12:00:00", "25:00": "25:00", None: "", "--": "--"}),
}


@pytest.mark.parametrize("name", CASES)
def test_cells(spark, name):
    change, table = CASES[name]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(table)], "i int, raw string")
    got = {r.raw: r.value for r in rows.select("raw", change(F.col("raw")).alias("value")).collect()}
    assert got == table


def test_header_names():
    raw = [' order  key', '"Supp key" ', "﻿Flag"]
    assert text.header_names(raw, "upper", '"﻿') == ["ORDER_KEY", "SUPP_KEY", "FLAG"]
    assert text.header_names(raw, "lower", '"﻿') == ["order_key", "supp_key", "flag"]


def test_serials(spark):
    row = spark.range(1).select(
        dates.serial_day(F.lit("45356.9")).cast("string").alias("d"),
        dates.seconds_clock(F.lit(-1)).alias("low"),
        dates.seconds_clock(F.lit(90000)).alias("high"),
        dates.serial_moment_text(F.lit("45356.999999")).alias("edge"),
    ).first()
    assert tuple(row) == ("2024-03-05", "00:00:00", "23:59:59", "2024-03-05 23:59:59")
