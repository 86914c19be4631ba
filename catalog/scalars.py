"""Cell normalisers over cells rendered from the payments.

Each query renders a cell per payment in one of several raw shapes (picked by the id) and normalises
it; the oracle states the expected value straight from the payment, without the raw text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import duck
from catalog.registry import add
from catalog.standins import payments
from tripledger.functions import amounts, dates, text, times
from tripledger.plans.formatters import rejected

DAY, NOW = "strftime(ts, '%Y-%m-%d')", "strftime(ts, '%Y-%m-%d %H:%M:%S')"
MINUTE = "strftime(ts, '%Y-%m-%d %H:%M:00')"
CLOCK, CLOCK_MIN = "strftime(ts, '%H:%M:%S')", "strftime(ts, '%H:%M:00')"


def fmt(pattern: str) -> str:
    return f"date_format(ts, '{pattern}')"


def pick(values: list[str]) -> str:
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case trx_id % {len(values)} {cases} end"


def scalar(name, normalise, shapes: list[tuple[str, str]], result: str = "{v}"):
    """Shapes are (raw cell in Spark SQL, expected value in DuckDB SQL)."""
    raw = pick([s for s, _ in shapes])
    wanted = pick([w for _, w in shapes])

    def run(spark, folder):
        cells = payments(spark, folder).withColumn("raw", F.expr(raw))
        return cells.select("trx_id", normalise(F.col("raw")).alias("value"))

    add(
        name,
        run,
        f"WITH {duck.PAY} SELECT trx_id, {result.format(v='value')} AS value FROM "
        f"(SELECT trx_id, {wanted} AS value FROM pay)",
    )


DOUBLE = "CAST({v} AS DOUBLE)"
STAMP = "strftime({v}, '%Y-%m-%d %H:%M:%S')"
ID = "cast(trx_id as string)"
SQL_ID = "CAST(trx_id AS VARCHAR)"
NULL, SQL_NULL = "cast(null as string)", "CAST(NULL AS VARCHAR)"
# Fractions of a day that are exact in binary, so that a serial renders and reads back exactly.
EIGHTH = "cast(datediff(cast(ts as date), date'1899-12-30') + (qty % 8) / 8.0D as string)"
SQL_EIGHTH = "strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds((qty % 8) * 10800), '%Y-%m-%d %H:%M:%S')"

# Text.
scalar(
    "pad2",
    lambda c: text.pad_left(c, 2),
    [
        ("cast(qty as string)", "CASE WHEN qty < 10 THEN '0' || qty ELSE CAST(qty AS VARCHAR) END"),
        (f"concat('1', {ID})", f"'1' || {SQL_ID}"),
        ("''", "''"),
    ],
)
scalar(
    "count_char",
    lambda c: text.count_char(c, ";"),
    [
        ("repeat('a;', qty)", "qty"),
        ("repeat(',', qty)", "0"),
        (NULL, "0"),
        ("concat_ws(';', flag, line_status, issuer)", "2"),
    ],
)
scalar(
    "pad_rrn",
    lambda c: text.pad_id(c, 12),
    [
        (f"concat(' ', {ID}, ' ')", f"lpad({SQL_ID}, 12, '0')"),
        (f"concat('RRN-LONG-', {ID}, '000')", f"'RRN-LONG-' || {SQL_ID} || '000'"),
        (NULL, "''"),
        ("'  '", "''"),
    ],
)
scalar(
    "mid_numeric",
    text.merchant_number,
    [
        (f"concat(' 000', {ID}, ' ')", SQL_ID),
        (f"concat('M', {ID})", f"'M' || {SQL_ID}"),
        (NULL, SQL_NULL),
        (f"concat('12345678901234567890', lpad({ID}, 10, '0'))", f"'12345678901234567890' || lpad({SQL_ID}, 10, '0')"),
    ],
)
scalar(
    "text_prefix",
    text.mark_as_text,
    [(ID, f"'''' || {SQL_ID}"), ("''", "''"), (NULL, SQL_NULL)],
)
scalar(
    "strip_quotes",
    text.strip_quotes,
    [
        (f"concat('\"', {ID}, '\"')", SQL_ID),
        (f"concat(\"''\", {ID}, \"'\")", SQL_ID),
        ("concat('  a\"b\"', \"'\", 'c ', issuer)", "'ab''c ' || issuer"),
    ],
)
scalar(
    "sanitize_name",
    text.first_line_name,
    [
        ("concat(' ', issuer, char(13), char(10), flag, ' ; rest')", "issuer || ' ' || flag"),
        ("concat(issuer, char(10), char(10), flag)", "issuer || ' ' || flag"),
        ("concat(issuer, ' ', flag)", "issuer || ' ' || flag"),
        ("concat(';', issuer)", "''"),
    ],
)
scalar(
    "pad_approval",
    lambda c: text.pad_id(c, 6),
    [
        ("cast(qty as string)", "lpad(CAST(qty AS VARCHAR), 6, '0')"),
        ("concat('AB', lpad(cast(qty as string), 9, '0'))", "'AB' || lpad(CAST(qty AS VARCHAR), 9, '0')"),
        (NULL, "''"),
    ],
)
scalar(
    "safe_string",
    text.plain_text,
    [
        (f"concat(' ', {ID})", SQL_ID),
        ("concat(cast(qty as string), 'E+12')", "CAST(CAST(qty AS BIGINT) * 1000000000000 AS VARCHAR)"),
        ("concat('1.', lpad(cast(qty as string), 2, '0'), 'E15')", "CAST((100 + CAST(qty AS BIGINT)) * 10000000000000 AS VARCHAR)"),
        (NULL, "''"),
        ("issuer", "issuer"),
    ],
)

# Amounts.
scalar(
    "mdr_dash_zero",
    amounts.dash_as_zero,
    [("'-'", "'0'"), ("'  '", "'0'"), (NULL, "'0'"), ("' 0.7 '", "'0.7'"), ("cast(disc as string)", "CAST(disc AS VARCHAR)")],
)
scalar(
    "numeric_ref",
    amounts.reference_number,
    [
        ("format_number(trx_id, 0)", SQL_ID),
        (f"concat('00', {ID})", SQL_ID),
        (f"concat('X', {ID})", "''"),
        ("''", "''"),
        (NULL, SQL_NULL),
        ("concat(cast(qty as string), '.50')", "qty || '.5'"),
    ],
)
scalar(
    "strip_thousands",
    amounts.strip_grouping,
    [
        ("format_number(gmv * 1000, 0)", "CAST(CAST(gmv * 1000 AS BIGINT) AS VARCHAR)"),
        ("format_number(gmv * 1000, 2)", "CAST(CAST(gmv * 1000 AS BIGINT) AS VARCHAR) || '.00'"),
        ("replace(format_number(gmv * 1000, 0), ',', '.')", "CAST(CAST(gmv * 1000 AS BIGINT) AS VARCHAR)"),
        ("concat(cast(gmv as string), ' IDR')", "CAST(gmv AS VARCHAR) || ' IDR'"),
        ("cast(gmv as string)", "CAST(gmv AS VARCHAR)"),
    ],
)
scalar(
    "amount_or_zero",
    amounts.amount_or_zero,
    [("cast(gmv as string)", "gmv"), ("concat('9,', cast(gmv as string))", "0"), ("''", "0"), (NULL, "0"), ("concat(' -', cast(gmv as string))", "-gmv")],
    DOUBLE,
)
scalar(
    "cast_if_numeric",
    amounts.number_if_numeric,
    [
        ("concat('000', cast(cast(gmv as bigint) as string), '.00')", "CAST(CAST(floor(gmv) AS BIGINT) AS VARCHAR)"),
        ("concat(cast(qty as string), '.25')", "qty || '.25'"),
        ("concat('Rp ', cast(qty as string))", "'Rp ' || qty"),
    ],
)
scalar(
    "amount_digits",
    amounts.amount_from_digits,
    [
        ("concat('Rp ', cast(gmv as string))", "gmv"),
        ("concat('IDR -', format_number(gmv, 2))", "-gmv"),
        ("concat('1.000.', cast(qty as string))", "0"),
        (NULL, "0"),
        ("'none'", "0"),
    ],
    DOUBLE,
)
scalar(
    "mdr_percent",
    amounts.fee_rate,
    [
        ("concat('0.', cast(qty as string), '%')", "rtrim('0.00' || qty, '0')"),
        ("concat('0,', cast(qty as string))", "rtrim('0.' || qty, '0')"),
        ("concat(cast(qty as string), ' %')", "rtrim(rtrim(printf('%.2f', qty / 100.0), '0'), '.')"),
        ("'free'", "'free'"),
        ("' '", "''"),
    ],
)
scalar(
    "int_strip",
    amounts.integer_without_marks,
    [
        ("cast(gmv as string)", "CAST(gmv * 100 AS BIGINT)"),
        ("format_number(trx_id, 0)", "trx_id"),
        ("concat(cast(qty as string), 'x9')", "qty"),
        ("'n/a'", "0"),
        (NULL, "0"),
    ],
)
scalar(
    "account_number",
    amounts.account_number,
    [("format_number(trx_id, 0)", SQL_ID), (f"concat('0', {ID}, ' IDR')", SQL_ID), ("'closed'", SQL_NULL)],
)
scalar(
    "split_amount_type",
    lambda c: F.concat_ws("|", *amounts.amount_and_type(c)),
    [
        ("concat(' ', format_number(gmv, 2), ' CR')", "format('{:,}', CAST(floor(gmv) AS BIGINT)) || '.' || right(CAST(gmv AS VARCHAR), 2) || '|CR'"),
        ("cast(gmv as string)", "CAST(gmv AS VARCHAR) || '|'"),
        ("concat(cast(qty as string), ' DB extra')", "qty || '|DB'"),
    ],
)

# Dates.
scalar(
    "date_btn",
    dates.day_btn,
    [
        (fmt("yyyy-MM-dd HH:mm:ss"), DAY),
        (fmt("yyyy/M/d"), DAY),
        (fmt("d/M/yyyy"), DAY),
        (f"concat(' ', {fmt('d-M-yyyy')}, 'T10:00 ')", DAY),
        (fmt("dd.MM.yyyy"), "strftime(ts, '%d.%m.%Y')"),
        ("'31/2/2024'", "'2024-02-31'"),
        (NULL, "''"),
    ],
)
scalar(
    "datetime_bca",
    dates.moment_text_bca,
    [
        (fmt("M/d/yy h:mm a"), "strftime(ts, '%Y/%m/%d %H:%M:00')"),
        (fmt("M/d/yyyy H:mm:ss"), "strftime(ts, '%Y/%m/%d %H:%M:%S')"),
        (f"lower({fmt('M/d/yyyy hh:mm:ss a')})", "strftime(ts, '%Y/%m/%d %H:%M:%S')"),
        (fmt("yyyy-M-d HH:mm"), "strftime(ts, '%Y/%m/%d %H:%M:00')"),
        (f"concat({fmt('yyyy/MM/dd')}, 'T', {fmt('HH:mm:ss')}, '.000')", "strftime(ts, '%Y/%m/%d %H:%M:%S')"),
        (fmt("MMM d, yyyy HH:mm:ss"), "strftime(ts, '%Y/%m/%d %H:%M:%S')"),
        ("'pending'", "'pending'"),
        (NULL, SQL_NULL),
    ],
)
scalar(
    "date_mandiri",
    dates.day_mandiri,
    [
        (fmt("d/M/yyyy"), DAY),
        (fmt("dd-MM-yyyy"), DAY),
        (fmt("yyyy/M/d"), DAY),
        (fmt("dd/MM/yy"), "''"),
        ("'31/02/2024'", SQL_NULL),
        ("''", "''"),
    ],
)
scalar(
    "datetime_reformat",
    dates.moment_text,
    [
        (fmt("yyyy-MM-dd HH:mm:ss"), NOW),
        (f"concat({fmt('yyyy-MM-dd')}, 'T', {fmt('HH:mm:ss')})", NOW),
        (fmt("M/d/yyyy H:mm"), MINUTE),
        (fmt("M/d/yyyy h:mm:ss a"), NOW),
        (fmt("yyyy/MM/dd HH:mm:ss"), NOW),
        (fmt("d MMM yyyy HH:mm:ss"), NOW),
        ("'n/a'", "'n/a'"),
        (NULL, SQL_NULL),
    ],
)
scalar(
    "strip_offset",
    lambda c: dates.as_moment(dates.free_moment(dates.without_offset(c))),
    [(f"concat({fmt('yyyy-MM-dd HH:mm:ss')}, ' +07:00')", NOW), (fmt("yyyy-MM-dd HH:mm:ss"), NOW)],
)
scalar(
    "datetime_otto",
    dates.moment_otto,
    [
        (fmt("yyyy-MM-dd HH:mm:ss"), NOW),
        (fmt("yyyy-MM-dd  HH:mm"), MINUTE),
        (fmt("M/d/yyyy H:m:s"), NOW),
        (fmt("M-d-yyyy H:m"), MINUTE),
        (fmt("yyyy/MM/dd HH:mm:ss"), NOW),
        (EIGHTH, SQL_EIGHTH),
        ("'  late   entry '", "'late entry'"),
        (NULL, "''"),
    ],
)
_MAYBE_DAY_FIRST = "CASE WHEN day(ts) > 12 THEN {iso} ELSE strftime(ts, '%Y-%d-%m') END".format(iso=DAY)
scalar(
    "date_otto",
    dates.day_otto,
    [
        (fmt("yyyy-MM-dd"), DAY),
        (fmt("M/d/yyyy"), DAY),
        (fmt("d/M/yyyy"), _MAYBE_DAY_FIRST),
        (fmt("yyyy/MM/dd"), DAY),
        (fmt("M/d/yyyy H:mm"), DAY),
        ("'unknown'", "'unknown'"),
        (NULL, "''"),
    ],
)
scalar(
    "excel_serial",
    lambda c: dates.serial_day(c),
    [
        ("cast(datediff(cast(ts as date), date'1899-12-30') as string)", DAY),
        (EIGHTH, DAY),
    ],
)
scalar(
    "datetime_id",
    dates.moment_id,
    [
        (fmt("d/M/yyyy H.m"), "date_trunc('minute', ts)"),
        (fmt("d-M-yy HH:mm:ss"), "ts"),
        (fmt("dd/MM/yyyy"), "date_trunc('day', ts)"),
        (EIGHTH, "CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds((qty % 8) * 10800)"),
        (fmt("MMM d, yyyy HH:mm:ss"), "ts"),
        ("'31/02/2024 10.00'", "CAST(NULL AS TIMESTAMP)"),
        ("''", "CAST(NULL AS TIMESTAMP)"),
    ],
    STAMP,
)
scalar(
    "year_pivot",
    lambda c: F.concat_ws("|", *[dates.year_from(c, p) for p in (70, 71)]),
    [
        (fmt("yy"), "year(ts) || '|' || year(ts)"),
        (fmt("yyyy"), "year(ts) || '|' || year(ts)"),
        ("'70'", "'1970|2070'"),
        ("'69'", "'2069|2069'"),
        ("'71'", "'1971|1971'"),
    ],
)
scalar(
    "date_nobu",
    dates.day_nobu,
    [
        (fmt("d/M/yyyy"), DAY),
        (fmt("dd-MM-yyyy HH:mm"), DAY),
        (fmt("yyyy-MM-dd HH:mm:ss"), DAY),
        (fmt("d M yyyy"), DAY),
        (fmt("MMM d, yyyy"), DAY),
        ("'30/02/2024'", SQL_NULL),
        ("'tba'", "'tba'"),
    ],
)
_THIS_CENTURY = "CASE WHEN year(ts) < 2000 THEN '20' || strftime(ts, '%y-%m-%d') ELSE {iso} END".format(iso=DAY)
scalar(
    "date_bri",
    dates.day_bri,
    [
        (fmt("yyyy-MM-dd"), DAY),
        (fmt("yyyyMMdd"), DAY),
        (fmt("d.M.yyyy"), DAY),
        (fmt("yyyy.M.d"), DAY),
        (fmt("d/M/yy"), _THIS_CENTURY),
        ("cast(datediff(cast(ts as date), date'1899-12-30') as string)", DAY),
        (fmt("MMM d, yyyy"), DAY),
        ("'??'", "'??'"),
        (NULL, "''"),
    ],
)
scalar(
    "date_bca_bank",
    dates.day_bank_bca,
    [(fmt("dd/MM/yyyy"), DAY), (fmt("d-M-yyyy"), DAY), ("'PEND'", "'PEND'"), ("'31/04/2024'", SQL_NULL), (fmt("yyyy.MM.dd"), "strftime(ts, '%Y.%m.%d')")],
)
scalar(
    "date_btn_bank",
    dates.day_bank_btn,
    [(fmt("d/M/yyyy"), DAY), (fmt("yyyy/M/d"), DAY), (fmt("yyyy-MM-dd HH:mm"), DAY), ("'x/y'", "'x/y'"), (NULL, "''")],
)

scalar(
    "reject_flag",
    lambda c: rejected(c, dates.day_bank_bca(c)),
    [(fmt("dd/MM/yyyy"), "FALSE"), ("'PEND'", "FALSE"), ("'31/04/2024'", "TRUE"), ("''", "FALSE")],
)

# Times.
scalar(
    "time_btn",
    times.clock_btn,
    [
        (fmt("HH:mm:ss"), CLOCK),
        (fmt("H.m.s"), CLOCK),
        (fmt("HHmmss"), CLOCK),
        (fmt("HH:mm"), "strftime(ts, '%H:00:%M')"),
        ("'27:61:99'", "'23:59:59'"),
        ("'  '", "'00:00:00'"),
        (NULL, "''"),
        (f"concat({fmt('HH')}, 'h:', {fmt('mm')}, 'm:', {fmt('ss')}, 's')", CLOCK),
    ],
)
scalar(
    "time_mandiri",
    times.clock_mandiri,
    [(fmt("HH:mm:ss"), CLOCK), (fmt("HHmm"), CLOCK_MIN), (fmt("HH.mm"), CLOCK_MIN), ("'9:05'", "'9:05'"), (NULL, SQL_NULL)],
)
scalar(
    "time_otto",
    times.clock_otto,
    [
        (fmt("HH:mm:ss"), CLOCK),
        (fmt("H:m"), CLOCK_MIN),
        (fmt("H:m:s"), CLOCK),
        (fmt("M/d/yyyy H:mm:ss"), CLOCK),
        ("'noon'", "'noon'"),
        (NULL, "''"),
    ],
)
_SECONDS = "hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
scalar(
    "seconds_to_hms",
    lambda c: dates.seconds_clock(c.cast("int")),
    [(f"cast({_SECONDS} as string)", CLOCK), ("cast(-qty as string)", "'00:00:00'"), ("cast(86400 + qty as string)", "'23:59:59'")],
)
scalar(
    "time_bri",
    times.clock_bri,
    [
        (fmt("H:mm:ss"), CLOCK),
        (fmt("H.mm.ss"), CLOCK),
        (fmt("HHmmss"), CLOCK),
        ("cast(qty % 8 / 8.0D + 0.0625D as string)", "CASE WHEN TRUE THEN strftime(TIMESTAMP '2000-01-01' + to_seconds((qty % 8) * 10800 + 5400), '%H:%M:%S') END"),
        ("'1:2'", "'1:2'"),
        (NULL, "''"),
        ("'91530'", "'09:15:30'"),
    ],
)
scalar(
    "time_btn_bank",
    times.clock_bank_btn,
    [(fmt("HH:mm:ss"), CLOCK), (fmt("H:mm"), CLOCK_MIN), (fmt("h:mm:ss a"), CLOCK), (f"lower({fmt('h:mm a')})", CLOCK_MIN), ("'--'", "'--'"), (NULL, "''")],
)
