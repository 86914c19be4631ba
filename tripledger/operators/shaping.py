"""Shaping of raw rows: where the data of a file starts and ends, and which cell is which column.

Positions such as "the header row of each file" are found with one small aggregate per file and
joined back, so a large file is never gathered into one task. Marks that are needed together come from one aggregate: each mark
of its own would read the rows, with all that was done to them before, once more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripledger.sources.raw import per_file

# About how many bytes the place and the header of a file take.
HEADED = 2048


def cell(i: int) -> Column:
    """Cell by position; blank if the row is shorter."""
    return F.coalesce(F.get("cells", F.lit(i)), F.lit(""))


def joined(sep: str = ",") -> Column:
    return F.array_join("cells", sep)


def is_empty() -> Column:
    return F.trim(joined("")) == ""


def _first(rows: DataFrame, condition: Column) -> DataFrame:
    return rows.groupBy("file").agg(F.min(F.when(condition, F.col("pos"))).alias("mark"))


def leading_marks(rows: DataFrame, count: int) -> DataFrame:
    """Place of the last of the first rows of each file. Only that many rows per file and task reach the window."""
    order = Window.partitionBy("file").orderBy("pos")
    head = rows.select("file", "pos").withColumn("n", F.row_number().over(order)).where(F.col("n") <= count)
    return head.groupBy("file").agg(F.max("pos").alias("mark"))


def drop_leading(rows: DataFrame, count: int) -> DataFrame:
    """Drop the first rows of each file."""
    return per_file(rows, leading_marks(rows, count), "inner").where(F.col("pos") > F.col("mark")).drop("mark")


def drop_header(rows: DataFrame) -> DataFrame:
    """Drop the first row of each file."""
    return after_first(rows, F.lit(True))


def after_first(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows after the first match; a file without a match is skipped whole."""
    marks = _first(rows, condition).where(F.col("mark").isNotNull())
    return per_file(rows, marks, "inner").where(F.col("pos") > F.col("mark")).drop("mark")


def before_first(rows: DataFrame, condition: Column) -> DataFrame:
    """Rows before the first match; a file without a match is kept whole."""
    marked = per_file(rows, _first(rows, condition), "left")
    return marked.where(F.col("mark").isNull() | (F.col("pos") < F.col("mark"))).drop("mark")


def between(rows: DataFrame, start: Column, end: Column, inclusive: bool = False) -> DataFrame:
    """Rows after the first match of ``start`` (from it on, if inclusive) and before the next match of ``end`` behind it.

    A file without a start is skipped whole; one without an end runs to its last row. All matches of ``end`` are rows of the
    aggregate, as only the start decides which of them counts.
    """
    by_file = Window.partitionBy("file")
    found = rows.groupBy("file", F.when(end, F.col("pos")).alias("end")).agg(F.min(F.when(start, F.col("pos"))).alias("start"))
    found = found.withColumn("start", F.min("start").over(by_file)).where("start IS NOT NULL")
    marks = found.groupBy("file").agg(F.min("start").alias("start"), F.min(F.when(F.col("end") > F.col("start"), F.col("end"))).alias("end"))
    after = F.col("pos") >= F.col("start") if inclusive else F.col("pos") > F.col("start")
    body = per_file(rows, marks, "inner").where(after & (F.col("end").isNull() | (F.col("pos") < F.col("end"))))
    return body.drop("start", "end")


# Statement header, statement footers, other end marks.
STATEMENT_HEADER = "Tanggal Transaksi,Keterangan,Cabang,Jumlah,Saldo"
STATEMENT_FOOTERS = ["Saldo Awal", "Mutasi Debet", "Mutasi Kredit", "Saldo Akhir"]
TOTAL, CHECKSUM = "TOTAL", "SAMPLE CHECKSUM"


def is_header(signature: str = STATEMENT_HEADER) -> Column:
    return joined(",").contains(signature)


def is_footer(markers: Sequence[str] = tuple(STATEMENT_FOOTERS)) -> Column:
    return cell(0).rlike("|".join(markers))


def seek_header(rows: DataFrame, signature: str = STATEMENT_HEADER) -> DataFrame:
    return after_first(rows, is_header(signature))


def cut_footer(rows: DataFrame, markers: Sequence[str] = tuple(STATEMENT_FOOTERS)) -> DataFrame:
    return before_first(rows, is_footer(markers))


def cut_total(rows: DataFrame) -> DataFrame:
    return before_first(rows, F.upper(cell(0)).contains(TOTAL))


def is_checksum() -> Column:
    return F.upper(joined(" ")).contains(CHECKSUM)


def cut_checksum(rows: DataFrame) -> DataFrame:
    return before_first(rows, is_checksum())


def numeric_run(rows: DataFrame) -> DataFrame:
    """First run of rows whose first cell starts with an integer; a blank first cell does not end it."""
    numbered = cell(0).rlike(r"^\s*[+-]?\d")
    return between(rows, numbered, (cell(0) != "") & ~numbered, inclusive=True)


def drop_empty(rows: DataFrame) -> DataFrame:
    return rows.where(~is_empty())


def trim_trailing_empty(rows: DataFrame) -> DataFrame:
    """Drop empty rows at the end of each file; empty rows inside stay."""
    last = rows.groupBy("file").agg(F.max(F.when(~is_empty(), F.col("pos"))).alias("mark"))
    return per_file(rows, last, "inner").where(F.col("pos") <= F.col("mark")).drop("mark")


def header_and_tail_off(rows: DataFrame) -> DataFrame:
    """Rows without the first one of each file and without the empty rows at its end."""
    marks = rows.groupBy("file").agg(F.min("pos").alias("first"), F.max(F.when(~is_empty(), F.col("pos"))).alias("last"))
    return per_file(rows, marks, "inner").where((F.col("pos") > F.col("first")) & (F.col("pos") <= F.col("last"))).drop("first", "last")


def drop_blank_key(rows: DataFrame) -> DataFrame:
    return rows.where(cell(0) != "")


def min_columns(rows: DataFrame, count: int) -> DataFrame:
    return rows.where(F.col("width") >= count)


# Headers ---------------------------------------------------------------------------------------


def header_cell(c: Column, case: str | None = None, drop: str = "") -> Column:
    """One header cell: unwanted characters out, trimmed, inner spaces to underscores."""
    text = F.regexp_replace(c, drop, "") if drop else c
    text = F.regexp_replace(F.trim(text), r"\s+", "_")
    return F.upper(text) if case == "upper" else F.lower(text) if case == "lower" else text


def take_header(rows: DataFrame, case: str | None = None, drop: str = "", verbatim: bool = False, until: Column | None = None) -> DataFrame:
    """First row of each file as its ``header`` array next to every other row of that file, up to the first match of ``until``.

    Files of one source may order their columns differently; each keeps its own header.
    """
    first = rows.groupBy("file").agg(
        F.min("pos").alias("mark"),
        F.min_by("cells", "pos").alias("cells"),
        *([F.min(F.when(until, F.col("pos"))).alias("end")] if until is not None else []),
    )
    names = F.col("cells") if verbatim else F.transform("cells", lambda c: header_cell(c, case, drop))
    marks = first.select("file", "mark", names.alias("header"), *(["end"] if until is not None else []))
    body = per_file(rows, marks, "inner", HEADED).where(F.col("pos") > F.col("mark")).drop("mark")
    return body if until is None else body.where("end IS NULL OR pos < end").drop("end")


def has_column(name: str) -> Column:
    return F.array_contains("header", name)


def named(name: str) -> Column:
    """Cell under a header name; blank if the file has no such column."""
    at = F.array_position("header", name).cast("int")
    return F.coalesce(F.when(at > 0, F.get("cells", at - 1)), F.lit(""))


def by_position(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the header by position with a fixed list."""
    return rows.select("file", "pos", *[cell(i).alias(n) for i, n in enumerate(names)])


def by_name(rows: DataFrame, sources: Mapping[str, str], rest: str | None = None) -> DataFrame:
    """Target columns from source header names; a missing source gives blanks.

    ``rest`` names a column for the cells of all other header names.
    """
    others = [unlisted(rows, list(sources.values())).alias(rest)] if rest else []
    return rows.select("file", "pos", *[named(s).alias(t) for t, s in sources.items()], *others)


def unlisted(rows: DataFrame, listed: Sequence[str]) -> Column:
    """Cells under header names that are not listed, as a map from name to cell; NULL if there are none.

    Files of one source may carry different further columns, so they are one column of the result. Of a
    name that occurs twice, the last cell counts; a cell without a name is called by its place.
    """
    pairs = F.transform("cells", lambda c, i: F.struct(F.coalesce(F.get("header", i), F.lit("")).alias("name"), c.alias("cell"), i.alias("at")))
    other = F.filter(pairs, lambda p: ~p["name"].isin(list(listed)))
    named_pairs = F.transform(other, lambda p: F.struct(F.when(p["name"] == "", F.concat(F.lit("column "), p["at"] + 1)).otherwise(p["name"]), p["cell"]))
    entries = F.when(F.size(other) > 0, named_pairs)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["col1"] == e["col1"]))
    return F.map_from_entries(last)


def insert_if_missing(rows: DataFrame, column: str, at: int) -> DataFrame:
    """Insert a blank cell where a column is absent, so that later cells keep their place."""
    cells = F.col("cells")
    shifted = F.concat(F.slice(cells, 1, at), F.array(F.lit("")), F.slice(cells, at + 1, F.size(cells)))
    return rows.withColumn("cells", F.when(has_column(column), cells).otherwise(shifted))


def drop_cell(rows: DataFrame, at: int) -> DataFrame:
    """Remove the cell at a position."""
    cells = F.col("cells")
    return rows.withColumn("cells", F.concat(F.slice(cells, 1, at), F.slice(cells, at + 2, F.size(cells))))


def resplit_single_column(rows: DataFrame) -> DataFrame:
    """Rows that came as one comma-joined cell, split again without their outer quotes."""
    one = (F.col("width") == 1) & cell(0).contains(",")
    parts = F.transform(
        F.split(cell(0), ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', ""))
    )
    return rows.withColumn("cells", F.when(one, parts).otherwise(F.col("cells"))).withColumn(
        "width", F.when(one, F.size(parts)).otherwise(F.col("width"))
    )
