"""Typed loads of normalised files: fixed schema, no row silently dropped or half-read."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.shaping import leading_marks
from tripledger.schemas import TABLES, LandedTable
from tripledger.session import scratch_root
from tripledger.sources import raw
from tripledger.sources.commits import landed, write_table

# A clock of the day, seconds optional; a whole day, a clock optional.
CLOCK = r"^([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d(\.\d+)?)?$"
DAY = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?$"


def clock(value: Column) -> Column:
    """``HH:mm:ss`` of a clock, zero-padded so that text compares like time; NULL if it is no clock."""
    text = F.trim(value)
    parts = F.split(F.split_part(text, F.lit("."), F.lit(1)), ":")
    two = [F.lpad(F.coalesce(F.get(parts, F.lit(i)), F.lit("0")), 2, "0") for i in range(3)]
    fraction = F.regexp_extract(text, r"\.\d+$", 0)
    return F.when(text.rlike(CLOCK), F.concat(F.concat_ws(":", *two), fraction))


def typed(value: Column, kind: str, is_clock: bool = False) -> Column:
    """Landed value of a text cell; NULL if blank or bad. Slashed dates are read as dashed."""
    if is_clock:
        return clock(value)
    if kind == "string":
        return F.nullif(value, F.lit(""))
    text = F.nullif(F.trim(value), F.lit(""))
    if kind in ("date", "timestamp_ntz"):
        # A year or a month alone would be cast to its first day.
        text = F.replace(text, F.lit("/"), F.lit("-"))
        text = F.when(text.rlike(DAY), text)
    return text.try_cast(kind)


def _kinds(table: LandedTable) -> list[tuple[str, str, bool]]:
    clocks = [part.split()[1] == "TIME" for part in table.declared.split(",")]
    return [(n, k, is_clock) for (n, k), is_clock in zip(table.columns, clocks)]


# Columns of landed values beside the text that they were read from.
LANDED = "landed "


def _checked(table: LandedTable) -> list[tuple[str, str, bool]]:
    """Columns whose text may be bad."""
    return [k for k in _kinds(table) if k[1] != "string" or k[2]]


def _with_landed(rows: DataFrame, table: LandedTable) -> DataFrame:
    """Rows of text with the landed values of checked columns: both the faults and the landed row look at them, so each is made once."""
    return rows.withColumns({f"{LANDED}{n}": typed(F.col(f"`{n}`"), kind, is_clock) for n, kind, is_clock in _checked(table)})


def _fault(name: str) -> Column:
    """Column name if its cell holds something that is not of the declared type."""
    return F.when((F.trim(F.col(f"`{name}`")) != "") & F.col(f"`{LANDED}{name}`").isNull(), name)


def _header_marks(records: DataFrame, count: int) -> DataFrame:
    """Place where the header of each file ends; of at most one row, it takes no order to find it."""
    if count > 1:
        return leading_marks(records, count)
    return records.groupBy("file").agg((F.min("pos") - (1 - count)).alias("mark"))


def read_normalised(
    spark: SparkSession,
    path: str,
    table: LandedTable,
    sep: str = ";",
    header_rows: int = 1,
    quoted_newlines: bool = True,
) -> DataFrame:
    """Rows as text in declared columns, with ``fault``: what makes a row bad, NULL for a good row.

    Columns are taken by position and the header is skipped. ``path`` is a folder or a glob and is
    not searched below its own level.
    """
    return _text(_judged(spark, path, table, sep, header_rows, quoted_newlines))


def _text(rows: DataFrame) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith(LANDED)])


def _judged(spark: SparkSession, path: str, table: LandedTable, sep: str = ";", header_rows: int = 1, quoted_newlines: bool = True) -> DataFrame:
    """What ``read_normalised`` returns, with the landed values."""
    names = [n for n, _ in table.columns]
    records = raw.read_records(spark, path, sep, quoted_newlines)
    data = F.col("pos") > F.col("mark")
    body = raw.filled(raw.per_file(records, _header_marks(records, header_rows), "inner").where(data))
    rows = body.withColumn("cells", raw.line_cells(F.col("line"), sep)).select(
        *[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)],
        F.when(F.size("cells") != len(names), F.array_join("cells", sep)).alias("bad_row"),
        data.alias("data"),
    )
    shape = F.when(F.col("bad_row").isNotNull(), "row width")
    faults = [shape] + [_fault(n) for n, _, _ in _checked(table)]
    # A filter on a loaded column may be pushed below the step that drops the header rows: those have no faults.
    return _with_landed(rows, table).withColumn("fault", F.when(F.col("data"), F.coalesce(*faults))).drop("data")


def _typed_columns(table: LandedTable) -> list[Column]:
    checked = {n for n, _, _ in _checked(table)}
    return [(F.col(f"`{LANDED}{n}`") if n in checked else typed(F.col(f"`{n}`"), k)).alias(n) for n, k, _ in _kinds(table)]


def load_strict(spark: SparkSession, path: str, table: str, **reading) -> DataFrame:
    """Typed table; the first bad row fails the load.

    """
    declared = TABLES[table]
    rows = _judged(spark, path, declared, **reading)
    message = F.concat(F.lit(f"{table}: bad "), F.col("fault"))
    row = F.when(F.col("fault").isNull(), F.struct(*_typed_columns(declared)))
    return rows.select(row.otherwise(F.raise_error(message)).alias("row")).select("row.*")


def _sides(rows: DataFrame, declared: LandedTable) -> DataFrame:
    """Rows of text with ``fault`` and landed values as one frame of both sides: ``good`` (typed) or ``bad`` (as text), and which one it is."""
    good = F.col("fault").isNull()
    text_columns = [c for c in _text(rows).columns if c != "data"]
    return rows.select(
        F.when(good, F.struct(*_typed_columns(declared))).alias("good"),
        F.when(~good, F.struct(*[F.col(f"`{c}`") for c in text_columns])).alias("bad"),
        F.when(good, "good").otherwise("bad").alias("side"),
    )


def _split(rows: DataFrame, declared: LandedTable, path: str) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows from one read: written once, partitioned by side, each side read from its own folder."""
    sides = _sides(rows, declared)
    sides.write.partitionBy("side").parquet(path)
    written = rows.sparkSession.read.schema(sides.schema).parquet(path)
    return written.where("side = 'good'").select("good.*"), written.where("side = 'bad'").select("bad.*")


def load_with_quarantine(
    spark: SparkSession, path: str, table: str, **reading
) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and bad rows as text with the reason. The files are read once, when this is called."""
    declared = TABLES[table]
    rows = _judged(spark, path, declared, **reading)
    return _split(rows, declared, f"{scratch_root(spark)}/sides/{table}-{uuid.uuid4().hex}")


def land(rows: DataFrame, table: str, target: str, quarantine: str, disposition: str = "truncate") -> None:
    """Formatted rows (``formatters.for_load`` with ``rejected``) into a landed table; bad ones into its quarantine, with ``fault``.

    A cell that could not be normalised is a fault like one that is not of its declared type: a day that does not exist never
    lands as a legal blank. Rows are read once. Both tables change as ``write_table`` does it, the quarantine first.
    """
    declared = TABLES[table]
    faults = [F.col("rejected")] if "rejected" in rows.columns else []
    faults += [_fault(n) for n, _, _ in _checked(declared)]
    marked = _with_landed(rows, declared).withColumn("fault", F.coalesce(*faults)).drop("rejected")
    good, bad = _split(marked, declared, f"{scratch_root(rows.sparkSession)}/sides/{table}-{uuid.uuid4().hex}")
    write_table(bad, quarantine, disposition)
    write_table(good, target, disposition, keep_replaced=True)


def load_all(
    spark: SparkSession,
    project: str,
    warehouse: str,
    tables: Iterable[str] = tuple(TABLES),
    at_once: int = len(TABLES),
    partition: Callable[[DataFrame, str], tuple[DataFrame, Sequence[str]]] | None = None,
) -> Mapping[str, str]:
    """Load every registered table from its folder, several at a time, replacing what was there.

    The loads are independent Spark jobs; the threads only wait for them. A load that is refused leaves its table as it
    was, and one that is read meanwhile changes as a whole (``sources.commits``). ``partition`` returns a table's rows as they
    are to be written, and the columns to partition them by.
    """

    def one(name: str) -> tuple[str, str]:
        target = f"{warehouse}/{name}"
        source = f"{project}/{TABLES[name].folder}/*.csv{{,.gz}}"
        rows, columns = load_strict(spark, source, name), ()
        if partition:
            rows, columns = partition(rows, name)
        write_table(rows, target, keep_replaced=True, partition_by=columns)
        return name, target

    with ThreadPoolExecutor(at_once) as pool:
        return dict(pool.map(one, tables))


def all_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {name: landed(spark, f"{warehouse}/{name}") for name in TABLES}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per loaded table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)
