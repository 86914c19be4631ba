"""File names and file manifests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FileRule:
    """Which files belong to a source, by name."""

    contains: str = ""
    without: str = ""
    suffixes: tuple[str, ...] = ()
    not_prefix: str = ""

    def accepts(self, name: Column) -> Column:
        ok = F.lit(True)
        if self.contains:
            ok = ok & name.contains(self.contains)
        if self.without:
            ok = ok & ~name.contains(self.without)
        if self.not_prefix:
            ok = ok & ~name.startswith(self.not_prefix)
        if self.suffixes:
            ending = F.lit(False)
            for suffix in self.suffixes:
                ending = ending | F.lower(name).endswith(suffix)
            ok = ok & ending
        return ok


# The name patterns of the sources. Spreadsheets must arrive converted to CSV.
FILE_RULES = {
    "bank_bca": FileRule(contains="BCA_BankFile"),
    "bank_btn": FileRule(contains="SingleTransactionInquiry", without="_temp"),
    "bank_bni": FileRule(contains="BNI_BankFile"),
    "bank_mandiri": FileRule(contains="Acc_Statement"),
    "btn": FileRule(suffixes=(".csv",)),
    "bca": FileRule(suffixes=(".csv",)),
    "bni": FileRule(suffixes=(".csv",)),
    "kredivo": FileRule(suffixes=(".csv",)),
    "mandiri": FileRule(suffixes=(".csv",)),
    "shopeepay": FileRule(suffixes=(".csv",)),
    "indodana": FileRule(suffixes=(".csv",), not_prefix="~$"),
    "linkaja": FileRule(suffixes=(".csv",)),
    "ottopay": FileRule(suffixes=(".csv",)),
    "ottopay_dashboard": FileRule(suffixes=(".csv",)),
    "nobu": FileRule(suffixes=(".csv",)),
    "bri": FileRule(suffixes=(".csv",)),
}


# Never data, whatever the source: lock files of open workbooks and files under conversion.
LEFT_OVERS = FileRule(without="_temp", not_prefix="~$")


def not_left_over(name: Column) -> Column:
    return LEFT_OVERS.accepts(name)


def accepted(source: str, name: Column) -> Column:
    """Whether a file of that name is one of a source's own."""
    return LEFT_OVERS.accepts(name) & FILE_RULES[source].accepts(name)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths, names and sizes of a folder's files; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length", "modificationTime")
    return files.withColumn("name", F.substring_index("path", "/", -1))


def select_files(files: DataFrame, source: str) -> DataFrame:
    return files.where(FILE_RULES[source].accepts(F.col("name")))


def stem(name: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(name, r"\.[^/.]+$", "")


def output_name(name: Column, suffix: str = "") -> Column:
    return F.concat(stem(name), F.lit(f"{suffix}.csv"))


def underscored_name(name: Column) -> Column:
    return F.concat(F.replace(name, F.lit("-"), F.lit("_")), F.lit(".csv"))


def date_ranges(rows: DataFrame, day: Column, by: Sequence[str] = ("file",)) -> DataFrame:
    """First and last day, row count and a range label per file (``NA`` if no day can be read)."""
    ranges = rows.groupBy(*by).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("row_count")
    )
    first, last = [F.col(c).cast("string") for c in ("first_day", "last_day")]
    label = (
        F.when(first.isNull(), "NA")
        .when(first == last, first)
        .otherwise(F.concat(first, F.lit("_sampai_"), last))
    )
    return ranges.withColumn("label", label)


def first_row_days(rows: DataFrame, day: Column) -> DataFrame:
    """Day of the first row of each file, for names that go by it."""
    return rows.groupBy("file").agg(F.min_by(day, "pos").alias("first_row_day"))


def day_name(prefix: str, day: Column, pattern: str = "yyyy-MM-dd", missing: str = "0000-00-00") -> Column:
    """Output name by a day; ``missing`` stands for one that can't be read."""
    return F.concat(F.lit(prefix), F.coalesce(F.date_format(day, pattern), F.lit(missing)), F.lit(".csv"))


def range_name(prefix: str, first: Column, last: Column, pattern: str = "ddMMyyyy") -> Column:
    """Output name by the days a file spans, one day once."""
    a, b = F.date_format(first, pattern), F.date_format(last, pattern)
    return F.concat(F.lit(prefix), F.when(a.isNull(), "unknown").when(a == b, a).otherwise(F.concat_ws("-", a, b)), F.lit(".csv"))


def latest_day_name(prefix: str, last_day: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Output name by the latest day of the data; ``unknown`` if there is none."""
    day = F.coalesce(F.date_format(last_day, pattern), F.lit("unknown"))
    return F.concat(F.lit(prefix), day, F.lit(".csv"))
