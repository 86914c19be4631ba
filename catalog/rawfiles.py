"""Raw report files rendered by Spark from the payments: one per supplier and source.

A file has head lines, one record per payment, and foot lines. Their number grows with the data and their size does not, so the
files of a source are written once to the scratch folder as one pack (``sources.raw``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.standins import payments
from tripledger.session import read_table, written_once
from tripledger.sources import raw

FILE = "concat('file_key=', file_key, '/report.csv')"


def rendered(spark, folder: str, name: str, record: str, head=(), foot=(), file: str = FILE) -> str:
    """Pack of the rendered files. ``record`` is a Spark SQL text expression over a payment;
    ``head``, ``foot`` and ``file`` (the name) are text expressions that may use ``file_key``."""

    def fixed(section, lines):
        keys = read_table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("file_key")).distinct()
        return keys.select("file_key", F.lit(section).alias("section"), F.posexplode(F.array(*[F.expr(e) for e in lines]))).toDF(
            "file_key", "section", "seq", "value"
        )

    def write(path):
        rows = payments(spark, folder).select(
            F.col("supp").alias("file_key"), F.lit(1).alias("section"), F.col("trx_id").alias("seq"), F.expr(record).alias("value")
        )
        for section, lines in ((0, head), (2, foot)):
            if lines:
                rows = rows.unionByName(fixed(section, lines))
        raw.write_pack(rows.withColumn("file", F.expr(file)), path, ["section", "seq"])

    return written_once(spark, f"raw/{name}/{folder.strip('/').replace('/', '_')}{raw.PACK}", write)
