"""Tables stored by the hash of a key: joins of two of them on it, and distinct counts of it, need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripledger.session import scratch_root


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, folder: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` in ``buckets`` files by ``key``, sorted by it, and read it from there.

    Tables that are to be joined need the same number of buckets, and a key of the same type. Rows are dealt by the key first, so
    each bucket is one file. ``folder`` is where the table lives; without one it is an intermediate.
    """
    spark = df.sparkSession
    path = f"{folder or scratch_root(spark) + '/bucketed'}/{name}"
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)
