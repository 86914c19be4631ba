"""What the operators share: session settings, stored intermediates, word hashes."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.session import configure, read_table, scratch_root, setting

# Rows and bytes per Arrow batch: a batch of very long texts stays small in a Python worker. Shuffle files go as soon as
# the query that wrote them ends, so operators of several steps need the disk of their largest step only.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "400",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Python workers import this package from where the driver has it; elsewhere it is installed or shipped with the job.
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(prepare(spark), folder, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Rows that are sent to all tasks at once by their number.
SENT_ROWS = 1 << 15
LIMIT = "spark.sql.autoBroadcastJoinThreshold"
LIMIT_MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that run while this is held send a table to all tasks if its rows were measured to be within Spark's limit, or counted (``sent_if_few``).

    Else the size of its files decides. Rows of few keys, as those of large buckets are, take up to 40 times as much in the memory of the
    driver, which puts together what is sent.
    """
    limit = spark.conf.get(LIMIT_MEASURED, None) or spark.conf.get(LIMIT)
    with setting(spark, LIMIT_MEASURED, limit), setting(spark, LIMIT, "-1"):
        yield


def sent_if_few(table: DataFrame, stored_rows: int) -> DataFrame:
    """``table``, sent to all tasks if the stored rows that it is made of are few."""
    return F.broadcast(table) if stored_rows <= SENT_ROWS else table


def text_key(text: str | Column = "text") -> Column:
    """16-byte identity of a text; a null text is the empty text."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.unhex(F.md5(c))


def training_row(doc_id: str = "doc_id") -> Column:
    """True for rows that a model may learn from: crc32 of the id as text, mod 5, is not 0 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))


def held_out(doc_id: str = "doc_id") -> Column:
    return ~training_row(doc_id)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` on each Arrow batch of ``df``; it returns columns in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# Rolling sums are taken in the ring of 64-bit integers, where an odd base has an inverse.
BASE = 0x9E3779B97F4A7C15
_byte_codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_powers: list[tuple[np.ndarray, np.ndarray]] = []
# Powers up to here are kept per worker.
KEPT_POWERS = 1 << 22


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse for i below n (at least)."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length())
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = BASE, pow(BASE, -1, 1 << 64)
        made = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size > KEPT_POWERS:
            return made
        _powers[:] = [made]
    return _powers[0]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Rolling sums of a byte array: ``hash_spans`` gives the hash of any span from them."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _byte_codes[data]
    terms *= up[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def hash_spans(sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """64-bit hashes of the spans ``[start, end)`` by their bytes alone."""
    _, down = powers(len(sums))
    out = sums[ends] - sums[starts]
    out *= down[starts]
    return out


# Bytes that belong to a word: letters and digits, and all of a letter outside ASCII.
_word_byte = np.zeros(256, bool)
_word_byte[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def word_edges(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of ``text`` in lower case, and start and end of each word: a run of letters, digits or non-ASCII."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    edges = np.flatnonzero(np.diff(_word_byte[data], prepend=False, append=False))
    return data, edges[::2], edges[1::2]


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word of ``text``."""
    data, starts, ends = word_edges(text)
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix(hash_spans(prefix_sums(data), starts, ends) ^ (ends - starts).astype(np.uint64))
