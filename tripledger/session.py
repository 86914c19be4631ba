"""Session settings and the shared scratch folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on: adaptive re-planning (coalescing, skewed joins, run-time
# broadcast only below the size limit) and a zone-free clock.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_root: dict[str, str] = {}
_written: dict[tuple[str, str], str] = {}
# Settings in use by ``setting``: how many hold them, and what was set before the first.
_held: dict[tuple[int, str], tuple[int, str | None]] = {}
_held_lock = threading.Lock()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripledger")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local
    folder would be lost with its executor, so the setting is required there.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tripledger/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="tripledger-")
    return _local_root[app]


def written_once(
    spark: SparkSession, name: str, write: Callable[[str], None]
) -> str:
    """Path of an intermediate dataset, written on first use and shared by later queries."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _written:
        path = f"{scratch_root(spark)}/{name}"
        write(path)
        _written[key] = path
    return _written[key]


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting while some steps run. Of several threads that hold it, the last one to end restores what was set before."""
    at = (id(spark), key)
    with _held_lock:
        count, before = _held.get(at) or (0, spark.conf.get(key, None))
        spark.conf.set(key, value)
        _held[at] = (count + 1, before)
    try:
        yield
    finally:
        with _held_lock:
            count, before = _held.pop(at)
            if count > 1:
                _held[at] = (count - 1, before)
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """While this is held, the shuffle files of a write go as soon as it ends, not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed now, written to the scratch folder and read from there: later plans hold a scan of its files."""
    path = f"{scratch_root(df.sparkSession)}/kept/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
