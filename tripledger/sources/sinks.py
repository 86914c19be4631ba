"""Delimited sinks. Cells are always escaped, so a separator or line break inside a cell survives."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.sources.commits import Files

# Of Hadoop's codecs. The usual level takes several times the time of this one, for files that are little smaller.
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}
# Tasks that write one named sink: names are spread over them by range, so that a large file is written by several.
NAMED_PARTS = 64


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ";",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> None:
    """Normalised dataset: header, one separator, RFC-style quoting, blank for empty.

    With ``compression`` (``gzip``, at its fastest level) a file takes a fraction of the disk, but is read by one task.
    """
    writer = df.write.mode(mode).options(
        header=True, sep=sep, quote='"', escape='"', emptyValue="", nullValue=""
    )
    if compression:
        writer = writer.options(**{"compression": compression, **FAST_GZIP})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_named(rows: DataFrame, names: DataFrame, folder: str, sep: str = ";", parts: int = NAMED_PARTS) -> list[str]:
    """Write the rows of each input ``file`` under the output name that ``names`` (columns file, name) has for it.

    Two phases: all rows go to a hidden folder, partitioned by name; then the files take their names. A name that several tasks
    wrote becomes ``x.csv``, ``x.2.csv`` and so on, in the order of ``pos``. Inputs of one name are written one after the other. Files of those
    names from an earlier run are replaced, others stay. Columns ``file`` and ``pos`` are not written. Returns the names written.
    """
    target, staged = Files(rows.sparkSession, folder), f"_staged-{uuid.uuid4().hex}"
    columns = [c for c in rows.columns if c not in ("file", "pos")]
    named = rows.join(names.select("file", F.col("name").alias("__name")), "file")
    ordered = named.repartitionByRange(parts, "__name", "file", "pos").sortWithinPartitions("__name", "file", "pos")
    written = []
    try:
        write_delimited(ordered.select(*[f"`{c}`" for c in columns], "__name"), f"{target.folder}/{staged}", sep, partition_by=["__name"])
        by_name: dict[str, list[str]] = {}
        for path in target.names(staged, hidden=True):
            label, _, part = path.partition("/")
            if part and not part.startswith(("_", ".")):
                by_name.setdefault(unquote(label.removeprefix("__name=")), []).append(path)
        for name, paths in sorted(by_name.items()):
            stem, dot, ending = name.rpartition(".")
            for i, path in enumerate(sorted(paths)):
                own = name if not i else f"{stem}.{i + 1}.{ending}" if dot else f"{name}.{i + 1}"
                target.delete(own)
                target.move(f"{staged}/{path}", own)
                written.append(own)
    finally:
        target.delete(staged)
    return written
