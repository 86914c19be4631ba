"""Connected components of links, by alternating star joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import dropped, stored


# So many edges are joined by one task: fewer than a single round of joins is worth.
FEW_EDGES = 10_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    """``key, root`` of at most ``FEW_EDGES`` edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[bytes, bytes] = {}

        def root(key: bytes) -> bytes:
            while above.setdefault(key, key) != key:
                above[key] = above[above[key]]
                key = above[key]
            return key

        for batch in batches:
            for a, b in zip(batch.column("high").to_pylist(), batch.column("low").to_pylist()):
                a, b = sorted((root(a), root(b)))
                above[b] = a
        keys = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([root(k) for k in keys], pa.binary())], names=["key", "root"])

    return edges.coalesce(1).mapInArrow(run, "key binary, root binary")


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(high, low))")).first())


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``key, root`` for every end of ``links`` (columns a, b): root is the smallest key of the component.

    With ``rounds``, at most so many are made: keys of one root are connected then, but a component may still have several.

    Each round points all neighbours of a node to the smallest one: first the larger neighbours, then the smaller ones and
    the node itself. Both are aggregations of edges; rounds grow with the logarithm of a component's diameter. Edges are
    written per round, so a lost executor costs one round at most.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct(), "edges")
    state, made = _state(edges), 0
    if rounds is None and state[0] <= FEW_EDGES:
        return _in_one_task(edges)
    while state[0] and made != rounds:
        made += 1
        # Larger neighbours of a node point to the smallest node around it.
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        around = both.groupBy("high").agg(F.min("low").alias("least")).select(F.col("high").alias("low"), F.least("least", "high").alias("least"))
        pushed = edges.join(around, "low").select("high", F.col("least").alias("low"))
        # A node's smaller neighbours, and the node, point to the smallest of them.
        least = pushed.groupBy("high").agg(F.min("low").alias("least"))
        small = pushed.join(least, "high").where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        after = stored(small.unionByName(least.withColumnRenamed("least", "low")).distinct(), "edges")
        dropped(edges)
        before, edges = state, after
        if made == rounds:
            break
        state = _state(after)
        if state == before:
            break
    roots = edges.select(F.col("low").alias("key"), F.col("low").alias("root"))
    ends = edges.select(F.col("high").alias("key"), F.col("low").alias("root")).unionByName(roots)
    return ends.groupBy("key").agg(F.min("root").alias("root"))
