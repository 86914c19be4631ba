"""Sharding by extendible hashing.

A directory is indexed by the first bits of a row's hash. A bucket that holds more bytes than a shard may hold is split
on the next bit, and only such buckets are: the shard of a row is the shortest prefix of its hash whose rows fit.

Bits are taken in steps. A step sums bytes per cell (rows that agree on all bits so far), adds the cells up to
all shorter prefixes of the step, and gives each cell its first prefix that fits. Only rows of cells that are still too
large go on to the next step, so the number of jobs depends on the directory's depth, not on the number of shards.

A row larger than the limit gets a shard of its own. Null and empty texts have no bytes. Rows equal in id and
text share the first ``CONTENT_BITS`` bits; the bits after those come from the row's place in the input, so that copies
that do not fit one shard are split like others. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import stored

CONTENT_BITS = 36
PLACE_BITS = 24
BITS = CONTENT_BITS + PLACE_BITS
STEP = 12


def hashed_rows(docs: DataFrame) -> DataFrame:
    """Id, hash bits and bytes of each row; 60 bits fit a long."""
    identity = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))
    content = F.conv(F.substring(F.md5(identity), 1, CONTENT_BITS // 4), 16, 10).cast("long")
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << PLACE_BITS) - 1)
    return docs.select(
        "doc_id",
        F.shiftleft(content, PLACE_BITS).bitwiseOR(place).alias("bits"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )


def directory(rows: DataFrame, limit_bytes: int, first: int, last: int) -> DataFrame:
    """Per cell of ``last`` bits: depth, prefix and size of its bucket; depth is null while no prefix fits."""
    cells = rows.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
    nodes = cells.select(
        "cell", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth"), "bytes", "docs"
    ).withColumn("prefix", F.expr(f"shiftright(cell, {last} - depth)"))
    sizes = nodes.groupBy("depth", "prefix").agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
    )
    fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1) | (F.col("depth") >= BITS)
    leaf = F.min(F.when(fits, F.struct("depth", "prefix", "shard_bytes", "shard_docs")))
    return nodes.select("cell", "depth", "prefix").join(sizes, ["depth", "prefix"]).groupBy("cell").agg(leaf.alias("leaf"))


def extendible_shards(docs: DataFrame, limit_bytes: int) -> DataFrame:
    """Shard of every row: ``shard`` is the bucket's prefix in binary (empty if one shard holds all)."""
    rows = stored(hashed_rows(docs), "shard-rows")
    parts = []
    for first in range(0, BITS, STEP):
        last = first + STEP
        rows = rows.withColumn("cell", F.shiftright("bits", BITS - last))
        cells = stored(directory(rows, limit_bytes, first and first + 1, last), "shard-cells")
        parts.append(rows.join(cells.where("leaf is not null"), "cell"))
        full = cells.where("leaf is null")
        if full.isEmpty():
            break
        rows = rows.join(full.select("cell"), "cell", "left_semi").select("doc_id", "bits", "n_bytes")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    path = F.when(F.col("leaf.depth") == 0, "").otherwise(F.lpad(F.bin("leaf.prefix"), F.col("leaf.depth"), F.lit("0")))
    return found.select(
        "doc_id", "n_bytes", path.alias("shard"), F.col("leaf.depth").alias("depth"),
        F.col("leaf.shard_bytes").alias("shard_bytes"), F.col("leaf.shard_docs").alias("shard_docs"),
    )


def oracle(limit_bytes: int) -> str:
    """The same by windows over every prefix length; exact while no bucket needs bits of the place."""
    return f"""
    WITH rows AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) AS n_bytes,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || md5(coalesce(text, ''))), 1,
          {CONTENT_BITS // 4}) AS BIGINT) AS bits
      FROM documents),
    nodes AS (
      SELECT r, doc_id, n_bytes, d.depth, bits >> ({CONTENT_BITS} - d.depth) AS prefix,
        sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_docs
      FROM rows, (SELECT CAST(unnest(range(0, {CONTENT_BITS + 1})) AS INTEGER) AS depth) d
      WINDOW w AS (PARTITION BY d.depth, bits >> ({CONTENT_BITS} - d.depth))),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY r ORDER BY depth) AS k FROM nodes
      WHERE shard_bytes <= {limit_bytes} OR shard_docs = 1)
    SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
      CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, depth,
      CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs
    FROM leaves WHERE k = 1"""
