"""Groups of alike texts from the buckets in which they meet, without writing out the pairs of a bucket.

Texts are weighted sets of features, alike if the shared weight is ``t`` of the united weight at least. All pairs that are alike
and share a bucket end in one group, whatever the size of the bucket:

1. First, the member with most company over all its buckets stands for it, and each other member is verified against that one. Links join
   groups, and buckets that hold one group only, or two members, are done.
2. In what is left, round by round, each member x is verified against the lightest one, r. Let y be a partner of x, no lighter than r. If x and r
   are not alike, x and y share more weight than x and r do: ``|x & y| >= t / (1 + t) (|x| + |y|) > |x & r|``. So there are features that
   weigh more in both than in r, and of those they share as much at least as that bound exceeds ``|x & r|``. All members go on to
   buckets of single features beyond r, by a prefix of what lies beyond r, and r itself is done. If both are alike with r, they are in
   one group already. A member hands its prefix on as bytes, and only features that a member of another group in the bucket has too become rows (``met``).
3. Two kinds of buckets are settled at once, as their comparisons stay in proportion to their members: those where all but ``FEW`` members are of
   one group already (each of the few is verified against all others), and finer buckets of up to ``SMALL`` members (each by one task).

Rounds go on until no bucket holds two groups. A member of a bucket is verified a bounded number of times a round, and leaves when
nothing of it beyond r is shared with another member. Buckets of the same members are one bucket.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import dropped, map_batches, mix, sent_if_few, stored
from tripledger.llm.components import components

# Members of a bucket that one task compares among themselves.
SMALL = 64
# Members outside of a bucket's largest group that are compared with all others.
FEW = 4
# Members whose features beyond the lightest one are looked at together: the features of larger buckets are dealt by hash.
TOGETHER = 1024
# Bits of the filter that texts pass before they are joined with the keys of buckets.
KEY_BITS = 1 << 25


class Likeness(Protocol):
    """How texts are compared. It goes to the tasks, so what is large in it is a broadcast variable."""

    def bag(self, text: str) -> Any:
        """Features of a text."""

    def weight(self, bag: Any) -> float: ...

    def alike(self, x: Any, y: Any) -> bool: ...

    def prefix_beyond(self, x: Any, r: Any) -> np.ndarray:
        """Hashes of features of x beyond r, of which a partner of x, no lighter than r, has one in its own prefix beyond r."""


class Prefixes(Protocol):
    """What the index says of pairs before their texts are read. It may let pairs pass that are not alike, never the other way round."""

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b), those that may be alike."""

    def candidates(self, small: DataFrame) -> DataFrame:
        """Pairs (a, b) of different groups that may be alike, of buckets of up to ``SMALL`` members."""


def key_slot(key: str = "key") -> Column:
    """Place of a key among ``KEY_BITS`` bits."""
    return F.xxhash64(key).bitwiseAND(KEY_BITS - 1)


def maybe_in(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be wanted, by a filter of ``KEY_BITS`` bits: it passes all that are, so other texts stay out of the shuffle.

    At most 1,025 rows of 4 KB reach the driver.
    """
    slot = wanted.select((key_slot() + 1).alias("slot"))
    rows = slot.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).collect()
    # Numbers from 1 on fall into buckets of 32,768, counted from 1; the first number is the lowest bit.
    bits = bytearray(KEY_BITS >> 3)
    for row in rows:
        first = (row["bucket"] - 1) << 12
        bits[first : first + (1 << 12)] = row["bits"]
    shared = keyed.sparkSession.sparkContext.broadcast(bytes(bits))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flags, slots = np.frombuffer(shared.value, np.uint8), batch.column("slot").to_numpy()
        return batch.filter(pa.array((flags[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1)).select(["key", "text"])

    return map_batches(keyed.select("key", "text", key_slot().alias("slot")), run, "key binary, text string")


def wanted_texts(keyed: DataFrame, buckets: DataFrame) -> DataFrame:
    """key, text of all members of buckets, once each."""
    wanted = stored(buckets.select("key").distinct(), "bucket-keys")
    found = stored(maybe_in(keyed, wanted).join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "bucket-texts")
    dropped(wanted)
    return found


def crowded(buckets: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Rows of buckets that hold several groups: the group (``root``) of each member, the size of the bucket (``members``), its largest
    group (``main``) and how many members are outside of that (``others``).

    Of buckets of one ``line`` that have the same members, one is kept.
    """
    plain = buckets.select("band", "line", "key", "size")
    if groups is None:
        rooted = plain.withColumn("root", F.col("key"))
    else:
        # Read twice below: written, so that it is joined once.
        rooted = stored(plain.join(sent_if_few(groups, groups.count()), "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted")
    same = [F.expr("bit_xor(xxhash64(key))").alias("one"), F.expr("bit_xor(xxhash64(key, 1))").alias("other")]
    each = rooted.groupBy("band", "line", "root").agg(F.count("*").alias("n"), *same)
    largest = F.max(F.struct("n", "root")).alias("largest")
    whole = each.groupBy("band", "line").agg(F.sum("n").alias("members"), largest, *[F.expr(f"bit_xor({c})").alias(c) for c in ("one", "other")])
    full = whole.where("members > largest.n").groupBy("line", "members", "one", "other").agg(F.min(F.struct("band", "largest")).alias("kept"))
    full = full.select("kept.band", "members", F.col("kept.largest.root").alias("main"), (F.col("members") - F.col("kept.largest.n")).alias("others"))
    found = stored(rooted.join(full, "band").select("band", "line", "key", "size", "root", "members", "main", "others"), "buckets")
    if groups is not None:
        dropped(rooted)
    return found


def verified(pairs: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """Whether a and b are alike, the weight of a, and, for each of ``lines``, the features of a beyond b by part of the new line.

    ``pairs`` is a stored table: its rows are counted, and few pairs go to the texts. Else both sides read one shuffle of the texts.
    """
    rows = pairs.agg(F.sum(F.lit(1) + F.coalesce(F.size("lines"), F.lit(0)))).first()[0] or 0
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    rows = sent_if_few(pairs, rows).join(left, "a").join(right, "b").select("a", "b", "lines", "text_a", "text_b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[bytes, Any] = {}

        def bag(key: bytes, text: str) -> Any:
            if key not in known:
                known[key] = likeness.bag(text)
            return known[key]

        links, sizes, bands = [], [], []
        for a, b, lines, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "lines", "text_a", "text_b"))):
            x, r = bag(a, ta), bag(b, tb)
            links.append(likeness.alike(x, r))
            sizes.append(likeness.weight(x))
            bands.append([])
            if lines:
                prefix = likeness.prefix_beyond(x, r)
                own = np.uint64(int.from_bytes(b[:8], "little"))
                for line in lines:
                    lineage = mix(np.array([line["line"]], np.int64).view(np.uint64) * np.uint64(3) + own)
                    number, found = int(lineage.view(np.int64)[0]), mix(prefix + lineage)
                    part = (found >> np.uint64(20)).astype(np.int64) % line["parts"]
                    bands[-1] += [{"line": number, "part": p, "bands": found[part == p].tobytes()} for p in np.unique(part).tolist()]
        kind = pa.list_(pa.struct([("line", pa.int64()), ("part", pa.int64()), ("bands", pa.binary())]))
        columns = [batch.column("a"), batch.column("b"), pa.array(links, pa.bool_()), pa.array(sizes, pa.float64()), pa.array(bands, kind)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "alike", "size", "finer"])

    return map_batches(rows, run, "a binary, b binary, alike boolean, size double, finer array<struct<line:long,part:long,bands:binary>>")


def met(checked: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """line, band, key, size of the features that members of two groups of a line have at least; of features of the same members, one of a part.

    What only members of one group share can join nothing any more, and in a large group that is most of it.
    """
    if groups is None:
        rooted = checked.withColumn("root", F.col("a"))
    else:
        rooted = checked.join(groups.withColumnRenamed("key", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bands = [np.unique(np.frombuffer(b, np.int64)) for b in table.column("bands").to_pylist()]
        number: dict[bytes, int] = {}
        group = np.array([number.setdefault(r, len(number)) for r in table.column("root").to_pylist()], np.int64)
        every = np.concatenate([*bands, np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], np.repeat(np.arange(len(bands)), [len(b) for b in bands])[order]
        starts = np.flatnonzero(np.append(True, every[1:] != every[:-1])[: len(every)])
        ends = np.append(starts[1:], len(every))
        of = group[owner]
        several = np.minimum.reduceat(of, starts) < np.maximum.reduceat(of, starts) if len(starts) else np.zeros(0, bool)
        kept = {owner[i:j].tobytes(): (i, j) for i, j in zip(starts[several].tolist(), ends[several].tolist())}
        at = np.concatenate([*(np.arange(i, j) for i, j in kept.values()), np.zeros(0, np.int64)])
        columns = [pa.array(np.full(len(at), key[0].as_py(), np.int64)), pa.array(every[at])]
        columns += [table.column(c).take(pa.array(owner[at])) for c in ("key", "size")]
        return pa.table(columns, names=["line", "band", "key", "size"])

    parts = rooted.select(F.explode("finer").alias("f"), F.col("a").alias("key"), "size", "root").select("f.*", "key", "size", "root")
    return parts.groupBy("line", "part").applyInArrow(run, "line long, band long, key binary, size double")


def settled(small: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """Links between different groups inside buckets of at most ``SMALL`` members."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, bags = table.column("key").to_pylist(), [likeness.bag(t) for t in table.column("text").to_pylist()]
        root = list(table.column("root").to_pylist())
        found = []
        for j in range(len(keys)):
            for i in range(j):
                if root[i] != root[j] and likeness.alike(bags[i], bags[j]):
                    found.append((keys[i], keys[j]))
                    root = [root[i] if r == root[j] else r for r in root]
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return small.join(texts, "key").select("band", "key", "root", "text").groupBy("band").applyInArrow(run, "a binary, b binary")


def resolved(buckets: DataFrame, texts: DataFrame, likeness: Likeness, prefixes: Prefixes | None = None) -> tuple[DataFrame, DataFrame]:
    """Links found (a, b), and ``key, root`` of every linked text. ``buckets``: what ``crowded`` returned; it and the texts are used up.

    With ``prefixes``, pairs of the first round are read only if they may be alike, and its small buckets are settled by them.
    """
    spark = buckets.sparkSession
    no_lines = F.lit(None).cast("array<struct<line:long,parts:long>>").alias("lines")
    found: list[DataFrame] = []
    groups: DataFrame | None = None

    def joined(links: DataFrame) -> DataFrame | None:
        """The groups after some more links."""
        new = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        if new.isEmpty():
            return groups
        found.append(new)
        # Of earlier links, one per member and group is enough.
        earlier = [groups.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b"))] if groups is not None else []
        made = stored(components(reduce(DataFrame.unionByName, [found[-1], *earlier])), "groups")
        if groups is not None:
            dropped(groups)
        return made

    if not buckets.isEmpty():
        # Against the member with most company, the likeliest centre of a group.
        company = buckets.groupBy("key").agg(F.sum("members").alias("company"))
        hubs = buckets.join(company, "key").groupBy("band").agg(F.max(F.struct("company", "key", "root")).alias("hub"))
        hubs = hubs.select("band", F.col("hub.key").alias("b"), F.col("hub.root").alias("hub_root"))
        meets = buckets.join(hubs, "band").where("root <> hub_root").select(F.col("key").alias("a"), "b").distinct()
        if prefixes:
            meets = prefixes.likely(meets)
        meets = stored(meets, "pairs")
        checked = stored(verified(meets.select("a", "b", no_lines), texts, likeness), "verified")
        dropped(meets)
        groups = joined(checked.where("alike"))
        left = crowded(buckets.where("members > 2"), groups)
        dropped(buckets)
        dropped(checked)
        small = left.where(F.col("members") <= SMALL)
        if prefixes:
            some = stored(prefixes.candidates(small).distinct(), "candidates")
            groups = joined(verified(some.select("a", "b", no_lines), texts, likeness).where("alike"))
            dropped(some)
        else:
            groups = joined(settled(small, texts, likeness))
        buckets = crowded(left.where(F.col("members") > SMALL), groups)
        dropped(left)
    while not buckets.isEmpty():
        left = buckets
        # Only texts that are still in a bucket are read again.
        wanted = stored(left.select("key").distinct(), "bucket-keys")
        before, texts = texts, stored(texts.join(sent_if_few(wanted, wanted.count()), "key", "left_semi"), "bucket-texts")
        dropped(before)
        dropped(wanted)
        # The few outside of the largest group against all others.
        few = left.where(F.col("others") <= FEW)
        aside = few.where("root <> main").select("band", F.col("key").alias("b"), F.col("root").alias("b_root"))
        meets = few.join(aside, "band").where("root <> b_root AND (root = main OR key < b)")
        # In the other buckets, all against the lightest member; what lies beyond it decides who meets again.
        many = left.where(F.col("others") > FEW)
        light = F.min(F.struct("size", "key", "root")).alias("light")
        lightest = many.groupBy("band").agg(light).select("band", F.col("light.key").alias("b"))
        onward = many.join(lightest, "band").where(F.col("key") != F.col("b")).select(F.col("key").alias("a"), "b", "line").distinct()
        onward_rows = stored(onward, "onward")
        wide = onward_rows.groupBy("b", "line").agg((F.floor(F.count("*") / TOGETHER) + 1).alias("parts"))
        onward = onward_rows.join(wide, ["b", "line"]).select("a", "b", F.struct("line", "parts").alias("line"))
        pairs = onward.unionByName(meets.select(F.col("key").alias("a"), "b", F.lit(None).cast("struct<line:long,parts:long>").alias("line")))
        pairs = stored(pairs.groupBy("a", "b").agg(F.collect_set("line").alias("lines")), "pairs")
        checked = stored(verified(pairs, texts, likeness), "verified")
        # Who is alike with the lightest counts before the finer buckets are looked at.
        groups = joined(checked.where("alike"))
        finer = stored(met(checked, groups), "finer")
        narrow = crowded(finer, groups)
        groups = joined(settled(narrow.where(F.col("members") <= SMALL), texts, likeness))
        buckets = crowded(narrow.where(F.col("members") > SMALL), groups)
        for table in (left, onward_rows, pairs, checked, finer, narrow):
            dropped(table)
    links = reduce(DataFrame.unionByName, found, spark.createDataFrame([], "a binary, b binary"))
    return links.distinct(), groups if groups is not None else spark.createDataFrame([], "key binary, root binary")
