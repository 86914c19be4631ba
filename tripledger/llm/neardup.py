"""Near-duplicate texts by improved consistent weighted sampling (ICWS).

A text is the bag of its five-word shingles. A shingle weighs ``1 + ln(tf)`` times its idf, and two texts are as alike as their
weighted Jaccard similarity, the sum of smaller weights over the sum of larger ones. ICWS draws a sample of each text so that
two texts draw the same with just that probability; ``ROWS`` samples make a band, and texts that agree on one of ``BANDS``
bands meet in a bucket. With 16 bands of 4, a pair of similarity 0.8 meets with probability 0.9998.

Document frequencies come from all documents, counted in a table of fixed size (``DF_SLOTS``) by hash, with the mean
count of other shingles, and what that varies by, taken off: a frequency that can't be told from chance counts as that of a rare shingle. idf is damped to ``[1, 1 + IDF_SPAN]``: near copies raise the frequency of all they share, so a
full idf would push the members of a large family apart.

A bucket does not give all its pairs: its members are compared with representatives of the bucket, on their whole texts, until it
holds one group (``buckets``). The number of comparisons follows the members of buckets, not their pairs, and two alike texts that
share a bucket always end in one class; only that they meet in a bucket is left to sampling.

Equal texts are one text throughout. Texts of fewer than five words have one shingle of all words; texts without words (null and
empty ones too) are alike only if equal. Ties of representatives go to the smaller text key. A null doc_id stands last in its class.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.buckets import crowded, resolved, wanted_texts
from tripledger.llm.common import dropped, free_name, map_batches, mix, stored, text_key, texts_of, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 4
# Shingles that are sampled side by side: so many fit a core's cache.
SIDE_BY_SIDE = 1 << 14
DF_SLOTS = 1 << 20
IDF_SPAN = 0.1
# Standard deviations of a slot's count that other shingles may make.
CHANCE = 3
# Rows of counts that a task hands on at once.
DF_CHUNK = 1 << 14


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of a text and how often each occurs."""
    words = word_hashes(text)
    if not len(words):
        return words, np.zeros(0, np.int64)
    n = max(1, len(words) - WORDS + 1)
    total = np.full(n, WORDS, np.uint64)
    for i in range(min(WORDS, len(words))):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return np.unique(mix(total), return_counts=True)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(DF_SLOTS)).astype(np.int64)


class Frequencies:
    """Documents, and documents per shingle slot."""

    def __init__(self, n: int, slots: np.ndarray):
        self.n, self.slots = n, slots
        self.noise = slots.sum(dtype=np.int64) / DF_SLOTS

    def weights(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        df = np.maximum(1.0, self.slots[_slot(hashes)] - self.noise - CHANCE * np.sqrt(self.noise))
        idf = 1 + IDF_SPAN * (1 - np.minimum(1.0, np.log1p(df) / np.log1p(max(2, self.n))))
        return (1 + np.log(counts)) * idf


def document_frequencies(docs: DataFrame) -> Frequencies:
    """Counts over all documents; what reaches the driver has a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, n = np.zeros(DF_SLOTS, np.int64), 0
        for batch in batches:
            for text in texts_of(batch):
                hashes, _ = shingles(text)
                slots[np.unique(_slot(hashes))] += 1
                n += 1
        chunks = slots.reshape(-1, DF_CHUNK)
        used = np.flatnonzero(chunks.any(1)) if n else np.zeros(0, np.int64)
        values = [pa.array(used, pa.int64()), pa.array([chunks[i].astype("<u4").tobytes() for i in used], pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([values[0], pa.array([-1], pa.int64())]), pa.concat_arrays([values[1], pa.array([np.int64(n).tobytes()], pa.binary())])],
            names=["chunk", "counts"],
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chunk = 0, None
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                total = total + np.frombuffer(counts, "<i8" if chunk < 0 else "<u4").astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "counts"])

    schema = "chunk long, counts binary"
    parts = docs.select("text").mapInArrow(run, schema)
    slots, n = np.zeros(DF_SLOTS, np.int64), 0
    for row in parts.groupBy("chunk").applyInArrow(add, schema).collect():
        values = np.frombuffer(row["counts"], np.int64)
        if row["chunk"] < 0:
            n = int(values[0])
        else:
            slots[row["chunk"] * DF_CHUNK : (row["chunk"] + 1) * DF_CHUNK] = values
    return Frequencies(n, slots)


class Sampler:
    """ICWS with hashes in place of random numbers: the same shingle draws the same everywhere."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.seeds = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # Pairs of Gamma(2, 1) draws: 16 bits of a hash pick one.
        draws = rng.gamma(2, 1, (2, 1 << 16))
        self.r, self.log_c = draws[0].astype(np.float32), np.log(draws[1]).astype(np.float32)
        self.pace = 1 / self.r

    def bands_of(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row of band hashes per bag (hashes, weights); no bag is empty."""
        hashes = np.concatenate([h for h, _ in bags])
        logs = np.log(np.concatenate([w for _, w in bags])).astype(np.float32)
        starts = np.cumsum([0, *(len(h) for h, _ in bags[:-1])])
        place = np.arange(len(hashes))
        samples = np.zeros((len(self.seeds), len(bags)), np.uint64)
        for j, seed in enumerate(self.seeds):
            x = hashes * seed
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xD6E8FEB86659FD93)
            draw = (x >> np.uint64(48)).astype(np.int32)
            beta = ((x >> np.uint64(16)).astype(np.uint16)).astype(np.float32)
            beta *= np.float32(1 / 65536)
            t = logs * self.pace[draw]
            t += beta
            np.floor(t, out=t)
            # ln a = ln c - r (t - beta) - r
            beta -= t
            beta -= 1
            beta *= self.r[draw]
            beta += self.log_c[draw]
            # The bits of a float in an integer of the same order, the place below.
            order = beta.view(np.int32)
            order = (order ^ ((order >> 31) & 0x7FFFFFFF)).astype(np.int64)
            order <<= 32
            order |= place
            picked = np.minimum.reduceat(order, starts) & 0xFFFFFFFF
            samples[j] = mix(hashes[picked] + mix(t[picked].astype(np.int64).view(np.uint64)))
        out = np.tile(np.arange(self.bands, dtype=np.uint64) + np.uint64(1), (len(bags), 1))
        for row in samples.reshape(self.bands, self.rows, len(bags)).transpose(1, 2, 0):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + row)
        return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted hashes, weights) bags."""
    shared, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][at], b[1][bt]).sum()
    total = a[1].sum() + b[1].sum() - both
    return float(both / total) if total else 0.0


def band_rows(docs: DataFrame, frequencies) -> DataFrame:
    """band (hash, the band's number mixed in), key and weight (``size``) of every text with words; equal texts once."""
    sampler = Sampler()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, owner, bags, weights, seen, size = [], [], [], [], set(), 0
        for i, (key, text) in enumerate(zip(batch.column("key").to_pylist(), texts_of(batch))):
            if key in seen:
                continue
            seen.add(key)
            hashes, counts = shingles(text)
            if len(hashes):
                bags.append((hashes, frequencies.value.weights(hashes, counts)))
                owner += [i] * BANDS
                weights += [float(bags[-1][1].sum())] * BANDS
                size += len(hashes)
            if size >= SIDE_BY_SIDE:
                found.append(sampler.bands_of(bags).ravel())
                bags, size = [], 0
        if bags:
            found.append(sampler.bands_of(bags).ravel())
        bands = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
        columns = [pa.array(bands), batch.column("key").take(pa.array(owner, pa.int64())), pa.array(weights, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["band", "key", "size"])

    return map_batches(docs.select(text_key().alias("key"), "text"), run, "band long, key binary, size double").distinct()


class WeightedJaccard:
    """Texts as weighted bags (sorted hashes, weights), for ``buckets``; ``frequencies`` is a broadcast variable."""

    def __init__(self, frequencies, threshold: float = THRESHOLD):
        self.frequencies, self.threshold = frequencies, threshold

    def bag(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = shingles(text)
        return hashes, self.frequencies.value.weights(hashes, counts)

    def weight(self, bag: tuple[np.ndarray, np.ndarray]) -> float:
        return float(bag[1].sum())

    def alike(self, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> bool:
        return similarity(x, y) >= self.threshold

    def prefix_beyond(self, x: tuple[np.ndarray, np.ndarray], r: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Shingles that weigh more in x than in r, from the rarest on, until the others together weigh less than a partner shares."""
        shared, at, rt = np.intersect1d(x[0], r[0], assume_unique=True, return_indices=True)
        gain = x[1].copy()
        gain[at] -= r[1][rt]
        both = np.minimum(x[1][at], r[1][rt]).sum()
        extra, gain = x[0][gain > 0], gain[gain > 0]
        own, t = self.weight(x), self.threshold
        least = max(t * own, t / (1 + t) * (own + self.weight(r)))
        order = np.lexsort((extra, self.frequencies.value.slots[_slot(extra)]))
        # Weight from a shingle on to the end of the order; with room for rounding.
        rest = gain[order][::-1].cumsum()[::-1]
        return extra[order][rest >= least - both - 1e-6 * least]


def links_and_groups(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between different texts, and ``key, root`` of every linked text."""
    shared = docs.sparkSession.sparkContext.broadcast(document_frequencies(docs))
    rows = stored(band_rows(docs, shared).withColumn("line", F.lit(0).cast("long")), "bands")
    buckets = crowded(rows)
    dropped(rows)
    keyed = docs.select(text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return resolved(buckets, wanted_texts(keyed, buckets), WeightedJaccard(shared, threshold))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Class of every row of ``docs``: ``class_id`` is the smallest doc_id of its near and exact copies.

    ``class_rows`` counts the class, ``n_links`` the links found between this row's text and other texts, and ``kept`` marks
    the row's text and id as the class's representative.
    """
    links, groups = links_and_groups(docs, threshold)
    ends = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("n_links"))
    rows = docs.select("doc_id", text_key().alias("key")).join(groups, "key", "left")
    rows = stored(rows.withColumn("root", F.coalesce("root", "key")), "classed-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")).alias("first")
    classes = rows.groupBy("root").agg(first, F.count("*").alias("class_rows"))
    return rows.join(classes, "root").join(ends, "key", "left").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), F.lower(F.hex("root")).alias("class_key"), "class_rows",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` per class, all columns as they are: that of the smallest doc_id."""
    _, groups = links_and_groups(docs, threshold)
    rows = docs.select("doc_id", text_key().alias("key")).join(groups, "key", "left").withColumn("root", F.coalesce("root", "key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")).alias("first")
    own_key, own_id, own_row = (free_name(docs, n) for n in ("kept_key", "kept_id", "kept_row"))
    kept = rows.groupBy("root").agg(first).select(F.col("first.key").alias(own_key), F.col("first.doc_id").alias(own_id))
    kept = stored(kept, "kept")
    mine = docs.withColumn(own_key, text_key())
    same = (mine[own_key] == kept[own_key]) & mine["doc_id"].eqNullSafe(kept[own_id])
    # Rows equal in id and text: one of them stays, by the order of their columns.
    once = mine.join(kept, same, "left_semi")
    plain = [f.name for f in docs.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    picked = once.groupBy(own_key, "doc_id").agg(F.min_by(columns, F.struct(*[F.col(f"`{c}`") for c in plain])).alias(own_row))
    return picked.select(*[F.col(f"{own_row}.`{c}`").alias(c) for c in docs.columns])
