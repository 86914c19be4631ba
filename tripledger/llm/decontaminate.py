"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: words under a 1 are hashed, words under a 0 are ignored, so a passage whose
words were replaced here and there still shares seeds with its source. Seeds of all benchmark items are joined with seeds of
all documents. Before that join, document seeds pass a Bloom filter of the benchmark's seeds; its size is fixed
(``FILTER_BITS``) whatever the benchmark's size, it loses nothing, and what it lets through is settled by the join.

A hit fixes an alignment of item and document. Along it, words are compared one to one; the longest stretch of at least
``least`` words of which a share of ``agree`` or more are equal, is the overlap. An item shorter than ``least`` words must
overlap as a whole. The masks are chosen by enumeration: with the default limits every overlap has a seed, whichever words are replaced
(checked for all overlaps of 8 to 25 words; of a longer one, some half is an overlap too). Limits below these would lose some.

Items of fewer than ``SHORTEST`` words are found only with ``short_items``, and then as a whole and without replaced words: a passage
of few words stands in many texts by chance, so the caller says if that counts.

Words are runs of letters and digits in lower case. Null and empty texts have no words. Equal texts are searched once and
reported for each of their rows; repeated items are reported once per id. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import map_batches, mix, stored, text_key, texts_of, word_hashes

# Fixed masks, chosen one by one as those that hit most of the overlaps that the ones before miss.
MASKS = ("1101111", "111010011", "1100010111", "1111101", "10110111", "111001101")
# Shorter items are hashed as a whole.
SHORTEST = 8
LEAST = 13
AGREE = 0.8
FILTER_BITS = 1 << 24
FILTER_HASHES = 3


def seeds_of(words: np.ndarray, masks: tuple[str, ...] = MASKS, first: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every seed of a text."""
    hashes, places = [], []
    for number, mask in enumerate(masks):
        n = len(words) - len(mask) + 1
        if n <= 0:
            continue
        total = np.full(n, number + first, np.uint64)
        for at, bit in enumerate(mask):
            if bit == "1":
                total = total * np.uint64(0x9E3779B97F4A7C15) + words[at : at + n]
        hashes.append(mix(total))
        places.append(np.arange(n))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def short_seeds(words: np.ndarray, lengths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes and places of all runs of so many words, apart from the masks' seeds."""
    return [seeds_of(words, ("1" * n,), len(MASKS) + n) for n in lengths]


def filter_slots(hashes: np.ndarray, k: int) -> np.ndarray:
    """The filter's k-th slot of each hash: a slice of its bits, as ``seed_filter`` takes it."""
    return ((hashes >> np.uint64(20 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def short_lengths(items: DataFrame) -> list[int]:
    """Numbers of words below ``SHORTEST`` that items have."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = {len(word_hashes(t)) for t in texts_of(batch)}
        return pa.RecordBatch.from_arrays([pa.array([n for n in sizes if 0 < n < SHORTEST], pa.int32())], names=["n"])

    return sorted(r["n"] for r in map_batches(items.select("text"), run, "n int").distinct().collect())


def item_seeds(items: DataFrame, short_items: bool = False) -> DataFrame:
    """seed, item_id, at of every benchmark item."""

    def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(words) >= SHORTEST:
            return seeds_of(words)
        return short_seeds(words, [len(words)])[0] if short_items and len(words) else seeds_of(words[:0])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [seeds(word_hashes(t)) for t in texts_of(batch)]
        sizes = [len(h) for h, _ in found]
        owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        hashes = np.concatenate([h for h, _ in found]).view(np.int64)
        at = np.concatenate([p for _, p in found]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(hashes), batch.column("item_id").take(owner), pa.array(at)], names=["seed", "item_id", "at"])

    kind = items.schema["item_id"].dataType.simpleString()
    return map_batches(items.select("item_id", "text"), run, f"seed long, item_id {kind}, at int").distinct()


def seed_filter(seeds: DataFrame) -> bytes:
    """Bloom filter of ``FILTER_BITS`` bits: at most 513 rows of 4 KB reach the driver."""
    slots = F.array(*[F.shiftrightunsigned("seed", 20 * k).bitwiseAND(FILTER_BITS - 1) for k in range(FILTER_HASHES)])
    rows = (
        seeds.select(F.explode(slots).alias("slot"))
        .groupBy(F.expr("bitmap_bucket_number(slot + 1)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot + 1))").alias("bits"))
        .collect()
    )
    # Numbers from 1 on fall into buckets of 32,768, counted from 1; the first number is the lowest bit.
    bits = bytearray(FILTER_BITS >> 3)
    for row in rows:
        first = (row["bucket"] - 1) << 12
        bits[first : first + (1 << 12)] = row["bits"]
    return bytes(bits)


def document_hits(docs: DataFrame, bits: bytes, short: list[int] | None = None) -> DataFrame:
    """Seeds of documents that pass the filter: key (of the text), seed, at; ``short`` lists lengths of items hashed as a whole."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flags = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        seeds, places, sizes = [], [], []
        for text in texts_of(batch):
            words = word_hashes(text)
            hashes, at = map(np.concatenate, zip(seeds_of(words), *short_seeds(words, short or [])))
            for k in range(FILTER_HASHES):  # later slices are looked up for what is left only
                kept = flags[filter_slots(hashes, k)]
                hashes, at = hashes[kept], at[kept]
            seeds.append(hashes)
            places.append(at)
            sizes.append(len(hashes))
        owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        return pa.RecordBatch.from_arrays(
            [batch.column("key").take(owner), pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))],
            names=["key", "seed", "at"],
        )

    return map_batches(docs.select(text_key().alias("key"), "text"), run, "key binary, seed long, at int").distinct()


def longest_overlap(same: np.ndarray, agree: float) -> tuple[int, int]:
    """Start and end of the longest stretch of ``same`` with a share of at least ``agree`` true."""
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - agree, -agree))]) + 1e-9 * np.arange(len(same) + 1)
    # Starts worth trying have a score below all before them.
    low = np.minimum.accumulate(score)
    starts = np.flatnonzero(np.concatenate([[True], score[1:] < low[:-1]]))
    best = (0, 0)
    ends = np.maximum.accumulate(score[::-1])[::-1]  # best score from here on
    for start in starts:
        end = int(np.searchsorted(-ends, -score[start], side="right")) - 1
        if end - start > best[1] - best[0]:
            best = int(start), end
    return best


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, least: int, agree: float) -> tuple[int, int, int] | None:
    """First document word, words and equal words of the overlap on one alignment (document word = item word + shift)."""
    first, last = max(0, -shift), min(len(item), len(doc) - shift)
    if last <= first:
        return None
    same = doc[first + shift : last + shift] == item[first:last]
    start, end = longest_overlap(same, agree)
    if end - start < min(least, len(item)):
        return None
    inside = np.flatnonzero(same[start:end])
    start, end = start + int(inside[0]), start + int(inside[-1]) + 1
    if end - start < min(least, len(item)):
        return None
    return first + start + shift, end - start, int(same[start:end].sum())


def contaminated_texts(docs: DataFrame, items: DataFrame, least: int = LEAST, agree: float = AGREE, short_items: bool = False) -> DataFrame:
    """key, item_id, doc_word, n_words, n_same for every text and item that overlap: the longest overlap of each pair."""
    seeds = stored(item_seeds(items, short_items), "item-seeds")
    short = short_lengths(items) if short_items else []
    hits = stored(document_hits(docs, seed_filter(seeds), short), "seed-hits")
    aligned = hits.join(seeds.withColumnRenamed("at", "item_at"), "seed").select("key", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
    pairs = stored(aligned.groupBy("key", "item_id").agg(F.collect_set("shift").alias("shifts")), "alignments")
    texts = docs.select(text_key().alias("key"), "text").join(pairs.select("key").distinct(), "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))
    known = items.select(F.col("item_id").alias("known_id"), F.coalesce("text", F.lit("")).alias("item_text")).distinct()
    rows = pairs.join(texts, "key").join(known, F.col("item_id").eqNullSafe(F.col("known_id")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        words: dict[str, np.ndarray] = {}
        for i, (text, item, shifts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "item_text", "shifts")))):
            for t in (text, item):
                if t not in words:
                    words[t] = word_hashes(t)
            tried = (overlap(words[text], words[item], s, least, agree) for s in shifts)
            best = max((o for o in tried if o), key=lambda o: (o[1], o[2], -o[0]), default=None)
            if best:
                found.append((i, *best))
        at, start, n, same = (pa.array([f[k] for f in found], pa.int64()) for k in range(4))
        return pa.RecordBatch.from_arrays(
            [batch.column("key").take(at), batch.column("item_id").take(at), start, n, same],
            names=["key", "item_id", "doc_word", "n_words", "n_same"],
        )

    kind = items.schema["item_id"].dataType.simpleString()
    schema = f"key binary, item_id {kind}, doc_word long, n_words long, n_same long"
    checked = map_batches(rows.select("key", "item_id", "text", "item_text", "shifts"), run, schema)
    best = F.max(F.struct("n_words", "n_same", (-F.col("doc_word")).alias("back"))).alias("best")
    return checked.groupBy("key", "item_id").agg(best).select(
        "key", "item_id", (-F.col("best.back")).alias("doc_word"), "best.n_words", "best.n_same"
    )


def contaminations(docs: DataFrame, items: DataFrame, least: int = LEAST, agree: float = AGREE, short_items: bool = False) -> DataFrame:
    """One row per contaminated document and item it overlaps."""
    found = contaminated_texts(docs, items, least, agree, short_items)
    return docs.select("doc_id", text_key().alias("key")).join(found, "key").drop("key")


def decontaminated(docs: DataFrame, items: DataFrame, least: int = LEAST, agree: float = AGREE, short_items: bool = False) -> DataFrame:
    """The rows of ``docs`` that overlap no item, all columns as they are."""
    found = stored(contaminated_texts(docs, items, least, agree, short_items).select(F.col("key").alias("__key")).distinct(), "contaminated")
    return docs.join(found, text_key() == found["__key"], "left_anti")
