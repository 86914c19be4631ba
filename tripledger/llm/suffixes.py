"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Which strings repeat is found as in the
building of a suffix array by prefix doubling: positions are ranked by a short prefix, Spark groups and sorts (rank, name of a
longer string) pairs, positions whose pair is unique leave, and the others are ranked anew by longer strings, until they are
unique or the length is reached. Two things differ from the textbook. Ranks are names (64-bit hashes of the strings) instead of
places in an order, as only equality counts. And positions are taken in groups, so that not each of them is shuffled:

1. *Anchors.* Of the 64-byte strings inside a 200-byte string, the one with the smallest hash is its anchor. Equal strings
   have equal anchors at equal distance, so strings whose anchor is unique are unique. Neighbouring strings mostly share their
   anchor: about every 60th position becomes a row, a *run* of strings with one anchor.
2. *Runs.* Runs are ranked by the anchor. Where that is not unique, they are paired with the name of the whole stretch that
   the run's strings cover. Equal pairs: all strings of the run repeat. Pairs that are unique although their rank is not (the run
   contains the border of a repeat), go on with one row for each equal pair to be compared with.
3. *Blocks* of up to 16 neighbouring strings of such runs, ranked by the 185 bytes that all 16 share, paired with their stretch.
4. *Strings*, ranked by those 185 bytes, paired with the name of the full 200 bytes.

Each step needs one pass over the texts. Rows of steps 3 and 4 come from borders of repeats only. Equal texts are one text within
a task, and are removed by their count. Groups are aggregated before the shuffle (least and greatest position), so a string that a third of
all rows hold is no hot group; the join that hands the result back is split by the optimizer where it is skewed.

A null text is empty. Texts shorter than ``LENGTH`` bytes have no strings and stay. Repeated rows are removed whole if long enough. An
empty table gives no rows; extra columns are not read, or passed through by ``without_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import free_name, hash_spans, map_batches, mix, prefix_sums, stored, text_key

LENGTH = 200
ANCHOR = 64
BLOCK = 16
# Bytes of texts that are hashed side by side.
SIDE_BY_SIDE = 1 << 15
# Rows that are compared: strings that start in [start, start + width) of a text. ``back`` is the anchor's distance from the start.
ROWS = "rank long, name long, key binary, start int, width int, back int"


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def runs_of(datas: list[np.ndarray], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of texts of at least ``length`` bytes, side by side.

    Per run: text, rank (hash of its anchor), name (hash of the stretch), start, width, distance to the anchor.
    """
    sizes = np.array([len(d) for d in datas])
    ends = np.cumsum(sizes)
    data = np.concatenate(datas)
    sums = prefix_sums(data)
    place = np.arange(len(data) - anchor + 1, dtype=np.uint64)
    hashes = hash_spans(sums, slice(0, len(place)), slice(anchor, None))
    # Hash above, place below: the least of a window is its anchor, the leftmost of equals.
    keys = hashes * np.uint64(0xD6E8FEB86659FD93)
    keys &= np.uint64(0xFFFFFFFF00000000)
    keys |= place
    anchors = (sliding_least(keys, length - anchor + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings that run over the end of a text are none: they part the runs of one text from those of the next.
    for end in ends[:-1]:
        anchors[end - length + 1 : end] = -1
    start = np.flatnonzero(np.diff(anchors, prepend=-2))
    stop = np.append(start[1:], len(anchors))
    at = anchors[start]
    start, stop, at = start[at >= 0], stop[at >= 0], at[at >= 0]
    names = mix(hash_spans(sums, start, stop - 1 + length) + (at - start).astype(np.uint64))
    text = np.searchsorted(ends, start, side="right")
    return text, mix(hashes[at]), names, start - (ends - sizes)[text], stop - start, at - start


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: running minima from both ends of blocks of that width."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _batch(rank, name, keys: pa.Array, owner, start, width, back) -> pa.RecordBatch:
    def joined(parts, kind):
        return np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)

    return pa.RecordBatch.from_arrays(
        [
            pa.array(joined(rank, np.uint64).view(np.int64)),
            pa.array(joined(name, np.uint64).view(np.int64)),
            keys.take(pa.array(joined(owner, np.int64))),
            *(pa.array(joined(x, np.int32)) for x in (start, width, back)),
        ],
        names=["rank", "name", "key", "start", "width", "back"],
    )


def runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """Runs of every text, equal texts of a batch once."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen, out, owner = set(), [], []
        datas, rows, size = [], [], 0

        def flush() -> None:
            if datas:
                text, *found = runs_of(datas, length, anchor)
                out.append(found)
                owner.append(np.array(rows)[text])

        for i, (key, text) in enumerate(zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())):
            data = _bytes(text)
            if key in seen or len(data) < length:
                continue
            seen.add(key)
            datas.append(data)
            rows.append(i)
            size += len(data)
            if size >= SIDE_BY_SIDE:
                flush()
                datas, rows, size = [], [], 0
        flush()
        rank, name, start, width, back = zip(*out) if out else ([],) * 5
        return _batch(rank, name, batch.column("key"), owner, start, width, back)

    return map_batches(docs.select(text_key().alias("key"), "text"), run, ROWS)


def blocks_of(sums: np.ndarray, row: dict, length: int, block: int) -> tuple[np.ndarray, ...]:
    """Blocks of a run: cut where the distance to the anchor is a multiple of ``block``, so that equal strings share a block."""
    last, first = row["back"], row["back"] - row["width"] + 1  # distances to the anchor
    number = np.arange(first // block, last // block + 1)
    near, far = number * block, number * block + block - 1
    anchor = row["start"] + row["back"]
    start, stop = anchor - np.minimum(far, last), anchor - np.maximum(near, first) + 1
    rank = hash_spans(sums, anchor - near, anchor - far + length)
    # A block cut by the end of its run can't be told whole: its name is its own place.
    cut = stop - start < block
    name = mix(hash_spans(sums, start, stop - 1 + length) + cut * (start + 1).astype(np.uint64))
    rank = mix(rank + mix(np.uint64(row["rank"] & 0xFFFFFFFFFFFFFFFF) + number.astype(np.uint64)))
    return rank, name, start, stop - start, np.zeros(len(start), np.int64)


def strings_of(sums: np.ndarray, row: dict, length: int) -> tuple[np.ndarray, ...]:
    """Each string of a block: ranked as the block, by its place in it."""
    start = row["start"] + np.arange(row["width"])
    rank = np.full(len(start), row["rank"], np.int64).view(np.uint64)
    return rank, hash_spans(sums, start, start + length), start, np.ones(len(start), np.int64), np.zeros(len(start), np.int64)


def longer(open_rows: DataFrame, texts: DataFrame, split) -> DataFrame:
    """The rows that ``split`` makes of open rows with their texts at hand."""
    grouped = open_rows.groupBy("key").agg(F.collect_list(F.struct("rank", "start", "width", "back")).alias("rows"))
    wanted = texts.join(grouped, "key").select("key", "text", "rows")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, owner, seen = [], [], set()
        for i, (key, text, rows) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("key", "text", "rows")))):
            if key in seen:
                continue
            seen.add(key)
            sums = prefix_sums(_bytes(text))
            for row in rows:
                out.append(split(sums, row))
                owner.append(np.full(len(out[-1][0]), i))
        rank, name, start, width, back = zip(*out) if out else ([],) * 5
        return _batch(rank, name, batch.column("key"), owner, start, width, back)

    return map_batches(wanted, run, ROWS)


def place():
    return F.struct("key", "start")


def ranked_alike(rows: DataFrame) -> DataFrame:
    """Rows whose rank occurs at another place too."""
    ends = rows.select("rank", F.xxhash64("key", "start").alias("at")).groupBy("rank").agg(F.min("at").alias("a"), F.max("at").alias("b"))
    return rows.join(ends.where("a <> b").select("rank"), "rank", "left_semi")


def settled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of the rows whose (rank, name) pair occurs elsewhere, and the rows that must be told by longer strings.

    The latter are all rows whose pair is unique though their rank is not, and one row of each repeated pair of that rank.
    """
    whole = F.struct("key", "start", "width", "back")
    pairs = rows.groupBy("rank", "name").agg(F.min(whole).alias("one"), F.max(place()).alias("other"))
    pairs = pairs.withColumn("repeated", F.struct("one.key", "one.start") != F.col("other"))
    pairs = stored(pairs.select("rank", "name", "one", "repeated"), "pairs")
    spans = rows.join(pairs.where("repeated").select("rank", "name"), ["rank", "name"], "left_semi").select("key", "start", "width")
    unsettled = pairs.groupBy("rank").agg(F.count("*").alias("n"), F.bool_or(~F.col("repeated")).alias("open")).where("n > 1 AND open")
    left = pairs.join(unsettled.select("rank"), "rank", "left_semi").select("rank", "one.*")
    return spans, left


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block: int = BLOCK) -> DataFrame:
    """key, start, width: strings of ``length`` bytes that start in [start, start + width) occur elsewhere too."""
    texts = docs.select(text_key().alias("key"), "text")
    first = stored(ranked_alike(runs(docs, length, anchor)), "runs")
    whole_runs, left = settled(first)
    second = stored(ranked_alike(longer(left, texts, lambda sums, row: blocks_of(sums, row, length, block))), "blocks")
    whole_blocks, left = settled(second)
    third = stored(ranked_alike(longer(left, texts, lambda sums, row: strings_of(sums, row, length))), "strings")
    pairs = third.groupBy("rank", "name").agg(F.min(place()).alias("one"), F.max(place()).alias("other")).where("one <> other")
    strings = third.join(pairs.select("rank", "name"), ["rank", "name"], "left_semi").select("key", "start", "width")
    copies = texts.where(F.octet_length("text") >= length).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    whole = copies.select("key", F.lit(0).alias("start"), F.lit(-1).alias("width"))
    return whole_runs.unionByName(whole_blocks).unionByName(strings).unionByName(whole)


def kept_mask(n: int, spans: list[dict] | None, length: int) -> np.ndarray:
    """True for bytes that stay."""
    edges = np.zeros(n + 1, np.int64)
    for span in spans or ():
        if span["width"] < 0:
            return np.zeros(n, bool)
        edges[span["start"]] += 1
        edges[span["start"] + span["width"] - 1 + length] -= 1
    return np.cumsum(edges[:n]) == 0


def with_spans(docs: DataFrame, length: int) -> tuple[DataFrame, str]:
    """``docs`` with the repeated strings of each text, and the name of that column, which is its last one."""
    spans_name, own, key = (free_name(docs, n) for n in ("repeated", "own_key", "span_key"))
    grouped = repeated_spans(docs, length).groupBy(F.col("key").alias(key)).agg(F.collect_set(F.struct("start", "width")).alias(spans_name))
    return docs.withColumn(own, text_key()).join(grouped, F.col(own) == F.col(key), "left").drop(own, key), spans_name


def repeats(docs: DataFrame, length: int = LENGTH, with_rest: bool = True) -> DataFrame:
    """Per row of ``docs``: bytes, bytes removed, maximal removed spans and digest of the rest.

    ``with_rest`` adds the rest itself and the removed spans.
    """

    marked, spans_name = with_spans(docs.select("doc_id", "text"), length)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column(spans_name).to_pylist()):
            data = _bytes(text)
            if not spans:
                out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data.tobytes() if with_rest else b"", []))
                continue
            kept = kept_mask(len(data), spans, length)
            edges = np.flatnonzero(np.diff(~kept, prepend=False, append=False)).reshape(-1, 2)
            rest = data[kept].tobytes()
            cuts = [{"start": int(a), "end": int(b)} for a, b in edges] if with_rest else []
            out.append((len(data), int((~kept).sum()), len(edges), hashlib.sha256(rest).hexdigest(), rest, cuts))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns][: len(names)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept", "removed"] if with_rest else [])]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary, removed array<struct<start:int,end:int>>" if with_rest else ""
    return map_batches(marked, run, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; a character that loses a byte goes, other columns stay."""
    names = docs.columns
    place_of_text = names.index("text")
    marked, spans_name = with_spans(docs, length)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(place_of_text).to_pylist()
        out = []
        for text, spans in zip(texts, batch.column(spans_name).to_pylist()):
            data = _bytes(text)
            out.append(text if not spans else data[kept_mask(len(data), spans, length)].tobytes().decode("utf-8", "ignore"))
        columns = [pa.array(out, pa.string()) if i == place_of_text else batch.column(i) for i in range(len(names))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(marked, run, docs.schema)
