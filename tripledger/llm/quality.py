"""Quality rules by compression bands.

A text that repeats itself compresses too well, and noise compresses too little. The zstandard ratio (compressed
bytes over bytes) is taken of the whole document and of fixed chunks, and held against limits for its length:
short texts compress less, so their limits are higher.

The limits (``ORDINARY``) come from the 3,243 documents of sf0.1 labelled good that pass the base rule: per length, their least ratio
less a margin of 0.01 to 0.035, and their highest plus 0.05, rounded. These documents are in Latin letters, so the
limits hold for texts of at most ``LATIN`` bytes a character. Letters of two bytes and more compress otherwise; such texts are held
against the wide limits of ``Bands``.

Null and empty texts have no words and fail the base rule. Repeated rows are judged alike, each by its own text.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tripledger.llm.common import map_batches, texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
VERDICT = "base_failed boolean, kept boolean, ratio double, n_chunks long, bad_chunks long, reason string"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio; documents of up to ``bytes`` bytes keep within ``(low, high)``."""

    whole: tuple[tuple[float, float, float], ...] = (
        (1024, 0.35, 0.85),
        (4096, 0.28, 0.80),
        (16384, 0.24, 0.75),
        (float("inf"), 0.20, 0.72),
    )
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (0.28, 0.80)
    # A document fails if more than this share of its chunks leaves the band.
    bad_share: float = 0.25
    level: int = 3


# Limits of ordinary text in Latin letters.
ORDINARY = Bands(
    whole=(
        (512, 0.51, 0.78),
        (768, 0.505, 0.73),
        (1024, 0.487, 0.67),
        (1448, 0.475, 0.63),
        (2048, 0.456, 0.59),
        (2896, 0.454, 0.57),
        (4096, 0.441, 0.55),
        (5793, 0.427, 0.52),
        (8192, 0.417, 0.52),
        (16384, 0.405, 0.50),
        (32768, 0.393, 0.48),
        (65536, 0.375, 0.48),
        # No such text is given: longer ones may compress further.
        (float("inf"), 0.34, 0.48),
    ),
    chunk=(0.435, 0.60),
)
LATIN = 1.2


def bands_for(text: str, data: bytes, bands: Bands | None = None) -> Bands:
    """``bands`` if there are any; else those of the kind of text."""
    if bands is not None:
        return bands
    return ORDINARY if len(data) <= LATIN * len(text) else Bands()


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            repeats += line in seen
            seen.add(line)
    return repeats


def base_features(text: str) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
    )


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def band_verdict(data: bytes, bands: Bands, squeeze) -> tuple[float | None, int, int, str | None]:
    """Ratio of the whole, chunks, chunks outside the band, and the reason of a rejection."""
    if not data:
        return None, 0, 0, "empty"
    ratio = len(squeeze(data)) / len(data)
    low, high = next((lo, hi) for most, lo, hi in bands.whole if len(data) <= most)
    size = bands.chunk_bytes
    # The rest after the last full chunk belongs to that chunk: a short rest compresses too little to be judged alone.
    n_chunks = len(data) // size
    bad = 0
    for i in range(n_chunks):
        part = data[i * size : (i + 1) * size if i + 1 < n_chunks else len(data)]
        share = len(squeeze(part)) / len(part)
        bad += not bands.chunk[0] <= share <= bands.chunk[1]
    reason = None
    if ratio < low:
        reason = "repetitive"
    elif ratio > high:
        reason = "incompressible"
    elif bad > bands.bad_share * n_chunks:
        reason = "chunks"
    return ratio, n_chunks, bad, reason


def judge(text: str, bands: Bands | None, squeeze) -> tuple:
    base = base_features(text)
    failed = base_fails(base[0], base[4])
    data = text.encode("utf-8", "surrogatepass")
    ratio, n_chunks, bad, reason = band_verdict(data, bands_for(text, data, bands), squeeze)
    return *base, failed, not failed and reason is None, ratio, n_chunks, bad, "base" if failed else reason


def _arrays(texts: list[str], bands: Bands | None) -> list[pa.Array]:
    squeeze = zstandard.ZstdCompressor(level=(bands or ORDINARY).level).compress
    columns = zip(*(judge(t, bands, squeeze) for t in texts))
    kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
    return [pa.array(values, kind) for values, kind in zip(columns, kinds)]


def quality_rules(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """Features and verdict of every document: one row per row of ``docs``, other columns are not read.

    Without ``bands``, each text is held against the limits of its kind (``bands_for``).
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [batch.column(0), *_arrays(texts_of(batch), bands)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {FEATURES}, {VERDICT}"
    names = [part.split()[0] for part in schema.split(", ")]
    return map_batches(docs.select("doc_id", "text"), run, schema)


def keep_good(docs: DataFrame, bands: Bands | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are."""
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=(bands or ORDINARY).level).compress
        texts = (t or "" for t in batch.column(place).to_pylist())
        return batch.filter(pa.array([judge(t, bands, squeeze)[6] for t in texts], pa.bool_()))

    return map_batches(docs, run, docs.schema)
