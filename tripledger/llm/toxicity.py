"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their first bytes (inflected forms share those), hashed into ``BUCKETS`` buckets and
taken once per text. Besides a weight per term, the machine learns a short vector per term; the product of two vectors is
the weight of the pair, so an insult next to a group's name can count for more than both alone.

Values are ``1 / sqrt(terms)``: a long text must show more than a short one. The machine is fitted on the driver from a
bounded sample of labelled rows (``PER_CLASS`` per label, by hash of the id), and the fitted arrays, of fixed size,
are broadcast. Only terms of at least ``MIN_ROWS`` sample rows count, and
of these the common ones and those whose share of toxic rows is no chance. The bias is set on rows left out of a fit.

Null and empty texts are scored by the bias alone. Rows with a null id are held out. Without labelled rows of both kinds
every score is the share of toxic rows, 0 if there are none. Repeated rows get the same score. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import hash_spans, held_out, map_batches, mix, prefix_sums, texts_of, training_row, word_edges

BUCKETS = 1 << 20
RANK = 4
PER_CLASS = 5000
MIN_ROWS = 3
MIN_G = 12.0
COMMON = 0.02
ALARM_COST = 10
STEM_BYTES = 5
SAMPLE = "toxic int, terms binary"


def terms_of(text: str) -> np.ndarray:
    """Sorted distinct buckets of a text's words and stems."""
    data, starts, ends = word_edges(text)
    if not len(starts):
        return np.zeros(0, np.int32)
    sums = prefix_sums(data)
    words = mix(hash_spans(sums, starts, ends))
    long = ends - starts > STEM_BYTES
    stems = mix(hash_spans(sums, starts[long], starts[long] + STEM_BYTES) + np.uint64(1))
    return np.unique((np.concatenate([words, stems]) % np.uint64(BUCKETS)).astype(np.int32))


@dataclass
class Machine:
    """``logit = bias + sum w[i] x[i] + sum over pairs <v[i], v[j]> x[i] x[j]``"""

    bias: float
    kept: np.ndarray  # sorted buckets that have weights
    w: np.ndarray
    v: np.ndarray

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate([*rows, np.zeros(0, np.int32)])
        at = np.searchsorted(self.kept, flat)
        at[at == len(self.kept)] = 0
        known = self.kept[at] == flat if len(self.kept) else np.zeros(len(flat), bool)
        owner = np.repeat(np.arange(len(rows)), sizes)[known]
        at, x = at[known], (1 / np.sqrt(np.maximum(sizes, 1)))[owner]
        total = lambda values: np.bincount(owner, values, len(rows))
        out = self.bias + total(self.w[at] * x)
        for k in range(self.v.shape[1]):
            f = self.v[at, k] * x
            out += (total(f) ** 2 - total(f * f)) / 2
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits([terms_of(t) for t in texts]), -30, 30)))


def telling_terms(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms whose share of toxic rows is no chance (G-test over ``MIN_G``), and common terms, which may tell in pairs only."""
    seen, counts = np.unique(np.concatenate(rows), return_counts=True)
    toxic = np.zeros(len(seen))
    for row, label in zip(rows, labels):
        if label:
            toxic[np.searchsorted(seen, row)] += 1
    n, most = len(rows), float(labels.sum())
    g = np.zeros(len(seen))
    for part, total in ((toxic, most), (counts - toxic, n - most)):
        for found, whole in ((part, counts), (total - part, n - counts)):
            expected = total * whole / n
            g += 2 * np.where(found > 0, found * np.log(np.maximum(found, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return seen[(counts >= MIN_ROWS) & ((g >= MIN_G) | (counts >= COMMON * n))]


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = 20, rate: float = 8.0, decay: float = 2e-4, seed: int = 7) -> Machine:
    """Logistic loss by gradient descent in batches of 64 rows; both labels weigh the same.

    One pace for all weights: what many rows agree on moves far, what marks three rows alone hardly moves.
    """
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        bias = np.log(max(share, 1e-9) / max(1 - share, 1e-9)) if len(labels) else -30.0
        return Machine(float(bias), np.zeros(0, np.int32), np.zeros(0), np.zeros((0, RANK)))
    kept = telling_terms(rows, labels)
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(kept)), rng.normal(0, 0.05, (len(kept), RANK)), 0.0
    places = []
    for r in rows:
        at = np.searchsorted(kept, r)
        ok = at < len(kept)
        ok[ok] = kept[at[ok]] == r[ok]
        places.append(at[ok])
    scale = np.array([1 / np.sqrt(max(len(r), 1)) for r in rows])
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for epoch in range(epochs):
        pace = rate / (1 + 0.1 * epoch)
        order = rng.permutation(len(rows))
        for some in np.array_split(order, -(-len(order) // 64)):
            at = np.concatenate([places[i] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(places[i]) for i in some])
            x = scale[some][owner]
            f = v[at] * x[:, None]
            sums = np.stack([np.bincount(owner, f[:, k], len(some)) for k in range(RANK)], 1)
            squares = np.bincount(owner, (f * f).sum(1), len(some))
            logit = bias + np.bincount(owner, w[at] * x, len(some)) + ((sums**2).sum(1) - squares) / 2
            error = weight[some] * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]) / len(some)
            g = error[owner] * x
            used, where = np.unique(at, return_inverse=True)
            w[used] -= pace * (np.bincount(where, g) + decay * w[used])
            for k in range(RANK):
                v[used, k] -= pace * (np.bincount(where, g * (sums[owner, k] - f[:, k])) + decay * v[used, k])
            bias -= pace * 0.05 * error.sum()
    return Machine(float(bias), kept, w, v)


def calibrated(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """A machine fitted on all rows, its bias moved to where one fitted on four fifths parts the other fifth best.

    Best is most toxic rows found, less ``ALARM_COST`` times the share of clean rows blamed.
    """
    model = fit(rows, labels)
    fold = np.arange(len(rows)) % 5 == 0
    if not 0 < labels[fold].sum() < fold.sum() or not 0 < labels[~fold].sum() < (~fold).sum():
        return model
    logits = fit([r for r, out in zip(rows, fold) if not out], labels[~fold]).logits([r for r, out in zip(rows, fold) if out])
    cuts = np.arange(-2, 2.05, 0.1)
    toxic, clean = np.sort(logits[labels[fold] == 1]), np.sort(logits[labels[fold] == 0])
    found = 1 - np.searchsorted(toxic, cuts) / len(toxic)
    blamed = 1 - np.searchsorted(clean, cuts) / len(clean)
    gain = found - ALARM_COST * blamed
    best = cuts[gain >= gain.max() - 1e-9]
    model.bias -= float(best[np.abs(best - best.mean()).argmin()])
    return model


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """At most ``per_class`` labelled training rows per label: the smallest id of each hash slot."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(per_class))
    known = labels.where(training_row() & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    ids = known.groupBy("toxic", slot.alias("slot")).agg(F.min("doc_id").alias("doc_id"))
    # At most two rows per slot, so this side has a fixed bound.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "toxic")), "doc_id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = [terms_of(t).tobytes() for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()), pa.array(terms, pa.binary())],
            names=["doc_id", "toxic", "terms"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_batches(rows, run, f"doc_id {kind}, {SAMPLE}")
    # A repeated id counts once.
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Machine:
    rows = training_sample(docs, labels, per_class).orderBy("doc_id").toArrow()
    terms = [np.frombuffer(x, np.int32) for x in rows.column("terms").to_pylist()]
    return calibrated(terms, np.array(rows.column("toxic").to_pylist(), np.int64))


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Score and prediction of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.value.scores(texts_of(batch))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, score double, predicted int")
