"""Periodic runs of words, by Lyndon arrays of Baier's suffix grouping.

Words are stretches without space, tab, line feed, vertical tab, form feed or carriage return. A run is a stretch of words with smallest
period q, at least ``LEAST`` words and ``TIMES`` periods long, that no neighbouring word extends.

1. *Stretches.* Every ``LEAST // 3`` words inside a run stand there again, one period before or after. Only stretches of words covered by
   repeated windows are looked at further, and only where the windows repeat within a third of the stretch. A document without
   such a stretch has no run. Windows go by 64-bit hashes, which find too many of them at worst.
2. *Lyndon arrays.* Suffixes start in groups by their first word. Groups are taken from the last to the first; the next
   smaller suffix before each member of the group moves into a new group right behind its own, the more often it is met the
   later, and its context grows by that of the group. The length of a suffix's final context is its longest Lyndon
   prefix (``lyndon_lengths``). This is done under an order of the words and under its reverse.
3. *Runs.* In one of both orders a run of period q has Lyndon prefixes of length q, one period apart. Each such pair of places is
   extended to both sides by longest common extensions (``extensions``), found by bisection on hashes. What comes
   out is compared word by word before it counts.

Everything about a document happens in one Python call of a batch, so no rows move and a lost task is just run again; memory follows the
longest text. A null text has no words, and a document without runs has nulls in place of its best run. Ties of the best run go
to the smaller start, then the smaller period. Equal rows give equal rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripledger.llm.common import hash_spans, map_batches, mix, powers, prefix_sums

LEAST = 24
TIMES = 3
Words = list[bytes]


def words_of(text: str | None) -> Words:
    return (text or "").encode("utf-8", "surrogatepass").split()


def planted(doc_id: int | None, words: Words) -> Words:
    """The words with a periodic end, for every tenth id by crc32: places from ``a`` on repeat the ``p`` words that stand at ``a``."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), code // 10
    if code % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon prefix of each suffix, the end of the text being smaller than every rank (0, 1, ... all in use).

    A group is a range of places in the suffix array, known by its first one; new groups take the last places of their old one.
    ``members`` keeps suffixes that have left: ``group`` tells.
    """
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, rank in enumerate(ranks):
        members[rank].append(i)
    by_start: dict[int, list[int]] = {}
    first, last, context = [0] * n, [0] * n, [1] * n  # first by last place, last by first place
    group, before, lengths = [0] * n, [-1] * n, [0] * n
    place = 0
    for some in members:
        by_start[place] = some
        last[place] = place + len(some) - 1
        first[last[place]] = place
        for i in some:
            group[i] = place
        place += len(some)
    end = n - 1
    while end >= 0:
        start = first[end]
        size = context[start]
        found: dict[int, int] = {}
        for i in by_start.pop(start):
            if group[i] != start:
                continue
            lengths[i] = size
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in found.items():
            moves.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
            some = moves[times, old]
            stop = last[old]
            new = stop - len(some) + 1
            if new != old:
                last[old] = new - 1
                first[new - 1] = old
                last[new] = stop
                first[stop] = new
                by_start[new] = some
                for j in some:
                    group[j] = new
            context[new] = context[old] + times * size
        end = start - 1
    return lengths


def rolling(codes: np.ndarray) -> np.ndarray:
    """Rolling sums of 64-bit codes: ``hash_spans`` gives the hash of any span from them."""
    up, _ = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def stretches(sums: np.ndarray, least: int) -> np.ndarray:
    """Start and end of the stretches that may hold a run: rows of two columns."""
    window = least // 3
    n = len(sums) - 1
    none = np.zeros((0, 2), np.int64)
    if n < least:
        return none
    at = np.arange(n - window + 1)
    hashes = hash_spans(sums, at, at + window)
    sorted_hashes = np.sort(hashes)
    if not (sorted_hashes[1:] == sorted_hashes[:-1]).any():
        return none
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    gaps = np.where(same, np.diff(order), n)
    nearest = np.full(len(at), n)
    nearest[order[1:]] = gaps
    nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gaps)
    wanted = nearest < n
    while True:
        edges = np.zeros(n + 1, np.int64)
        edges[:-window][wanted] += 1
        edges[window:][wanted] -= 1
        found = np.flatnonzero(np.diff(np.cumsum(edges[:n]) > 0, prepend=False, append=False)).reshape(-1, 2)
        found = found[found[:, 1] - found[:, 0] >= least]
        if not len(found):
            return none
        # A run's windows repeat within its period, which is a third of the stretch at most.
        own = np.searchsorted(found[:, 0], at, side="right") - 1
        reach = np.where((own >= 0) & (at + window <= found[own, 1]), (found[own, 1] - found[own, 0]) // 3, 0)
        fewer = wanted & (nearest <= reach)
        if (fewer == wanted).all():
            return found
        wanted = fewer


def extensions(sums: np.ndarray, at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words are equal to the left of both places (exclusive), and from both places on; ``at < other``."""
    n = len(sums) - 1

    def longest(most: np.ndarray, same: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            ok = same(middle)
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        return low

    left = longest(at, lambda k: hash_spans(sums, at - k, at) == hash_spans(sums, other - k, other))
    right = longest(n - other, lambda k: hash_spans(sums, at, at + k) == hash_spans(sums, other, other + k))
    return left, right


def runs_of(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a stretch of word numbers, sorted by start and period."""
    n = len(codes)
    _, ranks = np.unique(codes, return_inverse=True)
    sums = rolling(mix(ranks.astype(np.uint64) + np.uint64(1)))
    found = set()
    for order in (ranks, ranks.max(initial=0) - ranks):
        lengths = np.array(lyndon_lengths(order.tolist()), np.int64)
        at = np.arange(n)
        # Of three periods or more, two Lyndon roots in a row stand inside.
        inner = at + 2 * lengths <= n
        at = at[inner]
        at = at[lengths[at] == lengths[at + lengths[at]]]
        period = lengths[at]
        left, right = extensions(sums, at, at + period)
        start, length = at - left, left + period + right
        some = length >= np.maximum(least, times * period)
        found.update(zip(start[some].tolist(), length[some].tolist(), period[some].tolist()))
    # Word by word: a run that only hashes see is none.
    sure = [(s, k, p) for s, k, p in found if (ranks[s : s + k - p] == ranks[s + p : s + k]).all()]
    return sorted(sure, key=lambda r: (r[0], r[2]))


def document_runs(joined: bytes, words: Words, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Runs of a document of ``words``; ``joined`` are the words with a space between."""
    if len(words) < least:
        return []
    data = np.frombuffer(joined, np.uint8)
    spaces = np.flatnonzero(data == 32)
    codes = mix(hash_spans(prefix_sums(data), np.append(0, spaces + 1), np.append(spaces, len(data))))
    out = []
    for start, end in stretches(rolling(codes), least).tolist():
        numbers: dict[bytes, int] = {}
        part = np.array([numbers.setdefault(w, len(numbers)) for w in words[start:end]])
        out += [(start + s, k, p) for s, k, p in runs_of(part, least, times)]
    return out


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, by exact fractions; of equals the first, then the shortest period."""
    best = None
    for run in runs:  # sorted by start and period: only a greater one takes over
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: Words, runs: list[tuple[int, int, int]]) -> Words:
    """The words without those that stand in a run behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    change: Callable[[int | None, Words], Words] | None = None,
    with_text: bool = True,
) -> DataFrame:
    """Per row of ``docs``: number of runs, the best one, digests of all runs and of the collapsed text; with both in full if asked for.

    ``change`` may replace a document's words first. ``times`` is three at least.
    """
    if times < 3 or least < 3:
        raise ValueError("runs are of three periods and three words at least")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    names += ["runs", "collapsed"] if with_text else []
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [RUNS, pa.string()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            if change:
                words = change(doc_id, words)
            joined = b" ".join(words)
            runs = document_runs(joined, words, least, times)
            best = best_run(runs)
            rest = b" ".join(collapsed(words, runs)) if runs else joined
            listed = "".join(f"{s},{k},{p}\n" for s, k, p in runs).encode()
            row = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
            row += (hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())
            if with_text:
                row += ([dict(zip(("start", "length", "period"), r)) for r in runs], rest.decode("utf-8", "replace"))
            out.append(row)
        columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", runs array<struct<start:long,length:long,period:long>>, collapsed string" if with_text else ""
    return map_batches(docs.select("doc_id", "text"), run, schema)
