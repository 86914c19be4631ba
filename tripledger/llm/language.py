"""Language identification by cross-parsing entropy.

For each language, a suffix automaton is built of labelled text. A text is parsed from left to right into phrases, each the
longest match with anything in that language's text; the fewer phrases, the nearer the language. Phrases are normalised by
what a phrase costs to name, log2 of the length of the labelled text.

Letters are taken in lower case, everything else is one space. Texts are cut into blocks of ``BLOCK`` symbols, each parsed
from a new phrase, and all blocks of a batch step through all automata at once, as array look-ups.

The labelled text is a bounded sample: per language at most ``SLOTS`` rows (the one with the smallest hash per slot), at most
``SLOT_CHARS`` code points of each. Only training rows with a language are taken.

A null text or one without letters is ``und`` with score 0; so is every text if nothing could be learned. Ties go to the
language first in the alphabet. Repeated rows are predicted alike. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripledger.llm.common import held_out, map_batches, training_row

SLOTS = 64
SLOT_CHARS = 500
BLOCK = 512
# Symbols that an automaton knows: the commonest letters of the sample, over all languages, are symbols of their own; all other letters
# are spelled by the bytes of their UTF-8 form, so large and many alphabets are told apart too.
SPACE, UNKNOWN, FIRST = 0, 1, 2
MOST_LETTERS = 60
# Marks in the table of code points: a letter that is spelled, and a code point not looked up yet.
SPELLED, OPEN = 254, 255


def labelled_sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(language, text) pairs, at most ``SLOTS`` per language."""
    order = F.xxhash64("text", "doc_id")
    rows = docs.where(training_row() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    slot = F.pmod(order, F.lit(SLOTS)).alias("slot")
    picked = rows.groupBy("lang", slot).agg(F.min(F.struct(order.alias("at"), F.substring("text", 1, SLOT_CHARS).alias("text"))).alias("one"))
    return [(r["lang"], r["one"]["text"]) for r in picked.orderBy("lang", "slot").collect()]


class Alphabet:
    """Code points to symbols: known letters, bytes of other letters, one space for all else."""

    def __init__(self, letters: list[str], spelled: list[int]):
        self.table = np.full(0x110000, SPACE, np.uint8)
        # What lies outside the table's known letters is looked up per text, only where it occurs.
        self.size = FIRST + len(letters) + len(spelled)
        self.bytes = np.full(256, UNKNOWN, np.uint8)
        for i, byte in enumerate(spelled):
            self.bytes[byte] = FIRST + len(letters) + i
        self.table[128:] = OPEN
        for c in range(128):
            if chr(c).isalpha():
                self.table[c] = SPELLED
        for i, letter in enumerate(letters):
            self.table[ord(letter)] = FIRST + i

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        out = self.table[points]
        if (out == OPEN).any():
            for point in np.unique(points[out == OPEN]):
                self.table[point] = SPELLED if chr(point).isalpha() else SPACE
            out = self.table[points]
        before = np.concatenate([[SPACE], out])[: len(out)]
        wanted = (out != SPACE) | (before != SPACE)
        points, out = points[wanted], out[wanted]
        rare = out == SPELLED
        if not rare.any():
            return out
        forms = [chr(p).encode("utf-8", "surrogatepass") for p in points[rare]]
        sizes = np.ones(len(out), np.int64)
        sizes[rare] = [len(f) for f in forms]
        whole = np.repeat(out, sizes)
        whole[np.repeat(rare, sizes)] = self.bytes[np.frombuffer(b"".join(forms), np.uint8)]
        return whole


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all suffixes; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
        last = new
    return moves


class Parser:
    """Automata of all languages in one table: an entry is twice the next state, plus one if a phrase ended."""

    def __init__(self, sample: list[tuple[str, str]]):
        letters = Counter(c for _, text in sample for c in text.lower() if c.isalpha())
        order = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))]
        spelled = sorted({byte for c in order[MOST_LETTERS:] for byte in c.encode("utf-8", "surrogatepass")})
        self.alphabet = Alphabet(order[:MOST_LETTERS], spelled)
        self.langs = sorted({lang for lang, _ in sample})
        self.roots, self.costs, tables, base = [], [], [], 0
        size = self.alphabet.size
        for lang in self.langs:
            symbols: list[int] = []
            for one, text in sample:
                if one == lang:
                    symbols += [*self.alphabet.symbols(text).tolist(), SPACE]
            moves = suffix_automaton([s for s in symbols if s != UNKNOWN])
            start = np.zeros(size, np.int64)
            for c, to in moves[0].items():
                start[c] = to
            table = np.tile(2 * (start + base) + 1, (len(moves), 1))
            for state, to in enumerate(moves):
                table[state, list(to)] = 2 * (np.array([*to.values()], np.int64) + base)
            tables.append(table.astype(np.int32))
            self.roots.append(base)
            self.costs.append(np.log2(max(2, len(symbols))))
            base += len(moves)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text in each language: blocks of all texts side by side, one symbol a step."""
        lengths = np.array([len(t) for t in texts])
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = first[owner] + inside * BLOCK
        size = np.minimum(BLOCK, lengths[owner] - inside * BLOCK)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        flat = np.concatenate([*texts, np.zeros(0, np.uint8)])
        state = np.repeat(np.array(self.roots)[:, None], len(owner), 1) * 2
        ended = np.zeros(state.shape, np.int32)
        width = self.alphabet.size
        for i in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -i))
            symbol = flat[begin[:live] + i]
            now = self.table[(state[:, :live] >> 1) * width + symbol]
            state[:, :live] = now
            ended[:, :live] += now & 1
        return np.stack([np.bincount(owner, e + 1, len(texts)) for e in ended])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        symbols = [self.alphabet.symbols(t or "") for t in texts]
        blank = np.array([not (s != SPACE).any() for s in symbols])
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        bits = self.phrases(symbols) * np.array(self.costs)[:, None]
        best = bits.argmin(0)
        # The share that the best language has if bits are taken as negative log2 of likelihoods.
        score = 1 / np.exp2(-np.minimum(bits - bits.min(0), 60)).sum(0)
        langs = ["und" if b else self.langs[k] for b, k in zip(blank, best)]
        return langs, np.where(blank, 0.0, score)


_parsers: dict[int, Parser] = {}


def language_id(docs: DataFrame) -> DataFrame:
    """Predicted language of every row of ``docs``."""
    sample = docs.sparkSession.sparkContext.broadcast(labelled_sample(docs))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = hash(tuple(sample.value))
        if key not in _parsers:  # built once per Python worker
            _parsers.clear()
            _parsers[key] = Parser(sample.value)
        langs, score = _parsers[key].predict(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return map_batches(rows, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
