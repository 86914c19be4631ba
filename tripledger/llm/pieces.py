"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a vocabulary file and composed with each input:

* the normaliser maps a space to the piece mark and puts one mark in front of the text;
* the piece transducer has one arc per piece, found at each place of the input in a trie over reversed pieces, and an
  arc of its UTF-8 bytes for every character that no piece spells;
* for merged (BPE) vocabularies, the merge acceptor remembers the last piece and lets the next one follow only if merging
  both together leaves them as they are. Other pairs have infinite weight, the zero of the tropical semiring.

The output is the path of least weight in the tropical semiring (min, +): piece weights are negative scores for unigram
vocabularies. For merged ones a finite path is unique, because each prefix of a text has one segmentation whose neighbours
all hold, so one state per place of the input is enough and composition is linear in the text.

A text falls apart where no piece spells both neighbouring characters; the parts are composed one by one and
remembered per worker, up to twice ``CACHE`` parts. Decoding is the inverse: pieces to text, bytes to characters, marks to
spaces, the first mark dropped.

Null texts are empty and have no pieces. A piece mark (U+2581) in a text reads back as a space, and an unpaired surrogate
as a replacement character, as the vocabulary's normaliser has it. Repeated rows are encoded alike. Extra columns are not read.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tripledger.llm.common import map_batches, texts_of

MODEL = os.environ.get("TRIPLEDGER_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
# Parts remembered per worker (twice as many for a while), and pairs of pieces.
CACHE = 400_000
PAIRS = 2_000_000
# Weight of a character that no piece spells, in unigram vocabularies.
UNSPELT = 1e6
UNIGRAM, MERGED = 1, 2
NORMAL, UNKNOWN_PIECE, BYTE_PIECE, USER_PIECE = 1, 2, 6, 4
INFINITE = float("inf")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces, scores and kinds by id, as read on the driver and broadcast."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    merged: bool
    front_mark: bool

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        plain = model.normalizer_spec
        if plain.precompiled_charsmap or plain.remove_extra_whitespaces or not plain.escape_whitespaces:
            raise ValueError("only vocabularies with the identity normaliser are compiled")
        if any(p.type == USER_PIECE for p in model.pieces):
            raise ValueError("vocabularies with user-defined pieces are not compiled")
        return cls(
            tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces), tuple(p.type for p in model.pieces),
            model.trainer_spec.model_type == MERGED, plain.add_dummy_prefix,
        )


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        normal = [i for i, kind in enumerate(vocabulary.kinds) if kind == NORMAL]
        self.id = {vocabulary.pieces[i]: i for i in normal}
        self.weight = [0.0 if vocabulary.merged else -score for score in vocabulary.scores]
        self.byte_id = {int(vocabulary.pieces[i][3:5], 16): i for i, kind in enumerate(vocabulary.kinds) if kind == BYTE_PIECE}
        self.unknown = vocabulary.kinds.index(UNKNOWN_PIECE) if UNKNOWN_PIECE in vocabulary.kinds else 0
        # One trie over reversed pieces: from the end of a prefix, all pieces that end there.
        self.trie: dict = {}
        joints = set()
        for piece, i in self.id.items():
            node = self.trie
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = i
            joints.update(zip(piece, piece[1:]))
        self.joints = joints
        # A mark inside a piece comes first only, so words part at their mark; other vocabularies are cut at joints alone.
        inner = any(MARK in p[1:] and p.strip(MARK) for p in self.id)
        self.word = re.compile(r"(?s).+" if inner else f"{MARK}*[^{MARK}]+|{MARK}+")
        # What a piece decodes to: a byte, or its text with marks as spaces.
        self.surface = [
            bytes([int(p[3:5], 16)]) if kind == BYTE_PIECE else p.replace(MARK, " ").encode() for p, kind in zip(vocabulary.pieces, vocabulary.kinds)
        ]
        self.parts: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.holds: dict[tuple[int, int], bool] = {}

    # Merge acceptor

    def merges(self, text: str) -> list[str]:
        """Pieces after all merges, best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.id.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.vocabulary.scores[k] > best):
                    best, at = self.vocabulary.scores[k], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the pair's text leaves the two pieces; -1 on the left stands for what merges with nothing."""
        pieces = self.vocabulary.pieces
        b = pieces[right]
        if left < 0:
            return self.merges(b) == [b]
        a = pieces[left]
        return (a[-1], b[0]) not in self.joints or self.merges(a + b) == [a, b]

    # Composition and shortest path

    def shortest_path(self, text: str) -> tuple[int, ...]:
        """Ids of the path of least weight through the composition with one part of a text."""
        merged, weight, holds, n = self.vocabulary.merged, self.weight, self.holds, len(text)
        cost = [0.0, *[INFINITE] * n]
        back = [0] * (n + 1)  # where the last arc began
        last = [-1] * (n + 1)  # its piece; -1 at the start and for an unspelt character
        for end in range(1, n + 1):
            node, begin = self.trie, end
            while begin:
                begin -= 1
                node = node.get(text[begin])
                if node is None:
                    break
                if "" not in node:
                    continue
                piece = node[""]
                total = cost[begin] + weight[piece]
                if total < cost[end]:
                    if merged:
                        pair = (last[begin], piece)
                        held = holds.get(pair)
                        if held is None:
                            if len(holds) > PAIRS:
                                holds.clear()
                            held = holds[pair] = self.follows(*pair)
                        if not held:
                            continue
                    cost[end], back[end], last[end] = total, begin, piece
                    if merged:
                        break  # of a prefix's segmentations one holds
            if text[end - 1] not in self.id and cost[end - 1] < INFINITE:
                total = cost[end - 1] + (0.0 if merged else UNSPELT)
                if total < cost[end]:
                    cost[end], back[end], last[end] = total, end - 1, -1
        ids: list[int] = []
        while n:
            if last[n] >= 0:
                ids.append(last[n])
            else:
                data = text[back[n] : n].encode("utf-8", "replace")
                ids.extend(self.byte_id.get(b, self.unknown) for b in reversed(data))
            n = back[n]
        return tuple(reversed(ids))

    def remember(self, part: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Keep a part's ids; when full, only parts seen since the last time stay."""
        if len(self.parts) >= CACHE:
            self.older, self.parts = self.parts, {}
        self.parts[part] = ids
        return ids

    def part(self, text: str) -> tuple[int, ...]:
        found = self.parts.get(text)
        if found is None:
            found = self.older.get(text)
            found = self.remember(text, self.shortest_path(text) if found is None else found)
        return found

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a word, cut where no piece spells both neighbours."""
        known = self.older.get(word)
        if known is None:
            joints, begin = self.joints, 0
            pieces: tuple[int, ...] = ()
            for i in range(1, len(word)):
                if (word[i - 1], word[i]) not in joints:
                    pieces += self.part(word[begin:i])
                    begin = i
            known = pieces + self.part(word[begin:])
            if not begin or len(word) > 40:
                return known
        return self.remember(word, known)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        normal = (MARK if self.vocabulary.front_mark else "") + text.replace(" ", MARK)
        ids: list[int] = []
        for word in self.word.findall(normal):
            found = self.parts.get(word)
            ids += self.word_ids(word) if found is None else found
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.vocabulary.front_mark and text.startswith(" ") else text


_compiled: dict[int, Transducer] = {}


def transducer(vocabulary: Vocabulary) -> Transducer:
    """Compiled once per Python worker."""
    key = hash((vocabulary.pieces, vocabulary.scores))
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(vocabulary)
    return _compiled[key]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``ids`` of every row of ``docs`` and whether they decode to its text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(vocabulary.value)
        texts = texts_of(batch)
        ids = [machine.encode(t) for t in texts]
        same = [machine.decode(i) == t for i, t in zip(ids, texts)]
        columns = [batch.column("doc_id"), pa.array(map(len, ids), pa.int64(), size=len(ids)), pa.array(same, pa.bool_()), pa.array(ids, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "round_trip", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_pieces long, round_trip boolean, ids array<int>")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Text of every row's ``ids``; a null list is the empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(model))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = transducer(vocabulary.value)
        texts = [machine.decode(i or []) for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")
