"""Encoding and decoding with a SentencePiece model of the merge type, from a table over prefixes.

The encoding of every prefix of a text has a last token, and only one: among the tokens that end
there, the one that may follow the last token of the prefix before it. So one pass fills a table
of last tokens, with the matches of an Aho-Corasick automaton over the pieces, and a walk from
the end of the text recovers the ids. No merge is carried out and no token is taken back, so a
text costs time in proportion to its length whatever is in it.

Two tokens may stand side by side if merging their characters on either side, best score first
and leftmost among equals, comes to its end on both sides before a pair across the border is
the best one. The merges that make a piece are replayed once for all; a test runs through those
that change the character run at the border.

Texts are cut where no piece reaches across (before spaces, around control characters), and the
ids of short parts are remembered. Characters without a piece are written as the ids of their bytes.

Defined cases: null and empty texts have no token and decode to nothing; very long texts, and long
ones without a space, are encoded whole; repeated rows and null doc_ids get a row each; an empty
table gives none; a model of another kind, with a normaliser or with pieces of the user is
refused. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ridelake.llm.textbytes import pieces as slices

SPACE = "▁"
#: Fixed values of the model format: kinds of pieces, and the merge type of model.
NORMAL, UNKNOWN, CONTROL, BYTE, MERGES = 1, 2, 3, 6, 2
#: Fixed value: what an unknown piece decodes to.
UNKNOWN_SHOWN = " ⁇ "
#: Bounds of what a worker remembers: parts of texts, their length, and pairs of tokens.
PARTS, PART_CHARS, PAIRS = 1 << 18, 48, 1 << 19


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a message in the protocol buffer format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(wire)
            size = number() if size is None else size
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Model:
    """Pieces by id with their scores and kinds, and whether a text gets a space in front."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    lead: bool

    @classmethod
    def parsed(cls, data: bytes) -> Model:
        names, scores, kinds, trainer, normaliser = [], [], [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                names.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3) != MERGES or not trainer.get(35) or trainer.get(24):
            raise ValueError("not a model of merges with byte fallback and leading spaces")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a model that normalises texts, or has pieces of the user, is not supported")
        return cls(tuple(names), tuple(scores), tuple(kinds), bool(normaliser.get(3, 1)))


class _Borders:
    """How a piece comes about, seen from its left and its right end.

    Per end: the run of characters at the end before anything is merged, and for each merge that
    changes it the worst rank up to there and the run after it. Ranks: the best score is least.
    """

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.left: dict[str, list[tuple[float, str]]] = {}
        self.right: dict[str, list[tuple[float, str]]] = {}

    def learn(self, piece: str) -> bool:
        """Replay the merges of a piece; False if they do not make it."""
        runs = list(piece)
        left, right = [(0.0, runs[0])], [(0.0, runs[-1])]
        worst_left = worst_right = -float("inf")
        while len(runs) > 1:
            rank, at = min((self.ranks.get(a + b, float("inf")), k) for k, (a, b) in enumerate(zip(runs, runs[1:])))
            if rank == float("inf"):
                return False
            runs[at : at + 2] = [runs[at] + runs[at + 1]]
            worst_left, worst_right = max(worst_left, rank), max(worst_right, rank)
            if runs[0] != left[-1][1]:
                left.append((worst_left, runs[0]))
                worst_left = -float("inf")
            if runs[-1] != right[-1][1]:
                right.append((worst_right, runs[-1]))
                worst_right = -float("inf")
        self.left[piece], self.right[piece] = left, right
        return True

    def may_follow(self, a: str, b: str) -> bool:
        """Whether a and b are left as they are side by side; a character without a piece has no merges."""
        before = self.right.get(a) or [(0.0, a)]
        after = self.left.get(b) or [(0.0, b)]
        i = j = 1
        x, y = before[0][1], after[0][1]
        while True:
            mine = before[i][0] if i < len(before) else float("inf")
            theirs = after[j][0] if j < len(after) else float("inf")
            across = self.ranks.get(x + y, float("inf"))
            if across < mine and across <= theirs:  # of equals the leftmost is first
                return False
            if mine == theirs == float("inf"):
                return True
            if mine <= theirs:
                x, i = before[i][1], i + 1
            else:
                y, j = after[j][1], j + 1


class Encoder:
    """Ids of texts and texts of ids under a model."""

    def __init__(self, model: Model):
        self.model = model
        named = [(name, k) for k, name in enumerate(model.pieces) if model.kinds[k] == NORMAL]
        self.ids = dict(named)
        self.of_byte = {int(name[3:5], 16): k for k, name in enumerate(model.pieces) if model.kinds[k] == BYTE}
        self.controls = {k for k, kind in enumerate(model.kinds) if kind == CONTROL}
        self.borders = _Borders({name: -model.scores[k] for name, k in named})
        self.automaton = ahocorasick.Automaton()
        for name, _ in named:
            if self.borders.learn(name):
                self.automaton.add_word(name, name)
        self.automaton.make_automaton()
        # Where no piece reaches across: before a space that follows something else, around control characters.
        known = {c for name, _ in named for c in name}
        alone = "".join(re.escape(c) for c in map(chr, range(0x20)) if c not in known)
        spaces_lead = not any(SPACE in name.lstrip(SPACE) for name, _ in named)
        run = f"[^{SPACE}{alone}]" if spaces_lead else f"[^{alone}]" if alone else "."
        parts = [f"{SPACE}+{run}*", f"{run}+"] if spaces_lead else [f"{run}+"]
        self.parts = re.compile("|".join([*parts, *([f"[{alone}]"] if alone else [])]), re.DOTALL).findall
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self.bytes_of = [self._bytes(k) for k in range(len(model.pieces))]

    # Encoding

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as 32-bit integers one after the other."""
        if not text:
            return b""
        if len(self._known) >= PARTS:  # parts met since then are remembered on, others are not
            self._known, self._before = {}, self._known
        known, before = self._known, self._before
        parts = self.parts((SPACE if self.model.lead else "") + text.replace(" ", SPACE))
        encoded = list(map(known.get, parts))
        for k, ids in enumerate(encoded):
            if ids is None:
                part = parts[k]
                ids = known.get(part) or before.get(part)
                if ids is None:
                    ids = array("i", self._recovered(part, self.last_tokens(part))).tobytes()
                if len(part) <= PART_CHARS:
                    known[part] = ids
                encoded[k] = ids
        return b"".join(encoded)

    def last_tokens(self, part: str) -> list[str | None]:
        """For the end of every prefix its last token; None where that is a character without a piece."""
        last: list[str | None] = [None] * (len(part) + 1)
        pairs = self._pairs
        if len(pairs) >= PAIRS:
            pairs.clear()
        for end, token in self.automaton.iter(part):
            end += 1
            if last[end] is None:
                begin = end - len(token)
                if begin:
                    pair = (last[begin] or part[begin - 1], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.borders.may_follow(*pair)
                    if not fits:
                        continue
                last[end] = token
        return last

    def _recovered(self, part: str, last: list[str | None]) -> list[int]:
        ids, end = [], len(part)
        while end:
            token = last[end]
            if token is None:
                ids.extend(self.of_byte[b] for b in reversed(part[end - 1].encode()))
                end -= 1
            else:
                ids.append(self.ids[token])
                end -= len(token)
        ids.reverse()
        return ids

    # Decoding

    def _bytes(self, k: int) -> bytes:
        kind, name = self.model.kinds[k], self.model.pieces[k]
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        return b"" if kind == CONTROL else UNKNOWN_SHOWN.encode() if kind == UNKNOWN else name.replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space in front goes, and so do control pieces; bytes of no character are replaced one by one."""
        kinds, of = self.model.kinds, self.bytes_of
        first = next((k for k, i in enumerate(ids) if kinds[i] != CONTROL), len(ids))
        ids = ids[first:]
        led = self.model.lead and bool(ids) and kinds[ids[0]] == NORMAL and of[ids[0]][:1] == b" "
        if self.controls.isdisjoint(ids):
            try:
                return b"".join([of[i] for i in ids])[led:].decode()
            except UnicodeDecodeError:
                pass
        # Only bytes side by side make a character together.
        runs = ("".join(_each_byte(b"".join(of[i] for i in run))) for _, run in groupby(ids, lambda i: kinds[i] == BYTE))
        return "".join(runs)[led:]


def _each_byte(data: bytes) -> Iterator[str]:
    while data:
        try:
            yield data.decode()
            return
        except UnicodeDecodeError as wrong:
            yield data[: wrong.start].decode() + "�"
            data = data[wrong.start + 1 :]


_encoders: dict[int, Encoder] = {}


def encoder_of(data: bytes) -> Encoder:
    """The encoder of a model file's bytes, built once per worker process."""
    key = hash(data)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Model.parsed(data))
    return _encoders[key]


def _id_lists(encoded: list[bytes]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in encoded])])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def _mapped(frame: DataFrame, model: str, by: str, run, out: str) -> DataFrame:
    """Apply ``run(encoder, piece)`` to slices of (doc_id, by); the model file is read by the driver and sent along."""
    sent = frame.sparkSession.sparkContext.broadcast(Path(model).read_bytes())  # half a megabyte, whatever the corpus

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoder = encoder_of(sent.value)
            for piece in slices(batch, by) if by == "text" else [batch]:
                columns = {"doc_id": piece.column("doc_id"), **run(encoder, piece)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.select("doc_id", by).mapInArrow(each, f"doc_id {kind}, {out}")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of every whole text."""

    def run(encoder: Encoder, piece: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"ids": _id_lists([encoder.encode(text or "") for text in piece.column("text").to_pylist()])}

    return _mapped(docs, model, "text", run, "ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every list of ids; a null list is empty."""

    def run(encoder: Encoder, piece: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"text": pa.array([encoder.decode(ids or []) for ids in piece.column("ids").to_pylist()], pa.string())}

    return _mapped(encoded, model, "ids", run, "text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids of every whole text and the text that the ids decode to, in one pass."""

    def run(encoder: Encoder, piece: pa.RecordBatch) -> dict[str, pa.Array]:
        encoded = [encoder.encode(text or "") for text in piece.column("text").to_pylist()]
        decoded = [encoder.decode(np.frombuffer(ids, np.int32).tolist()) for ids in encoded]
        return {"ids": _id_lists(encoded), "decoded": pa.array(decoded, pa.string())}

    return _mapped(docs, model, "text", run, "ids array<int>, decoded string")
