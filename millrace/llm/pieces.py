"""Encodes texts with a merge-type (BPE) piece model, and decodes ids, as the model's own library does.

Merging in order of score gives the same pieces wherever a text is cut, as long as no merge crosses
the cut. So a sequence of pieces is the encoding of a text if each piece encodes to itself and each
two neighbours stay apart when they are encoded together. It follows that every prefix of a text has
one last piece: of the pieces that end there, which an automaton finds in one pass, the one that
is compatible with the last piece of the prefix before it. A table keeps this piece for each prefix, and
the ids are read off it from the end. The time is linear in the text, whatever its words look like.

Texts are first cut between characters that stand side by side in no piece, as no merge crosses
there; short segments that came before are not worked out again.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from millrace.functions import quoted
from millrace.llm.tokens import text_slices

_BPE = 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_SPACE = "▁"
_NEVER = float("-inf")

#: Segments up to this length are remembered, so many at most, and so many tests of pairs.
_SHORT, _SEGMENTS, _PAIRS = 48, 1 << 19, 1 << 19
#: Characters that are cut into segments at a time.
_STEP = 1 << 18
#: Slots that tell which characters stand side by side in a piece. Two pairs of a slot only cut less.
_SLOTS = 1 << 22


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("millrace-each-byte", _each_byte)


class _Known(dict):
    """Values by key, worked out when first asked for. Of more than ``limit`` those not asked for lately are forgotten.

    Texts of more than ``_SHORT`` characters are worked out each time.
    """

    def __init__(self, work: Callable, limit: int) -> None:
        self._work, self._limit, self._before = work, limit, {}

    def __missing__(self, key: int | str):
        value = self._before.get(key)
        if value is None:
            value = self._work(key)
        if isinstance(key, int) or len(key) <= _SHORT:
            if 2 * len(self) >= self._limit:
                self._before = dict(self)
                self.clear()
            self[key] = value
        return value


class PieceModel:
    """A model file of kind BPE with byte fallback and no normalization."""

    def __init__(self, path: str) -> None:
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        rules = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        if (
            spec.trainer_spec.model_type != _BPE
            or not spec.trainer_spec.byte_fallback
            or spec.trainer_spec.treat_whitespace_as_suffix
            or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
            or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError(f"{path} is no BPE model with byte fallback and plain text")
        self.prefix = _SPACE if rules.add_dummy_prefix else ""
        self.size = len(spec.pieces)
        self.end_id = next(i for i, p in enumerate(spec.pieces) if p.piece == "</s>")
        self._control = {i for i, p in enumerate(spec.pieces) if p.type == _CONTROL}
        self._bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == _BYTE}
        #: The bytes that an id stands for in a decoded text.
        self.surface = [self._surface(p, spec.trainer_spec.unk_surface) for p in spec.pieces]
        self._leads = {i for i, p in enumerate(spec.pieces) if p.type == _NORMAL and p.piece[0] == _SPACE}
        self._scores = {p.piece: p.score for p in spec.pieces if p.type == _NORMAL}
        # Characters that are in pieces but are none are units of their own, written as bytes.
        inner = sorted({c for p in self._scores for c in p} - self._scores.keys())
        ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == _NORMAL}
        ids |= {c: self.size + i for i, c in enumerate(inner)}
        self._units = [None] * (self.size + len(inner))
        for piece, i in ids.items():
            self._units[i] = piece
        self._fallback = {ids[c]: self._as_bytes(c) for c in inner}
        self._history = [self._merge(piece) if piece else None for piece in self._units]
        self._compatible = _Known(self._stay_apart, _PAIRS)
        self._automaton = ahocorasick.Automaton()
        for piece, i in ids.items():
            if self._history[i]:
                self._automaton.add_word(piece, (i, len(piece)))
        self._automaton.make_automaton()
        self._inside = np.zeros(_SLOTS, dtype=bool)
        for piece in self._scores:
            codes = self._codes(piece)
            self._inside[self._slot(codes)] = True
        self._segments = _Known(self._encode_segment, _SEGMENTS)

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == _CONTROL:
            return b""
        if piece.type == _BYTE:
            return bytes([int(piece.piece[3:5], 16)])
        return (unknown if piece.type == _UNKNOWN else piece.piece.replace(_SPACE, " ")).encode()

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        """Where the pairs of neighbouring characters are noted."""
        return (codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(10)

    def _as_bytes(self, char: str) -> tuple[int, ...]:
        return tuple(self._bytes[b] for b in char.encode())

    def _merge(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make up the piece: (score of the next, last symbol, first symbol) before each.

        None if merging its characters does not lead to the piece.
        """
        symbols, steps = list(piece), []
        while len(symbols) > 1:
            scores = [self._scores.get(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = max(scores)
            if best == _NEVER:
                return None
            steps.append((best, symbols[-1], symbols[0]))
            at = scores.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [*steps, (_NEVER, symbols[0], symbols[0])]

    def _stay_apart(self, pair: int) -> bool:
        """Whether no merge crosses from one piece to the next when both are encoded together.

        ``pair`` is the first times the number of units, plus the second. Merges go by score, the leftmost
        first of equal ones.
        """
        left, right = (self._history[i] for i in divmod(pair, len(self._units)))
        i = j = 0
        while True:
            (next_left, last, _), (next_right, _, first) = left[i], right[j]
            across = self._scores.get(last + first, _NEVER)
            if across > next_left and across >= next_right and across != _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left >= next_right:
                i += 1
            else:
                j += 1

    def _encode_segment(self, segment: str) -> bytes:
        """Its ids, of four bytes each: a remembered segment is two small objects, not one for each id."""
        last, lengths = [-1] * (len(segment) + 1), [0] * (len(segment) + 1)
        apart, units = self._compatible, len(self._units)
        for at, (piece, length) in self._automaton.iter(segment):
            before = at + 1 - length
            # Behind the start, and behind a character that no piece has, any piece that ends here is the first.
            if last[at + 1] < 0 and (not before or last[before] < 0 or apart[last[before] * units + piece]):
                last[at + 1], lengths[at + 1] = piece, length
        out, at = [], len(segment)
        while at:
            piece = last[at]
            if piece < 0:
                out += reversed(self._as_bytes(segment[at - 1]))
                at -= 1
            elif piece >= self.size:
                out += reversed(self._fallback[piece])
                at -= lengths[at]
            else:
                out.append(piece)
                at -= lengths[at]
        return array("i", reversed(out)).tobytes()

    def _cut(self, text: str) -> Iterator[list[str]]:
        """Segments between which no merge takes place, those of a part of the text at a time."""
        at, step = 0, _STEP
        while at < len(text):
            part = text[at : at + step]
            ends = (np.flatnonzero(~self._inside[self._slot(self._codes(part))]) + 1).tolist()
            if at + len(part) == len(text):
                ends.append(len(part))
            elif not ends:
                step *= 2
                continue
            yield [part[i:j] for i, j in zip([0, *ends], ends, strict=False)]
            at, step = at + ends[-1], _STEP

    def encode(self, text: str) -> np.ndarray:
        """The ids of the pieces of a text, without an end id."""
        parts = self._cut(self.prefix + text.replace(" ", _SPACE)) if text else ()
        return np.frombuffer(b"".join(map(self._segments.__getitem__, chain.from_iterable(parts))), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids. Bytes that are no UTF-8 give U+FFFD each; ids out of range are an error."""
        out = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and next((i for i in ids if i not in self._control), -1) in self._leads:
            out = out[1:]
        return out.decode("utf-8", "millrace-each-byte")


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(
    docs: DataFrame,
    model_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    add_end: bool = True,
    with_decoded: bool = False,
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row's whole text, in the table's order of rows.

    ``add_end`` puts the model's end id last. ``with_decoded`` decodes the ids again in the same task, as
    a column ``decoded``.

    Null and empty texts have the end id alone, or none. A null doc_id stays null, repeated rows give
    a row each, an empty table none; other columns are ignored. Nothing is shuffled. The model's
    file must be readable on the executors under the same path.
    """
    names = ["doc_id", "ids", *(["decoded"] if with_decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        end = np.array([model.end_id] if add_end else [], np.int32)
        for batch in batches:
            for row, offsets, data in text_slices(batch.column(1)):
                body, at = data.tobytes(), offsets.tolist()
                texts = [body[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]
                ids = [np.concatenate([model.encode(t), end]) for t in texts]
                columns = [batch.column(0).slice(row, len(ids)), _lists(ids)]
                if with_decoded:
                    columns.append(pa.array([model.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    inputs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"))
    schema = "doc_id long, ids array<int>" + (", decoded string" if with_decoded else "")
    return inputs.mapInArrow(run, schema)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(arrays)))


def decode(rows: DataFrame, model_path: str, row_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded``, the text that each row's array of ids stands for.

    Null and empty arrays give an empty text, null ids within an array and ids that the model does not have
    stop the job. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            texts = []
            for x in batch.column(1):
                x = x.as_py() or []
                if any(i is None or not 0 <= i < model.size for i in x):
                    raise ValueError(f"ids must lie between 0 and {model.size - 1}")
                texts.append(model.decode(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    inputs = rows.select(quoted(row_id).cast("long").alias("doc_id"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    return inputs.mapInArrow(run, "doc_id long, decoded string")
