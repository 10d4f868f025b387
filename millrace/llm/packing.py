"""Packs documents into training sequences of several lengths with almost no padding.

Each task tokenizes its documents and packs them block by block. A block is a run of documents of
a bounded number of tokens, so memory does not depend on the data, nothing is shuffled, and each
block's plan depends on its documents alone.

Within a block, whole sequences are cut from long documents first. What is left of a document goes
to the tier of the shortest sequence that holds it. Each tier, the shortest first, is packed into
sequences of its own length, longest pieces first; the gap behind a piece is filled with what the shorter
tiers have left over, the last of it cut to fit. Pieces of any tier that fill no sequence of their
length are put together to the longest ones. What does not fill one goes on to the next block; at the end of a task it goes
to shorter sequences of a power of two, so that at most one sequence a task is padded. Sequences
are dealt to step groups, longest first, each to the group with the fewest tokens.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from millrace.functions import quoted
from millrace.llm.tokens import text_slices

#: The split of a byte-level BPE text into the pieces that are encoded one by one. A fixed value.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Lead bytes below this stand for letters all Unicode versions agree on (up to U+027F).
_PLAIN_LEAD = 0xCA


class BpeEncoder:
    """Ids of a byte-level BPE vocabulary file of the ``tokenizers`` library.

    The file's vocabulary is loaded into ``tiktoken``, which gives the same ids several times as
    fast. Where a text has characters beyond U+027F, on whose class libraries may disagree, or the
    file is not a plain byte-level BPE in rank order, ``tokenizers`` itself encodes. So it does texts
    with a run of white space that is too long for the patterns of ``tiktoken``, some million characters.

    ``special`` says whether the strings of special tokens in a text stand for these tokens.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = not special
        self._allowed = "all" if special else frozenset()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.fast = self._fast(spec)

    @staticmethod
    def _fast(spec: dict) -> tiktoken.Encoding | None:
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("ignore_merges")
        )
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = {c: b for b, c in byte_letters().items()}
        try:
            ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        except KeyError:
            return None
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [model["vocab"][m] for m in merged]
        if not plain or ids != sorted(ids):
            return None
        return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str, plain: bool) -> list[int]:
        if plain and self.fast is not None:
            try:
                return self.fast.encode(text, allowed_special=self._allowed, disallowed_special=())
            except ValueError:
                pass
        return self.exact.encode(text, add_special_tokens=False).ids

    def ids(self, text: str, plain: bool) -> np.ndarray:
        """The same ids as an array."""
        if plain and self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special=self._allowed, disallowed_special=())
            except ValueError:
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def _encoder(path: str) -> BpeEncoder:
    return BpeEncoder(path)


Piece = tuple[int, int, int]


def plan_block(
    lengths: list[int], longest: int, tiers: tuple[int, ...], last: bool = True
) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Sequences of one block: (window, [(document, start, length), ...]), and the pieces left.

    ``lengths`` are the documents' tokens, ``tiers`` the shorter windows, powers of two. All
    sequences are full, but for the end of the last block. Unless the block is the last, what does not fill one
    more is left. The last block's end goes to shorter windows, so that at most one sequence, of
    the shortest tier, is not full.
    """
    sequences: list[tuple[int, list[Piece]]] = []
    windows = sorted({*tiers, longest})
    pools: dict[int, list[Piece]] = {w: [] for w in windows}  # (length, document, start)
    for doc, n in enumerate(lengths):
        whole = n - n % longest
        sequences += [(longest, [(doc, at, longest)]) for at in range(0, whole, longest)]
        if n % longest:
            tier = next(w for w in windows if n % longest <= w)
            pools[tier].append((n % longest, doc, whole))
    for pool in pools.values():
        pool.sort()
    left = sum(piece[0] for pool in pools.values() for piece in pool)

    def fitting(gap: int, tiers: list[int] = windows) -> Piece | None:
        """Takes the longest piece of the tiers that fits."""
        for w in reversed(tiers):
            at = bisect_right(pools[w], (gap, 1 << 62, 0)) - 1
            if at >= 0:
                return pools[w].pop(at)
        return None

    def shortest() -> Piece:
        return next(pool for w in windows if (pool := pools[w])).pop(0)

    def cut(gap: int) -> Piece:
        """Takes a part of the shortest piece, its rest stays."""
        n, doc, start = shortest()
        rest = (n - gap, doc, start + gap)
        insort(pools[next(w for w in windows if rest[0] <= w)], rest)
        return gap, doc, start

    spare = 0  # tokens that shorter tiers have left over
    for k, w in enumerate(windows):
        unfilled: list[Piece] = []
        while pools[w]:
            taken = [pools[w].pop()]
            gap = w - taken[0][0]
            if k and gap > spare:
                unfilled += taken
                continue
            # The shortest tier fills its windows with its own pieces, and cuts none.
            while gap and (piece := fitting(gap, windows[: max(k, 1)]) or (cut(gap) if k else None)):
                taken.append(piece)
                gap -= piece[0]
            if gap:
                unfilled.append(taken[0])
                for piece in taken[1:]:
                    insort(pools[w], piece)
                continue
            sequences.append((w, [(doc, start, n) for n, doc, start in taken]))
            left -= w
            spare -= (w - taken[0][0]) if k else 0
        pools[w] = sorted(unfilled)
        spare += sum(piece[0] for piece in unfilled)

    while left >= (1 if last else longest):
        window = next((w for w in reversed(windows) if w <= left), windows[0])
        gap, pieces = min(window, left), []
        while gap:
            piece = fitting(gap)
            if piece is None:
                piece = cut(gap)
            pieces.append((piece[1], piece[2], piece[0]))
            gap -= piece[0]
            left -= piece[0]
        sequences.append((window, pieces))
    rest = sorted((doc, start, n) for pool in pools.values() for n, doc, start in pool)
    return sequences, rest


def step_groups(totals: list[int], per_group: int) -> list[int]:
    """A group for each sequence, so that groups differ little in tokens."""
    n = max(1, -(-len(totals) // per_group))
    heap = [(0, g) for g in range(n)]
    out = [0] * len(totals)
    for i in sorted(range(len(totals)), key=lambda i: (-totals[i], i)):
        tokens, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (tokens + totals[i], g))
    return out


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, window long, step_group long"
)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    longest: int = 2048,
    tiers: tuple[int, ...] = (16, 32, 64, 128, 256, 512, 1024),
    block_tokens: int = 1 << 20,
    sequences_per_step: int = 64,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece of a document, with the sequence and the offset where it lies.

    A document's ids are those of its text and then ``end_id``. ``sequence_id`` numbers sequences
    (not without gaps), ``window`` is the sequence's length with padding, ``step_group`` numbers
    groups of about ``sequences_per_step`` sequences of nearly the same number of tokens.
    ``with_ids`` adds the ids of each piece as a column ``ids`` (array of int).

    Null and empty texts are the end id alone; a null doc_id stays null. Repeated rows are packed
    each. An empty table gives no rows. Other columns are ignored. A block has ``block_tokens``
    tokens or one document more. The tokenizer's file must be readable on the executors under the
    same path; sequence ids hold for one run, as Spark deals files to tasks.
    """
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    # An entry of a block: doc_id, the ids that are left to pack, how many came before, all ids.
    Entry = tuple[int | None, np.ndarray, int, int]

    def emit(block: list[Entry], first: int, last: bool) -> tuple[pa.RecordBatch, int, list[Entry]]:
        sequences, left = plan_block([len(entry[1]) for entry in block], longest, tiers, last)
        groups = step_groups([sum(p[2] for p in pieces) for _, pieces in sequences], sequences_per_step)
        rows, ids_of = [], []
        for k, (window, pieces) in enumerate(sequences):
            offset = 0
            for entry, start, n in pieces:
                key, ids, before, total = block[entry]
                cut = ids[start : start + n]
                crc = zlib.crc32(cut.tobytes())
                rows.append((key, before + start, n, crc, total, first + k, offset, window, first + groups[k]))
                ids_of.append(cut)
                offset += n
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        if with_ids:
            columns.append(pa.array(ids_of, pa.list_(pa.int32())))
        rest = [
            (key, ids[start : start + n], before + start, total)
            for e, start, n in left
            for key, ids, before, total in [block[e]]
        ]
        return pa.RecordBatch.from_arrays(columns, names=names), len(sequences), rest

    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 36
        block: list[Entry] = []
        tokens = 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, offsets, data in text_slices(batch.column(1)):
                for i in range(len(offsets) - 1):
                    body = data[offsets[i] : offsets[i + 1]]
                    plain = not len(body) or bool(body.max() < _PLAIN_LEAD)
                    ids = encoder.encode(body.tobytes().decode("utf-8", "replace"), plain)
                    ids.append(end_id)
                    block.append((keys[row + i], np.array(ids, dtype="<u4"), 0, len(ids)))
                    tokens += len(ids)
                    if tokens >= max(block_tokens, longest):
                        out, made, block = emit(block, first, False)
                        first, tokens = first + made, sum(len(entry[1]) for entry in block)
                        yield out
        if block:
            yield emit(block, first, True)[0]

    inputs = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text")
    )
    return inputs.mapInArrow(run, schema)
