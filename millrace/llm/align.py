"""Holds the tokens of two tokenizers against each other, byte by byte.

Both encode the same text, so the tokens of each side cover the same bytes without gaps. Two tokens
overlap if one starts inside the other: an as-of join by document gives for each token's start the
other side's token that covers it, in both directions, and the union of both is every overlap. Where tokens
of both sides end at the same byte, a group ends.

How often a pair of ids is linked is counted over the whole corpus. Documents are put together to blocks of
bounded size in the task that tokenizes them. A block asks once for each of its distinct pairs, of which
there are few, so the join with the counts moves pairs of blocks, not links, and a pair that is in every
document is one row per block. The answers and the block's documents meet in a group of their own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions import quoted
from millrace.llm.packing import BpeEncoder, byte_letters
from millrace.llm.pieces import piece_model
from millrace.llm.shared import stored
from millrace.llm.tokens import text_slices

_PLAIN_LEAD = 0xCA
#: Bytes of text that are tokenized, and tokens that are joined, at a time.
_SLICE, _JOINED = 1 << 19, 1 << 18


def _names(mark: str, size: int) -> np.ndarray:
    """``mark`` and each id as ASCII text, padded with zero bytes to one width."""
    return np.array([f"{mark}{i}" for i in range(size)], dtype=np.bytes_)


class _Side:
    """One tokenizer: the bytes of its ids, and the ids as text, first in a group or behind others."""

    def __init__(self, surfaces: list[bytes], mark: str) -> None:
        self.size = len(surfaces)
        self.lengths = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.first, self.next = _names(mark, self.size), _names(",", self.size)

    def encode(self, text: str) -> np.ndarray:
        raise NotImplementedError


class ByteSide(_Side):
    """A byte-level BPE file of the ``tokenizers`` library. Strings of special tokens are plain text.

    The tokens give back the text, as merging bytes loses none, so long as the file puts nothing before the bytes.
    """

    def __init__(self, path: str) -> None:
        self._encoder = BpeEncoder(path, special=False)
        if self._encoder.fast is None:
            raise ValueError(f"{path} is no byte-level BPE file in rank order")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = {c: b for b, c in byte_letters().items()}
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        surfaces = [b""] * (1 + max(vocab.values()))
        for entry, i in vocab.items():
            surfaces[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        super().__init__(surfaces, ";")

    def encode(self, text: str) -> np.ndarray:
        body = text.encode()
        return self._encoder.ids(" " + text, not body or max(body) < _PLAIN_LEAD).astype(np.int64)


class PieceSide(_Side):
    """A piece model file, which puts a blank before the text itself.

    The tokens give back the text unless it has U+2581, which the model reads as a blank.
    """

    def __init__(self, path: str) -> None:
        self._model = piece_model(path)
        if not self._model.prefix:
            raise ValueError(f"{path} puts no blank before a text")
        super().__init__(self._model.surface, "|")

    def encode(self, text: str) -> np.ndarray:
        return self._model.encode(text).astype(np.int64)


@lru_cache(maxsize=2)
def _sides(a_path: str, b_path: str) -> tuple[ByteSide, PieceSide]:
    return ByteSide(a_path), PieceSide(b_path)


def overlaps(
    a_starts: np.ndarray, b_starts: np.ndarray, a_docs: np.ndarray, b_docs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of tokens, one of each side, whose bytes overlap.

    Starts ascend over all documents; a document's tokens of both sides cover the same bytes.
    """
    a = pd.DataFrame({"start": a_starts, "doc": a_docs, "a": np.arange(len(a_starts))})
    b = pd.DataFrame({"start": b_starts, "doc": b_docs, "b": np.arange(len(b_starts))})
    covering_a = pd.merge_asof(a, b, on="start", by="doc")
    covering_b = pd.merge_asof(b, a.assign(same=a_starts), on="start", by="doc")
    # Tokens that start together are found from both sides.
    covering_b = covering_b[covering_b["same"] != covering_b["start"]]
    both = pd.concat([covering_a[["a", "b"]], covering_b[["a", "b"]]])
    return both["a"].to_numpy(), both["b"].to_numpy()


@dataclass
class _Document:
    """A document's groups as text: the digest, and the text itself if it is wanted."""

    digest: hashlib._Hash
    parts: list[str] | None
    begun: bool = False

    def add(self, text: bytes) -> None:
        text = text if self.begun else text[1:]
        self.begun = True
        self.digest.update(text)
        if self.parts is not None:
            self.parts.append(text.decode())


@dataclass
class Aligned:
    """Of some documents: groups of each, and how often a document links each of its pairs of ids.

    ``of``, ``pairs`` and ``links`` go together, in order of document and pair.
    """

    n_groups: np.ndarray
    digests: list[str]
    texts: list[str | None]
    of: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


def align_ids(a: _Side, b: _Side, a_ids: list[np.ndarray], b_ids: list[np.ndarray], with_groups: bool) -> Aligned:
    """Aligns the ids of documents whose bytes are the same on both sides. A pair is ``a * size of b + b``.

    About ``_JOINED`` tokens are worked on at a time, and the rest of the group in which they end, so that
    a very long document takes little more memory than its tokens.
    """
    n, all_pairs = len(a_ids), a.size * b.size
    ids = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (a_ids, b_ids)]
    docs = [np.repeat(np.arange(n), [len(y) for y in x]) for x in (a_ids, b_ids)]
    ends = [np.cumsum(side.lengths[x]) for side, x in zip((a, b), ids, strict=True)]
    # Which tokens of each side end where one of the other does: they are the last of their groups.
    place = np.minimum(np.searchsorted(ends[1], ends[0]), max(0, len(ends[1]) - 1))
    shared = ends[1][place] == ends[0]
    last_b = np.zeros(len(ids[1]), dtype=bool)
    last_b[place[shared]] = True
    group = [np.cumsum(x) - x for x in (shared, last_b)]
    written = [_Document(hashlib.sha256(), [] if with_groups else None) for _ in range(n)]
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = [0, 0]
    while at[0] < len(ids[0]):
        first, last = group[0][at[0]], group[0][min(at[0] + _JOINED, len(ids[0])) - 1]
        parts = [slice(x, int(np.searchsorted(g, last, side="right"))) for x, g in zip(at, group, strict=True)]
        (a_part, a_of, a_end, a_group), (b_part, b_of, b_end, b_group) = (
            (x[p], d[p], e[p], g[p] - first) for x, d, e, g, p in zip(ids, docs, ends, group, parts, strict=True)
        )
        i, j = overlaps(a_end - a.lengths[a_part], b_end - b.lengths[b_part], a_of, b_of)
        found = a_of[i] * all_pairs + a_part[i] * b.size + b_part[j]
        for out, x in zip((keys, counts), np.unique(found, return_counts=True), strict=True):
            out.append(x)
        _write_groups(a, b, a_part, b_part, a_group, b_group, a_of, written)
        at = [p.stop for p in parts]
    found, links = keys[-1], counts[-1]
    if len(keys) > 2:  # a document may go on in the next part
        found, which = np.unique(np.concatenate(keys), return_inverse=True)
        links = np.bincount(which, np.concatenate(counts), len(found)).astype(np.int64)
    return Aligned(
        np.bincount(docs[0][shared], minlength=n),
        [d.digest.hexdigest() if d.begun else "" for d in written],
        ["".join(d.parts) if d.parts is not None else None for d in written],
        found // all_pairs,
        found % all_pairs,
        links,
    )


def _write_groups(
    a: _Side, b: _Side, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray,
    of: np.ndarray, written: list[_Document],
) -> None:
    """Adds whole groups to their documents, ``;a1,a2|b1`` each. ``of`` is the document of each token of a."""
    per_a, per_b = np.bincount(a_group), np.bincount(b_group)
    a_place = np.arange(len(a_ids)) + (np.cumsum(per_b) - per_b)[a_group]
    b_place = np.arange(len(b_ids)) + np.cumsum(per_a)[b_group]
    out = np.empty(len(a_ids) + len(b_ids), dtype=max(a.first.dtype, b.first.dtype))
    for side, ids, place, group in ((a, a_ids, a_place, a_group), (b, b_ids, b_place, b_group)):
        out[place] = side.next[ids]
        leads = np.flatnonzero(np.diff(group, prepend=-1))
        out[place[leads]] = side.first[ids[leads]]
    # Ends of documents are ends of groups, so a document's tokens lie side by side.
    lasts = np.flatnonzero(np.diff(of, append=-1))
    start = 0
    for doc, end in zip(of[lasts].tolist(), (a_place[lasts] + 1 + per_b[a_group[lasts]]).tolist(), strict=True):
        written[doc].add(out[start:end].tobytes().translate(None, b"\0"))
        start = end


_BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()),
        ("groups", pa.string()),
        ("places", pa.list_(pa.int32())),
        ("links", pa.list_(pa.int64())),
        ("pairs", pa.list_(pa.int64())),
    ]
)


def _tokenized(
    docs: DataFrame, a_path: str, b_path: str, block_bytes: int, block_rows: int, with_groups: bool
) -> DataFrame:
    """A row per document, and one per block of documents, which alone has ``pairs``, in ascending order.

    ``links`` says how often a document has the pairs at ``places`` of its block's ``pairs``; the block's row has the
    sums of its documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _sides(a_path, b_path)
        none = np.zeros(0, dtype=np.int64)
        block = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def emit() -> pa.RecordBatch:
            counts = np.concatenate([x for _, x in linked])
            pairs, places = np.unique(np.concatenate([x for x, _ in linked]), return_inverse=True)
            sums = np.bincount(places, counts, len(pairs)).astype(np.int64)
            cuts = np.cumsum([len(x) for x, _ in linked])[:-1]
            own = zip(np.split(places, cuts), np.split(counts, cuts), strict=True)
            out = [(block, *row, *x, None) for row, x in zip(rows, own, strict=True)]
            out.append((block, *[None] * 7, sums, pairs))
            columns = zip(zip(*out, strict=True), _BLOCKS, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in columns], schema=_BLOCKS)

        for batch in batches:
            for row, offsets, data in text_slices(batch.column(1), _SLICE):
                a_ids, b_ids, at = [], [], offsets.tolist()
                for start, end in zip(at, at[1:], strict=False):
                    text = data[start:end].tobytes().decode("utf-8", "replace")
                    kept = text and "\u2581" not in text
                    a_ids.append(a.encode(text) if kept else none)
                    b_ids.append(b.encode(text) if kept else none)
                    if a.lengths[a_ids[-1]].sum() != b.lengths[b_ids[-1]].sum():
                        raise AssertionError("both sides must cover the text")
                found = align_ids(a, b, a_ids, b_ids, with_groups)
                cuts = np.searchsorted(found.of, np.arange(1, len(a_ids)))
                linked += zip(np.split(found.pairs, cuts), np.split(found.links, cuts), strict=True)
                keys = batch.column(0).slice(row, len(a_ids)).to_pylist()
                n_a, n_b = map(len, a_ids), map(len, b_ids)
                rows += zip(keys, n_a, n_b, found.n_groups.tolist(), found.digests, found.texts, strict=True)
                size += at[-1]
                if size >= block_bytes or len(rows) >= block_rows:
                    yield emit()
                    block, size, rows, linked = block + 1, 0, [], []
        if rows:
            yield emit()

    schema = (
        "block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, "
        "places array<int>, links array<long>, pairs array<long>"
    )
    return docs.mapInArrow(run, schema)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 16 << 20,
    block_rows: int = 20_000,
    with_groups: bool = False,
    with_links: bool = False,
) -> DataFrame:
    """A row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``.

    ``a_path`` is a byte-level BPE file that encodes a blank and the text, ``b_path`` a piece model that puts
    the blank there itself. ``n_links`` counts the overlapping pairs of tokens. The count of a pair of ids is the number of
    links over the whole table; ``n_best`` counts the links whose count is the highest of their id of b, ties included,
    ``count_sum`` adds the counts of all links. Groups are written ``a1,a2|b1;a3|b2,b3`` and hashed;
    ``with_groups`` gives that text as ``groups`` too, ``with_links`` an array ``id_pairs`` of the document's distinct pairs with
    (a, b, links, count).

    Null and empty texts, and texts whose tokens do not give back the text (as with U+2581, which the piece model
    reads as a blank) have no tokens: zeros and empty texts. A null doc_id stays null; repeated rows
    count and are given each; an empty table gives no rows; other columns are ignored. A block has ``block_bytes`` of text
    or ``block_rows`` documents, and one slice of a megabyte or one document more. The files must be readable under the same path
    everywhere.
    """
    inputs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"))
    found = stored(_tokenized(inputs, a_path, b_path, block_bytes, block_rows, with_groups), "aligned")
    size_b = piece_model(b_path).size
    asked = found.filter("pairs IS NOT NULL").select("block", F.inline(F.arrays_zip("pairs", "links")))
    counts = asked.groupBy("pairs").agg(F.sum("links").alias("count"))
    # An id of b has as many pairs as a has ids at most.
    highest = F.max("count").over(Window.partitionBy(F.col("pairs") % size_b))
    counts = counts.withColumn("best", F.col("count") == highest)
    answers = asked.select(F.col("block").alias("for_block"), "pairs").join(counts, "pairs")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        + (", groups string" if with_groups else "")
        + (", id_pairs array<struct<a:int,b:int,links:long,count:long>>" if with_links else "")
    )

    def finish(block: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers["pairs"].to_numpy())
        pairs, count, best = (answers[c].to_numpy()[order] for c in ("pairs", "count", "best"))
        places, links = (block[c].combine_chunks() for c in ("places", "links"))
        offsets = places.offsets.to_numpy()
        places, links = places.values.to_numpy(), links.values.to_numpy()

        def sums(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
            return upto[offsets[1:]] - upto[offsets[:-1]]

        columns = [block[c] for c in ("doc_id", "n_a", "n_b", "n_groups")]
        columns += [sums(links), sums(links * best[places]), sums(links * count[places]), block["groups_sha256"]]
        names_ = list(names)
        if with_groups:
            columns.append(block["groups"])
            names_.append("groups")
        if with_links:
            a, b = (x.astype(np.int32) for x in np.divmod(pairs[places], size_b))
            rows = pa.StructArray.from_arrays([a, b, links, count[places]], ["a", "b", "links", "count"])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows))
            names_.append("id_pairs")
        return pa.table(columns, names=names_)

    rows = found.filter("pairs IS NULL").drop("pairs")
    return rows.groupBy("block").cogroup(answers.groupBy("for_block")).applyInArrow(finish, schema)
