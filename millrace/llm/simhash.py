"""SimHash near-duplicates by bit counts of segments.

A text's fingerprint takes the majority of each bit over the hashes of its word shingles. Two
fingerprints that differ in at most ``max_bits`` bits are linked, links joined to components.

Candidates come from the segment-popcount embedding: a fingerprint is cut into segments and mapped
to the vector of their bit counts. The Manhattan distance of two vectors is at most the Hamming
distance of the fingerprints, so pairs beyond ``max_bits`` in the embedding need no look. The
range join runs on a grid: the segments are dealt to ``max_bits + 4`` groups, and of two vectors
within ``max_bits`` at least four groups are equal. Every choice of four groups is a grid whose
cells are the counts in these groups; each pair in range meets in a cell of some grid. There it is
held against the Manhattan bound and then compared bit by bit.

No pairs are put out: a cell gives each fingerprint a link to the smallest one of its component
within the cell. A cell with more than ``cell_rows`` fingerprints is not worked on as a whole but
cut into blocks, and pairs of blocks are dealt out to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import components
from millrace.functions import quoted
from millrace.llm.shared import stored
from millrace.llm.tokens import mix, words

_SEED = 42
SEGMENT_BITS = 2
#: Cells of up to so many fingerprints are worked on together.
SMALL_CELL = 64
#: Parts in which the fingerprints of a component are joined with its smallest document.
_PARTS = 16
_MAJORITY_ROWS = 1 << 15


def _fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _MAJORITY_ROWS):
        bits = np.unpackbits(hashes[at : at + _MAJORITY_ROWS].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint16 if len(bits) < 1 << 16 else np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(np.uint64)[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits in a long) of every row; other columns are ignored.

    A-Z is lower-cased, words end at ASCII white space. A text of fewer words than a shingle is one
    shingle; null and empty texts have fingerprint zero. Repeated rows give repeated rows.
    """
    schema = "doc_id long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            out = []
            for w in words(batch.column(1), lower=True):
                sizes = (w.ends - w.starts).astype(np.int64)
                for i in range(len(w.counts)):
                    first, last = int(w.of_text[i]), int(w.of_text[i + 1])
                    if first == last:
                        out.append(0)
                        continue
                    joined = b" ".join(w.data[w.offsets[i] : w.offsets[i + 1]].tobytes().split())
                    ends = np.cumsum(sizes[first:last] + 1) - 1
                    k = min(shingle, last - first)
                    starts = np.concatenate([[0], ends[:-1] + 1])[: last - first - k + 1].tolist()
                    found = [digest(joined[a:b], _SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]
                    out.append(_fingerprint(np.array(found, dtype=np.uint64)))
            fps = pa.array(np.array(out, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["doc_id", "fp"])

    inputs = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text")
    )
    return inputs.mapInArrow(run, schema)


def _count_codes(fps: np.ndarray) -> np.ndarray:
    """The bit counts of all segments, each in the two bits of its segment."""
    low = np.uint64(0x5555555555555555)
    return (fps & low) + ((fps >> np.uint64(1)) & low)


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The Manhattan distance of count vectors, counts 0 to 2 in two bits each."""
    low = np.uint64(0x5555555555555555)
    apart = a ^ b  # 0/1: 01, 1/2: 11, 0/2: 10
    high = (apart >> np.uint64(1)) & low
    one = apart & low
    return np.bitwise_count(one) + 2 * np.bitwise_count(high & ~one)


def _grids(max_bits: int) -> list[np.ndarray]:
    """For each grid a mask of the segments whose counts make the cell."""
    groups, segments = max_bits + 4, 64 // SEGMENT_BITS
    masks = []
    for g in range(groups):
        bits = sum(0b11 << (SEGMENT_BITS * s) for s in range(segments) if s * groups // segments == g)
        masks.append(bits)
    return [np.uint64(sum(masks[g] for g in chosen)) for chosen in combinations(range(groups), 4)]


def _roots(n: int, pairs: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each of n the member of its component that comes first in ``order``."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        a, b = root(i), root(j)
        if a != b:
            if order[a] > order[b]:
                a, b = b, a
            parent[b] = a
    return np.array([root(i) for i in range(n)], dtype=np.int64)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs are linked: first by the lower bound, then bit by bit."""
    near = np.flatnonzero(_manhattan(_count_codes(a), _count_codes(b)) <= max_bits)
    return near[np.bitwise_count(a[near] ^ b[near]) <= max_bits]


def _linked(fps: np.ndarray, others: np.ndarray | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all components of ``fps``, or of both lots by pairs across them.

    Rows are compared with a block of the others at a time. Only links between what is not joined
    yet are kept.
    """
    everything = fps if others is None else np.concatenate([fps, others])
    label = np.arange(len(everything))
    for i in range(len(fps)):
        first = i + 1 if others is None else len(fps)
        near = first + _near(everything[first:], np.broadcast_to(everything[i], len(everything) - first), max_bits)
        joined = np.unique(label[near])
        joined = joined[joined != label[i]]
        if len(joined):
            label[np.isin(label, joined)] = label[i]
    return _to_lowest(everything, label)


def _to_lowest(fps: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each fingerprint to the smallest of the same label."""
    order = np.lexsort((fps, label))
    first = np.concatenate([[True], label[order[1:]] != label[order[:-1]]])
    low = np.empty(len(fps), dtype=fps.dtype)
    low[order] = fps[order[first]][np.cumsum(first) - 1]
    moved = low != fps
    return fps[moved], low[moved]


def _small_cells(cells: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many small cells at once, rows sorted by cell."""
    found, at, apart = [], np.arange(len(cells)), 1
    while len(at := at[at + apart < len(cells)]):
        at = at[cells[at] == cells[at + apart]]
        near = at[_near(fps[at], fps[at + apart], max_bits)]
        found.append(np.stack([near, near + apart], axis=1))
        apart += 1
    pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    members, flat = np.unique(pairs, return_inverse=True)
    return _to_lowest(fps[members], _roots(len(members), flat.reshape(-1, 2), fps[members])) if len(members) else (fps[:0], fps[:0])


def near_links(fps: DataFrame, max_bits: int, cell_rows: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that give the same components
    as all pairs at ``max_bits`` or fewer differing bits."""
    grids = _grids(max_bits)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(own), 4096):
                some = own[at : at + 4096]
                codes = _count_codes(some)
                cells = [mix((codes & mask) ^ mix(np.uint64([g + 1]))) for g, mask in enumerate(grids)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(cells).view(np.int64)),
                        pa.array(np.tile(some, len(grids)).view(np.int64)),
                    ],
                    names=["cell", "fp"],
                )

    schema = "a long, b long, cell long, block long"

    def rows(a: np.ndarray, b: np.ndarray, cell: int | None = None, block: int | None = None) -> pa.RecordBatch:
        columns = [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
        columns += [pa.array([cell] * len(a), pa.int64()), pa.array([block] * len(a), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "cell", "block"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell. Blocks of cells beyond ``cell_rows``, and of those that may go on in the task before or
        behind, leave to be paired."""
        cells, fps_here, block = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0
        first, at_start = TaskContext.get().partitionId() << 20, True

        def close(shared: bool) -> Iterator[pa.RecordBatch]:
            """What is held is the task's last block of the cell."""
            if len(fps_here) > 1:
                yield rows(*_linked(fps_here, None, max_bits))
            if block or shared:
                yield rows(fps_here, fps_here, int(cells[0]), first + block)

        for batch in batches:
            cells = np.concatenate([cells, batch.column(0).to_numpy(zero_copy_only=False)])
            own = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            fps_here = np.concatenate([fps_here, own])
            if not len(cells):
                continue
            change = np.flatnonzero(cells[1:] != cells[:-1]) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(cells)]])
            all_cells, all_fps = cells, fps_here
            small = ends - starts <= SMALL_CELL
            small[-1] = False  # may go on
            small[0] &= block == 0 and not at_start
            inside = np.repeat(small, ends - starts)
            yield rows(*_small_cells(all_cells[inside], all_fps[inside], max_bits))
            for k in np.flatnonzero(~small):
                cells, fps_here = all_cells[starts[k] : ends[k]], all_fps[starts[k] : ends[k]]
                block = block if k == 0 else 0
                while len(cells) > cell_rows:
                    some, cells, rest = fps_here[:cell_rows], cells[cell_rows:], fps_here[cell_rows:]
                    yield rows(*_linked(some, None, max_bits))
                    yield rows(some, some, int(cells[0]), first + block)
                    fps_here, block = rest, block + 1
                if k < len(starts) - 1:
                    yield from close(at_start and k == 0)
            at_start &= len(starts) == 1
        if len(cells):
            yield from close(True)

    cells = fps.select("fp").mapInArrow(to_cells, "cell long, fp long")
    # By ranges, so that a cell with a third of all fingerprints is dealt to a third of the tasks.
    dealt = cells.repartitionByRange("cell", "fp").sortWithinPartitions("cell", "fp").mapInArrow(solve, schema)
    dealt = stored(dealt, "cells")
    links = dealt.filter("cell IS NULL").select("a", "b")
    blocks = dealt.filter("cell IS NOT NULL").select("cell", "block", F.col("a").alias("fp"))

    def across(table: pa.Table) -> pa.Table:
        side = table["block"].to_numpy()
        own = table["fp"].to_numpy().view(np.uint64)
        left, right = own[side == side.min()], own[side == side.max()]
        links = _linked(left, right, max_bits)
        return pa.table({"a": links[0].view(np.int64), "b": links[1].view(np.int64)})

    # Pairs of blocks of one cell, then the fingerprints of both; most cells have one block, and no pair.
    known = blocks.select("cell", "block").distinct()
    pairs = known.withColumnRenamed("block", "x").join(known.withColumnRenamed("block", "y"), "cell").filter("x < y")
    sides = pairs.select("cell", "x", "y", F.explode(F.array("x", "y")).alias("block"))
    crossed = sides.join(blocks, ["cell", "block"]).groupBy("cell", "x", "y").applyInArrow(across, "a long, b long")
    return links.unionAll(crossed)


def _component_of(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints with the ``component`` they are linked in, named by one of its own; null without links."""
    # Signed order is as good as any for roots, as long as it is one order.
    nodes = components(near_links(distinct, max_bits))
    joined = distinct.join(nodes, distinct["fp"] == nodes["node"], "left").drop("node")
    return stored(joined, "components")


def simhash_components(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest doc_id reachable over links, the own one included; rows of a
    null doc_id take part and get the smallest id that is not null (null if there is none). Rows
    without words have fingerprint zero and are linked like others. Repeated rows stay. An empty
    table gives an empty result. Other columns are ignored.
    """
    marked = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    joined = _component_of(distinct, max_bits)
    linked = joined.filter("component IS NOT NULL")
    lowest = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    # A component may have a third of all fingerprints: it is joined in parts.
    lowest = lowest.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(_PARTS)])))
    part = F.pmod(F.xxhash64("fp"), F.lit(_PARTS)).cast("int").alias("part")
    # One plan at any size: components grow with the documents, so they are never sent to every task.
    named = linked.select("fp", "component", part).join(lowest.hint("merge"), ["component", "part"])
    named = named.select("fp", "component_id")
    named = named.unionAll(joined.filter("component IS NULL").select("fp", F.col("low").alias("component_id")))
    return marked.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def representatives(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one with the smallest id.

    Null ids come last; of rows that share the smallest id one stays, by a hash of id and text.
    """
    keyed = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("row"),
        F.xxhash64(quoted(doc_id), quoted(text)).alias("key"),
        quoted(doc_id).alias("id"),
        quoted(text).alias("body"),
    )
    marked = fingerprints(keyed, shingle, "key", "body").select(F.col("doc_id").alias("key"), "fp")
    prints = stored(marked, "fingerprints").distinct()
    rank = F.struct(F.col("id").isNull().alias("late"), "id", "key").alias("rank")
    lowest = keyed.select("key", rank).join(prints, "key").groupBy("fp").agg(F.min("rank").alias("low"))
    group = F.coalesce("component", "fp")
    kept = _component_of(lowest, max_bits).groupBy(group).agg(F.min("low").alias("low"))
    found = keyed.select("row", "key").join(kept.select("low.key"), "key", "left_semi")
    return found.dropDuplicates(["key"]).select("row.*")
