"""Ranked search for texts by their words, with the best position algorithm.

A query's terms have a list each of the documents that hold them, by descending impact. All lists of a query are
read from the top at the same pace; a document that turns up anywhere is looked up directly in all other
lists, which gives its whole score and marks its positions there as seen. The best position of a list is the end
of the run of seen positions at its top, and may be far below the last one read. A document not seen yet
lies below the best position in every list, so it scores at most the sum of the impacts that follow
there. Reading stops when this bound is below the k-th score: strictly, as ties go by document id.

The corpus is divided by documents: a task builds lists for blocks of bounded size, one after another, and keeps
each query's best documents so far, so later blocks stop early or are not read at all. Tasks give
k documents a query at most, whose best are the result. What depends on the whole corpus (the number of documents
and terms, and how many documents hold a term) is counted before. Queries are worked on in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions import quoted
from millrace.llm.shared import stored
from millrace.llm.tokens import ALNUM, words

#: Positions of each list that are read first; each further round reads twice as many.
_FIRST = 32
#: Positions of all lists that are read at a time at most, or one of each list.
_READ = 1 << 20
#: An impact is below this, and a block has fewer documents than the other.
_IMPACTS, _DOCUMENTS = 1 << 20, 1 << 22


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What ``tf`` occurrences in a text of ``n`` terms are worth, in millionths."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        m = 25 + 75 * n * documents // terms
    else:
        m = np.array([25 + 75 * x * documents // terms for x in n.tolist()], dtype=np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    """The weight of a term that ``df`` of the documents hold, in thousandths."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Best:
    """The best documents of a query so far, best first. Null ids come behind others of the same score."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc_id: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    is_null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def least(self) -> int:
        """What a document must score to be among them."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray, is_null: np.ndarray) -> None:
        good = score >= self.least
        if not good.any():
            return
        score, doc_id, is_null = (
            np.concatenate([x, y[good]])
            for x, y in ((self.score, score), (self.doc_id, doc_id), (self.is_null, is_null))
        )
        top = np.lexsort((doc_id, is_null, -score))[: self.k]
        self.score, self.doc_id, self.is_null = score[top], doc_id[top], is_null[top]


class Lists:
    """Impact lists of a block of documents, and the terms of each document for direct access."""

    def __init__(
        self, doc_id: np.ndarray, is_null: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int
    ) -> None:
        self.doc_id, self.is_null = doc_id, is_null
        self._offsets, self._terms, self._impact = offsets, terms, impact
        docs = np.repeat(np.arange(len(doc_id)), np.diff(offsets))
        # Ordered by term, then impact from the highest, then document.
        if n_terms * _IMPACTS * _DOCUMENTS < 1 << 63:
            order = np.argsort((terms.astype(np.int64) * _IMPACTS + (_IMPACTS - 1 - impact)) * _DOCUMENTS + docs)
        else:
            order = np.lexsort((docs, -impact, terms))
        self._position = np.empty(len(order), dtype=np.int64)
        self._position[order] = np.arange(len(order))
        self._listed, self._worth = docs[order], impact[order]
        self._starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=n_terms))])
        self._seen_doc = np.zeros(len(doc_id), dtype=bool)
        self._unseen = np.ones(len(order) + 1, dtype=bool)
        self._weight = np.zeros(n_terms, dtype=np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> tuple[int, int]:
        """Puts the documents that score highest among the best. Gives the accesses: (sorted, direct)."""
        there = (self._starts[terms + 1] > self._starts[terms]) & (weights > 0)
        terms, weights = terms[there], weights[there]
        starts, ends = self._starts[terms], self._starts[terms + 1]
        self._weight[terms] = weights
        at, depth, accesses = starts.copy(), 0, [0, 0]
        step = max(1, min(_FIRST, _READ // max(1, len(terms))))
        touched_docs: list[np.ndarray] = []
        touched: list[np.ndarray] = []
        while True:
            open_ = at < ends
            if (weights[open_] * self._worth[at[open_]]).sum() < best.least:
                break
            reach = (starts + depth)[:, None] + np.arange(step)
            read = reach[reach < ends[:, None]]
            depth, step = depth + step, max(1, min(step * 2, _READ // len(terms)))
            docs = self._listed[read]
            docs = np.unique(docs[~self._seen_doc[docs]])
            accesses[0] += len(read)
            accesses[1] += len(docs)
            if len(docs):
                self._seen_doc[docs] = True
                touched_docs.append(docs)
                first, counts = self._offsets[docs], self._offsets[docs + 1] - self._offsets[docs]
                before = np.cumsum(counts) - counts
                own = np.arange(counts.sum()) + np.repeat(first - before, counts)
                w = self._weight[self._terms[own]]
                scores = np.add.reduceat(w * self._impact[own], before)
                seen = self._position[own[w > 0]]
                self._unseen[seen] = False
                touched.append(seen)
                best.add(scores, self.doc_id[docs], self.is_null[docs])
            for i, (a, b) in enumerate(zip(at.tolist(), ends.tolist(), strict=True)):
                # The first position that is not seen; the mark behind all lists is never seen.
                at[i] = min(b, a + int(self._unseen[a : b + 1].argmax())) if a < b else b
                if at[i] < b and not self._unseen[at[i]]:
                    at[i] = b
        self._weight[terms] = 0
        for x in touched_docs:
            self._seen_doc[x] = False
        for x in touched:
            self._unseen[x] = True
        return accesses[0], accesses[1]


def _query_terms(items: DataFrame) -> DataFrame:
    """``item``, ``term`` (a hash of 64 bits) and ``n``, how often the item has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for w in words(batch.column(1), ALNUM, lower=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[w.first_row + w.text_of]), pa.array(w.hashes.view(np.int64))], names=["item", "term"]
                )

    found = items.select("item", F.col("text").cast("binary")).mapInArrow(run, "item long, term long")
    return found.groupBy("item", "term").agg(F.count("*").alias("n"))


def _forward(docs: DataFrame, terms) -> DataFrame:
    """``doc_id``, ``n`` terms in all, and the document's distinct terms of those in a broadcast array.

    ``terms`` has places in that array, ``tfs`` how often the document has each. Texts without terms have no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            for w in words(batch.column(1), ALNUM, lower=True):
                place = np.minimum(np.searchsorted(known, w.hashes), len(known) - 1)
                hit = known[place] == w.hashes
                keys, tf = np.unique(w.text_of[hit] * len(known) + place[hit], return_counts=True)
                some = np.flatnonzero(w.counts)
                offsets = np.append(np.searchsorted(keys, some * len(known)), len(keys))
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x.astype(np.int32)))
                    for x in (keys % len(known), tf)
                ]
                ids = batch.column(0).take(pa.array(w.first_row + some))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(w.counts[some].astype(np.int64)), *lists], names=["doc_id", "n", "terms", "tfs"]
                )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _candidates(forward: DataFrame, queries, k: int, block_postings: int) -> DataFrame:
    """``item``, ``doc_id``, ``score`` of each task's best documents, k an item at most.

    ``queries`` is a broadcast of (items, offsets of their terms, terms, weights, number of terms, N, L).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, offsets, terms, weights, n_terms, documents, total = queries.value
        best = [Best(k) for _ in items]
        parts: list[tuple[np.ndarray, ...]] = []
        size = 0

        def search() -> None:
            doc_id, is_null, counts, own, impact = (np.concatenate(x) for x in zip(*parts, strict=True))
            ends = np.concatenate([[0], np.cumsum(counts)])
            lists = Lists(doc_id, is_null, ends, own, impact, n_terms)
            for i, found in enumerate(best):
                part = slice(offsets[i], offsets[i + 1])
                lists.search(terms[part], weights[part], found)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Rows until the block is full.
                lists = batch.column(2)
                upto = lists.offsets.to_numpy()
                room = upto[at] + block_postings - size
                end = min(max(at + 1, int(np.searchsorted(upto, room, side="right")) - 1), at + _DOCUMENTS // 2, batch.num_rows)
                rows = batch.slice(at, end - at)
                counts = np.diff(upto[at : end + 1])
                ids, n = rows.column(0), rows.column(1).to_numpy()
                tf = rows.column(3).flatten().to_numpy().astype(np.int64)
                worth = impacts(tf, np.repeat(n, counts), documents, total)
                null = ids.is_null().to_numpy(zero_copy_only=False)
                parts.append((ids.fill_null(0).to_numpy(), null, counts, rows.column(2).flatten().to_numpy(), worth))
                size += int(counts.sum())
                at = end
                if size >= block_postings or sum(len(p[0]) for p in parts) >= _DOCUMENTS // 2:
                    search()
                    size, parts = 0, []
        if parts:
            search()
        for i, found in enumerate(best):
            if len(found.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.score), items[i])),
                        pa.array(found.doc_id, mask=found.is_null),
                        pa.array(found.score),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return forward.mapInArrow(run, "item long, doc_id long, score long")


def _block(spark: SparkSession, docs: DataFrame, asked: DataFrame, k: int, block_postings: int) -> DataFrame | None:
    """``item``, ``doc_id``, ``score``: candidates for the items of a block of queries."""
    rows = asked.toArrow().combine_chunks().sort_by([("item", "ascending"), ("term", "ascending")])
    if not len(rows):
        return None
    item, term, times = (rows[c].to_numpy() for c in ("item", "term", "n"))
    known = np.unique(term.view(np.uint64))
    forward = stored(_forward(docs, spark.sparkContext.broadcast(known)), "forward-index")
    documents, total = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # A row for each term of the queries at most.
    held = forward.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df = np.zeros(len(known), dtype=np.int64)
    df[held["t"].to_numpy()] = held["count"].to_numpy()
    weights = np.array([weight(documents, x) for x in df.tolist()], dtype=np.int64)
    place = np.searchsorted(known, term.view(np.uint64))
    items, starts = np.unique(item, return_index=True)
    queries = (items, np.append(starts, len(item)), place, weights[place] * times, len(known), documents, total)
    return _candidates(forward, spark.sparkContext.broadcast(queries), k, block_postings)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_postings: int = 1 << 21,
    block_terms: int = 1 << 20,
) -> DataFrame:
    """A row for each of an item's ``k`` documents of the highest scores above zero: ``item_id``, ``rank`` (from 1),
    ``doc_id``, ``score``. Equal scores go by document id, nulls last.

    Terms are runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased. A term counts as often
    as the item has it. See ``weight`` and ``impacts`` for the score, which is in whole numbers.

    Null and empty texts and items have no terms: such documents are not counted and not found, such items
    have no rows. Rows that repeat a doc_id, and rows that repeat an item_id, are documents and items of their own;
    null ids are kept. Empty tables give no rows. Other columns are ignored. Terms are told apart by hashes of 64 bits.

    ``block_postings`` bounds the entries of a task's lists (or one document's). ``block_terms`` bounds the terms of
    the items that are searched for at a time, and with them what is broadcast (or one item's); documents are read once for
    each such block of items.
    """
    spark = docs.sparkSession
    named = items.select(
        F.monotonically_increasing_id().alias("item"), quoted(item_id).alias("item_id"), quoted(item_text).alias("text")
    )
    named = stored(named, "items")
    asked = stored(_query_terms(named), "item-terms")
    inputs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"))
    n_blocks = -(-asked.count() // block_terms)
    blocks = [asked.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == i) for i in range(n_blocks)]
    parts = [found for b in blocks if (found := _block(spark, inputs, b, k, block_postings)) is not None]
    if not parts:
        none = named.limit(0).select("item_id")
        return none.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    found = reduce(DataFrame.unionAll, parts)
    # Each task gave k rows an item, so the best are found in two steps.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(f"rank <= {k}")
    return found.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
