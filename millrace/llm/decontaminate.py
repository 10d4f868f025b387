"""Finds benchmark passages in documents by winnowing.

A window is a run of ``window`` consecutive words of an item, or a whole shorter item. Of the hashes
of all k-grams of a text only those are kept that are the smallest in some run of
``window - k + 1`` k-grams. A run of ``window`` words that a document and an item share has such a
run of k-grams on both sides, so both keep its smallest: no shared window is missed.

Fingerprints that documents and items share are extended to the windows around them, and these
are joined with the items' windows by a 128-bit digest of their words. Before the join
both fingerprints and windows are held against a bitmap of the benchmark's, of a fixed size; it
lets through everything that is shared and very little else, so that the join moves hits, not the
corpus. Items shorter than a window are looked up at every position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions import quoted
from millrace.llm.shared import stored
from millrace.llm.tokens import ALNUM, Words, minimizers, mix, words

_NEVER = np.uint64(2**64 - 1)


def _salted(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of runs of one length, apart from those of other lengths."""
    return mix(hashes ^ mix(np.array([length], dtype=np.uint64)))


def _grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-grams at all positions, and which lie within one text."""
    return _salted(w.rolling.grams(k), k), w.whole(k)


def _kept_grams(w: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed k-grams of the texts."""
    grams, whole = _grams(w, k)
    at = minimizers(np.where(whole, grams, _NEVER), window - k + 1)
    at = at[whole[at]]
    return at, grams[at]


def _digest(w: Words, starts: np.ndarray, length: int) -> list[bytes]:
    body = w.data.tobytes()
    first, last = w.starts.tolist(), w.ends.tolist()
    return [
        xxhash.xxh3_128_digest(b" ".join([body[first[j] : last[j]] for j in range(i, i + length)]))
        for i in starts.tolist()
    ]


def _item_windows(items: DataFrame, k: int, window: int) -> DataFrame:
    """``item``, ``length``, ``digest`` of every window, and the hashes that the bitmap is to have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0)
            for w in words(batch.column(1), ALNUM, lower=True):
                keep = lambda text, n, d, h: pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(w.first_row + text)),
                        pa.array([n] * len(text), pa.int32()),
                        pa.array(d, pa.binary()),
                        pa.array(h.view(np.int64)),
                    ],
                    names=["item", "length", "digest", "hash"],
                )
                grams, whole = _grams(w, window)
                at = np.flatnonzero(whole)
                yield keep(w.text_of[at], window, _digest(w, at, window), grams[at])
                at, hashes = _kept_grams(w, k, window)
                yield keep(w.text_of[at], 0, [None] * len(at), hashes)
                for n in range(1, window):
                    short = np.flatnonzero(w.counts == n)
                    if len(short):
                        grams, at = _grams(w, n)[0], w.of_text[short]
                        yield keep(short, n, _digest(w, at, n), grams[at])

    inputs = items.select("item", F.col("text").cast("binary"))
    return inputs.mapInArrow(run, "item string, length int, digest binary, hash long")


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each hash modulo ``bits``; ``bits`` bounds what comes to the driver."""
    slot = F.expr(f"pmod(hash, {bits})")
    found = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits >> 6, dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    k: int = 5,
    bitmap_bits: int = 1 << 26,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    with_row: bool = False,
) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``.

    A word is hit if it lies in an occurrence of a window. ``n_items`` counts the items that have
    such a window, ``items_sha256`` is the hex digest of their ids, sorted as strings and joined by
    commas. ``with_row`` gives the whole input rows as a struct ``row`` besides.

    Null and empty texts have no words and are clean; items without words have no window, and items
    of a null id are left out. Rows that repeat a doc_id or a whole row get a result each; items that repeat
    an id count as one item. Empty tables give no rows, or clean ones. Other columns are ignored.
    """
    spark = docs.sparkSession
    named = items.select(quoted(item_id).cast("string").alias("item"), quoted(item_text).alias("text"))
    found = stored(_item_windows(named.filter("item IS NOT NULL"), k, window), "item-windows")
    bitmap = spark.sparkContext.broadcast(_bitmap(found, bitmap_bits))
    lengths = sorted(r[0] for r in found.filter(f"length between 1 and {window - 1}").select("length").distinct().collect())
    has_long = not found.filter(f"length = {window}").isEmpty()

    def starts_of(w: Words) -> Iterator[tuple[int, np.ndarray]]:
        """Lengths, and where windows of it may start."""
        if has_long:
            at, hashes = _kept_grams(w, k, window)
            at = at[_in_bitmap(bitmap.value, hashes)]
            if len(at):
                around = np.unique((at[:, None] - np.arange(window - k + 1)).ravel())
                around = around[(around >= 0) & (around + window <= len(w.starts))]
                around = around[w.text_of[around] == w.text_of[around + window - 1]]
                runs = _salted(w.rolling.runs(around, around + window), window)
                yield window, around[_in_bitmap(bitmap.value, runs)]
        for n in lengths:
            grams, whole = _grams(w, n)
            yield n, np.flatnonzero(whole & _in_bitmap(bitmap.value, grams))

    kept = docs.columns if with_row else []
    inputs = docs.select(
        quoted(doc_id).cast("long").alias("doc_id"),
        quoted(text).cast("binary").alias("text"),
        *([F.struct(*map(quoted, kept)).alias("row")] if with_row else []),
    )
    hit = T.StructType().add("start", "integer").add("length", "integer").add("digest", "binary")
    schema = T.StructType().add("row_id", "long").add("doc_id", "long").add("n_words", "long")
    schema = schema.add("hits", T.ArrayType(hit))
    if with_row:
        schema = schema.add("row", inputs.schema["row"].dataType)
    hit_type = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 36
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros(n, dtype=np.int64)
            hits: list[list | None] = [None] * n
            for w in words(batch.column(1), ALNUM, lower=True):
                counts[w.first_row : w.first_row + len(w.counts)] = w.counts
                for length, starts in starts_of(w):
                    of = w.text_of[starts]
                    places = (starts - w.of_text[of]).tolist()
                    for text_no, start, digest in zip(of.tolist(), places, _digest(w, starts, length), strict=True):
                        row = w.first_row + text_no
                        hits[row] = hits[row] or []
                        hits[row].append((start, length, digest))
            arrays = [
                pa.array(np.arange(next_id, next_id + n)),
                batch.column(0),
                pa.array(counts),
                pa.array([x and [dict(zip(("start", "length", "digest"), h, strict=True)) for h in x] for x in hits], pa.list_(hit_type)),
            ]
            next_id += n
            yield pa.RecordBatch.from_arrays(arrays + batch.columns[2:], names=schema.names)

    passed = stored(inputs.mapInArrow(run, schema), "document-hits")

    hits = passed.filter("hits IS NOT NULL").select("row_id", F.explode("hits").alias("h")).select("row_id", "h.*")
    windows = found.filter("length > 0").select("length", "digest", "item").distinct()
    real = stored(hits.join(windows.select("length", "digest").distinct(), ["length", "digest"], "left_semi"), "real-hits")
    # Ranges of one document, from left to right; each adds what the ones before do not cover.
    spans = real.groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"))
    spans = spans.select(
        "row_id",
        F.expr(
            "aggregate(spans, named_struct('upto', 0, 'n', 0L), (s, x) -> named_struct("
            "'upto', greatest(s.upto, x.start + x.length),"
            "'n', s.n + greatest(0, x.start + x.length - greatest(s.upto, x.start)))).n"
        ).alias("n_hit"),
    )
    pairs = real.select("row_id", "length", "digest").distinct().join(windows, ["length", "digest"])
    named_items = pairs.groupBy("row_id").agg(F.array_sort(F.collect_set("item")).alias("found"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    found_items = F.coalesce("found", F.array().cast("array<string>"))
    return (
        passed.drop("hits")
        .join(spans, "row_id", "left")
        .join(named_items, "row_id", "left")
        .select(
            *(["row"] if with_row else []),
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(found_items).cast("long").alias("n_items"),
            F.sha2(F.array_join(found_items, ","), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
