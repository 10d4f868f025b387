"""Toxic passages as maximum-scoring segments of token log-odds.

Learning counts, over all labelled training texts, in how many toxic and in how many other
texts a token occurs. A token's share of toxic texts is drawn to that of its prefixes by Dirichlet
(here beta) priors: from the share of all texts over ever longer prefixes down to the word, each
estimate is the prior of the next. So words never seen take after those that begin alike. Its
score is the log-odds of that share against the share of all texts, less some of its standard
deviation and a drift.

A linear scan finds every maximal-scoring segment of a text. The best chance segment of a text of n
tokens follows an extreme-value law with ``K n exp(-lambda s)`` expected segments above a score s;
``lambda`` is solved from the token scores of all clean training texts, ``K`` is fitted to their best segments.
Segments with fewer than one expected are significant. A logistic curve over the normalised
scores, fitted on a bounded sample of training rows, gives the probability. Training texts are scored
without their own counts there, so that it is not fitted to what the counts remember.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.functions import quoted
from millrace.llm.shared import added_up, stored
from millrace.llm.tokens import ALNUM, Words, mix, words

#: Lengths in bytes of the prefixes a word takes after; after these comes the word itself.
PREFIXES = (4, 5, 6, 7, 8, 10)
_BLOCKS = 64
#: Steps of the bounded draw, and the unit in which best scores are added up, exactly and in any order.
_DRAWS = 1024
_UNIT = 1 << 16


@dataclass
class Model:
    """What scoring needs: counts by hashed feature, priors, the extreme-value law and the curve."""

    counts: np.ndarray  # (buckets, 2): toxic and other texts
    base: float
    strength: float
    caution: float
    drift: float
    decay: float
    log_k: float
    curve: np.ndarray


def _features(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For each level and word the bucket of its feature, and whether the word has that level."""
    sizes = w.ends - w.starts
    out, has = [], []
    for level, size in enumerate((*PREFIXES, 0)):
        ends = np.minimum(w.ends, w.starts + size) if size else w.ends
        hashes = mix(w.bytes_hashed.runs(w.starts, ends) ^ np.uint64(level + 1))
        out.append((hashes % np.uint64(buckets)).astype(np.int64))
        has.append(sizes >= size)
    return np.array(out), np.array(has)


def _count_texts(w: Words, toxic: np.ndarray, counts: np.ndarray) -> None:
    """Adds each text once to the counts of each feature it has."""
    features, has = _features(w, len(counts))
    for f, h in zip(features, has, strict=True):
        pairs = np.unique(w.text_of[h] * np.int64(len(counts)) + f[h])
        text, bucket = pairs // len(counts), pairs % len(counts)
        label = toxic[text].astype(np.int64)
        np.add.at(counts, (bucket, 1 - label), 1)


def _token_scores(w: Words, model: Model, toxic: np.ndarray | None = None) -> np.ndarray:
    """Log-odds of each word. ``toxic``: the texts' labels, to leave out each text's own count."""
    if not 0 < model.base < 1:
        return np.zeros(len(w.starts))
    features, has = _features(w, len(model.counts))
    own = np.zeros(len(w.starts)) if toxic is None else toxic[w.text_of].astype(np.float64)
    left = 0.0 if toxic is None else 1.0
    share = np.full(len(w.starts), model.base)
    bad = good = np.zeros(0)
    for level in range(len(features)):
        bad, good = model.counts[features[level], 0] - left * own, model.counts[features[level], 1] - left * (1 - own)
        if level + 1 < len(features):
            # A prefix speaks by the texts that do not have the longer one, so that none counts twice.
            deeper = has[level + 1]
            bad = bad - np.where(deeper, model.counts[features[level + 1], 0] - left * own, 0)
            good = good - np.where(deeper, model.counts[features[level + 1], 1] - left * (1 - own), 0)
            bad, good = np.maximum(bad, 0), np.maximum(good, 0)
            share = np.where(
                has[level], (bad + model.strength * share) / (bad + good + model.strength), share
            )
    bad = np.maximum(bad, 0) + model.strength * share
    good = np.maximum(good, 0) + model.strength * (1 - share)
    odds = np.log(bad / good) - np.log(model.base / (1 - model.base))
    unsure = np.sqrt(1 / bad + 1 / good)
    return np.clip(odds - model.caution * unsure, -3, 6) - model.drift


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments, as (score, start, end), in one pass over the scores.

    Neighbours of one sign are summed first. Of the candidates so far each has the sums before and
    behind it; a new one is merged with the nearest one that begins lower and ends lower.
    """
    if not (scores > 0).any():
        return []
    bounds = np.flatnonzero(np.diff(scores > 0, prepend=not scores[0] > 0))
    sums = np.add.reduceat(scores, bounds).tolist()
    starts, ends = bounds.tolist(), np.append(bounds[1:], len(scores)).tolist()
    total, found = 0.0, []  # (sum before, sum behind, start, end)
    for value, start, end in zip(sums, starts, ends, strict=True):
        if value > 0:
            low, high, first = total, total + value, start
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][0] >= low:
                    j -= 1
                if j < 0 or found[j][1] >= high:
                    found.append((low, high, first, end))
                    break
                low, first = found[j][0], found[j][2]
                del found[j:]
        total += value
    return [(high - low, start, end) for low, high, start, end in found]


def _decay(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root x of the mean of exp(x * value) = 1, for values of negative mean."""
    low, high = 1e-3, 1.0
    mean = lambda x: float((weights * np.exp(x * values)).sum() / weights.sum())
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return (low + high) / 2


def _summary(scores: np.ndarray, model: Model) -> tuple[float, float, float]:
    """Normalised best score, log of one plus the sum of significant ones, log of their number."""
    found = segments(scores)
    if not found:
        return -10.0, 0.0, 0.0
    shift = model.log_k + np.log(len(scores))
    normal = [model.decay * s - shift for s, _, _ in found]
    significant = [x for x in normal if x > 0]
    return max(max(normal), -10.0), float(np.log1p(sum(significant))), float(np.log1p(len(significant)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, gradient)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _design(summaries: np.ndarray) -> np.ndarray:
    """Constant, positive and negative part of the best score, sum and number of significant ones."""
    best = summaries[:, 0]
    return np.column_stack([np.ones(len(best)), np.minimum(best, 0), np.maximum(best, 0).clip(max=40), summaries[:, 1:]])


def learn(
    labelled: DataFrame,
    toxic: str = "toxic",
    text: str = "text",
    buckets: int = 1 << 21,
    strength: float = 5.0,
    caution: float = 1.5,
    drift: float = 0.8,
    sample_rows: int = 100_000,
    sample_seed: int = 42,
    row_id: str | None = None,
) -> Model:
    """A model from labelled texts. Rows of a null label are left out; rows that repeat, such as those of a text that is
    labelled twice, count each.

    Counts and the law cover all rows; ``buckets`` bounds what comes to the driver (8 bytes each). The
    curve is fitted on ``sample_rows`` rows at most. They are drawn by a hash of ``row_id``, a column of
    unique values, else of the number that a row gets when it is stored: copies of a text are drawn one by
    one. Without rows of both labels every text gets the share of toxic rows.
    """
    key = quoted(row_id) if row_id else F.monotonically_increasing_id()
    rows = labelled.select(
        quoted(toxic).cast("int").alias("toxic"),
        quoted(text).cast("binary").alias("text"),
        (F.shiftrightunsigned(F.xxhash64(key, F.lit(sample_seed)), 11) * F.lit(2.0**-53)).alias("draw"),
    )
    rows = stored(rows.filter("toxic IS NOT NULL"), "labelled-texts")  # read four times, joined once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros((buckets, 2), dtype=np.int32), np.zeros(2, dtype=np.int64)
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False) != 0
            seen += [labels.sum(), (~labels).sum()]
            for w in words(batch.column(1), ALNUM, lower=True):
                _count_texts(w, labels[w.first_row : w.first_row + len(w.counts)], counts)
        if not seen.any():
            return
        size = buckets // _BLOCKS
        bodies = [zstandard.compress(counts[i * size : (i + 1) * size].astype(np.int64).tobytes(), 1) for i in range(_BLOCKS)]
        task = pa.array([TaskContext.get().partitionId()] * _BLOCKS, pa.int32())
        columns = [pa.array(range(_BLOCKS), pa.int32()), task, pa.array(bodies, pa.binary()), pa.array([seen.tolist()] * _BLOCKS)]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "task", "packed", "seen"])

    def add(table: pa.Table) -> pa.Table:
        total: np.ndarray | int = 0
        for body in table["packed"].to_pylist():
            total = total + np.frombuffer(zstandard.decompress(body), dtype=np.int64)
        seen = np.array(table["seen"].to_pylist(), dtype=np.int64).sum(axis=0).tolist()
        packed = pa.array([zstandard.compress(np.asarray(total, dtype=np.int64).tobytes(), 1)], pa.binary())
        return pa.table({"block": table["block"][:1], "task": table["task"][:1], "packed": packed, "seen": pa.array([seen])})

    schema = "block int, task int, packed binary, seen array<long>"
    blocks = added_up(rows.mapInArrow(count, schema), ["block"], add, schema, rows.rdd.getNumPartitions())
    blocks = blocks.toArrow().sort_by("block")
    counts = np.zeros((buckets, 2), dtype=np.float32)
    size, seen = buckets // _BLOCKS, [0, 0]
    for i, body in enumerate(blocks["packed"].to_pylist()):
        counts[i * size : (i + 1) * size] = np.frombuffer(zstandard.decompress(body), dtype=np.int64).reshape(-1, 2)
        seen = blocks["seen"][0].as_py()
    base = seen[0] / sum(seen) if sum(seen) else 0.0
    model = Model(counts, base, strength, caution, drift, 1.0, 0.0, np.zeros(5))
    if not all(seen):
        model.curve[0] = 30.0 if base else -30.0
        return model

    clean = rows.filter("toxic = 0").select("text")
    shared = rows.sparkSession.sparkContext.broadcast(model)
    edges = np.linspace(-4, 6, 1001)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each token score occurs in the clean texts."""
        bins = np.zeros(len(edges) + 1, dtype=np.int64)
        for batch in batches:
            for w in words(batch.column(0), ALNUM, lower=True):
                scores = _token_scores(w, shared.value, np.zeros(len(w.counts), dtype=bool))
                bins += np.bincount(np.searchsorted(edges, scores), minlength=len(bins))
        yield pa.RecordBatch.from_arrays([pa.array([bins.tolist()])], names=["bins"])

    bins = clean.mapInArrow(histogram, "bins array<long>").selectExpr("posexplode(bins) AS (bin, n)")
    totals = bins.groupBy("bin").sum("n").toArrow().sort_by("bin")
    weights = np.zeros(len(edges) + 1)
    weights[totals["bin"].to_numpy()] = totals["sum(n)"].to_numpy()
    values = np.concatenate([[edges[0]], (edges[1:] + edges[:-1]) / 2, [edges[-1]]])
    if (weights * values).sum() < 0 and weights[values > 0].sum() > 0:
        model.decay = _decay(values, weights)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def best_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number and sum of the best scores of the clean texts that have a segment."""
        n = total = 0
        for batch in batches:
            for w in words(batch.column(0), ALNUM, lower=True):
                scores = _token_scores(w, shared.value, np.zeros(len(w.counts), dtype=bool))
                best = [_summary(scores[a:b], shared.value)[0] for a, b in zip(w.of_text[:-1], w.of_text[1:], strict=True)]
                best = np.array([x for x in best if x > -10])
                n, total = n + len(best), total + int(np.rint(best * _UNIT).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "total"])

    # The law has the location log K: the mean of a Gumbel variable is Euler's constant.
    located = clean.mapInArrow(best_scores, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    if located and located["n"]:
        model.log_k = float(np.clip(located["total"] / _UNIT / located["n"] - np.euler_gamma, -20, 5))
        shared = rows.sparkSession.sparkContext.broadcast(model)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False) != 0
            out = []
            for w in words(batch.column(1), ALNUM, lower=True):
                own = labels[w.first_row : w.first_row + len(w.counts)]
                scores = _token_scores(w, shared.value, own)
                out += [_summary(scores[a:b], shared.value) for a, b in zip(w.of_text[:-1], w.of_text[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels.astype(np.int32)), *(pa.array([x[i] for x in out], pa.float64()) for i in range(3))],
                names=["toxic", "best", "total", "n"],
            )

    # The draws below the share are counted in steps; the rows of as many steps as fit come to the driver.
    share = min(1.0, sample_rows / sum(seen))
    step = F.floor(F.col("draw") / share * _DRAWS).cast("int")
    drawn = rows.filter(F.col("draw") < share).groupBy(step.alias("step")).count().toArrow()
    sizes = np.zeros(_DRAWS + 1, dtype=np.int64)
    sizes[drawn["step"].to_numpy()] = drawn["count"].to_numpy()
    fits = int(np.searchsorted(np.cumsum(sizes), sample_rows, side="right"))
    sample = rows.filter((F.col("draw") < share) & (step < fits)).select("toxic", "text")
    table = sample.mapInArrow(summaries, "toxic int, best double, total double, n double").toArrow()
    x, y = np.column_stack([table[c].to_numpy() for c in ("best", "total", "n")]), table["toxic"].to_numpy()
    model.curve = _logistic(_design(x), y.astype(float))
    return model


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``passages`` of every row.

    ``score`` is the probability that the text is toxic, ``predicted`` 1 from ``threshold`` on.
    ``passages`` has the significant segments: first word, end, normalised score. Null and empty
    texts have no segment and get the score of such texts. Repeated rows stay. An empty table
    gives an empty result. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out, passages = [], []
            for w in words(batch.column(1), ALNUM, lower=True):
                scores = _token_scores(w, own)
                for a, b in zip(w.of_text[:-1].tolist(), w.of_text[1:].tolist(), strict=True):
                    out.append(_summary(scores[a:b], own))
                    shift = own.log_k + np.log(max(1, b - a))
                    found = [(s, x, y) for s, x, y in (segments(scores[a:b]) if out[-1][0] > 0 else [])]
                    passages.append(
                        [{"start": x, "end": y, "score": z} for s, x, y in found if (z := own.decay * s - shift) > 0]
                    )
            odds = _design(np.array(out).reshape(-1, 3)) @ own.curve
            score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(passages, kind)],
                names=["doc_id", "score", "predicted", "passages"],
            )

    inputs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"))
    schema = "doc_id long, score double, predicted int, passages array<struct<start:long,end:long,score:double>>"
    return inputs.mapInArrow(run, schema)

