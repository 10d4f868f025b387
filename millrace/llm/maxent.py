"""A hashed maximum-entropy language model with a class-factored softmax.

The probability of a token given the ones before it is that of its class's group, times that of its
class within the group, times that of the word within the class. The first two are softmaxes over sums of
weights; the features are a constant, the word before, the class of the one before that (a skip) and
the pair of both classes, hashed to rows of weights. The most frequent words are classes of
their own; other words share a class with those of a like ending, and within it have the add-0.1 estimate
of their count.

Counts cover all training texts. Weights start from the smoothed log-ratios of how often each class
comes with a feature. Then each of some rounds takes another share of the training texts:
every task adds up, over its texts, how often classes came with each feature and how often the model
expected them; the sums move the weights by a gradient scaled with their own curvature.
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
from millrace.llm.tokens import Words, mix, words

GROUPS, PER_GROUP = 8, 16
ENDINGS = 96
FREQUENT = GROUPS * PER_GROUP - ENDINGS
#: Rows of weights, by which features are hashed.
ROWS = 1 << 16
_END = mix(np.array([0x0E4D], dtype=np.uint64))[0]
_BLOCKS = 256
_PRIOR = 0.1


class Lookup:
    """Values of sorted 64-bit keys. Keys are hashes, so their first bits say nearly where they are."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values
        bits = max(1, int(len(keys) - 1).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        found = np.searchsorted(keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.starts, self.sizes = found[:-1].astype(np.int32), np.diff(found).astype(np.int32)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(len(keys), missing, dtype=np.int64)
        bucket = (keys >> self.shift).astype(np.int64)
        at, left = self.starts[bucket], self.sizes[bucket]
        open_ = np.flatnonzero(left > 0)
        at, left, asked = at[open_], left[open_], keys[open_]
        while len(open_):
            hit = self.keys[at] == asked
            out[open_[hit]] = self.values[at[hit]]
            more = np.flatnonzero(~hit & (left > 1))
            open_, at, left, asked = open_[more], at[more] + 1, left[more] - 1, asked[more]
        return out


@dataclass
class Vocabulary:
    """Counts of frequent words and sums over all; what is rarer is looked up by a join."""

    total: int
    distinct: int
    head: np.ndarray  # sorted hashes
    head_counts: np.ndarray
    frequent: np.ndarray  # sorted hashes of the words that are classes
    classes: np.ndarray  # their classes
    ending_totals: np.ndarray
    ending_distinct: np.ndarray


@dataclass
class Tokens:
    """The tokens of some texts, an end after each, with class and history."""

    hashes: np.ndarray
    endings: np.ndarray
    text_of: np.ndarray
    is_first: np.ndarray
    n_texts: int


def joined(slices: Iterator[Words], n: int = 1 << 18) -> Iterator[Tokens]:
    """Tokens of several slices at a time, at least ``n`` but for the last."""
    held: list[Tokens] = []
    for w in slices:
        held.append(tokens(w))
        if sum(len(t.hashes) for t in held) >= n:
            yield _concatenated(held)
            held = []
    if held:
        yield _concatenated(held)


def _concatenated(parts: list[Tokens]) -> Tokens:
    before = np.cumsum([0, *(t.n_texts for t in parts)])
    return Tokens(
        np.concatenate([t.hashes for t in parts]),
        np.concatenate([t.endings for t in parts]),
        np.concatenate([t.text_of + b for t, b in zip(parts, before[:-1], strict=True)]),
        np.concatenate([t.is_first for t in parts]),
        int(before[-1]),
    )


def tokens(w: Words) -> Tokens:
    n_texts, n = len(w.counts), len(w.starts) + len(w.counts)
    at = np.arange(len(w.starts)) + w.text_of
    ends = w.of_text[1:] + np.arange(n_texts)
    hashes = np.full(n, _END)
    hashes[at] = w.hashes
    last = w.data[w.ends - 1].astype(np.int64) if len(w.ends) else np.zeros(0, np.int64)
    second = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)], 0) if len(w.ends) else last
    endings = np.zeros(n, dtype=np.int64)
    endings[at] = (mix((256 * last + second).astype(np.uint64)) % np.uint64(ENDINGS)).astype(np.int64)
    text_of = np.empty(n, dtype=np.int64)
    text_of[at], text_of[ends] = w.text_of, np.arange(n_texts)
    is_first = np.ones(n, dtype=bool)
    is_first[1:] = text_of[1:] != text_of[:-1]
    return Tokens(hashes, endings, text_of, is_first, n_texts)


def _classes(t: Tokens, frequent: Lookup) -> np.ndarray:
    own = frequent.get(t.hashes, -1)
    return np.where(own >= 0, own, FREQUENT + t.endings)


_CLASSES = GROUPS * PER_GROUP
_MASK = np.uint64(ROWS - 1)


def _hashed_rows() -> tuple[np.ndarray, np.ndarray]:
    """Rows of the constant, the skip and the pair for each pair of classes, and for each with a group."""
    pair = np.arange(_CLASSES * _CLASSES, dtype=np.uint64)
    two = pair % np.uint64(_CLASSES)
    features = [mix(x) for x in (np.zeros_like(pair), two + np.uint64(1 << 32), pair + np.uint64(1 << 40))]
    groups = mix(np.arange(GROUPS, dtype=np.uint64) + np.uint64(7))
    first = np.array([f & _MASK for f in features]).astype(np.int32)
    second = np.array([mix(f[:, None] ^ groups).ravel() & _MASK for f in features]).astype(np.int32)
    return first, second


_PAIR_ROWS = _hashed_rows()


@dataclass
class History:
    """What the choices of each token depend on: the pair of classes before it, alone and with its
    own group, and the rows of the word before, likewise."""

    pair: np.ndarray
    pair_group: np.ndarray
    word: np.ndarray
    word_group: np.ndarray

    @staticmethod
    def of(t: Tokens, classes: np.ndarray, end_class: int) -> History:
        one = np.concatenate([[end_class], classes[:-1]])
        two = np.concatenate([[end_class], one[:-1]])
        two[t.is_first] = end_class
        pair, group = one * _CLASSES + two, classes // PER_GROUP
        word = (mix(np.concatenate([[_END], t.hashes[:-1]])) & _MASK).astype(np.int64)
        word_group = mix((word * GROUPS + group).astype(np.uint64) + np.uint64(1 << 48)) & _MASK
        return History(pair, pair * GROUPS + group, word, word_group.astype(np.int64))

    def level(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        return (self.pair_group, self.word_group) if level else (self.pair, self.word)


class Scorer:
    """Softmaxes under weights. The features of a pair of classes are summed beforehand."""

    def __init__(self, weights: list[np.ndarray]) -> None:
        self.weights = weights
        self.pairs = [w[rows[0]] + w[rows[1]] + w[rows[2]] for w, rows in zip(weights, _PAIR_ROWS, strict=True)]

    def softmax(self, level: int, history: History) -> np.ndarray:
        pair, word = history.level(level)
        scores = self.pairs[level][pair]
        scores += self.weights[level][word]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores


def _order(rows: np.ndarray) -> np.ndarray:
    """An order that sorts numbers below 2**32. Numpy sorts 16 bits by radix, several times as fast."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    high = (rows >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _sum_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Adds each value's row to its row of the total, equal rows together."""
    order = _order(rows)
    sorted_rows = rows[order]
    bounds = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    total[sorted_rows[bounds]] += np.add.reduceat(values[order], bounds, axis=0)


class Sums:
    """How often classes came with the features of each row, and how often they were expected."""

    def __init__(self) -> None:
        widths = (GROUPS, PER_GROUP)
        # Single floats would stop at 2 ** 24, which a word that a task repeats can reach.
        tables = lambda sizes: [[np.zeros((n, w), dtype=np.float64) for n, w in zip(sizes, widths, strict=True)] for _ in range(2)]
        self.seen_words, self.expected_words = tables((ROWS, ROWS))
        self.seen_pairs, self.expected_pairs = tables((_CLASSES**2, _CLASSES**2 * GROUPS))

    def add(self, t: Tokens, frequent: Lookup, end_class: int, scorer: Scorer | None) -> None:
        classes = _classes(t, frequent)
        history = History.of(t, classes, end_class)
        for level, choice in enumerate((classes // PER_GROUP, classes % PER_GROUP)):
            pair, word = history.level(level)
            for total, rows in ((self.seen_pairs[level], pair), (self.seen_words[level], word)):
                np.add.at(total.reshape(-1), rows * total.shape[1] + choice, 1.0)
            if scorer is not None:
                p = scorer.softmax(level, history)
                _sum_rows(self.expected_pairs[level], pair, p)
                _sum_rows(self.expected_words[level], word, p)

    def tables(self) -> list[np.ndarray]:
        """Seen and expected by row, for groups and for classes in a group."""
        out = []
        for words_, pairs in ((self.seen_words, self.seen_pairs), (self.expected_words, self.expected_pairs)):
            for level in range(2):
                total = words_[level].copy()
                for rows in _PAIR_ROWS[level]:
                    _sum_rows(total, rows, pairs[level])
                out.append(total)
        return out

    def packed(self) -> list[bytes]:
        size, parts = ROWS // _BLOCKS, self.tables()
        return [
            zstandard.compress(b"".join(x[i * size : (i + 1) * size].astype(np.float32).tobytes() for x in parts), 1)
            for i in range(_BLOCKS)
        ]


def _unpacked(block: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(block), dtype=np.float32)
    size, out, at = ROWS // _BLOCKS, [], 0
    for width in (GROUPS, PER_GROUP, GROUPS, PER_GROUP):
        out.append(raw[at : at + size * width].reshape(size, width))
        at += size * width
    return out


def start_weights(seen: list[np.ndarray], smooth: float = 8.0, share: float = 0.5) -> list[np.ndarray]:
    """Each row's smoothed log-ratio of its classes to those of all rows, times ``share``."""
    out = []
    for counts in seen:
        counts = counts.astype(np.float64)
        overall = counts.sum(axis=0) + 1e-3
        overall /= overall.sum()
        n = counts.sum(axis=1, keepdims=True)
        ratio = np.log((counts + smooth * overall) / (n + smooth)) - np.log(overall)
        out.append((share * ratio).astype(np.float32))
    return out


def moved_weights(weights: list[np.ndarray], sums: list[np.ndarray], rate: float, smooth: float = 2.0) -> list[np.ndarray]:
    """One gradient step, each weight's scaled by how often its class came or was expected."""
    out = []
    for w, seen, expected in zip(weights, sums[:2], sums[2:], strict=True):
        step = (seen - expected) / (np.maximum(seen, expected) + smooth)
        out.append((w + rate * step).astype(np.float32))
    return out


def _gather(texts: DataFrame, vocabulary: Vocabulary, end_class: int, weights: list[np.ndarray] | None) -> list[np.ndarray]:
    """The sums over all texts. What comes to the driver has a fixed size."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shared.value
        frequent, scorer = Lookup(v.frequent, v.classes), None if w is None else Scorer(w)
        sums, some = Sums(), False
        for batch in batches:
            for t in joined(words(batch.column(0), lower=True)):
                sums.add(t, frequent, end_class, scorer)
                some = True
        if some:
            task = pa.array([TaskContext.get().partitionId()] * _BLOCKS, pa.int32())
            columns = [pa.array(range(_BLOCKS), pa.int32()), task, pa.array(sums.packed(), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "task", "packed"])

    def add(table: pa.Table) -> pa.Table:
        total = None
        for body in table["packed"].to_pylist():
            parts = [x.astype(np.float64) for x in _unpacked(body)]
            total = parts if total is None else [a + b for a, b in zip(total, parts, strict=True)]
        raw = b"".join(x.astype(np.float32).tobytes() for x in total)
        packed = pa.array([zstandard.compress(raw, 1)], pa.binary())
        return pa.table({"block": table["block"][:1], "task": table["task"][:1], "packed": packed})

    schema = "block int, task int, packed binary"
    found = added_up(texts.mapInArrow(run, schema), ["block"], add, schema, texts.rdd.getNumPartitions())
    found = found.toArrow().sort_by("block")
    blocks = [_unpacked(b) for b in found["packed"].to_pylist()]
    if not blocks:
        return [np.zeros((ROWS, w), np.float32) for w in (GROUPS, PER_GROUP, GROUPS, PER_GROUP)]
    return [np.concatenate(x) for x in zip(*blocks, strict=True)]


def count_words(texts: DataFrame) -> DataFrame:
    """``hash``, ``ending`` and count ``n`` of every distinct token of a column ``text`` of binary texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, endings = [], []
            for w in words(batch.column(0), lower=True):
                t = tokens(w)
                hashes.append(t.hashes)
                endings.append(t.endings)
            if not hashes:
                continue
            distinct, first, n = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(distinct.view(np.int64)),
                    pa.array(np.concatenate(endings)[first].astype(np.int32)),
                    pa.array(n.astype(np.int64)),
                ],
                names=["hash", "ending", "n"],
            )

    found = texts.mapInArrow(run, "hash long, ending int, n long")
    return found.groupBy("hash").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame, head_words: int) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count from which words are in its head.

    Besides the classes of their own at most ``head_words`` are.
    """
    end = int(_END.view(np.int64))
    scale = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    by_scale = counts.groupBy(scale.alias("k")).agg(F.count("*").alias("words"), F.sum("n").alias("n"))
    sizes = {r["k"]: (r["words"], r["n"]) for r in by_scale.collect()}
    least, held = 1 << 62, 0
    for k in sorted(sizes, reverse=True):
        held += sizes[k][0]
        if held > head_words:
            break
        least = 1 << k
    # The most frequent words, the end first: they are classes, however large the head is.
    own = counts.filter(F.col("hash") == end).toArrow()
    top = counts.filter(F.col("hash") != end).orderBy(F.desc("n"), "hash").limit(FREQUENT - 1).toArrow()
    top = pa.concat_tables([own, top])
    rest = counts.filter((F.col("n") >= least) & ~F.col("hash").isin(top["hash"].to_pylist())).toArrow()
    head = pa.concat_tables([top, rest])
    hashes, n = head["hash"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(hashes)
    frequent = top["hash"].to_numpy().view(np.uint64)
    place = np.argsort(frequent)
    totals, distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        totals[r["ending"]], distinct[r["ending"]] = r["n"], r["words"]
    endings = top["ending"].to_numpy()
    np.subtract.at(totals, endings, top["n"].to_numpy())  # these are classes of their own
    np.subtract.at(distinct, endings, 1)
    total, in_all = sum(x[1] for x in sizes.values()), sum(x[0] for x in sizes.values())
    if not in_all:  # no training text: an end that was never seen
        none = np.zeros(1, dtype=np.int64)
        return Vocabulary(0, 0, np.array([_END]), none, np.array([_END]), none, totals, distinct), least
    v = Vocabulary(total, in_all, hashes[order], n[order], frequent[place], place, totals, distinct)
    return v, least


def _scored(
    t: Tokens, frequent: Lookup, head: Lookup, end_class: int, scorer: Scorer
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log10 of class probabilities per token; counts, -1 for those to look up; classes."""
    classes = _classes(t, frequent)
    history = History.of(t, classes, end_class)
    each = np.arange(len(classes))
    p = scorer.softmax(0, history)[each, classes // PER_GROUP] * scorer.softmax(1, history)[each, classes % PER_GROUP]
    return np.log10(np.maximum(p.astype(np.float64), 1e-30)), head.get(t.hashes, -1), classes


def score_texts(
    docs: DataFrame,
    training: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    head_words: int = 1 << 18,
    rounds: int = 2,
    rate: float = 0.5,
    seed: int = 7,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    Tokens are the words, A-Z lower-cased and split at ASCII white space, and an end. ``base_score`` is
    the log10 probability under add-0.1 word frequencies, ``score`` that under the model; both are
    learnt from all texts of ``training`` (same text column). At most ``head_words`` frequent words
    are held by every task; counts of rarer ones come by a join.

    Null and empty texts are the end alone. Repeated rows stay, in training they count each. Without
    training texts every token is unknown. An empty table gives an empty result. Other columns are ignored.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = training.select(quoted(text).cast("binary").alias("text"))
    counts = stored(count_words(texts), "word-counts")
    vocabulary, least = vocabulary_of(counts, head_words)
    end_at = int(np.searchsorted(vocabulary.frequent, _END))
    end_class = int(vocabulary.classes[min(end_at, len(vocabulary.classes) - 1)])

    weights = start_weights(_gather(texts, vocabulary, end_class, None)[:2])
    for k in range(rounds):
        share = texts.filter(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(rounds)) == k) if rounds > 1 else texts
        weights = moved_weights(weights, _gather(share, vocabulary, end_class, weights), rate)
    shared = spark.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shared.value
        frequent, head, scorer = Lookup(v.frequent, v.classes), Lookup(v.head, v.head_counts), Scorer(w)
        next_id = TaskContext.get().partitionId() << 36
        norms = np.log10(v.ending_totals + _PRIOR * (v.ending_distinct + 1))
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            rare: list[dict] = []
            for t in joined(words(batch.column(1), lower=True), 1 << 16):
                log_p, n, classes = _scored(t, frequent, head, end_class, scorer)
                known, unique_class = n >= 0, classes < FREQUENT
                word = np.where(known, np.log10(np.maximum(n, 0) + _PRIOR), 0.0)
                norm = np.where(unique_class, 0.0, norms[np.maximum(classes - FREQUENT, 0)])
                per_text = lambda values: np.bincount(t.text_of, values, t.n_texts)  # noqa: B023, E731
                parts.append(
                    [
                        np.bincount(t.text_of, minlength=t.n_texts),
                        per_text(known & (n > 0)),
                        per_text(word),
                        per_text(log_p + np.where(unique_class, 0.0, word) - norm),
                    ]
                )
                at = np.flatnonzero(~known)
                bounds = np.searchsorted(t.text_of[at], np.arange(t.n_texts + 1))
                hashes = t.hashes[at].view(np.int64)
                rare += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            if not parts:
                continue
            n_tokens, n_known, base, model = (np.concatenate(c) for c in zip(*parts, strict=True))
            ids = np.arange(next_id, next_id + batch.num_rows)
            next_id += batch.num_rows
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids),
                    batch.column(0),
                    pa.array(n_tokens.astype(np.int64)),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(base),
                    pa.array(model),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rare))),
                ],
                names=["row_id", "doc_id", "n_tokens", "n_known", "word", "model", "rare"],
            )

    inputs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text"))
    schema = "row_id long, doc_id long, n_tokens long, n_known long, word double, model double, rare array<long>"
    passed = stored(inputs.mapInArrow(run, schema), "scored-texts")
    looked = passed.select("row_id", F.explode("rare").alias("hash")).join(
        counts.filter(F.col("n") < least).select("hash", "n"), "hash", "left"
    )
    rare = looked.groupBy("row_id").agg(
        F.count("n").alias("rare_known"),
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(_PRIOR))).alias("rare_word"),
    )
    rest = F.coalesce("rare_word", F.lit(0.0))
    norm = float(np.log10(vocabulary.total + _PRIOR * (vocabulary.distinct + 1)))
    return passed.join(rare, "row_id", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("word") + rest - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model") + rest).alias("score"),
    )
