"""The language model: its base against plain counts, its probabilities, and that it learns."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import maxent
from millrace.llm.maxent import score_texts
from millrace.llm.queries import op5_lm_scoring
from millrace.llm.shared import fold
from millrace.llm.tokens import words

from .conftest import SF_DIR


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain_base(texts, training):
    counts = collections.Counter(t for x in training for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    norm = math.log10(total + 0.1 * (distinct + 1))
    for doc_id, text in texts:
        own = tokens(text)
        score = sum(math.log10(counts[t] + 0.1) - norm for t in own)
        yield repr(doc_id), len(own), sum(counts[t] > 0 for t in own), total, score


def compare(rows, texts, training):
    keys = ("n_tokens", "n_known", "train_tokens", "base_score")
    found = sorted((repr(r["doc_id"]), *(r[k] for k in keys)) for r in rows)
    expected = sorted(plain_base(texts, training))
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([r[4] for r in found], [r[4] for r in expected], rtol=1e-9)


@pytest.mark.parametrize("head_words", [20, 1 << 18])
def test_base(documents, head_words):
    training = documents.filter(fold(F.col("doc_id"), 10) != 0)
    rows = score_texts(documents, training, head_words=head_words).collect()
    compare(rows, [(r["doc_id"], r["text"]) for r in documents.collect()], [r["text"] for r in training.collect()])
    assert all(r["score"] < 0 for r in rows)


def test_head_and_join_give_the_same_scores(documents):
    training = documents.filter("doc_id % 3 = 0")
    one = score_texts(documents, training, head_words=50).orderBy("doc_id").collect()
    two = score_texts(documents, training).orderBy("doc_id").collect()
    assert np.allclose([r["score"] for r in one], [r["score"] for r in two])


def test_model_beats_the_base_on_texts_not_seen(corpus):
    rows = [r for r in op5_lm_scoring(corpus, SF_DIR.replace("0.001", "0.01")).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / n > sum(r["base_score"] for r in rows) / n + 0.2


def test_probabilities_sum_to_one(corpus):
    """Over all classes in any context, and over the words of a class and one that was not seen."""
    texts = ["a b a c bb cc dd a b", "b c d e f g a", "", "zz yy xx ww vv uu tt ss"] * 3
    frame = corpus.createDataFrame([(t,) for t in texts], "text string").select(F.col("text").cast("binary"))
    vocabulary, _ = maxent.vocabulary_of(maxent.count_words(frame), 1 << 10)
    end = int(vocabulary.classes[np.searchsorted(vocabulary.frequent, maxent._END)])
    sums = maxent._gather(frame, vocabulary, end, None)
    assert [x.sum() for x in sums[:2]] == [4 * vocabulary.total] * 2
    weights = maxent.start_weights(sums[:2])
    sums = maxent._gather(frame, vocabulary, end, weights)
    assert np.allclose([x.sum() for x in sums], 4 * vocabulary.total)
    t = maxent.tokens(next(iter(words(pa.array([b"a b zz never"], pa.binary()), lower=True))))
    scorer = maxent.Scorer(weights)
    classes = maxent._classes(t, maxent.Lookup(vocabulary.frequent, vocabulary.classes))
    total = np.zeros(len(classes))
    for c in range(maxent.GROUPS * maxent.PER_GROUP):
        for i in range(len(classes)):
            asked = classes.copy()
            asked[i] = c  # the history of a token does not hold its own class, but the group asked for
            history = maxent.History.of(t, asked, end)
            group, place = divmod(c, maxent.PER_GROUP)
            total[i] += scorer.softmax(0, history)[i, group] * scorer.softmax(1, history)[i, place]
    assert np.allclose(total, 1, atol=1e-5)
    for ending in range(maxent.ENDINGS):
        n, distinct = vocabulary.ending_totals[ending], vocabulary.ending_distinct[ending]
        assert n >= distinct >= 0
    assert vocabulary.ending_totals.sum() + vocabulary.head_counts[
        np.searchsorted(vocabulary.head, vocabulary.frequent)
    ].sum() == vocabulary.total


def test_lookup():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 1000):
        keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 40)))
        asked = np.concatenate([keys, rng.integers(0, 2**64, 500, dtype=np.uint64)])
        expected = [int(np.flatnonzero(keys == k)[0]) if k in keys else -7 for k in asked]
        assert maxent.Lookup(keys, np.arange(len(keys))).get(asked, -7).tolist() == expected


def test_gradient_sums_are_those_of_each_token():
    rng = np.random.default_rng(6)
    rows, values = rng.integers(0, 9, 200), rng.random((200, 3)).astype(np.float32)
    total = np.ones((9, 3), dtype=np.float32)
    maxent._sum_rows(total, rows, values)
    plain = np.ones((9, 3))
    np.add.at(plain, rows, values)
    assert np.allclose(total, plain, atol=1e-4)


def test_odd_rows(odd_docs, no_docs):
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    compare(score_texts(odd_docs, odd_docs, head_words=10).collect(), texts, [t for _, t in texts])
    rows = score_texts(odd_docs, no_docs).collect()
    assert all(r["n_known"] == 0 == r["train_tokens"] and abs(r["base_score"]) < 1e-9 for r in rows)
    assert all(np.isfinite(r["score"]) for r in rows)
    assert score_texts(no_docs, odd_docs).count() == 0
