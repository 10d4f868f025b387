"""Segments against a plain definition, and the score on texts that were held out."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import millrace.llm.toxicity as module
from millrace.llm.queries import op10_toxicity
from millrace.llm.toxicity import _decay, _logistic, learn, segments, toxicity

from .conftest import SF_DIR


def plain_segments(scores):
    """The best segment (the shortest, first one), then the same to its left and to its right."""
    out = []

    def find(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] > 0:
            i, n = -best[2], -best[1]
            find(a, i)
            out.append((best[0], i, i + n))
            find(i + n, b)

    find(0, len(scores))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-50, 50).filter(bool), max_size=24))
def test_segments_are_all_maximal_ones(values):
    # Distinct sums, so that no two segments tie.
    scores = np.array([v + 1 / (3 + i * i) for i, v in enumerate(values)])
    found = segments(scores) if len(scores) else []
    assert [(i, j) for _, i, j in found] == [(i, j) for _, i, j in plain_segments(scores.tolist())]
    assert np.allclose([s for s, _, _ in found], [s for s, _, _ in plain_segments(scores.tolist())])


def test_decay_solves_its_equation():
    values, weights = np.array([-2.0, 1.0]), np.array([0.6, 0.4])
    x = _decay(values, weights)
    assert abs((weights * np.exp(x * values)).sum() - 1) < 1e-6 and x > 0.1


def test_score_finds_toxic_texts_that_were_held_out(corpus):
    folder = SF_DIR.replace("0.001", "0.1")
    rows = op10_toxicity(corpus, folder).join(corpus.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = rows.filter("held_out").select("toxic", "predicted", "score").collect()
    caught = sum(r["predicted"] for r in held if r["toxic"])
    wrong = sum(r["predicted"] for r in held if not r["toxic"])
    assert caught / sum(r["toxic"] for r in held) > 0.85
    assert wrong / (caught + wrong) < 0.08
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in held)


@pytest.fixture(scope="module")
def labelled(corpus):
    clean = [f"the {i} day was {w} and the people of town {i % 7} went home" for i in range(300) for w in ("fine", "cold")]
    bad = [f"the {i} day was fine you {w} idiot and the people went home" for i in range(60) for w in ("stupid", "dumb")]
    rows = [(t, 0) for t in clean] + [(t, 1) for t in bad] + [(None, 0), ("", 0), ("x", None)]
    return corpus.createDataFrame(rows, "text string, toxic int")


def test_passages_are_where_the_words_are(corpus, labelled):
    model = learn(labelled)
    docs = corpus.createDataFrame([(1, "the people of the town went home " * 20 + "you stupid idiot " + "and the day was cold " * 20)], "doc_id long, text string")
    row = toxicity(docs, model).first()
    assert row["predicted"] == 1
    best = max(row["passages"], key=lambda p: p["score"])
    assert 140 <= best["start"] < best["end"] <= 143


def test_odd_rows(odd_docs, no_docs, labelled):
    model = learn(labelled)
    rows = toxicity(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] < 0.5 and r["passages"] is not None for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1
    assert toxicity(no_docs, model).count() == 0
    for labels, expected in ((0, 0), (1, 1)):
        one = learn(labelled.withColumn("toxic", F.lit(labels)))
        assert {r["predicted"] for r in toxicity(odd_docs, one).collect()} == {expected}
    assert {r["predicted"] for r in toxicity(odd_docs, learn(labelled.limit(0))).collect()} == {0}


def test_the_law_covers_all_rows_and_the_sample_is_bounded(corpus, labelled, monkeypatch):
    """A text with a third of the rows: the curve gets its share of it, and the law does not know the sample."""
    hot = corpus.range(400).selectExpr("'you stupid idiot went home' AS text", "1 AS toxic")
    rows = labelled.unionByName(hot).repartition(3).withColumn("id", F.monotonically_increasing_id())
    fitted = []
    curve = lambda x, y: fitted.append((x, y)) or _logistic(x, y)
    monkeypatch.setattr(module, "_logistic", curve)
    whole = learn(rows)
    for row_id in (None, "id"):
        for seed in range(3):
            part = learn(rows, sample_rows=300, sample_seed=seed, row_id=row_id)
            assert (part.decay, part.log_k) == (whole.decay, whole.log_k)
            labels = fitted[-1][1]
            assert 200 < len(labels) <= 300
            assert abs(labels.mean() - fitted[0][1].mean()) < 0.1
    assert len(fitted[0][1]) == rows.filter("toxic IS NOT NULL").count()
