"""Metrics against plain Python, and verdicts of hosts."""

import re

import numpy as np
import pytest

from millrace.llm.quality import METRICS, beta_prior, quality_verdicts


def plain_metrics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), len("".join(words)), symbols, len(lines) - len(set(lines)), len(lines), len(repeated)


TEXTS = [
    "a b c a b c\na b c\n\n \na b c\r\nä#ö <x>",
    "\n\n",
    "x",
    "one\none\ntwo\n one\none",
    "a a a a a a",
    "日本語 😀😀 | | |",
]


def test_metrics(corpus):
    docs = corpus.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "'h' AS source")
    found = {r["doc_id"]: tuple(r[m] for m in METRICS) for r in quality_verdicts(docs.coalesce(1)).collect()}
    assert found == {i: plain_metrics(t) for i, t in enumerate(TEXTS)}


def test_odd_rows(odd_docs, no_docs):
    found = quality_verdicts(odd_docs, with_text=True)
    short = [r for r in odd_docs.collect() if len(r["text"] or "") < 10_000]
    expected = sorted((repr(r["doc_id"]), plain_metrics(r["text"])) for r in short)
    rows = found.collect()
    assert sorted((repr(r["doc_id"]), tuple(r[m] for m in METRICS)) for r in rows if r["n_words"] < 1000) == expected
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"] for r in rows if r["kept"]} <= {None, 4, 5}
    assert all(r["base_failed"] for r in rows if r["n_words"] < 50)
    assert quality_verdicts(no_docs).count() == 0


def test_verdicts_follow_the_host(corpus):
    good = " ".join(f"word{i}" for i in range(60))
    marked = " ".join(f"w{i}###" for i in range(60))
    rows = [(i, good if i % 10 else marked, "mixed") for i in range(300)]
    rows += [(1000 + i, "short" if i % 10 else good, "bad") for i in range(300)]
    rows += [(2000 + i, good if i else marked, "clean") for i in range(4000)]
    rows += [(9000, good, None)]
    docs = corpus.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r for r in quality_verdicts(docs).collect()}
    assert all(kept[i]["kept"] == bool(i % 10) for i in range(300))
    assert not any(kept[1000 + i]["kept"] for i in range(300))
    assert all(kept[1000 + i]["host_bad"] for i in range(300))
    assert all(kept[2000 + i]["kept"] for i in range(4000))
    assert kept[9000]["kept"]


@pytest.mark.parametrize("alpha,beta", [(2.0, 6.0), (10.0, 90.0)])
def test_prior_is_recovered(alpha, beta):
    rng = np.random.default_rng(3)
    n = rng.integers(50, 400, 4000)
    k = rng.binomial(n, rng.beta(alpha, beta, 4000))
    mean, strength = beta_prior(int(n.sum()), float((n * n).sum()), len(n), int(k.sum()), float((k * k / n).sum()))
    assert abs(mean - alpha / (alpha + beta)) < 0.01
    assert abs(strength / (alpha + beta) - 1) < 0.15
    assert beta_prior(0, 0.0, 0, 0, 0.0) == (0.0, 1.0)
    assert beta_prior(10, 100.0, 1, 0, 0.0) == (0.0, 1000.0)
