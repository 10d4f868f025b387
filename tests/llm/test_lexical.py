"""The best documents against scores of all documents, and that reading stops early."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import lexical
from millrace.llm.lexical import Best, Lists, impacts, search, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, k):
    """(item_id, rank, doc_id, score), from the definition."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, n, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select("item_id", "rank", "doc_id", "score").collect())


VOCABULARY = [f"t{i}" for i in range(30)]


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_lists_find_the_best(data):
    """Also over several blocks, with what was found in those before."""
    n_docs = data.draw(st.integers(1, 60))
    docs = [sorted(data.draw(st.lists(st.integers(0, 5), min_size=1, max_size=6))) for _ in range(n_docs)]
    weights = np.array(data.draw(st.lists(st.integers(0, 5), min_size=6, max_size=6)), dtype=np.int64)
    asked = np.array(data.draw(st.lists(st.integers(0, 5), min_size=1, max_size=6, unique=True)), dtype=np.int64)
    k, cut = data.draw(st.integers(1, 5)), data.draw(st.integers(0, n_docs))
    lexical._FIRST, before = data.draw(st.integers(1, 4)), lexical._FIRST
    try:
        best, expected = Best(k), []
        total = sum(map(len, docs))
        for part in (range(cut), range(cut, n_docs)):
            if not part:
                continue
            held = [Counter(docs[i]) for i in part]
            own = np.array([t for c in held for t in sorted(c)])
            tf = np.array([c[t] for c in held for t in sorted(c)], dtype=np.int64)
            sizes = np.array([len(c) for c in held])
            worth = impacts(tf, np.repeat([len(docs[i]) for i in part], sizes), n_docs, total)
            lists = Lists(np.array(part), np.zeros(len(part), bool), np.concatenate([[0], np.cumsum(sizes)]), own, worth, 6)
            lists.search(asked, weights[asked], best)
            at = 0
            for i, c in zip(part, held, strict=True):
                score = sum(int(weights[t]) * int(worth[at + n]) for n, t in enumerate(sorted(c)) if t in asked)
                at += len(c)
                if score:
                    expected.append((-score, i))
            # A list is clean for the next query.
            assert not lists._seen_doc.any() and lists._unseen.all() and not lists._weight.any()
        assert list(zip((-best.score).tolist(), best.doc_id.tolist(), strict=True)) == sorted(expected)[:k]
    finally:
        lexical._FIRST = before


def test_reading_stops_where_the_bound_falls_below_the_kth_score():
    """Ten thousand documents hold a common term, some of them a rare one too."""
    n = 10_000
    rng = np.random.default_rng(1)
    rare = np.sort(rng.choice(n, 40, replace=False))
    sizes = np.ones(n, dtype=np.int64)
    sizes[rare] = 2
    own = np.zeros(sizes.sum(), dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    own[ends[rare] + 1] = 1
    worth = rng.integers(1, 1_000_000, len(own))
    lists = Lists(np.arange(n), np.zeros(n, bool), ends, own, worth, 2)
    best = Best(10)
    read, looked_up = lists.search(np.array([0, 1]), np.array([1, 9]), best)
    scores = np.zeros(n, dtype=np.int64)
    np.add.at(scores, np.repeat(np.arange(n), sizes), np.where(own == 0, 1, 9) * worth)
    top = np.lexsort((np.arange(n), -scores))[:10]
    assert best.doc_id.tolist() == top.tolist() and best.score.tolist() == scores[top].tolist()
    assert read < 1_000 and looked_up < 1_000
    # Nothing is read where the lists' tops together cannot reach what was found before.
    again = Lists(np.arange(n), np.zeros(n, bool), ends, own, worth // 20, 2)
    assert again.search(np.array([0, 1]), np.array([1, 9]), best) == (0, 0)


def test_ties_at_the_end_go_by_id(corpus):
    docs = [(i, "same words here") for i in range(200, 0, -1)] + [(900, "other"), (901, "here and there other text")]
    items = [(1, "same here"), (2, "words same words"), (3, "nothing"), (4, "OTHER other")]
    for parts in (1, 7):
        found = search(
            corpus.createDataFrame(docs, "doc_id long, text string").repartition(parts),
            corpus.createDataFrame(items, "item_id long, text string"),
            k=10,
            block_postings=50,
        )
        assert rows(found) == plain(docs, items, 10)


@pytest.mark.parametrize("block_postings", [1, 1_000, 1 << 21])
def test_blocks_of_documents_and_items_do_not_matter(corpus, documents, block_postings):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    items = [(i, " ".join((t or "").split()[n : n + 12])) for n, (i, t) in enumerate(docs[:40])]
    given_items = corpus.createDataFrame(items, "item_id long, text string")
    found = search(documents.repartition(3), given_items, k=4, block_postings=block_postings, block_terms=100)
    assert rows(found) == plain(docs, items, 4)


def test_odd_rows(odd_docs, no_docs, corpus):
    clash = "item long, term long, n long, item_id string, text string, rank int"
    items = [
        (1, 2, 3, "a", "w1 w2 w79 été ÉTÉ", 9),
        (1, 2, 3, "a", "W5 w5 the of1", 9),
        (None, None, None, None, "one null byte", None),
        (1, 1, 1, "empty", "", 1),
        (1, 1, 1, "null", None, 1),
        (1, 1, 1, "long", " ".join(f"wort{i}" for i in range(3000)), 1),
    ]
    given_items = corpus.createDataFrame(items, clash)
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    expected = plain(docs, [(i[3], i[4]) for i in items], 10)
    assert rows(search(odd_docs, given_items)) == expected
    assert any("None, 1" in r or r.startswith("(None") for r in expected)
    assert rows(search(no_docs, given_items)) == []
    assert rows(search(odd_docs, given_items.limit(0))) == []
    assert rows(search(odd_docs, given_items.filter("text IS NULL"))) == []
    assert dict(search(odd_docs, given_items.limit(0)).dtypes) == dict(search(odd_docs, given_items).dtypes)


def test_large_numbers_do_not_overflow():
    n, documents, total = 10**7, 10**11, 10**14
    found = impacts(np.array([3], dtype=np.int64), np.array([n], dtype=np.int64), documents, total)
    assert found.tolist() == [3 * 10**9 // (3000 + 8 * (25 + 75 * n * documents // total))]
    assert weight(10, 10) == math.floor(1000 * math.log(22 / 21))
