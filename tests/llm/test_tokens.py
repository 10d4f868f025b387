"""Words, hashes and minima of whole batches against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm.tokens import ALNUM, NOT_SPACE, covered, minimizers, sliding_min, text_slices, words

TEXTS = st.lists(st.text(alphabet="aBz09 \t\n\x0b.-é 日", max_size=30), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    column = pa.array([t.encode() for t in texts], pa.binary())
    for letters, pattern, lower in (
        (NOT_SPACE, rb"[^\x20\x09-\x0D]+", False),
        (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True),
    ):
        found = []
        for w in words(column, letters, lower):
            body = w.data.tobytes()
            for i in range(len(w.counts)):
                a, b = w.of_text[i], w.of_text[i + 1]
                found.append([body[x:y] for x, y in zip(w.starts[a:b], w.ends[a:b], strict=True)])
        bodies = [t.encode().lower() if lower else t.encode() for t in texts]
        assert found == [re.findall(pattern, b) for b in bodies]
    assert sum(len(o) - 1 for _, o, _ in text_slices(column, limit)) == len(texts)


def test_null_texts_are_empty():
    column = pa.chunked_array([pa.array([None, b"a b"], pa.binary()), pa.array([b"c"], pa.binary())])
    assert [w.counts.tolist() for w in words(column)] == [[0, 2, 1]]
    assert list(words(pa.array([], pa.binary()))) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", "ab"]), max_size=25), st.integers(1, 6))
def test_equal_grams_have_equal_hashes(tokens, k):
    w = next(iter(words(pa.array([" ".join(tokens).encode()], pa.binary()))))
    grams = w.rolling.grams(k)
    plain = [tuple(tokens[i : i + k]) for i in range(max(0, len(tokens) - k + 1))]
    assert len(grams) == len(plain)
    assert len(set(grams.tolist())) == len(set(plain))
    assert len(set(zip(grams.tolist(), plain, strict=True))) == len(set(plain))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.integers(1, 8))
def test_minimizers_hold_the_minimum_of_some_run(values, width):
    array = np.array(values, dtype=np.uint64)
    runs = [values[i : i + width] for i in range(len(values) - width + 1)]
    if runs:
        assert sliding_min(array, width).tolist() == [min(r) for r in runs]
    expected = {i + j for i, r in enumerate(runs) for j, v in enumerate(r) if v == min(r)}
    assert set(minimizers(array, width).tolist()) == expected


@pytest.mark.parametrize("n,starts,length", [(5, [0, 3], 2), (4, [], 3), (6, [1, 1, 2], 3)])
def test_covered(n, starts, length):
    inside = {p for s in starts for p in range(s, s + length)}
    found = covered(n, np.array(starts, dtype=np.int64), length)
    assert found.tolist() == [i in inside for i in range(n)]
