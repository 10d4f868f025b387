"""Ids against the library's own, and that packing loses and repeats nothing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from millrace.llm.packing import BpeEncoder, pack, plan_block, step_groups

PATH = public_tokenizers.path("byte_bpe_50k.json")


ENCODER = BpeEncoder(PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x27F, codec="utf-8"), st.sampled_from(list(" \n'sle<|endoftext|>")))))
def test_fast_ids_are_those_of_the_file(text):
    assert ENCODER.fast is not None
    assert ENCODER.encode(text, True) == ENCODER.exact.encode(text, add_special_tokens=False).ids


BLANKS = [" " * 2_000_000, "\n\t" * 1_000_000, " " * 1_500_000 + "word", "a" + "\n" * 1_200_000 + " b", "\xa0" * 1_100_000]


@pytest.mark.parametrize("text", BLANKS, ids=range(len(BLANKS)))
def test_long_white_space_has_the_ids_of_the_file(text):
    assert ENCODER.encode(text, True) == ENCODER.exact.encode(text, add_special_tokens=False).ids


def test_long_white_space_is_packed(corpus):
    import corpus_pipeline

    docs = corpus.createDataFrame(list(enumerate(BLANKS)), "doc_id long, text string")
    check(pack(docs, PATH, with_ids=True).collect(), list(enumerate(BLANKS)), 2048)
    assert corpus_pipeline.STAGES[-1][1](corpus, docs, None).agg({"length": "sum"}).first()[0] > 10_000


def test_special_tokens_are_plain_text_if_asked_for():
    encoder = BpeEncoder(PATH, special=False)
    text = "a <|endoftext|> b"
    assert ENCODER.encode(text, True).count(50256) == 1
    plain = encoder.encode(text, True)
    assert 50256 not in plain and plain == encoder.encode(text, False)
    assert encoder.exact.decode(plain) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=40), st.booleans())
def test_plans_cover_every_token_once(lengths, last):
    sequences, rest = plan_block(lengths, 32, (4, 8, 16), last)
    seen = sorted((d, s, n) for _, pieces in sequences for d, s, n in pieces) + sorted(rest)
    by_doc = {}
    for d, s, n in sorted(seen):
        assert n > 0 and s == by_doc.get(d, 0)
        by_doc[d] = s + n
    assert by_doc == dict(enumerate(lengths))
    sizes = [(w, sum(p[2] for p in pieces)) for w, pieces in sequences]
    assert all(n <= w for w, n in sizes)
    assert sum(n < w for w, n in sizes) <= (1 if last else 0)
    assert not (last and rest)
    assert last or sum(n for _, _, n in rest) < 32


def test_tiers_are_packed_into_windows_of_their_own():
    lengths = [16] * 3 + [13] * 4 + [8] * 2 + [3] * 8 + [4] + [27] * 2
    sequences, rest = plan_block(lengths, 32, (4, 8, 16), False)
    made = sorted((w, tuple(sorted(n for _, _, n in pieces))) for w, pieces in sequences)
    # 13 is filled with 3, and 27 with 3 and parts of others.
    assert made == [(4, (4,)), *[(8, (8,))] * 2, *[(16, (3, 13))] * 4, *[(16, (16,))] * 3, (32, (1, 1, 3, 27)), (32, (2, 3, 27))]
    assert sum(n for _, _, n in rest) == 2
    # Without shorter pieces they are put together to the longest.
    assert sorted(w for w, _ in plan_block([13] * 5, 32, (4, 8, 16), False)[0]) == [32, 32]
    assert sorted(w for w, _ in plan_block([3, 1, 2, 2], 32, (4, 8, 16), False)[0]) == [4, 4]


def test_groups_are_balanced():
    totals = [2048] * 100 + [1024, 512, 512]
    groups = step_groups(totals, 16)
    sums = np.bincount(groups, totals)
    assert len(sums) == 7 and sums.max() - sums.min() <= 2048
    assert step_groups([], 4) == []


def check(rows, texts, longest):
    """Every document is whole, every sequence without gaps."""
    tokenizer = Tokenizer.from_file(PATH)
    expected = sorted((repr(i), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts)
    pieces, sequences = {}, {}
    for r in rows:
        ids = r["ids"]
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["window"]))
        pieces.setdefault((repr(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], ids))
    for parts in sequences.values():
        at = 0
        for offset, length, window in sorted(parts):
            assert offset == at
            at += length
        assert at <= window <= longest
    found = []
    for (doc, total), parts in pieces.items():
        ids = [x for _, p in sorted(parts, key=lambda p: p[0]) for x in p]
        copies = len(ids) // total
        if copies == 1:
            found.append((doc, ids))
        else:  # rows that repeat an id and have as many tokens
            found += [(doc, x) for d, x in expected if d == doc and len(x) == total]
            assert sorted(ids) == sorted(t for d, x in expected if d == doc and len(x) == total for t in x)
    assert sorted(found) == expected
    full = sum(sum(p[1] for p in s) for s in sequences.values())
    padded = sum(s[0][2] if (n := sum(p[1] for p in s)) & (n - 1) else n for s in sequences.values())
    return full / padded


def test_documents_are_whole_and_padding_is_small(documents):
    rows = pack(documents.repartition(2), PATH, with_ids=True, block_tokens=20_000).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert check(rows, texts, 2048) > 0.999


def test_odd_rows(odd_docs, no_docs):
    rows = pack(odd_docs, PATH, with_ids=True, longest=64, tiers=(8, 16, 32), block_tokens=100).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], 64)
    assert pack(no_docs, PATH).count() == 0
