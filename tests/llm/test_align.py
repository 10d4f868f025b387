"""Overlaps, groups and counts against a plain version over the libraries' own tokens."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from millrace.llm import align as module
from millrace.llm.align import ByteSide, PieceSide, align, align_ids
from millrace.llm.packing import byte_letters
from millrace.llm.queries import op12_token_alignment

from .conftest import SF_DIR

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTERS = {c: b for b, c in byte_letters().items()}
SIDES = ByteSide(A_PATH), PieceSide(B_PATH)


def piece_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(id, start, end) of both sides, or nothing."""
    out = []
    body = b" " + (text or "").encode()
    sides = (
        [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + (text or ""), add_special_tokens=False).ids],
        [(i, piece_bytes(i)) for i in B.encode(text or "")],
    )
    for side in sides:
        if not text or b"".join(x for _, x in side) != body:
            return [], []
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def plain_links(a, b):
    return [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]


def plain_groups(a, b):
    ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, last = [], 0
    for end in ends:
        inside = [",".join(str(i) for i, s, _ in side if last <= s < end) for side in (a, b)]
        groups.append("|".join(inside))
        last = end
    return groups


def plain(texts):
    aligned = [tokens(t) for t in texts]
    links = [plain_links(*x) for x in aligned]
    counts = Counter(x for part in links for x in part)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for (a, b), part in zip(aligned, links, strict=True):
        groups = plain_groups(a, b)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        n_best = sum(counts[x] == best[x[1]] for x in part)
        yield len(a), len(b), len(groups), len(part), n_best, sum(counts[x] for x in part), digest


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = st.one_of(
    st.text(max_size=40),
    st.text(alphabet="ae tn▁\n日é", max_size=60),
    st.lists(st.sampled_from(["<|endoftext|>", "</s>", "<0x41>", "don't", " ", "😀", "über", "123"]), max_size=8).map("".join),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4), st.sampled_from([1, 3, 1 << 19]))
def test_links_and_groups_are_those_of_a_plain_version(texts, joined):
    before, module._JOINED = module._JOINED, joined
    try:
        ids = [[[i for i, _, _ in tokens(t)[side]] for t in texts] for side in (0, 1)]
        arrays = [[module.np.array(x, dtype=module.np.int64) for x in side] for side in ids]
        found = align_ids(*SIDES, *arrays, with_groups=True)
    finally:
        module._JOINED = before
    for n, text in enumerate(texts):
        a, b = tokens(text)
        mine = {divmod(int(p), 32_000): int(c) for o, p, c in zip(found.of, found.pairs, found.links, strict=True) if o == n}
        assert mine == Counter(plain_links(a, b))
        assert found.texts[n] == ";".join(plain_groups(a, b))
        assert found.n_groups[n] == len(plain_groups(a, b))


def test_query_is_the_plain_version_over_the_whole_table(corpus, documents):
    # Links and counts of all texts by two pointers; groups by the plain version, which is quadratic, of texts below 3,000 tokens.
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    found = {r["doc_id"]: r for r in op12_token_alignment(corpus, SF_DIR).collect()}
    assert set(found) == {i for i, _ in rows}
    sides = {i: tokens(t) for i, t in rows}
    counts, links = Counter(), {}
    for i, (a, b) in sides.items():
        links[i], k = [], 0
        for x, s, e in a:
            while k and b[k - 1][2] > s:
                k -= 1
            while k < len(b) and b[k][2] <= s:
                k += 1
            while k < len(b) and b[k][1] < e:
                links[i].append((x, b[k][0]))
                k += 1
        counts.update(links[i])
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    for i, part in links.items():
        r = found[i]
        assert (r["n_a"], r["n_b"], r["n_links"]) == (*map(len, sides[i]), len(part))
        assert r["n_best"] == sum(counts[x] == best[x[1]] for x in part)
        assert r["count_sum"] == sum(counts[x] for x in part)
        if len(sides[i][0]) < 3_000:
            groups = plain_groups(*sides[i])
            assert (r["n_groups"], r["groups_sha256"]) == (
                len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )


@pytest.mark.parametrize("block_bytes", [1, 200, 16 << 20])
def test_blocks_do_not_matter(corpus, block_bytes):
    texts = ["the cat sat", "the cat sat", "", None, "le chat s'assit là", "▁no", "the the the", " ", "日本語 text"] * 3
    docs = corpus.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = align(docs, A_PATH, B_PATH, block_bytes=block_bytes, block_rows=5, with_links=True, with_groups=True).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(texts)
    for i, expected in enumerate(plain(texts)):
        assert tuple(by_id[i][c] for c in COLUMNS) == expected
        assert sum(p["links"] for p in by_id[i]["id_pairs"]) == expected[3]
        assert sum(p["links"] * p["count"] for p in by_id[i]["id_pairs"]) == expected[5]
        assert by_id[i]["groups"].count(";") == max(0, expected[2] - 1)


def test_odd_rows(odd_docs, no_docs):
    found = align(odd_docs, A_PATH, B_PATH).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(i) for i, _ in rows)
    short = {(i, t): [len(x) for x in tokens(t)] for i, t in rows if not t or len(t) < 5_000}
    assert {(repr(i), *n) for (i, _), n in short.items()} <= {(repr(r["doc_id"]), r["n_a"], r["n_b"]) for r in found}
    empty = [r for r in found if not r["n_a"]]
    assert all((r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) == (0, 0, 0, 0, 0, "") for r in empty)
    assert len(empty) == 3
    assert align(no_docs, A_PATH, B_PATH).collect() == []
    only_null = odd_docs.filter("text IS NULL")
    assert [r["n_links"] for r in align(only_null, A_PATH, B_PATH).collect()] == [0, 0]


def test_a_long_text_without_words(corpus):
    texts = ["a" * 200_000, " " * 300_000 + "x", "ab\n" * 100_000]
    docs = corpus.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in align(docs, A_PATH, B_PATH).collect():
        a, b = tokens(texts[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
        assert r["n_groups"] == len({e for _, _, e in a} & {e for _, _, e in b})
