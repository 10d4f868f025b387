"""Ids and texts against the model's own library."""

import hashlib
import random
import sys

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from millrace.llm.pieces import PieceModel, decode, encode
from millrace.llm.queries import op11_piece_ids

from .conftest import SF_DIR

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = PieceModel(PATH)
ALL_PIECES = [LIBRARY.id_to_piece(i) for i in range(3, LIBRARY.vocab_size())]

texts = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="aeinrst ▁\n", max_size=60),
    st.text(alphabet=" ▁a", max_size=90),
    st.lists(st.sampled_from(ALL_PIECES), max_size=12).map("".join),
)


@settings(max_examples=600, deadline=None)
@given(texts)
def test_ids_are_those_of_the_library(text):
    assert list(MODEL.encode(text)) == LIBRARY.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize(
    "text",
    [" " * 300_000 + "word", "\n" * 300_000, "a" * 300_000, "日本" * 100_000, "͸" * 50_000, "ab \t" * 100_000, "<s></s><0x41><unk>"],
)
def test_long_runs_take_linear_time(text):
    assert list(MODEL.encode(text)) == LIBRARY.encode(text)


def test_cuts_between_steps_do_not_matter(monkeypatch):
    text = "".join(random.Random(3).choices(["ab", " ", "é", "\n", "the", "  "], k=3_000))
    expected = LIBRARY.encode(text)
    for step in (1, 2, 7, 100):
        monkeypatch.setattr("millrace.llm.pieces._STEP", step)
        assert list(MODEL.encode(text)) == expected


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr("millrace.llm.pieces._SEGMENTS", 5)
    monkeypatch.setattr("millrace.llm.pieces._PAIRS", 5)
    model = PieceModel(PATH)
    text = " ".join(f"some{i} words{i * 7}" for i in range(200))
    assert list(model.encode(text)) == LIBRARY.encode(text)
    assert all(len(x) + len(x._before) <= 6 for x in (model._segments, model._compatible))


def test_what_is_remembered_has_four_bytes_for_an_id():
    model = PieceModel(PATH)
    letters = random.Random(5)
    text = " ".join("".join(letters.choices("abcdefgh", k=12)) for _ in range(2000))
    assert len(model.encode(text)) == len(LIBRARY.encode(text))
    sizes = [(sys.getsizeof(ids), len(model._encode_segment(segment)) // 4) for segment, ids in model._segments.items()]
    assert len(sizes) > 1000 and max(n for _, n in sizes) > 3
    assert all(size <= 40 + 4 * n for size, n in sizes)


def plain(text):
    ids = [*LIBRARY.encode(text or ""), LIBRARY.eos_id()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids))


def test_query_is_the_library_over_the_whole_table(corpus, documents):
    found = sorted(map(tuple, op11_piece_ids(corpus, SF_DIR).collect()))
    assert found == sorted((r["doc_id"], *plain(r["text"])) for r in documents.collect())


def test_odd_rows(odd_docs, no_docs):
    found = encode(odd_docs, PATH, with_decoded=True).collect()
    expected = []
    for r in odd_docs.collect():
        ids = [*LIBRARY.encode(r["text"] or ""), LIBRARY.eos_id()]
        expected.append((r["doc_id"], ids, LIBRARY.decode(ids)))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert encode(no_docs, PATH).collect() == []
    assert encode(odd_docs.filter("text IS NULL"), PATH, add_end=False).first()["ids"] == []


def test_decoding_a_table(corpus):
    rows = corpus.createDataFrame([(1, [450, 2]), (None, None), (2, [])], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in decode(rows, PATH).collect()}
    assert found == {1: LIBRARY.decode([450, 2]), None: "", 2: ""}
    with pytest.raises(Exception, match="ids must lie between"):
        decode(corpus.createDataFrame([(1, [32_000])], "doc_id long, ids array<int>"), PATH).collect()


def test_other_kinds_of_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = 1
    (tmp_path / "other.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="no BPE model"):
        PieceModel(str(tmp_path / "other.model"))
