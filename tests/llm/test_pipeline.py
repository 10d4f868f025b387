"""Every stage against a plain version of its decisions, and the whole over odd rows."""

import corpus_pipeline
import duckdb
import pytest

from millrace.llm.oracles import CONTAMINATION, QUALITY
from millrace.llm.shared import stored

from .conftest import SF_DIR
from .test_removal import plain_words
from .test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(corpus, documents):
    """The input and the output of each stage."""
    out, docs = [], documents
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(corpus, docs, SF_DIR), name)
        out.append((docs, found))
        docs = found
    return out


def rows(df):
    return sorted(df.select(corpus_pipeline.COLUMNS).toPandas().itertuples(index=False, name=None))


def by_sql(sql, docs, column, wanted):
    connection = duckdb.connect()
    frame = docs.toPandas()
    connection.register("documents", frame)
    connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_DIR}/benchmark.parquet'")
    keep = set(connection.execute(f"SELECT doc_id FROM ({sql}) WHERE {column} = {wanted}").df()["doc_id"])
    return sorted(r for r in frame[corpus_pipeline.COLUMNS].itertuples(index=False, name=None) if r[0] in keep)


def test_quality(stages):
    docs, found = stages[0]
    assert rows(found) == by_sql(QUALITY, docs, "kept", "true")
    assert 0 < found.count() < docs.count()


def test_near_duplicates(stages):
    docs, found = stages[1]
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    components = plain_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert rows(found) == [r for r in rows(docs) if components[r[0]] == r[0]]
    assert found.count() < docs.count()


def test_repeated_substrings(stages):
    docs, found = stages[2]
    before, after = {r[0]: r for r in rows(docs)}, {r[0]: r for r in rows(found)}
    assert set(before) == set(after)
    for doc_id, n, gone, _ in plain_words([(r[0], r[1]) for r in before.values()], 20):
        assert len(after[doc_id][1].encode().split()) == n - gone
        assert after[doc_id][2:4] == before[doc_id][2:4]
        assert gone or after[doc_id] == before[doc_id]
        assert after[doc_id][4] == len(after[doc_id][1]) or not gone


def test_decontamination(stages):
    docs, found = stages[3]
    assert rows(found) == by_sql(CONTAMINATION, docs, "contaminated", "false")
    assert 0 < found.count() < docs.count()


def test_packing_and_run(corpus, stages):
    docs, found = stages[4]
    assert {r["doc_id"] for r in found.collect()} == {r["doc_id"] for r in docs.collect()}
    whole = corpus_pipeline.run(corpus, SF_DIR)
    pieces = "doc_id", "doc_tokens"
    assert sorted(whole.select(*pieces).distinct().collect()) == sorted(found.select(*pieces).distinct().collect())


def test_odd_rows(corpus, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            alone = stage(corpus, frame, SF_DIR)
            assert alone.columns == corpus_pipeline.COLUMNS
            alone.count()
            docs = stage(corpus, docs, SF_DIR)
        packed = corpus_pipeline.STAGES[-1][1](corpus, docs, SF_DIR)
        assert packed.count() == 0 if frame is no_docs else packed.count() > 0
