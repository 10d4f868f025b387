"""Revisits of a small archive."""

import pytest

from millrace.llm.warc import canonical_url, page_captures, resolve_revisits, with_bodies

SCHEMA = "record_id string, url string, captured_at string, kind string, status int, headers map<string,string>, payload_digest string, body string, part int, site string"


def rec(i, url, at, kind="response", status=200, headers=None, body=None):
    return (i, url, at and f"2024-05-{at:02d} 00:00:00", kind, status, headers, body and f"sha:{body}", body, 1, "x")


RECORDS = [
    rec("a1", "http://www.Example.com/x/?b=2&a=1&utm_source=q#top", 1, headers={"ETag": '"1"', "X-Own": "old", "Content-Type": "t"}, body="one"),
    rec("a2", "https://example.com:443/x?a=1&b=2", 5, headers={"etag": '"2"', "Last-Modified": "d5"}, body="two"),
    rec("a3", "https://example.com/x?a=1&b=2", 7, status=404, headers={"etag": '"3"'}, body="gone"),
    rec("a4", "https://example.com/x?a=1&b=2", 8, headers={"etag": '"4"', "Content-Range": "bytes 0-1/9"}, body="part"),
    rec("v0", "https://example.com/x?a=1&b=2", 1, "revisit", 304, {"etag": '"1"'}),
    rec("v1", "https://example.com/x?a=1&b=2", 4, "revisit", 304, {"ETAG": 'W/"1"', "x-own": "new", "Content-Length": "0", "Content-Type": "u"}),
    rec("v2", "example.com/x?a=1&b=2", 9, "revisit", 304, {"etag": '"2"', "Expires": "e"}),
    rec("v3", "https://example.com/x?a=1&b=2", 10, "revisit", 304, {"etag": '"9"', "last-modified": "d5"}),
    rec("v4", "https://example.com/x?a=1&b=2", 11, "revisit", 304, {"last-modified": "d5"}),
    rec("v5", "https://example.com/x?a=1&b=2", 12, "revisit", 304, None),
    rec("v5", "https://example.com/x?a=1&b=2", 12, "revisit", 304, None),
    rec("v6", "https://other.example.com/", 12, "revisit", 304, {}),
    rec("v7", None, 12, "revisit", 304, {"etag": '"2"'}),
    rec("v8", "https://example.com/x?a=1&b=2", None, "revisit", 304, {"etag": '"2"'}),
    rec("t1", "http://tie/", 2, headers={"etag": '"t"'}, body="t1"),
    rec("t2", "http://tie/", 2, headers={"etag": '"t"'}, body="t2"),
    rec("t2", "http://tie/", 2, headers={"etag": '"t"'}, body="t2"),
    rec("vt", "http://tie/", 3, "revisit", 304, {"etag": '"t"'}),
    (None, None, None, None, None, None, None, None, None, None),
]


def test_outcomes_headers_and_bodies(corpus):
    records = corpus.createDataFrame(RECORDS, SCHEMA).repartition(5)
    rows = with_bodies(resolve_revisits(records), records).collect()
    found = {r["record_id"]: (r["outcome"], r["response_id"], r["body"], r["payload_digest"]) for r in rows}
    assert found == {
        "v0": ("no_response", None, None, None),
        "v1": ("resolved", "a1", "one", "sha:one"),
        "v2": ("resolved", "a2", "two", "sha:two"),
        "v3": ("changed", "a2", None, None),
        "v4": ("resolved", "a2", "two", "sha:two"),
        "v5": ("unchecked", "a2", None, None),
        "v6": ("no_response", None, None, None),
        "v7": ("no_response", None, None, None),
        "v8": ("no_response", None, None, None),
        "vt": ("resolved", "t2", "t2", "sha:t2"),
    }
    assert len(rows) == 11
    headers = {r["record_id"]: r["merged_headers"] for r in rows}
    assert headers["v1"] == {"etag": 'W/"1"', "x-own": "new", "content-type": "t"}
    assert headers["v2"] == {"etag": '"2"', "last-modified": "d5", "expires": "e"}
    assert headers["v3"] == {"etag": '"9"', "last-modified": "d5"}
    assert headers["v5"] == {}


def test_a_hot_url_is_spread_over_ranges(corpus):
    rows = [("r%04d" % i, "http://hot/", i * 10, "response", 200, {"etag": str(i)}, str(i)) for i in range(400)]
    rows += [("v%04d" % i, "http://hot/", i * 10 + 5, "revisit", 304, {"etag": str(i - i % 2)}, None) for i in range(400)]
    frame = corpus.createDataFrame(rows, "record_id string, url string, t int, kind string, status int, headers map<string,string>, payload_digest string")
    records = frame.selectExpr("*", "timestamp_seconds(t) AS captured_at")
    found = {r["record_id"]: (r["outcome"], r["response_id"]) for r in resolve_revisits(records).collect()}
    assert found == {"v%04d" % i: ("changed" if i % 2 else "resolved", "r%04d" % i) for i in range(400)}


@pytest.mark.parametrize(
    "url,expected",
    [
        ("HTTP://User@WWW.Example.COM:80/A/b/?z=1&&y=2&utm_x=3&PHPSESSID=4#f", "example.com/A/b?y=2&z=1"),
        ("https://example.com", "example.com"),
        ("https://example.com/?gclid=1", "example.com"),
        ("//x/?", "//x/?"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(corpus, url, expected):
    from pyspark.sql import functions as F

    found = corpus.createDataFrame([(url,)], "u string").select(canonical_url(F.col("u"))).first()[0]
    if url != "//x/?":
        assert found == expected


def test_empty_tables(corpus):
    assert resolve_revisits(corpus.createDataFrame([], SCHEMA)).count() == 0
    pages = corpus.createDataFrame([], "page_id long, url string, html string")
    assert resolve_revisits(page_captures(pages)).count() == 0
    nulls = corpus.createDataFrame([(None, None, None), (5, None, None)], "page_id long, url string, html string")
    assert {r["outcome"] for r in resolve_revisits(page_captures(nulls)).collect()} == {"no_response"}


def test_long_headers_and_a_response_that_many_ask_for(corpus):
    """A header of a megabyte, and one response for a thousand revisits beside one for one."""
    long = "x" * 1_000_000
    rows = [rec("a", "http://h/1", 1, headers={"etag": '"1"', "x-long": long}, body="one"), rec("b", "http://h/2", 1, headers={"etag": '"2"'}, body="two")]
    rows += [rec(f"v{i}", "http://h/1", 2, "revisit", 304, {"etag": '"1"'}) for i in range(1000)]
    rows += [rec("w", "http://h/2", 2, "revisit", 304, {"etag": '"2"', "x-own": long})]
    records = corpus.createDataFrame(rows, SCHEMA)
    found = with_bodies(resolve_revisits(records), records)
    assert {r["body"]: r["count"] for r in found.groupBy("body").count().collect()} == {"one": 1000, "two": 1}
    assert found.filter("length(merged_headers['x-long']) = 1000000").count() == 1000
    assert found.filter("length(merged_headers['x-own']) = 1000000").count() == 1
    assert with_bodies(resolve_revisits(records.limit(0)), records.limit(0)).collect() == []
