"""Resolves not-modified revisits of a web archive.

A revisit record says that a page had not changed: it has validators and some headers, but no
body. It takes its body from the latest earlier full response of the same canonical URL, if the
validators agree, and of its own headers those that a not-modified answer may renew.

The as-of join sorts all records by URL and time into ranges, so that a URL with most of the
records is spread over many tasks. Each range looks back within itself; what the ranges before
it end with comes from a table of one row per range and URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import quoted
from millrace.llm.shared import stored

#: Headers that describe the body or the connection, which a not-modified answer does not renew.
#: Fixed values.
NOT_RENEWED = (
    "connection", "content-encoding", "content-length", "content-location", "content-range",
    "content-type", "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)

#: Parts of the revisits that ask for one response.
_PARTS = 16

#: Query parameters that do not change what is shown.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|msclkid|sessionid|phpsessid)$"


def canonical_url(url: Column) -> Column:
    """The URL without scheme, credentials, fragment, default port, trailing slash and tracking parameters,
    its host in lower case without ``www.``, its other parameters sorted. Null for null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(bare, r"^(?i:https?)://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    parts = F.filter(
        F.split(query, "&"),
        lambda p: (p != "") & ~F.lower(F.split(p, "=")[0]).rlike(TRACKING),
    )
    query = F.array_join(F.array_sort(parts), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that repeat the last in order of their spelling counts."""
    entries = F.transform(
        F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"])
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda x: x["key"] == e["key"]),
    )
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def resolve_revisits(
    records: DataFrame,
    record_id: str = "record_id",
    url: str = "url",
    captured: str = "captured_at",
    kind: str = "kind",
    status: str = "status",
    headers: str = "headers",
    digest: str = "payload_digest",
) -> DataFrame:
    """A row per revisit: ``record_id``, ``canonical_url``, ``captured_at``, ``outcome``,
    ``response_id``, ``merged_headers`` (map) and ``payload_digest``.

    ``kind`` is ``response`` or ``revisit``; full responses are those of status 200 whose headers
    have no ``content-range``. The response is the latest captured strictly before the revisit; of
    several at one time that of the greatest id. ``outcome`` is ``resolved``, ``no_response``,
    ``changed`` (a validator differs) or ``unchecked`` (none to compare). Entity tags are compared
    weakly and decide if both sides have one, else the time of the last change does. Only
    resolved revisits have a payload and the response's headers; others keep their own headers.
    ``with_bodies`` adds the payload itself.

    Nulls: records without URL or time are in no join: such revisits get ``no_response``, such responses are
    passed over. Missing headers are none. Repeated revisits each get a row; repeated responses
    count once. An empty table gives an empty result. Other columns are ignored.
    """
    spark = records.sparkSession
    rows = stored(
        records.select(
            quoted(record_id).cast("string").alias("id"),
            canonical_url(quoted(url)).alias("site"),
            quoted(captured).cast("timestamp").alias("at"),
            (quoted(kind) == "revisit").alias("revisit"),
            quoted(status).cast("int").alias("status"),
            _lower_names(quoted(headers)).alias("headers"),
            quoted(digest).cast("string").alias("digest"),
        ),
        "records",
    )
    full = ~F.col("revisit") & (F.col("status") == 200) & F.col("headers")["content-range"].isNull()
    used = rows.filter("site IS NOT NULL AND at IS NOT NULL").filter(F.col("revisit") | full).drop("status")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # At one time revisits come before responses: a response counts for later times only.
    ranged = used.repartitionByRange(parts, "site", "at", F.desc("revisit"), "id")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "ranged-records")
    answer = F.struct("at", "id", "headers", "digest")
    ranged = ranged.withColumn("response", F.when(~F.col("revisit"), answer))
    last = F.max_by("response", F.when(~F.col("revisit"), F.struct("at", "id")))
    ends = ranged.groupBy("site", "part").agg(last.alias("response"))
    by_part = Window.partitionBy("site").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select("site", "part", F.last("response", ignorenulls=True).over(by_part).alias("carried"))
    before = before.filter("carried IS NOT NULL")
    in_part = Window.partitionBy("site", "part").orderBy("at", F.desc("revisit"), "id")
    looked = (
        ranged.withColumn("own", F.last("response", ignorenulls=True).over(in_part))
        .filter("revisit")
        .join(before, ["site", "part"], "left")
        .withColumn("response", F.coalesce("own", "carried"))
        .select("id", "site", "at", "headers", "response")
    )
    lost = rows.filter("revisit AND (site IS NULL OR at IS NULL)").select(
        "id", "site", "at", "headers", F.lit(None).cast(looked.schema["response"].dataType).alias("response")
    )
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    own, theirs = F.col("headers"), F.col("response.headers")
    same = F.coalesce(tag(own) == tag(theirs), own["last-modified"] == theirs["last-modified"])
    outcome = (
        F.when(F.col("response").isNull(), "no_response")
        .when(same, "resolved")
        .when(~same, "changed")
        .otherwise("unchecked")
    )
    renewed = F.map_filter(own, lambda k, v: ~k.isin(*NOT_RENEWED))
    kept = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(renewed, k))
    good = F.col("outcome") == "resolved"
    return (
        looked.unionAll(lost)
        .withColumn("outcome", outcome)
        .select(
            F.col("id").alias("record_id"),
            F.col("site").alias("canonical_url"),
            F.col("at").alias("captured_at"),
            "outcome",
            F.col("response.id").alias("response_id"),
            F.when(good, F.map_concat(kept, renewed)).otherwise(own).alias("merged_headers"),
            F.when(good, F.col("response.digest")).alias("payload_digest"),
        )
    )


def with_bodies(
    resolved: DataFrame, records: DataFrame, record_id: str = "record_id", kind: str = "kind", body: str = "body"
) -> DataFrame:
    """The resolved revisits with the ``body`` of their response; null for others.

    Only bodies that are needed are shuffled: to their ids first, then to the parts of the revisits that ask for
    them, as a third of all may ask for one. Of responses that share an id the smallest body counts.
    """
    body_of = F.when(F.col("outcome") == "resolved", F.col("response_id")).alias("_body_of")
    part = F.pmod(F.xxhash64("record_id"), F.lit(_PARTS)).cast("int").alias("_part")
    wanted = stored(resolved.select("*", body_of, part), "resolved")
    asked = wanted.filter("_body_of IS NOT NULL")
    bodies = records.filter(quoted(kind) == "response").select(
        quoted(record_id).cast("string").alias("_body_of"), quoted(body).alias("body")
    )
    parts = asked.groupBy("_body_of").agg(F.collect_set("_part").alias("_parts"))
    bodies = bodies.join(parts.hint("merge"), "_body_of")
    bodies = bodies.groupBy("_body_of").agg(F.min("body").alias("body"), F.first("_parts").alias("_parts"))
    bodies = bodies.select("_body_of", F.explode("_parts").alias("_part"), "body")
    found = asked.join(bodies.hint("merge"), ["_body_of", "_part"], "left").select(*resolved.columns, "body")
    rest = wanted.filter("_body_of IS NULL").select(*resolved.columns, F.lit(None).cast(bodies.schema["body"].dataType).alias("body"))
    return found.unionAll(rest)


def page_captures(pages: DataFrame) -> DataFrame:
    """Archive records made from a table of pages: ``page_id``, ``url`` and ``html``.

    Every page has a first response (every 13th of them partial), every fourth a changed one a day
    and a half later, and each a revisit some days before or after. Revisits spell the URL in
    another way; their validators are right, weak, stale or missing by the page's number.
    """
    n = F.col("page_id")
    day, start = 86400, 1704067200
    first = F.lit(start) + n * 2220
    second = F.concat(F.col("html"), F.lit("2"))
    digests = pages.select(
        "page_id",
        "url",
        "html",
        F.md5(F.col("html").cast("binary")).alias("one"),
        F.md5(second.cast("binary")).alias("two"),
        F.length("html").alias("size"),
    )
    quote = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    changed = F.concat(F.lit("day "), (n % 28).cast("string"))

    def headers(*pairs: tuple[str, Column]) -> Column:
        names, values = F.array(*(F.lit(k) for k, _ in pairs)), F.array(*(v for _, v in pairs))
        return F.map_filter(F.map_from_arrays(names, values), lambda k, v: v.isNotNull())

    def record(prefix: str, at: Column, kind: str, status: Column, digest: Column, url: Column, fields: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), n.cast("string")).alias("record_id"),
            url.alias("url"),
            F.timestamp_seconds(at).alias("captured_at"),
            F.lit(kind).alias("kind"),
            status.alias("status"),
            fields.alias("headers"),
            digest.alias("payload_digest"),
        )

    def response(prefix: str, at: Column, digest: Column, size: Column, partial: Column) -> Column:
        fields = headers(
            ("ETag", F.when(n % 3 != 0, quote(digest))),
            ("Last-Modified", changed),
            ("Content-Type", F.lit("text/html")),
            ("Content-Length", size.cast("string")),
            ("Cache-Control", F.lit("max-age=60")),
            ("Content-Range", F.when(partial, "bytes 0-9/*")),
        )
        return record(prefix, at, "response", F.when(partial, 206).otherwise(200), digest, F.col("url"), fields)

    bare = F.regexp_replace("url", "#.*$", "")
    again = F.concat(bare, F.when(F.instr(bare, "?") > 0, "&").otherwise("?"), F.lit("utm_medium=again#x"))
    current = quote(F.when(n % 8 == 0, F.col("two")).otherwise(F.col("one")))
    sent = F.when(n % 7 == 0, '"stale"').otherwise(F.concat(F.when(n % 2 == 0, "W/").otherwise(""), current))
    validated = n % 11 != 0
    fields = headers(
        ("etag", F.when((n % 3 != 0) & validated, sent)),
        ("last-modified", F.when(validated, changed)),
        ("Cache-Control", F.lit("max-age=600")),
        ("Expires", F.concat(F.lit("after "), n.cast("string"))),
        ("Content-Length", F.lit("0")),
    )
    no_digest = F.lit(None).cast("string")
    captures = F.array(
        response("r", first, F.col("one"), F.col("size"), n % 13 == 0),
        F.when(n % 4 == 0, response("q", first + day + day // 2, F.col("two"), F.col("size") + 1, F.lit(False))),
        record("v", first + (n % 5 - 1) * day, "revisit", F.lit(304), no_digest, again, fields),
    )
    body = F.when(F.col("c.record_id").startswith("r"), F.col("html")).when(F.col("c.record_id").startswith("q"), second)
    return digests.select("html", F.explode(captures).alias("c")).filter("c IS NOT NULL").select("c.*", body.alias("body"))
