"""SQL, as DuckDB runs it, for the registered queries that SQL can express."""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

CONTAMINATION = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format("text")} AS w FROM documents
),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM.format("text")} AS w FROM benchmark
    WHERE item_id IS NOT NULL
),
windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n,
           array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS words
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
starts AS (
    SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT r, s.n, i, item FROM starts s JOIN windows USING (n, words)),
covered AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, n, i FROM hits)) GROUP BY r
),
found AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

QUALITY = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
           {_WORDS.format("text")} AS w
    FROM documents
),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
grams AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times
    FROM (SELECT r, i, list_slice(w, i, i + 2) AS g
          FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs))
),
repeats AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE times > 1) GROUP BY r
),
metrics AS (
    SELECT r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           10 * n_symbols > word_chars AS symbols,
           n_lines >= 4 AND 2 * n_dup_lines > n_lines AS repeated_lines,
           word_chars < 2 * n_words OR word_chars > 15 * n_words AS word_length
    FROM metrics
),
failures AS (
    SELECT source, rule, count(*) AS n, CAST(count(*) FILTER (failed) AS DOUBLE) AS k
    FROM (
        SELECT source, 'any' AS rule, base_failed OR symbols OR repeated_lines OR word_length AS failed FROM judged
        UNION ALL SELECT source, 'symbols', symbols FROM judged
        UNION ALL SELECT source, 'repeated_lines', repeated_lines FROM judged
        UNION ALL SELECT source, 'word_length', word_length FROM judged)
    GROUP BY source, rule
),
priors AS (
    SELECT rule, mean, CASE WHEN variance > 0
        THEN greatest(1, least(1000, mean * (1 - mean) / variance - 1)) ELSE 1000 END AS strength
    FROM (
        SELECT rule, sum(k) / sum(n) AS mean,
               CASE WHEN sum(n) - sum(n * n) / sum(n) > 0 THEN
                   (sum(k * k / n) - sum(n) * (sum(k) / sum(n)) ** 2
                    - (count(*) - 1) * (sum(k) / sum(n)) * (1 - sum(k) / sum(n)))
                   / (sum(n) - sum(n * n) / sum(n)) END AS variance
        FROM failures GROUP BY rule)
),
rates AS (
    SELECT source,
           max(rate) FILTER (rule = 'any') AS rate_any,
           max(rate) FILTER (rule = 'symbols') AS rate_symbols,
           max(rate) FILTER (rule = 'repeated_lines') AS rate_repeated_lines,
           max(rate) FILTER (rule = 'word_length') AS rate_word_length
    FROM (SELECT source, rule, (k + mean * strength) / (n + strength) AS rate
          FROM failures JOIN priors USING (rule))
    GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate_any < 0.8
       AND NOT (symbols AND rate_symbols >= 0.001)
       AND NOT (repeated_lines AND rate_repeated_lines >= 0.001)
       AND NOT (word_length AND rate_word_length >= 0.001) AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
windows AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1 AS repeated
    FROM (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS words
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs))
),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM windows WHERE repeated
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs)
         ANTI JOIN removed USING (doc_id, p)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id) USING (doc_id)
     LEFT JOIN kept USING (doc_id)
"""

_SITE = r"""
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''),
                                  ':(80|443)?$', ''), '^www\.', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END
"""

REVISITS = rf"""
WITH spelled AS (
    SELECT page_id AS n, html, epoch_ms(0) + to_seconds(1704067200 + page_id * 2220) AS taken, url AS first_url,
           regexp_replace(url, '#.*$', '')
           || CASE WHEN contains(regexp_replace(url, '#.*$', ''), '?') THEN '&' ELSE '?' END
           || 'utm_medium=again#x' AS again_url
    FROM pages
),
urls AS (
    SELECT DISTINCT url, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://', '') AS rest
    FROM (SELECT first_url AS url FROM spelled UNION ALL SELECT again_url FROM spelled)
),
sites AS (
    SELECT url, {_SITE} AS site
    FROM (SELECT url, rest, list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p:
              p <> '' AND NOT regexp_matches(lower(string_split(p, '=')[1]),
                  '^(utm_[a-z]+|gclid|fbclid|msclkid|sessionid|phpsessid)$')) AS kept
          FROM urls)
),
responses AS (
    SELECT 'r' || n AS id, site, taken, html AS body, n,
           CASE WHEN n % 3 <> 0 THEN '"' || md5(html) || '"' END AS tag
    FROM spelled JOIN sites ON url = first_url WHERE n % 13 <> 0
    UNION ALL
    SELECT 'q' || n, site, taken + INTERVAL 36 HOUR, html || '2', n,
           CASE WHEN n % 3 <> 0 THEN '"' || md5(html || '2') || '"' END
    FROM spelled JOIN sites ON url = first_url WHERE n % 4 = 0
),
revisits AS (
    SELECT 'v' || n AS record_id, site, taken + to_days(CAST(n % 5 - 1 AS INTEGER)) AS taken, n,
           CASE WHEN n % 3 <> 0 AND n % 11 <> 0 THEN
               CASE WHEN n % 7 = 0 THEN '"stale"'
                    WHEN n % 8 = 0 THEN '"' || md5(html || '2') || '"'
                    ELSE '"' || md5(html) || '"' END END AS tag,
           CASE WHEN n % 2 = 0 AND n % 7 <> 0 THEN 'W/' ELSE '' END AS weak,
           CASE WHEN n % 11 <> 0 THEN 'day ' || (n % 28) END AS changed
    FROM spelled JOIN sites ON url = again_url
),
looked AS (
    SELECT v.*, r.id AS response_id, r.body, r.tag AS their_tag, 'day ' || (r.n % 28) AS their_changed,
           coalesce(v.tag = r.tag, v.changed = 'day ' || (r.n % 28)) AS same
    FROM revisits v ASOF LEFT JOIN responses r ON v.site = r.site AND v.taken > r.taken
),
judged AS (
    SELECT *, CASE WHEN response_id IS NULL THEN 'no_response' WHEN same THEN 'resolved'
                   WHEN NOT same THEN 'changed' ELSE 'unchecked' END AS outcome
    FROM looked
)
SELECT record_id, site AS canonical_url, CAST(epoch(taken) AS BIGINT) AS captured_second, outcome, response_id,
       array_to_string(list_filter([
           'cache-control: max-age=600',
           'content-length: ' || CASE WHEN outcome = 'resolved' THEN length(body) ELSE 0 END,
           CASE WHEN outcome = 'resolved' THEN 'content-type: text/html' END,
           'etag: ' || coalesce(weak || tag, CASE WHEN outcome = 'resolved' THEN their_tag END),
           'expires: after ' || n,
           'last-modified: ' || coalesce(changed, CASE WHEN outcome = 'resolved' THEN their_changed END)
       ], lambda x: x IS NOT NULL), '; ') AS merged_headers,
       CASE WHEN outcome = 'resolved' THEN md5(body) END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN strlen(body) ELSE 0 END AS body_bytes,
       CASE WHEN outcome = 'resolved' THEN sha256(body) END AS body_sha256
FROM judged
"""

SEARCH = f"""
WITH docs AS (
    SELECT r, doc_id, unnest(w) AS term, len(w) AS n
    FROM (SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format("text")} AS w FROM documents)
),
asked AS (
    SELECT q, item_id, term, count(*) AS times
    FROM (SELECT q, item_id, unnest(w) AS term
          FROM (SELECT row_number() OVER () AS q, item_id, {_ALNUM.format("text")} AS w FROM benchmark))
    GROUP BY ALL
),
corpus AS (SELECT CAST(count(DISTINCT r) AS BIGINT) AS big_n, CAST(count(*) AS BIGINT) AS big_l FROM docs),
held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM docs SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus
),
worth AS (
    SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * big_n) // big_l))) AS impact
    FROM held, corpus
),
scores AS (
    SELECT q, item_id, r, doc_id, CAST(sum(times * w * impact) AS BIGINT) AS score
    FROM asked JOIN worth USING (term) JOIN weights USING (term) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= 10
"""
