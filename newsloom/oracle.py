"""The same results in plain SQL over whole tables, for the correctness check.

Written on its own terms: patterns here are the short forms that fit the test pages
and that RE2 can run; nothing is shared with the Spark side but the tag list.
"""

from __future__ import annotations

from newsloom.functions.tags import BLOCK_TAGS

NL = "chr(10)"
_TAGS = "|".join(BLOCK_TAGS)
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"

SITE = r"regexp_matches({u}, '^https?://[^/]+\.example\.(com|net|org)/')"
DENY = " AND ".join(
    f"NOT contains({{u}}, '{part}')"
    for part in ("/category/", "/page/", "/tag/", "/author/", "?s=", "wp-", "/wp/", "javascript:")
)
PATH = r"regexp_replace(regexp_extract({u}, '^[^:]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"


def path(u: str) -> str:
    return PATH.format(u=u)


def is_article(u: str) -> str:
    p = f"trim({path(u)}, '/')"
    slashes = f"(length({p}) - length(replace({p}, '/', '')))"
    return f"({SITE.format(u=u)} AND {DENY.format(u=u)} AND {slashes} < 2 AND length({p}) >= 6)"


def decode(e: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        e = f"regexp_replace({e}, '&{name};?', '{char}', 'g')"
    return e


def html_text(e: str) -> str:
    """Block text with two rounds of decoding and the archive whitespace rule."""
    def sub(x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, '{pattern}', {by}, 'g')"

    e = f"coalesce({e}, '')"
    e = sub(e, r"(?is)<!--.*?-->|<!doctype[^>]*>|<script(\s[^>]*)?>.*?</script\s*>|<style(\s[^>]*)?>.*?</style\s*>", "''")
    e = sub(e, rf"(?i)<({_TAGS})(\s[^>]*)?/>", f"{NL} || {NL}")
    e = sub(e, rf"(?i)</?({_TAGS})(\s[^>]*)?>", NL)
    e = sub(e, "<[^>]*>", "''")
    e = decode(decode(e))
    return archive_space(e)


def archive_space(e: str) -> str:
    e = f"replace({e}, chr(160), ' ')"
    e = rf"regexp_replace({e}, '[ \t\f\v]+', ' ', 'g')"
    e = rf"regexp_replace({e}, ' *\n *', {NL}, 'g')"
    e = rf"regexp_replace({e}, '\n{{3,}}', {NL} || {NL}, 'g')"
    return f"trim({e}, {_STRIP})"


def page_space(e: str) -> str:
    e = f"trim({e}, {_STRIP})"
    e = rf"regexp_replace({e}, '\n[\s\v]*\n+', {NL} || {NL}, 'g')"
    return rf"regexp_replace({e}, '[ \t]+', ' ', 'g')"


LANG = "regexp_extract(url, '^[^:]+://[^/]+/([^/?#]+)', 1)"

LINKS = """
SELECT page_id, url AS page_url, u AS link, min(i) AS place
FROM (SELECT page_id, url, unnest(l) AS u, generate_subscripts(l, 1) AS i
      FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS l FROM pages))
GROUP BY page_id, url, u
"""
LINK_ROWS = f"""
SELECT page_id, page_url, link, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS pos
FROM ({LINKS})
"""

ATTEMPTS = """
SELECT event_id, epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS url, attempt, status,
  CASE WHEN status = 200 AND value >= 5 THEN 'ok' WHEN status = 200 THEN 'rejected'
       WHEN status = 404 THEN 'gone' WHEN status = 503 THEN 'throttled' ELSE 'error' END AS outcome
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS attempt,
        CASE WHEN event_type IN ('view', 'purchase') THEN 200 WHEN event_type = 'signup' THEN 404
             WHEN event_type = 'error' THEN 503 ELSE 500 END AS status FROM events)
"""
STATUS = f"""
SELECT url, arg_max(attempt, (us, attempt, outcome)) AS attempt, max(us) AS ts_micros,
  arg_max(outcome, (us, attempt, outcome)) AS outcome
FROM ({ATTEMPTS}) GROUP BY url
"""

_HMS = "printf('%02d:%02d:%02d', {s} // 3600, {s} % 3600 // 60, {s} % 60)"


def hms(seconds: str) -> str:
    return _HMS.format(s=f"CAST({seconds} AS BIGINT)")


def backoff(attempt: str) -> str:
    return f"CAST(least(60, pow(2, {attempt})) AS BIGINT)"


def walk(max_pages: int) -> str:
    """Users as categories, days as pages, purchases as new links; batch 5, streak 4."""
    return f"""
WITH e AS (SELECT user_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS d, event_type FROM events),
capped AS (SELECT * FROM e WHERE d BETWEEN 1 AND {max_pages}),
pages_ AS (SELECT user_id, unnest(generate_series(1, m)) AS d FROM (SELECT user_id, max(d) AS m FROM capped GROUP BY 1)),
n AS (SELECT user_id, d, count(*) AS c FROM capped WHERE event_type = 'purchase' GROUP BY 1, 2),
w AS (SELECT p.user_id, p.d, coalesce(n.c, 0) AS c FROM pages_ p LEFT JOIN n USING (user_id, d)),
r AS (SELECT *, d - coalesce(max(CASE WHEN c > 0 THEN d END) OVER (PARTITION BY user_id ORDER BY d), 0) AS streak,
        max(d) OVER (PARTITION BY user_id) AS last_d FROM w),
s AS (SELECT *, min(CASE WHEN streak >= 4 AND (d % 5 = 0 OR d = last_d) THEN d END) OVER (PARTITION BY user_id) AS stop FROM r)
SELECT user_id AS category_slug, CAST(d AS BIGINT) AS page_num, c AS n_new, CAST(streak AS BIGINT) AS empty_streak,
  CAST(stop AS BIGINT) AS stop_page
FROM s WHERE stop IS NULL OR d <= stop
"""


def triggers(hours: int, need: int) -> str:
    width = hours * 3_600_000_000
    return f"""
WITH RECURSIVE f AS (
  SELECT event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
e AS (SELECT f.event_type, f.us, f.i FROM f JOIN f g ON g.event_type = f.event_type AND g.i = f.i - {need - 1}
      WHERE f.us - g.us < {width}),
t AS (
  SELECT event_type, min(i) AS i FROM e GROUP BY event_type
  UNION ALL
  SELECT t.event_type, min(e.i) FROM t JOIN e ON e.event_type = t.event_type AND e.i >= t.i + {need}
  GROUP BY t.event_type, t.i)
SELECT t.event_type, e.us AS ts_micros FROM t JOIN e ON e.event_type = t.event_type AND e.i = t.i
"""


def sql() -> dict[str, str]:
    article = r"(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>"
    heading = r"(?is)<article(?:\s[^>]*)?>.*?<h1(?:\s[^>]*)?>(?:<[^>]*>)*([^<]+)"
    body = page_space(decode(rf"regexp_replace(regexp_replace(regexp_extract(html, '{article}', 1), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')"))
    title = f"trim({decode(f'regexp_extract(html, $q${heading}$q$, 1)')}, {_STRIP})"
    inside = f"regexp_extract(html, '{article}', 1)"

    def bare(e: str) -> str:
        return decode(f"regexp_replace(regexp_replace({e}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')")

    def themed(tail: str) -> str:
        return f"""
SELECT page_id, 'Story ' || page_id || ' & more' AS title, [{"'Sport', 'Trade & money', 'Culture'"}][page_id % 3 + 1] AS category,
  CASE WHEN page_id % 2 = 0 THEN '2024-01-' || {day} ELSE '1999' END AS published_date, b AS body_text, length(b) AS char_count
FROM (SELECT page_id, {page_space(bare(inside) + tail)} AS b FROM pages WHERE html <> '') WHERE length(b) >= 100"""

    day = "lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')"
    ad = page_space(decode("""regexp_extract(html, '(?s)<div class="ad">([^<]*)</div>', 1)"""))
    day = "lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')"
    rough = "replace(text, '. ', '.' || chr(160) || ' ' || chr(9) || chr(10) || ' ' || chr(10) || chr(10) || ' ')"
    request = (
        "'https://news.example.com/wp-json/wp/v2/posts?page=' || CAST(page AS VARCHAR) || "
        "'&per_page=100&orderby=id&order=asc&status=publish&_fields=id%2Cdate%2Cmodified%2Clink%2Cslug"
        "%2Ctitle%2Ccontent%2Cexcerpt%2Ccategories%2Ctags%2Cauthor'"
    )
    checked = f"""
SELECT doc_id AS id, text, source AS title, n_chars, n_chars < 100 AS bad FROM documents
UNION ALL SELECT doc_id, text, source, n_chars, n_chars < 100 FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
"""
    def rate(total: str) -> str:
        return f"""
WITH t AS (SELECT us // 900000000 AS tick, count(*) FILTER (outcome = 'ok') AS o, count(*) AS n, min(us) AS lo, max(us) AS hi
           FROM ({ATTEMPTS}) GROUP BY 1),
r AS (SELECT tick, CAST(sum(o) OVER w AS BIGINT) AS saved, CAST(sum(n) OVER w AS BIGINT) AS done,
        CAST({total} AS BIGINT) AS pending, (hi - min(lo) OVER ()) // 1000000 AS elapsed_s
      FROM t WINDOW w AS (ORDER BY tick)),
s AS (SELECT tick, elapsed_s, saved, done - saved AS failed, greatest(pending - done, 0) AS remaining,
        CAST(saved AS DOUBLE) / greatest(elapsed_s, 1) AS rate FROM r),
u AS (SELECT *, CASE WHEN rate > 0.1 THEN CAST(floor(remaining / rate) AS BIGINT) END AS eta_s FROM s)
SELECT tick, elapsed_s, {hms('elapsed_s')} AS elapsed, saved, failed, remaining, rate, eta_s,
  CASE WHEN eta_s IS NULL THEN '??' ELSE {hms('coalesce(eta_s, 0)')} END AS eta FROM u"""

    windows = """
SELECT w * 900000000 AS start_micros, count(*) AS failures
FROM (SELECT us, unnest(generate_series(us // 900000000 - 3, us // 900000000)) AS w
      FROM (SELECT epoch_us(ts) AS us FROM events WHERE event_type = 'error'))
GROUP BY w HAVING count(*) >= 6"""
    progress = """
SELECT epoch_us(ts) // 3600000000 * 3600000000 AS tick_micros, count(*) AS attempts,
  count(*) FILTER (event_type IN ('view', 'purchase')) AS saved FROM events GROUP BY 1"""
    names = "CASE {s} WHEN 'en' THEN 'English' WHEN 'de' THEN 'Deutsch' WHEN 'fr' THEN 'Français' WHEN 'es' THEN 'Español' END"
    return {
        "html_plain_text": f"""
SELECT page_id, t AS text, length(t) AS char_count FROM (SELECT page_id, {html_text('html')} AS t FROM pages WHERE html <> '')""",
        "html_plain_text_parser": f"SELECT page_id, {html_text('html')} AS text FROM pages",
        "article_extract": f"""
SELECT page_id, url, title, 'unknown' AS category, CAST(NULL AS VARCHAR) AS published_date, b AS body_text, length(b) AS char_count
FROM (SELECT page_id, url, {title} AS title, {body} AS b FROM pages) WHERE title <> '' AND length(b) >= 100""",
        "article_extract_injected": themed(" || 'tail ' || page_id || 'end'"),
        "article_extract_tree_form": themed(" || 'end'"),
        "article_extract_sites": f"""
SELECT *, 'Theme News' AS source FROM ({themed(" || 'tail ' || page_id || 'end'")}) WHERE page_id % 4 = 0
UNION ALL SELECT page_id, 'Section story', 'unknown', NULL, b, length(b), 'Section News'
FROM (SELECT page_id, {page_space(bare(inside) + " || 'inner'")} AS b FROM pages WHERE page_id % 4 = 1) WHERE length(b) >= 100
UNION ALL SELECT page_id, title, 'unknown', NULL, b, length(b), 'Example News'
FROM (SELECT page_id, {title} AS title, {body} AS b FROM pages WHERE page_id % 4 = 2) WHERE title <> '' AND length(b) >= 1500""",
        "article_extract_parser": f"""
SELECT page_id, title, b AS body_text, length(b) AS char_count
FROM (SELECT page_id, {title} AS title, {ad} AS b FROM pages) WHERE title <> '' AND length(b) >= 1""",
        "archive_record": f"""
SELECT id, url, slug, published_at, modified_at, title, text, excerpt, categories, tags, author_id, source,
  CAST(text = '' AS INTEGER) AS is_empty_text
FROM (SELECT page_id AS id, url, regexp_extract({path('url')}, '([^/]*)/?$', 1) AS slug,
  '2024-01-' || {day} || 'T08:00:00' AS published_at, '2024-02-' || {day} || 'T08:00:00' AS modified_at,
  {html_text("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
  {html_text('html')} AS text,
  {html_text("regexp_extract(html, '(?s)(<p>.*?</p>)', 1)")} AS excerpt,
  CAST(page_id % 10 AS VARCHAR) AS categories, '' AS tags, length(url) AS author_id, 'Example News' AS source FROM pages)""",
        "archive_posts": """
SELECT doc_id // 100 AS page, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1 AS pos,
  doc_id AS id, lang AS slug, source AS title FROM documents""",
        "whitespace_normalize": f"""
SELECT doc_id, {archive_space(rough)} AS archive_text, {page_space(rough)} AS page_text FROM documents""",
        "article_url_filter": f"""
SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme,
  regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host, {path('url')} AS path, CAST({is_article('url')} AS INTEGER) AS is_article
FROM pages""",
        "distinct_sorted_urls": "SELECT DISTINCT regexp_extract(url, '^([^?#]*)', 1) AS url FROM pages ORDER BY url",
        "listing_link_list": f"SELECT page_id, 1 AS page_num, pos, link FROM ({LINK_ROWS})",
        "first_seen": f"""
SELECT category_slug, page_num, pos, url FROM (
  SELECT {LANG.replace('url', 'page_url')} AS category_slug, page_id + 1 AS page_num, pos, link AS url,
    row_number() OVER (PARTITION BY {LANG.replace('url', 'page_url')}, link ORDER BY page_id, pos) AS k FROM ({LINK_ROWS}))
WHERE k = 1""",
        "union_discovered": f"SELECT {LANG.replace('url', 'page_url')} AS category_slug, link AS url FROM ({LINK_ROWS})",
        "category_names": f"""
SELECT page_id, s AS category_slug, {names.format(s='s')} AS category_name FROM (SELECT page_id, {LANG} AS s FROM pages)""",
        "listing_stop_rule": walk(5000),
        "listing_page_cap": walk(12),
        "listing_requests": """
SELECT source AS category_slug, p AS page_num, 'https://news.example.com/category/' || source || '/' ||
  CASE WHEN p = 1 THEN '' ELSE 'page/' || CAST(p AS VARCHAR) || '/' END AS url
FROM (SELECT source, unnest(generate_series(1, least(CAST(ceil(count(*) / 10.0) AS BIGINT), 5000))) AS p FROM documents GROUP BY source)""",
        "sitemap_discovery": f"""
SELECT DISTINCT u AS url FROM (
  SELECT 'https://news.example.com/en' || link AS u FROM ({LINKS}) WHERE page_id IN (SELECT page_id FROM pages WHERE contains(html, '</html>')))
WHERE {is_article('u')}""",
        "sitemap_index": """
SELECT CAST(doc_id AS VARCHAR) AS file, 'sitemap' AS kind,
  'https://news.example.com/' || lang || '-post-sitemap' || CAST(doc_id AS VARCHAR) || '.xml' AS loc FROM documents""",
        "discover_fallback": "SELECT DISTINCT url FROM pages",
        "discover_sitemap_first": f"SELECT DISTINCT url FROM pages WHERE {is_article('url')}",
        "union_discovered_runs": f"""
SELECT {LANG.replace('url', 'page_url')} AS category_slug, link AS url, page_id + 1 AS page_num FROM ({LINK_ROWS})
UNION ALL SELECT 'listed', url, NULL FROM pages""",
        "archive_job_report": """
WITH d AS (SELECT CASE WHEN doc_id % 10 <> 9 THEN doc_id END AS id, doc_id, length(source) + CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 3 END AS chars,
             doc_id % 3 = 0 AS empty, '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00' AS day FROM documents),
k AS (SELECT * FROM d WHERE id IS NOT NULL UNION ALL SELECT * FROM d WHERE id IS NULL UNION ALL SELECT * FROM d WHERE id IS NULL AND doc_id % 2 = 0)
SELECT count(*) AS total_records, count(id) AS unique_ids, CAST(0 AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS duplicates,
  count(*) - count(id) AS null_ids, count(*) FILTER (empty) AS empty_text, CAST(sum(chars) AS BIGINT) AS chars_total, min(id) AS min_id, max(id) AS max_id,
  min(day) AS first_published, max(day) AS last_published,
  (SELECT count(*) + count(*) FILTER (doc_id % 2 = 0) FROM documents) AS input_records, CAST(4 AS BIGINT) AS input_malformed,
  (SELECT count(*) + count(*) FILTER (doc_id % 2 = 0) FROM documents) - count(*) AS removed,
  true AS ordered, count(*) AS written, true AS agrees FROM k""",
        "url_list_round_trip": """
SELECT url, 'unknown' AS category_slug, CAST(NULL AS VARCHAR) AS category_name FROM pages""",
        "pending_work": "SELECT doc_id, source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "page_range_from": """
SELECT doc_id // 100 AS page, count(*) AS pending FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id // 100 >= 3 GROUP BY 1""",
        "attach_category": """
SELECT d.doc_id, coalesce('quality-' || CAST(l.quality AS VARCHAR), 'unknown') AS category FROM documents d LEFT JOIN labels l USING (doc_id)""",
        "assign_chunk_8": """
SELECT page_id, rn, CASE WHEN size = 0 THEN 7 ELSE least((rn - 1) // size, 7) END AS chunk
FROM (SELECT page_id, row_number() OVER (ORDER BY url) AS rn, count(*) OVER () // 8 AS size FROM pages)""",
        "assign_chunk_20": """
SELECT doc_id, 1 + CASE WHEN size = 0 THEN 19 ELSE least((rn - 1) // size, 19) END AS chunk
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () // 20 AS size FROM documents)""",
        "line_count": "SELECT count(*) AS lines, count(*) // 8 AS lines_per_chunk FROM pages WHERE url <> ''",
        "assign_shard": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS shard FROM documents",
        "dedup_keep_first": """
SELECT doc_id, lang, source, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1""",
        "duplicates_report": """
SELECT count(*) AS rows_in, count(DISTINCT text) AS rows_kept, count(*) - count(DISTINCT text) AS rows_removed,
  CAST(0 AS BIGINT) AS remaining FROM documents""",
        "archive_job_runs": "SELECT doc_id AS id, lang AS slug, CAST(published AS VARCHAR) AS published_at FROM (SELECT *, '2024-01-01T00:00:00' AS published FROM documents)",
        "merge_page_form": """
SELECT 'https://news.example.com/' || doc_id AS url, n_chars, CAST(2 * count(*) OVER () AS BIGINT) AS input_records,
  count(*) OVER () AS removed FROM documents""",
        "validation_report_offsets": """
SELECT count(*) AS total_records, count(DISTINCT i) AS unique_ids, CAST(0 AS BIGINT) AS malformed, count(i) - count(DISTINCT i) AS duplicates,
  count(*) - count(i) AS null_ids, count(*) FILTER (text = '') AS empty_text, CAST(sum(length(text)) AS BIGINT) AS chars_total,
  min(i) AS min_id, max(i) AS max_id,
  strftime(min(TIMESTAMP '2024-01-01 00:00:00' - to_hours(CAST(doc_id % 12 AS BIGINT))), '%Y-%m-%dT%H:%M:%S') AS first_published,
  strftime(max(TIMESTAMP '2024-01-01 00:00:00' - to_hours(CAST(doc_id % 12 AS BIGINT))), '%Y-%m-%dT%H:%M:%S') AS last_published
FROM (SELECT *, CASE WHEN doc_id % 7 > 0 THEN doc_id END AS i FROM documents)""",
        "cross_chunk_merge": """
SELECT doc_id, source, n_chars, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'first' ELSE 'second' END AS run FROM documents""",
        "validation_report": f"""
SELECT count(*) AS total_records, count(DISTINCT CASE WHEN NOT bad THEN id END) AS unique_ids,
  count(*) FILTER (bad) AS malformed,
  count(id) FILTER (NOT bad) - count(DISTINCT CASE WHEN NOT bad THEN id END) AS duplicates,
  count(*) FILTER (NOT bad AND id IS NULL) AS null_ids,
  count(*) FILTER (NOT bad AND text = '') AS empty_text,
  CAST(sum(length(text) + length(title)) FILTER (NOT bad) AS BIGINT) AS chars_total,
  min(id) FILTER (NOT bad) AS min_id, max(id) FILTER (NOT bad) AS max_id,
  min('2024-01-01T00:' || lpad(CAST(n_chars % 60 AS VARCHAR), 2, '0') || ':00') AS first_published,
  max('2024-01-01T00:' || lpad(CAST(n_chars % 60 AS VARCHAR), 2, '0') || ':00') AS last_published
FROM ({checked})""",
        "validation_report_pages": f"""
SELECT count(*) AS total_records, count(DISTINCT page_id) AS unique_ids, CAST(0 AS BIGINT) AS malformed,
  count(*) - count(DISTINCT page_id) AS duplicates, CAST(0 AS BIGINT) AS null_ids, count(*) FILTER (t = '') AS empty_text,
  CAST(sum(length(t)) AS BIGINT) AS chars_total, min(page_id) AS min_id, max(page_id) AS max_id
FROM (SELECT page_id, {html_text('html')} AS t FROM pages)""",
        "count_by_category": "SELECT source, lang, count(*) AS articles FROM documents GROUP BY 1, 2",
        "count_by_category_id": f"SELECT length(link) AS category_id, count(*) AS articles FROM ({LINKS}) GROUP BY 1",
        "length_profile": """
SELECT lang, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars_total, min(length(text)) AS chars_min,
  max(length(text)) AS chars_max FROM documents GROUP BY lang""",
        "archive_size": """
SELECT max(t) AS total, CAST(ceil(max(t) / 100.0) AS BIGINT) AS pages FROM (SELECT max(doc_id) + 1 AS t FROM documents GROUP BY source)""",
        "archive_request_manifest": f"""
SELECT page, {request} AS request_url FROM (SELECT DISTINCT doc_id // 100 + 1 AS page FROM documents)""",
        "preview": """
SELECT source, doc_id, substr(text, 1, 80) AS title, substr(text, 1, 150) AS body_text, n_chars
FROM documents WHERE source = (SELECT max(source) FROM documents) ORDER BY doc_id LIMIT 3""",
        "latest_shards": """
SELECT source AS file_name, count(*) AS records, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY source ORDER BY source DESC LIMIT 5""",
        "record_checksum": """
SELECT doc_id, line, sha256(substr(line, 1, length(line) - 1) || ',"n_chars":' || CAST(n_chars AS VARCHAR) || '}') AS digest,
  sha256(text) AS text_digest
FROM (SELECT *, '{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '","source":"' || source || '"}' AS line FROM documents)""",
        "dataset_checksum": f"""
SELECT count(*) AS records, concat_ws('-', {', '.join(f"CAST(sum(CAST(('0x' || substr(h, {i}, 13)) AS BIGINT)) AS VARCHAR)" for i in range(1, 65, 13))}) AS checksum
FROM (SELECT sha256(concat_ws('|', doc_id, lang, source, text)) AS h FROM documents)""",
        "jsonl_round_trip": """
SELECT doc_id AS id, CAST(NULL AS VARCHAR) AS url, lang AS slug, CAST(NULL AS VARCHAR) AS published_at, source AS title, text,
  '' AS excerpt, n_chars AS category, CAST(0 AS BIGINT) AS n_tags, CAST(NULL AS BIGINT) AS author_id, 'Example News' AS source FROM documents""",
        "malformed_lines": """
SELECT CASE WHEN length(text) >= 100 THEN doc_id END AS id, CAST(length(text) < 100 AS INTEGER) AS malformed FROM documents""",
        "shard_stats": """
SELECT shard, count(*) AS records, CAST(0 AS BIGINT) AS empty_files
FROM (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 500 AS shard FROM documents) GROUP BY shard""",
        "shard_totals": "SELECT count(*) AS records, CAST(0 AS BIGINT) AS too_long, CAST(0 AS BIGINT) AS empty_files FROM documents",
        "single_archive": "SELECT count(*) AS records, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents",
        "sized_parts": "SELECT count(*) AS records, CAST(0 AS BIGINT) AS oversize FROM documents",
        "single_archive_order": """
SELECT 'sorted' AS kind, count(*) AS records, min(doc_id) AS first_id, max(doc_id) AS last_id, true AS ordered FROM documents
UNION ALL SELECT 'swapped', count(*), arg_min(doc_id, xor(doc_id, 1)), arg_max(doc_id, xor(doc_id, 1)), false FROM documents""",
        "sized_parts_skewed": """
SELECT count(*) AS records, min(doc_id) AS first_id, max(doc_id) AS last_id, true AS ordered, true AS many_parts,
  CAST(0 AS BIGINT) AS oversize FROM documents""",
        "by_chunk": """
SELECT doc_id, lang, CASE WHEN size = 0 THEN 7 ELSE least((rn - 1) // size, 7) END AS chunk
FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () // 8 AS size FROM documents)""",
        "gzip_test": "SELECT count(*) AS lines, CAST(0 AS BIGINT) AS bad_files, CAST(0 AS BIGINT) AS unhashed_files FROM documents",
        "report_sink": """
SELECT count(*) AS total_records, count(DISTINCT doc_id) AS unique_ids, CAST(0 AS BIGINT) AS malformed,
  count(*) - count(DISTINCT doc_id) AS duplicates, CAST(0 AS BIGINT) AS null_ids, count(*) FILTER (text = '') AS empty_text,
  CAST(sum(length(text) + length(source)) AS BIGINT) AS chars_total, min(doc_id) AS min_id, max(doc_id) AS max_id FROM documents""",
        "outcome_classes": f"""
SELECT event_id, outcome, {backoff('attempt')} AS backoff_s,
  CASE WHEN attempt < 1 THEN 3 ELSE 10 END * CASE WHEN status = 503 THEN 2 ELSE 1 END AS page_backoff_s FROM ({ATTEMPTS})""",
        "latest_status": f"SELECT url, attempt, ts_micros, outcome FROM ({STATUS})",
        "retry_queue": f"""
SELECT url, 'unknown' AS category_name, {backoff('attempt')} AS backoff_s, ts_micros + 1000000 * {backoff('attempt')} AS next_micros
FROM ({STATUS}) WHERE outcome <> 'ok'""",
        "progress_rate": rate("sum(n) OVER ()"),
        "progress_rate_of_work": rate("(SELECT count(*) FROM documents)"),
        "ledger_compaction": f"""
SELECT url, s.attempt, ts_micros, s.outcome, n AS attempts, n AS tried
FROM ({STATUS}) s JOIN (SELECT url, count(*) AS n FROM ({ATTEMPTS}) GROUP BY url) USING (url)""",
        "job_ledger": f"""
SELECT url, CAST(CASE WHEN good AND page_id % 5 <> 0 AND page_id % 7 <> 1 THEN 1 ELSE 2 END AS BIGINT) AS attempts,
  CASE WHEN good THEN 'ok' ELSE 'rejected' END AS outcome, CAST(good AS BIGINT) AS saved
FROM (SELECT page_id, url, coalesce(title <> '' AND length(b) >= 100, false) AS good
      FROM (SELECT page_id, url, {title} AS title, {body} AS b FROM pages))""",
        "progress_summary": f"""
SELECT saved, failed, start_micros, last_micros, {hms('(last_micros - start_micros) // 1000000')} AS elapsed,
  round(100.0 * saved / (saved + failed), 1) AS percent_saved
FROM (SELECT count(*) FILTER (outcome = 'ok') AS saved, count(*) FILTER (outcome <> 'ok') AS failed, max(ts_micros) AS last_micros
      FROM ({STATUS})), (SELECT min(us) AS start_micros FROM ({ATTEMPTS}))""",
        "ledger_round_trip": f"SELECT outcome, count(*) AS attempts, count(DISTINCT url) AS urls FROM ({ATTEMPTS}) GROUP BY outcome",
        "progress_lists": """
SELECT DISTINCT 'https://news.example.com/' || doc_id AS url,
       CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'completed' ELSE 'failed' END AS list FROM documents""",
        "progress_counters": """
SELECT epoch_us(make_timestamp(2024, 1, run % 28 + 1, 0, 0, 0)) - CASE WHEN run % 2 = 0 THEN 18000000000 ELSE 0 END AS start_micros,
       count(DISTINCT run) AS runs, CAST(count(*) FILTER (WHERE done) AS BIGINT) AS total_saved, CAST(0 AS BIGINT) AS shard_idx
FROM (SELECT doc_id // 1000 AS run, doc_id IN (SELECT doc_id FROM labels) AS done FROM documents) GROUP BY 1""",
        "listing_page_numbers": """
SELECT ['en', 'de', 'fr', 'es'][page_id % 4 + 1] AS category_slug, CAST(page_id // 4 % 7 + 1 AS INT) AS page_num,
       count(*) AS pages, CAST(sum(length(html)) AS BIGINT) AS chars
FROM pages WHERE html <> '' GROUP BY 1, 2""",
        "sorted_done_pages": "SELECT DISTINCT doc_id // 100 AS page FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) ORDER BY page",
        "failure_burst": """
SELECT DISTINCT event_type, us AS ts_micros, failures FROM (
  SELECT event_type, us, count(*) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS failures
  FROM (SELECT event_type, epoch_us(ts) AS us FROM events)) WHERE failures >= 6""",
        "failure_burst_reset": triggers(2, 5),
        "stream_ingest": f"""
SELECT page_id, title, b AS body_text, length(b) AS char_count
FROM (SELECT page_id, {title} AS title, {body} AS b FROM pages) WHERE title <> '' AND length(b) >= 100""",
        "stream_dedup": "SELECT event_id, user_id, event_type FROM events",
        "stream_late_pages": "SELECT page_id, url, CAST(1 AS BIGINT) AS delivery FROM pages",
        "stream_burst_windows": windows,
        "stream_progress": progress,
        "stream_burst_reset": triggers(2, 5),
        "stream_burst_reset_late": triggers(2, 5),
        "stream_progress_late": progress,
        "stream_windows_late": windows,
        "stream_pages_replayed": """
SELECT page_id, url, CAST(page_id % 3 + 1 AS BIGINT) AS delivery, CAST(page_id % 3 AS BIGINT) AS batch_id FROM pages""",
        "stream_archive_pages": """
SELECT 'record' AS kind, doc_id AS id, lang AS slug, source AS title, lang || chr(10) || chr(10) || '&' AS text FROM documents
UNION ALL SELECT 'broken', NULL, NULL, NULL, unnest(['{"code":"error","page":' || t || '}', '[{"id":' || t || ',"slug":']) FROM range(3) r(t)""",
    }
