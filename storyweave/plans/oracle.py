"""The same results in SQL, from the same tables, for checking."""

from __future__ import annotations

from storyweave.operators.clusters import ROUNDS, thresholds
from storyweave.plans.catalog import STOP_WORDS, THRESHOLD

SLOT = "TIMESTAMP '2024-01-01 00:00:00' + {} * INTERVAL 5 MINUTE"
AT = SLOT.format("doc_id")


def text_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


ARTICLE = f"""article AS (SELECT doc_id AS article_id, CAST(substr(source, 4) AS INT) AS source_id,
  'https://' || source || '.example.com/a/' || doc_id AS url, substr(text, 1, 60) AS title, {AT} AS added_at
  FROM documents)"""
SOURCE = "source AS (SELECT DISTINCT CAST(substr(source, 4) AS INT) AS id, source AS name FROM documents)"
TC = f"""tc AS (SELECT article_id, term, added_at, count(*) AS cnt FROM (
  SELECT doc_id AS article_id, {AT} AS added_at, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term
  FROM documents) GROUP BY ALL)"""


def windows(size: str, slide: str, rows: str) -> str:
    """``win(wb, we)``: closed windows ending on multiples of the slide that hold some row."""
    return f"""win AS (SELECT we - INTERVAL {size} AS wb, we FROM (
  SELECT unnest(generate_series(TIMESTAMP '2023-12-25', (SELECT max(added_at) + INTERVAL 10 DAY FROM {rows}), INTERVAL {slide})) AS we))"""


DAILY = f"""{TC}, {windows('1 DAY', '1 DAY', 'tc')},
d AS (SELECT wb, we, article_id, term, cnt FROM tc JOIN win ON added_at BETWEEN wb AND we)"""


def sliding(size: str, slide: str) -> str:
    return f"""{TC}, {windows(size, slide, 'tc')}, d AS (SELECT wb, we, article_id, term, cnt FROM tc JOIN win ON added_at BETWEEN wb AND we)"""


WIDE = f"""{TC}, d AS (SELECT TIMESTAMP '2024-01-01' AS wb, TIMESTAMP '2024-01-01' AS we, article_id, term, cnt FROM tc)"""
WEIGHTS = """n AS (SELECT wb, we, count(DISTINCT article_id) AS n FROM d GROUP BY ALL),
df AS (SELECT wb, we, term, count(*) AS df FROM d GROUP BY ALL),
raw AS (SELECT d.wb, d.we, article_id, d.term, cnt, cnt * (ln((1 + n) / (1.0 + df)) + 1) AS w
  FROM d JOIN df ON d.wb = df.wb AND d.we = df.we AND d.term = df.term JOIN n ON d.wb = n.wb AND d.we = n.we),
w AS (SELECT wb, we, article_id, term, cnt, w / sqrt(sum(w * w) OVER (PARTITION BY wb, we, article_id)) AS w FROM raw)"""
REPS = """sig AS (SELECT wb, we, article_id, md5(string_agg(term || ':' || cnt, ',' ORDER BY term)) AS sig FROM d GROUP BY ALL),
mem AS (SELECT wb, we, article_id, min(article_id) OVER (PARTITION BY wb, we, sig) AS rep FROM sig)"""


def pairs(bar: float) -> str:
    """``p(wb, we, a, b, s)`` over all articles, copies included."""
    return f"""p AS (SELECT x.wb, x.we, x.article_id AS a, y.article_id AS b, round(sum(x.w * y.w), 9) AS s
  FROM w x JOIN w y ON x.wb = y.wb AND x.we = y.we AND x.term = y.term AND x.article_id < y.article_id
  GROUP BY ALL HAVING round(sum(x.w * y.w), 9) >= {bar!r})"""


def labels(days: str, bar: float) -> str:
    """``lab(wb, we, v, label)``: smallest reachable article."""
    return f"""WITH RECURSIVE {days}, {WEIGHTS}, {pairs(bar)},
e AS (SELECT wb, we, a, b FROM p UNION ALL SELECT wb, we, b, a FROM p),
cc(wb, we, v, r) AS (SELECT DISTINCT wb, we, article_id, article_id FROM d
  UNION SELECT cc.wb, cc.we, e.b, cc.r FROM cc JOIN e ON e.wb = cc.wb AND e.we = cc.we AND e.a = cc.v),
lab AS (SELECT wb, we, v, min(r) AS label FROM cc GROUP BY ALL)"""


CLUSTERS = f"""{labels(DAILY, THRESHOLD)},
big AS (SELECT wb, we, label, count(*) AS members FROM lab GROUP BY ALL HAVING count(*) > 1),
clus AS (SELECT sha256('threshold|{{"threshold": {THRESHOLD}}}|' || epoch_us(wb) || '|' || epoch_us(we) || '|' || label) AS id,
  wb, we, label, members FROM big),
links AS (SELECT id AS cluster_id, v AS article_id FROM lab JOIN clus USING (wb, we, label)),
words AS (SELECT id AS cluster_id, term, sum(w) / any_value(members) AS weight
  FROM links JOIN clus ON id = cluster_id JOIN w ON w.wb = clus.wb AND w.we = clus.we AND w.article_id = links.article_id
  GROUP BY ALL),
keywords AS (SELECT cluster_id, term, weight FROM words
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY round(weight, 9) DESC, term) <= 10),
{ARTICLE}, {SOURCE},
sizes AS (SELECT cluster_id, count(DISTINCT source_id) AS size FROM links JOIN article USING (article_id) GROUP BY ALL),
top AS (SELECT clus.*, size FROM clus JOIN sizes ON id = cluster_id
  WHERE we - wb = INTERVAL 1 DAY AND we = (SELECT max(we) FROM clus) ORDER BY size DESC, id LIMIT 10)"""

LEVELS = thresholds(0.2, 0.6, 40)
SWEEP = f"""WITH RECURSIVE {DAILY}, {WEIGHTS}, {REPS}, {pairs(LEVELS[0])},
lv AS (SELECT unnest({list(range(len(LEVELS)))}) AS step, unnest(CAST({LEVELS} AS DOUBLE[])) AS t),
e AS (SELECT step, wb, we, a, b FROM p JOIN lv ON s >= t UNION ALL SELECT step, wb, we, b, a FROM p JOIN lv ON s >= t),
cc(step, wb, we, v, label) USING KEY (step, wb, we, v) AS (
  SELECT step, wb, we, v, v FROM (SELECT DISTINCT wb, we, rep AS v FROM mem), lv
  UNION SELECT c.step, c.wb, c.we, e.b, min(c.label) FROM cc c
    JOIN e ON e.step = c.step AND e.wb = c.wb AND e.we = c.we AND e.a = c.v
    JOIN recurring.cc r ON r.step = c.step AND r.wb = c.wb AND r.we = c.we AND r.v = e.b
    WHERE c.label < r.label GROUP BY ALL),
counts AS (SELECT wb, we, step, count(DISTINCT label) AS cluster_count FROM cc GROUP BY ALL),
runs AS (SELECT wb, we, cluster_count, count(*) AS length, min(t) AS threshold, min(step) AS step
  FROM counts JOIN lv USING (step) GROUP BY ALL),
kept AS (SELECT * FROM runs QUALIFY count(*) OVER (PARTITION BY wb, we) = 1
  OR row_number() OVER (PARTITION BY wb, we ORDER BY threshold) > 1)"""


def plateau(direction: str) -> str:
    return f"""chosen AS (SELECT * FROM kept
  QUALIFY row_number() OVER (PARTITION BY wb, we ORDER BY length DESC, threshold {direction}) = 1)"""




def halves(rounds: int = ROUNDS) -> str:
    """Two groups in each window: ``s{rounds}(wb, we, article_id, side)``, every round of moving to the nearer centre spelt out."""
    def farthest(name: str, start: str) -> str:
        return f"""{name} AS (SELECT wb, we, arg_min(article_id, (round(dot, 9), article_id)) AS article_id FROM (
  SELECT x.wb, x.we, x.article_id, coalesce(sum(x.w * y.w), 0) AS dot FROM w x LEFT JOIN (SELECT w.* FROM w JOIN {start} USING (wb, we, article_id)) y
    ON x.wb = y.wb AND x.we = y.we AND x.term = y.term GROUP BY ALL) GROUP BY wb, we)"""

    steps = [
        "start AS (SELECT wb, we, min(article_id) AS article_id FROM w GROUP BY ALL)", farthest("one", "start"), farthest("other", "one"),
        """c0 AS (SELECT wb, we, term, sum(p) AS p, sum(q) AS q FROM (SELECT w.wb, w.we, term, w AS p, 0.0 AS q FROM w JOIN one USING (wb, we, article_id)
  UNION ALL SELECT w.wb, w.we, term, 0.0, w FROM w JOIN other USING (wb, we, article_id)) GROUP BY ALL)"""]
    for i in range(rounds):
        steps.append(f"""s{i + 1} AS (SELECT d.wb, d.we, article_id, (round(qq - 2 * dq, 9) < round(pp - 2 * dp, 9))::int AS side
  FROM (SELECT w.wb, w.we, article_id, sum(w * coalesce(p, 0)) AS dp, sum(w * coalesce(q, 0)) AS dq FROM w LEFT JOIN c{i} USING (wb, we, term) GROUP BY ALL) d
  JOIN (SELECT wb, we, sum(p * p) AS pp, sum(q * q) AS qq FROM c{i} GROUP BY ALL) n ON d.wb = n.wb AND d.we = n.we)""")
        steps.append(f"""c{i + 1} AS (SELECT wb, we, term, coalesce(sum(w) FILTER (side = 0) / any_value(n0), 0) AS p, coalesce(sum(w) FILTER (side = 1) / nullif(any_value(n1), 0), 0) AS q
  FROM w JOIN s{i + 1} USING (wb, we, article_id) JOIN (SELECT wb, we, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1 FROM s{i + 1} GROUP BY ALL) USING (wb, we)
  GROUP BY ALL)""")
    return ", ".join(steps)


BOUNDS = f'{text_time("wb")} AS "begin", {text_time("we")} AS "end"'

# Feed rows as the bodies were written: de and fr as Atom, de without dates, es with an empty summary.
FEED = f"""feed AS (SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS rss_feed_id, CAST(substr(source, 4) AS INT) AS source_id,
  'Story ' || doc_id AS title, 'https://' || source || '.example.com/a/' || doc_id AS url,
  CASE WHEN lang <> 'es' THEN '<p>' || lang || ' &amp; ' || n_chars || '</p>' ELSE '' END AS summary,
  CASE WHEN lang <> 'es' THEN lang || '  ' || n_chars ELSE 'Story ' || doc_id END AS cleaned, {AT} AS moment
  FROM documents WHERE lang <> 'de')"""

LOOKUPS = f"""{ARTICLE}, lookups AS (
  SELECT page_id * 3 AS query_id, url FROM pages
  UNION ALL SELECT article_id * 3 + 1, url || '?utm=x' FROM article
  UNION ALL SELECT article_id * 3 + 2, substr(url, 9) FROM article),
needle AS (SELECT query_id, url, split_part(url, '?', 1) AS needle FROM lookups),
exact AS (SELECT query_id, article_id FROM needle JOIN article ON needle = article.url),
part AS (SELECT query_id, arg_min(article_id, article.url) AS article_id FROM needle JOIN article ON contains(article.url, needle)
  WHERE query_id NOT IN (SELECT query_id FROM exact) GROUP BY query_id),
found AS (SELECT needle.query_id, needle.url, coalesce(exact.article_id, part.article_id) AS article_id FROM needle
  LEFT JOIN exact USING (query_id) LEFT JOIN part USING (query_id))"""
RELATED = f"""{CLUSTERS}, {LOOKUPS.replace(ARTICLE + ', ', '')},
others AS (SELECT DISTINCT query_id, o.article_id FROM found JOIN links m ON m.article_id = found.article_id
  JOIN links o ON o.cluster_id = m.cluster_id AND o.article_id <> m.article_id),
related AS (SELECT query_id, article.*, row_number() OVER (PARTITION BY query_id ORDER BY added_at DESC, article_id) AS position
  FROM others JOIN article USING (article_id)),
responses AS (SELECT query_id, coalesce(n, 0) AS response_count FROM found
  LEFT JOIN (SELECT query_id, count(*) AS n FROM related GROUP BY ALL) USING (query_id) WHERE article_id IS NOT NULL)"""

EVENT_KEYS = """ev AS (SELECT event_id, user_id, event_type, value, ts FROM events),
fresh AS (SELECT * FROM ev WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM ev WHERE value > 50)
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1)"""
FEEDS = """f AS (SELECT source AS id, CAST(substr(source, 4) AS INT) AS source_id,
  'https://' || source || '.example.com/feed' AS url FROM (SELECT DISTINCT source FROM documents)),
resp AS (SELECT *, CASE WHEN source_id < 2 THEN 301 WHEN source_id < 4 THEN 410 WHEN source_id < 5 THEN 503 ELSE 200 END AS status FROM f),
updated AS (SELECT id, source_id, CASE WHEN status = 301 THEN url || '/new' ELSE url END AS url, status <> 410 AS is_okay FROM resp)"""
RESPONSES = """resp AS (SELECT page_id, html, CASE WHEN contains(url, '?') THEN 404 WHEN length(html) < 2000 THEN NULL ELSE 200 END AS status FROM pages)"""
MARKUP = "<.*?>|&([a-z0-9]+|#[0-9]{1,6}|#x[0-9a-f]{1,6});"
STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

# What each layout of the query says, by event.
PARSED = """CASE event_id % 12 WHEN 0 THEN date_trunc('second', ts) + INTERVAL 5 HOUR WHEN 1 THEN date_trunc('minute', ts) + INTERVAL 4 HOUR
    WHEN 3 THEN TIMESTAMP '2024-06-01' + (date_trunc('second', ts) - date_trunc('day', ts)) WHEN 4 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
    WHEN 10 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END"""


def _members(size: str, slide: str) -> str:
    return f"""{labels(sliding(size, slide), THRESHOLD)}, big AS (SELECT wb, we, label FROM lab GROUP BY ALL HAVING count(*) > 1)
SELECT sha256('threshold|{{"threshold": {THRESHOLD}}}|' || epoch_us(wb) || '|' || epoch_us(we) || '|' || label) AS id, {BOUNDS}, v AS article_id FROM lab JOIN big USING (wb, we, label)"""


ORACLE: dict[str, str] = {
    "load_registry": f"WITH {SOURCE} SELECT id, name FROM source",
    "select_sources": f"WITH {SOURCE} SELECT id, name FROM source WHERE name IN ('src1', 'src2', 'src3')",
    "normalise_selector_config": f"""WITH {SOURCE} SELECT name AS id, 0 AS position, name AS selector_id, CAST(NULL AS VARCHAR) AS selector_class, false AS regex FROM source
        UNION ALL SELECT name, 1, NULL, 'story', true FROM source WHERE id < 5""",
    "route_feed_responses": f"""WITH {FEEDS} SELECT id AS rss_feed_id, status, CASE status WHEN 200 THEN 'parse' WHEN 301 THEN 'move' WHEN 410 THEN 'disable' ELSE 'drop' END AS action FROM resp""",
    "apply_feed_updates": f"WITH {FEEDS} SELECT id, url, is_okay FROM updated",
    "select_feeds": f"WITH {FEEDS} SELECT id, source_id, url FROM updated WHERE is_okay AND id IN ('src1', 'src2', 'src4', 'src7', 'src11')",
    "window_scan_half_day": f"""WITH {ARTICLE} SELECT article_id, url, {text_time('added_at')} AS added_at FROM article
        WHERE added_at BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-01 18:00:00'""",
    "batch_scan_one_tag": f"""WITH {ARTICLE} SELECT article_id, url, {text_time('added_at')} AS added_at FROM article WHERE added_at = TIMESTAMP '2024-01-01 12:00:00'""",
    "insert_ignore": f"WITH {EVENT_KEYS} SELECT event_id, user_id, event_type, value, {text_time('ts')} AS added_at FROM fresh",
    "rows_added": f"WITH {EVENT_KEYS} SELECT count(*) AS rows_added FROM fresh",
    "upsert": """SELECT event_id, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value > 50 DESC, event_id DESC) = 1""",
    "accept_pages": f"WITH {RESPONSES} SELECT page_id AS article_id, length(html) AS length, '2024-01-01 00:00:00' AS added_at FROM resp WHERE status = 200",
    "fetch_report": f"WITH {RESPONSES} SELECT status, count(*) AS responses FROM resp GROUP BY status",
    "write_clusters": f"""{CLUSTERS} SELECT id, 'threshold' AS type, '{{"threshold": {THRESHOLD}}}' AS parameters, {BOUNDS}, {text_time('we')} AS added_at, members AS size,
        (SELECT count(*) FROM keywords WHERE cluster_id = id) AS keywords FROM clus""",
    "parse_feed_entries": f"""WITH {FEED} SELECT rss_feed_id, source_id, title, summary,
        CASE WHEN lang = 'fr' THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(moment, '%d %b %Y %H:%M:%S EST') END AS published,
        url || '?ref=feed' AS link, CAST(NULL AS VARCHAR) AS author FROM feed""",
    "rejected_feeds": "SELECT CAST(doc_id AS VARCHAR) AS rss_feed_id, 'entry without date' AS reason FROM documents WHERE lang = 'de'",
    "entries_to_articles": f"""WITH {FEED} SELECT sha256(url) AS id, rss_feed_id, source_id, url, cleaned AS summary, title, CAST(NULL AS VARCHAR) AS authors,
        CASE WHEN lang = 'fr' THEN {text_time("moment")} ELSE {text_time("moment + INTERVAL 5 HOUR")} END AS published_at, '2024-06-01 00:00:00' AS added_at FROM feed""",
    "parse_pages": """SELECT page_id AS article_id, '' AS content, '2024-01-01 00:00:00' AS added_at FROM pages WHERE contains(html, 'class="ad"')""",
    "dedupe_titles": f"""WITH {ARTICLE} SELECT article_id, source_id, url, {text_time('added_at')} AS added_at FROM article n WHERE NOT EXISTS (
        SELECT 1 FROM article o WHERE o.title = n.title AND o.source_id = n.source_id AND o.url <> n.url AND o.added_at > TIMESTAMP '2023-12-31 18:00:00')""",
    "strip_markup": f"SELECT page_id AS article_id, regexp_replace(html, '{MARKUP}', '', 'g') AS content FROM pages",
    "strip_query": "SELECT page_id, split_part(url, '?', 1) AS url, regexp_matches(url, '^https?://') AS is_url FROM pages",
    "parse_time": f"""SELECT event_id, {text_time(PARSED)} AS parsed FROM events""",
    "format_time": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS written, strftime(ts, '%d-%m-%Y') AS day FROM events",
    "interval_eq": "SELECT event_id, event_type = 'click' AS is_day FROM events",
    "tokenise": f"SELECT doc_id AS article_id, len(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'), lambda t: t NOT IN ({STOPS}))) AS tokens FROM documents",
    "text_match": "SELECT doc_id FROM documents WHERE list_has_all(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), ['the', 'and'])",
    "term_counts": f'WITH {TC} SELECT article_id, term, cnt AS "count" FROM tc',
    "term_counts_stop_words": f'WITH {TC} SELECT article_id, term, cnt AS "count" FROM tc WHERE term NOT IN ({STOPS})',
    "lemma_counts": f"""WITH {TC} SELECT article_id, CASE WHEN length(term) > 3 AND term LIKE '%s' THEN substr(term, 1, length(term) - 1) ELSE term END AS term,
        CAST(sum(cnt) AS BIGINT) AS "count" FROM tc GROUP BY 1, 2""",
    "sliding_window_counts": f"""WITH {ARTICLE}, {windows('1 DAY', '6 HOUR', 'article')} SELECT {BOUNDS}, count(*) AS articles
        FROM article JOIN win ON added_at BETWEEN wb AND we GROUP BY wb, we""",
    "doc_frequency": f"WITH {DAILY}, {WEIGHTS} SELECT {BOUNDS}, term, df, n FROM df JOIN n USING (wb, we)",
    "tfidf": f"WITH {DAILY}, {WEIGHTS} SELECT {BOUNDS}, article_id, term, round(w, 6) AS weight FROM w",
    "similar_pairs": f"""WITH {DAILY}, {WEIGHTS}, {REPS}, {pairs(THRESHOLD)}
        SELECT {BOUNDS}, a, b, round(s, 6) AS cosine FROM p
        WHERE (wb, we, a) IN (SELECT (wb, we, rep) FROM mem) AND (wb, we, b) IN (SELECT (wb, we, rep) FROM mem)
        UNION ALL SELECT {BOUNDS}, rep, article_id, 1.0 FROM mem WHERE rep <> article_id""",
    "threshold_clusters": f"{labels(DAILY, THRESHOLD)} SELECT {BOUNDS}, v AS article_id, label FROM lab",
    "cluster_count": f"{labels(DAILY, 0.6)} SELECT {BOUNDS}, count(DISTINCT label) AS cluster_count FROM lab GROUP BY wb, we",
    "threshold_clusters_wide": f"{labels(WIDE, THRESHOLD)} SELECT v AS article_id, label FROM lab",
    "sweep_counts": f"{SWEEP} SELECT {BOUNDS}, step, cluster_count FROM counts",
    "plateau_coarse": f"{SWEEP}, {plateau('ASC')} SELECT {BOUNDS}, CAST(round(threshold, 6) AS DOUBLE) AS threshold, cluster_count, length FROM chosen",
    "plateau_fine": f"{SWEEP}, {plateau('DESC')} SELECT {BOUNDS}, CAST(round(threshold, 6) AS DOUBLE) AS threshold, cluster_count, length FROM chosen",
    "sweep_clusters": f"""{SWEEP}, {plateau('DESC')} SELECT {BOUNDS}, mem.article_id, cc.label FROM mem
        JOIN chosen USING (wb, we) JOIN cc ON cc.wb = mem.wb AND cc.we = mem.we AND cc.step = chosen.step AND cc.v = mem.rep""",
    "dbscan_clusters": f"""WITH RECURSIVE {DAILY}, {WEIGHTS}, {pairs(0.5)},
        both_ways AS (SELECT wb, we, a, b FROM p UNION ALL SELECT wb, we, b, a FROM p),
        core AS (SELECT wb, we, a AS v FROM both_ways GROUP BY ALL HAVING count(*) + 1 >= 3),
        e AS (SELECT x.* FROM both_ways x JOIN core c ON x.wb = c.wb AND x.we = c.we AND x.a = c.v JOIN core k ON x.wb = k.wb AND x.we = k.we AND x.b = k.v),
        cc(wb, we, v, r) AS (SELECT wb, we, v, v FROM core UNION SELECT cc.wb, cc.we, e.b, cc.r FROM cc JOIN e ON e.wb = cc.wb AND e.we = cc.we AND e.a = cc.v),
        lab AS (SELECT wb, we, v, min(r) AS label FROM cc GROUP BY ALL),
        border AS (SELECT x.wb, x.we, x.b AS v, min(label) AS label FROM both_ways x JOIN lab ON x.wb = lab.wb AND x.we = lab.we AND x.a = lab.v
          WHERE (x.wb, x.we, x.b) NOT IN (SELECT (wb, we, v) FROM core) GROUP BY ALL)
        SELECT {BOUNDS}, v AS article_id, label FROM (SELECT * FROM lab UNION ALL SELECT * FROM border)""",
    "fixed_k_clusters": f"""WITH {DAILY}, {WEIGHTS}, {halves()} SELECT {BOUNDS}, article_id, min(article_id) OVER (PARTITION BY wb, we, side) AS label FROM s{ROUNDS}""",
    "story_clusters": f"""{CLUSTERS} SELECT id, 'threshold' AS type, {BOUNDS}, {text_time('we')} AS added_at, article_id FROM clus JOIN links ON id = cluster_id""",
    "story_clusters_12h_hourly": _members("12 HOUR", "1 HOUR"),
    "story_clusters_3d_6h": _members("3 DAY", "6 HOUR"),
    "sliding_tfidf": f"WITH {sliding('12 HOUR', '6 HOUR')}, {WEIGHTS} SELECT {BOUNDS}, article_id, term, round(w, 6) AS weight FROM w",
    "cluster_keywords": f"{CLUSTERS} SELECT cluster_id, term, round(weight, 6) AS weight FROM keywords",
    "cluster_source_count": f"{CLUSTERS} SELECT cluster_id, size FROM sizes",
    "latest_added_at": f"{CLUSTERS} SELECT {text_time('max(we)')} AS added_at FROM clus",
    "latest_clusters": f"{CLUSTERS} SELECT id, 'threshold' AS type, {BOUNDS}, {text_time('we')} AS added_at, size FROM top",
    "cluster_members": f"""{CLUSTERS} SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY added_at DESC, article_id) AS position,
        title, url, name AS source, strftime(added_at, '%d-%m-%Y') AS date
        FROM top JOIN links ON top.id = cluster_id JOIN article USING (article_id) JOIN source ON source.id = source_id""",
    "latest_document": f"""{CLUSTERS} SELECT strftime(we, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS added_at, row_number() OVER (ORDER BY size DESC, top.id) - 1 AS position,
        size AS source_count, (SELECT count(*) FROM keywords WHERE cluster_id = top.id) AS topics, members AS articles,
        (SELECT arg_max(url, (added_at, -article_id)) FROM links JOIN article USING (article_id) WHERE cluster_id = top.id) AS newest FROM top""",
    "find_article": f"WITH {LOOKUPS} SELECT query_id, url, article_id FROM found",
    "find_article_like": f"""WITH {ARTICLE}, asked AS (SELECT article_id AS query_id, replace(url, 'src', 's_c') AS url FROM article)
        SELECT query_id, any_value(asked.url) AS url, arg_min(article_id, article.url) AS article_id
        FROM asked JOIN article ON article.url LIKE '%' || asked.url || '%' GROUP BY query_id""",
    "related_articles": f"""{RELATED} SELECT query_id, position, article_id, url, {text_time('added_at')} AS date, title, name AS source
        FROM related JOIN source ON source.id = source_id""",
    "response_count": f"{RELATED} SELECT query_id, response_count FROM responses",
    "search_log": f"""{RELATED} SELECT query_id, {text_time(SLOT.format('query_id'))} AS timestamp, CASE WHEN article_id IS NULL THEN 404 ELSE 200 END AS status_code,
        url AS target_url, CAST(NULL AS VARCHAR) AS client_id, CAST(NULL AS VARCHAR) AS referer, response_count FROM found LEFT JOIN responses USING (query_id)""",
    "stream_term_counts": f'WITH {TC} SELECT article_id, term, cnt AS "count" FROM tc',
    "stream_dedupe_titles": f"""WITH {ARTICLE}, again AS (SELECT doc_id AS article_id, CAST(substr(source, 4) AS INT) AS source_id, 'https://new.example.com/' || doc_id AS url,
        CASE WHEN lang = 'en' THEN substr(text, 1, 60) ELSE 'Re ' || substr(text, 1, 60) END AS title, {AT} + 1000000 * INTERVAL 5 MINUTE AS added_at FROM documents)
        SELECT article_id, source_id, url, title, {text_time('added_at')} AS added_at FROM (
          SELECT * FROM article UNION ALL SELECT article_id, source_id, url, title, added_at FROM again g
          WHERE NOT EXISTS (SELECT 1 FROM article o WHERE o.title = g.title AND o.source_id = g.source_id)
          AND NOT EXISTS (SELECT 1 FROM again e WHERE e.title = g.title AND e.source_id = g.source_id AND e.added_at < g.added_at))""",
}

for _name in ("similar_pairs", "threshold_clusters", "dbscan_clusters"):
    ORACLE[f"{_name}_blocks"] = ORACLE[_name]

for _name in ("insert_ignore", "dedupe_titles"):
    ORACLE[f"{_name}_laid_out"] = ORACLE[_name]
ORACLE["window_scan_laid_out"] = ORACLE["window_scan_half_day"]
ORACLE["windows_scan_laid_out"] = f"""WITH {TC}, asked AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-01 06:00:00', TIMESTAMP '2024-01-01 18:00:00'),
  (TIMESTAMP '2024-01-01 22:00:00', TIMESTAMP '2024-01-02 04:00:00')) v(wb, we))
  SELECT {BOUNDS}, article_id, term, cnt AS "count" FROM tc JOIN asked ON added_at BETWEEN wb AND we"""

# Every tenth page has no container and so no terms.
ORACLE["extract_by_feed"] = "SELECT doc_id AS article_id, text AS content FROM documents WHERE doc_id % 10 <> 0 AND text IS NOT NULL"
ORACLE["chain_clusters"] = _members("1 DAY", "1 DAY").replace("FROM documents) GROUP BY ALL", "FROM documents WHERE doc_id % 10 <> 0) GROUP BY ALL")

_TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"
ORACLE["search_all_words"] = f"""WITH asked AS (SELECT item_id AS query_id, {_TOKENS}[1:3] AS words FROM benchmark), held AS (SELECT doc_id, {_TOKENS} AS tokens FROM documents)
    SELECT query_id, doc_id FROM asked JOIN held ON list_has_all(tokens, words) WHERE len(words) > 0"""
ORACLE["latest_document_lines"] = f"""{CLUSTERS}, ranked AS (SELECT *, row_number() OVER (ORDER BY size DESC, id) - 1 AS place FROM top)
    SELECT strftime(we, '%Y-%m-%d %H:%M:%S.%f') || '+0000' AS added_at, place, size AS source_count, (SELECT count(*) FROM keywords WHERE cluster_id = ranked.id) AS topics,
    row_number() OVER (PARTITION BY place ORDER BY added_at DESC, article_id) - 1 AS position, title, url, name AS source, strftime(added_at, '%d-%m-%Y') AS date
    FROM ranked JOIN links ON ranked.id = cluster_id JOIN article USING (article_id) JOIN source ON source.id = source_id"""
ORACLE["append_search_log"] = f"""{RELATED} SELECT query_id, {text_time(SLOT.format('query_id') + ' + h * INTERVAL 1 HOUR')} AS timestamp, CASE WHEN article_id IS NULL THEN 404 ELSE 200 END AS status_code,
    url AS target_url, CAST(NULL AS VARCHAR) AS client_id, CAST(NULL AS VARCHAR) AS referer, response_count
    FROM found LEFT JOIN responses USING (query_id), (VALUES (0), (1)) v(h)"""
ORACLE["load_registry_feeds"] = """WITH f AS (SELECT DISTINCT CAST(substr(source, 4) AS INT) AS source_id, source, 'https://' || source || '.example.com/feed' AS url FROM documents)
    SELECT sha256(url) AS id, source_id, url, true AS is_okay, 0 AS position, source AS selector_id, CAST(NULL AS VARCHAR) AS selector_class FROM f
    UNION ALL SELECT sha256(url), source_id, url, true, 1, NULL, 'story' FROM f WHERE source_id < 5"""
ORACLE["load_registry_bias"] = "SELECT DISTINCT CAST(substr(source, 4) AS INT) AS source_id, 'ALLSIDES' AS type, ['left', 'centre', 'right'][CAST(substr(source, 4) AS INT) % 3 + 1] AS value FROM documents"
ORACLE["threshold_clusters_stop_words"] = ORACLE["threshold_clusters"].replace("FROM documents) GROUP BY ALL", f"FROM documents) WHERE term NOT IN ({STOPS}) GROUP BY ALL")
ORACLE["related_counts"] = ORACLE["response_count"]
ORACLE["find_repeated"] = f"""WITH {ARTICLE}, asked AS (SELECT article_id * 2 AS query_id, split_part(url, '/a/', 1) || '?page=' || article_id AS url FROM article
    UNION ALL SELECT article_id * 2 + 1, 'src1.example.com/a/' || article_id % 7 FROM article),
  hit AS (SELECT needle, arg_min(article_id, article.url) AS article_id FROM (SELECT DISTINCT split_part(url, '?', 1) AS needle FROM asked) JOIN article ON contains(article.url, needle) GROUP BY needle)
  SELECT query_id, url, article_id FROM asked LEFT JOIN hit ON split_part(asked.url, '?', 1) = needle"""
ORACLE["parse_rdf_entries"] = f"""SELECT CAST(doc_id AS VARCHAR) AS rss_feed_id, CAST(substr(source, 4) AS INT) AS source_id, 'Caf' || chr(233) || chr(160) || doc_id || ' & &unknown;' AS title,
    chr(8364) || ' ' || n_chars AS summary, strftime({AT}, '%Y-%m-%dT%H:%M:%SZ') AS published, 'https://example.com/' || doc_id AS link, lang AS author FROM documents"""
