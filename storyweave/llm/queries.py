"""The operators as named queries over a data folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyweave.llm import embedding_dedup, importance, langid, licenses, line_dedup, mixing, packing, periodic_runs, quality, simhash, token_files, topk, url_filter
from storyweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_line_dedup(spark, folder):
    return line_dedup.line_classes(table(spark, folder, "documents"))


@query
def op2_quality(spark, folder):
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_simhash(spark, folder):
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@query
def op4_url_filter(spark, folder):
    return url_filter.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select("doc_id", "digest", "licence", F.array_join("notices", ",").alias("notices"))


@query
def op6_mixing(spark, folder):
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op7_embedding_dedup(spark, folder):
    return embedding_dedup.groups(table(spark, folder, "embeddings"))


@query
def op8_packing(spark, folder):
    return packing.packed_digests(table(spark, folder, "documents"))


@query
def op9_top_k(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"))


@query
def op10_language(spark, folder):
    return langid.identify(table(spark, folder, "documents"))


@query
def op11_importance(spark, folder):
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_periodic_runs(spark, folder):
    return periodic_runs.run_digests(periodic_runs.planted(table(spark, folder, "documents")))


@query
def op13_token_files(spark, folder):
    return token_files.round_trip(table(spark, folder, "documents"))


def _canonical(text: str) -> str:
    plain = f"' ' || trim(regexp_replace(lower(regexp_replace({text}, '{licenses.COPYRIGHT}', '', 'g')), '{licenses.MARKS}', '  ', 'g')) || ' '"
    for spelling, same in licenses.SPELLINGS:
        plain = f"replace({plain}, ' {spelling} ', ' {same} ')"
    return f"sha256(replace(trim({plain}), '  ', ' '))"


def _literals(rows: tuple[tuple[str, str], ...]) -> str:
    return ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in rows)


ORACLE["op5_license_scan"] = f"""
WITH texts AS (SELECT {_canonical('t')} AS known, min(l) AS licence FROM (VALUES {_literals(licenses.TEXTS + licenses.NOTICES)}) v(l, t) GROUP BY 1),
notices AS (SELECT {_canonical('t')} AS known, min(l) AS licence FROM (VALUES {_literals(licenses.NOTICES)}) v(l, t) GROUP BY 1),
lines AS (SELECT doc_id, {_canonical('line')} AS known FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
named AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS notices
  FROM (SELECT DISTINCT doc_id, licence FROM lines JOIN notices USING (known)) GROUP BY doc_id),
whole AS (SELECT doc_id, {_canonical('text')} AS digest FROM documents)
SELECT w.doc_id, w.digest, t.licence, coalesce(n.notices, '') AS notices
FROM whole w LEFT JOIN texts t ON w.digest = t.known LEFT JOIN named n ON w.doc_id = n.doc_id
"""


def _url_sql() -> str:
    """The same models and cut as recursive levels spelt out, one for each order."""
    size, weight = url_filter.ORDER + 1, url_filter.WEIGHT
    rules = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{v} {h}/{p}'"
        for v, h, p in sorted(((v, *t.split("/", 1)) for v, t in url_filter.RULES), key=lambda r: -len(r[1] + r[2])))
    levels = []
    for order in range(size):
        part = f"substr(gram, {size - order}, {order + 1})"
        levels.append(f"g{order} AS (SELECT {part} AS part, sum(a) AS a, sum(r) AS r FROM counts GROUP BY 1)")
        seen = f"c{order} AS (SELECT substr(part, 1, {order}) AS ctx, sum(a) AS a, sum(r) AS r FROM g{order} GROUP BY 1)"
        levels.append(seen)
        one = f"FROM g{order} g JOIN c{order} c ON substr(g.part, 1, {order}) = c.ctx"
        if not order:
            p = ", ".join(f"(g.{x} + 1.0::double) / (c.{x} + {url_filter.SYMBOLS}.0::double) AS p{x}" for x in "ar")
        else:
            one += f" JOIN p{order - 1} s ON substr(g.part, 2, {order}) = s.part"
            p = ", ".join(f"(g.{x} + {weight}::double * s.p{x}) / (c.{x} + {weight}::double) AS p{x}" for x in "ar")
        levels.append(f"p{order} AS (SELECT g.part, {p} {one})")
    step = url_filter.STEP
    return f"""
WITH urls AS (SELECT DISTINCT url FROM pages),
parts AS (SELECT url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM urls),
ruled AS (SELECT *, CASE {rules} END AS found FROM parts),
asked AS (SELECT url, host, path, split_part(found, ' ', 1) AS verdict, split_part(found, ' ', 2) AS rule, substr(md5(url), 1, 1) IN ('0', '1', '2') AS held,
  repeat('^', {url_filter.ORDER}) || regexp_replace(regexp_replace(lower(url), '[0-9]', '0', 'g'), '{url_filter._USUAL}', '*', 'g') || '$' AS marked
  FROM ruled),
grams AS (SELECT url, verdict, held, substr(marked, i, {size}) AS gram
  FROM (SELECT *, unnest(generate_series(1, length(url) + 1)) AS i FROM asked WHERE url <> '')),
counts AS (SELECT gram, count(*) FILTER (verdict = 'allow' AND NOT held) AS a, count(*) FILTER (verdict = 'block' AND NOT held) AS r FROM grams GROUP BY 1),
{', '.join(levels)},
scores AS (SELECT url, any_value(verdict) AS verdict, any_value(held) AS held, avg(ln(pa) - ln(pr)) AS score
  FROM grams JOIN p{size - 1} ON gram = part GROUP BY url),
cells AS (SELECT floor(score * {step}) AS cell, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r
  FROM scores WHERE held AND verdict <> '' GROUP BY 1),
rated AS (SELECT cell, cell - coalesce(lag(cell) OVER (ORDER BY cell) + 1, cell) AS gap, round((sum(a) OVER () - coalesce(sum(a) OVER b, 0)) / sum(a) OVER ()::double + coalesce(sum(r) OVER b, 0) / sum(r) OVER ()::double, 9) AS good
  FROM cells WINDOW b AS (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT (2 * cell - gap) / {2.0 * step}::double AS cut FROM rated ORDER BY good DESC, gap DESC, cell LIMIT 1)
SELECT page_id, coalesce(q.host, '') AS host, coalesce(q.path, '') AS path, nullif(q.rule, '') AS rule,
  CASE WHEN q.verdict <> '' THEN q.verdict WHEN s.score IS NULL OR s.score >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END AS verdict
FROM pages p LEFT JOIN asked q ON p.url = q.url LEFT JOIN scores s ON p.url = s.url
"""


ORACLE["op4_url_filter"] = _url_sql()

ORACLE["op9_top_k"] = f"""
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: floor({topk.SCALE} * x::double)::bigint)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint AS score
  FROM v q JOIN v c ON q.vec_id % {topk.EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= {topk.K}
"""

#: CRC-32 over the bytes of each different word: the table of its 256 steps by rule, then a fold.
ORACLE["op11_importance"] = f"""
WITH RECURSIVE crc(i, c, k) AS (SELECT i, i::uinteger, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::uinteger) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
steps AS (SELECT list(c::bigint ORDER BY i) AS steps FROM crc WHERE k = 8),
words AS (SELECT 'd' AS side, doc_id, row_number() OVER () AS nth, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x80-\\x{{10FFFF}}]+') AS w FROM documents
  UNION ALL SELECT 'b', NULL, NULL, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x80-\\x{{10FFFF}}]+') FROM benchmark),
counts AS (SELECT side, nth, term, count(*) AS n FROM (SELECT side, nth, unnest(w) AS term FROM words) GROUP BY ALL),
known AS (SELECT term, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, strlen(term) + 1), lambda j: ('0x' || substr(hex(term), 2 * j - 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::bigint) % {importance.BUCKETS} AS bucket
  FROM (SELECT DISTINCT term FROM counts), steps),
held AS (SELECT side, bucket, sum(n) AS n FROM counts JOIN known USING (term) GROUP BY ALL),
totals AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0)::double AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::double AS t FROM held),
gain AS (SELECT k.bucket, floor(1000 * ln((coalesce(b.n, 0)::double + 1) * (s + {importance.BUCKETS}) / ((coalesce(d.n, 0)::double + 1) * (t + {importance.BUCKETS}))))::bigint AS gain
  FROM (SELECT DISTINCT bucket FROM known) k LEFT JOIN held d ON d.bucket = k.bucket AND d.side = 'd' LEFT JOIN held b ON b.bucket = k.bucket AND b.side = 'b', totals),
summed AS (SELECT nth, sum(n) AS features, sum(n * gain) AS total FROM counts JOIN known USING (term) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY nth),
scored AS (SELECT doc_id, coalesce(features, 0)::bigint AS n_features, CASE WHEN features > 0 THEN floor(total::double / features)::bigint ELSE 0 END AS weight, len(coalesce(w, [])) AS n_words,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint AS noise
  FROM words LEFT JOIN summed USING (nth) WHERE side = 'd'),
able AS (SELECT *, n_words >= {importance.LEAST} AND doc_id IS NOT NULL AS able FROM scored)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN able AND row_number() OVER (PARTITION BY able ORDER BY weight + noise DESC, doc_id, n_features, weight) <= (SELECT {importance.PERCENT} * count(*) // 100 FROM able WHERE able)
    THEN row_number() OVER (PARTITION BY able ORDER BY weight + noise DESC, doc_id, n_features, weight) END AS rank
FROM able
"""
