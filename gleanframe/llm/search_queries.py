"""Registered queries of the operators on urls, resampling and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanframe.llm import linktrust as lt
from gleanframe.llm.base import documents
from gleanframe.llm.ranking import rank_documents
from gleanframe.llm.registry import query
from gleanframe.llm.resample import resample

#: The rules of the query.
RULES = [
    lt.UrlRule("org", "/", "allow"),
    lt.UrlRule("example.org", "/es/", "block"),
    lt.UrlRule("example.org", "/en/1", "block"),
    lt.UrlRule("com", "/fr/", "allow"),
    lt.UrlRule("com", "/de/", "block"),
]


def _round_sql(k: int) -> str:
    return f"""
r{k} AS MATERIALIZED (
  SELECT kind, host, sum(rank)::BIGINT AS rank FROM (
    SELECT kind, e.nxt AS host, 85 * (rank // degree) // 100 AS rank FROM r{k - 1} JOIN e USING (kind, host)
    UNION ALL SELECT kind, host, 15 * rank // 100 FROM r0) GROUP BY ALL),"""


URL_SQL = rf"""
WITH p AS (
  SELECT page_id, html, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM (SELECT page_id, html, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS h,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)),
q AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM p),
h AS (SELECT host, count(rule) AS ruled, count(*) FILTER (rule IN ('org/', 'com/fr/')) AS allowed FROM q GROUP BY host),
x AS (
  SELECT host AS a, translate(unnest(regexp_extract_all(html,
    '(?i)\bhref[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''<>\x5C\x20\x09-\x0D]+)', 1)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b FROM p),
u AS (SELECT c.host AS a, o.host AS b FROM h c JOIN h o ON o.host = regexp_extract(c.host, '^[^.]*\.(.*)$', 1)),
l AS (SELECT * FROM (SELECT a, b FROM x UNION SELECT a, b FROM u UNION SELECT b, a FROM u) WHERE a <> '' AND b <> '' AND a <> b),
s AS (SELECT 'trust' AS kind, a AS host, b AS nxt FROM l UNION ALL SELECT 'distrust', b, a FROM l),
e AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM s),
r0 AS MATERIALIZED (
  SELECT * FROM (
    SELECT 'trust' AS kind, host, 100000000 * allowed // nullif(ruled, 0) AS rank FROM h WHERE ruled > 0 AND host <> ''
    UNION ALL SELECT 'distrust', host, 100000000 * (ruled - allowed) // nullif(ruled, 0) FROM h WHERE ruled > 0 AND host <> '')
  WHERE rank > 0),
{"".join(_round_sql(k) for k in range(1, lt.ROUNDS + 1))}
v AS (
  SELECT host, sum(CASE kind WHEN 'distrust' THEN rank ELSE -rank END) > 0 AS blocked FROM r{lt.ROUNDS} GROUP BY host)
SELECT page_id, q.host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR blocked THEN 'block' ELSE 'allow' END AS verdict
FROM q LEFT JOIN v ON q.host = v.host
"""


@query("op11_url_filters", URL_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return lt.filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")

def _crc_sql() -> str:
    """CTEs: ``f`` (doc, item or null; feature) to ``b`` (feature, bucket) by CRC-32."""
    return """
z AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
x AS (SELECT DISTINCT f FROM g),
y AS (SELECT f, hex(encode(f)) AS h FROM x),
b AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(h), 2),
      lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1)),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket FROM y, z)"""


RESAMPLE_SQL = rf"""
WITH a AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 't', -row_number() OVER (), NULL, text FROM benchmark),
w AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM a),
g AS MATERIALIZED (
  SELECT side, r, array_to_string(w[i : i + k - 1], ' ') AS f
  FROM (SELECT side, r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
{_crc_sql()},
n AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM g JOIN b USING (f) GROUP BY bucket),
o AS (SELECT coalesce(sum(s), 0)::DOUBLE AS ss, coalesce(sum(t), 0)::DOUBLE AS tt FROM n),
v AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain FROM n, o),
m AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM g JOIN b USING (f) JOIN v USING (bucket) WHERE side = 'd' GROUP BY r),
p AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m USING (r) WHERE side = 'd'),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM p WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 5 * count(*) // 100 FROM k) THEN rank END AS rank
FROM p LEFT JOIN k USING (r)
"""


@query("op12_importance_resampling", RESAMPLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


RANKING_SQL = r"""
WITH a AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(w) AS w FROM a) GROUP BY ALL),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM a),
i AS (
  SELECT item_id, w, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY ALL),
g AS (SELECT w, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS g FROM t, c GROUP BY w),
s AS (
  SELECT item_id, a.r, any_value(doc_id) AS doc_id,
    sum(q * g * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(a.w) * n) // l))))::BIGINT AS score
  FROM i JOIN g USING (w) JOIN t USING (w) JOIN a USING (r), c GROUP BY item_id, a.r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


@query("op13_ranked_search", RANKING_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
