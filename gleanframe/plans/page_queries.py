"""Queries over pages: extraction, cleaning, validation, link graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanframe.functions import text as tx
from gleanframe.functions.url import canonical_url, url_parts
from gleanframe.operators import links, quality
from gleanframe.operators.dedup import dedup_keep_first
from gleanframe.operators.extract import (
    ARTICLE_RULES,
    LISTING_RULES,
    amenity_text,
    export_rows,
    info_pairs,
    normalize_listing,
    pair_value,
    raw_listing,
    read_page,
    read_page_of_site,
    top_pairs,
)
from gleanframe.operators.markup import PageRules, Pick
from gleanframe.plans.inputs import HOST, cte, derived, table
from gleanframe.plans.registry import query
from gleanframe.plans.text_queries import (
    sql_canonical,
    sql_clean,
    sql_currency,
    sql_number,
    sql_price,
    sql_status,
    sql_yes_no,
)
from gleanframe.schemas import EXPORT_COLUMNS, FIELD_RENAMES, RAW_FIELDS
from gleanframe.session import written

# --- what the listing pages hold, straight from the columns they were made of --------

_EXPECTED = {
    "property_id": "pid",
    "url": "'https://site.example/p/' || CAST(p_partkey AS VARCHAR)",
    "title": "'“' || p_name || '”in ' || p_brand",
    "price_raw": "raw",
    "price_currency": sql_currency("raw"),
    "location": "p_type || ',  Zone' || chr(160) || CAST(p_size AS VARCHAR)",
    "description": "p_name || ' & more😀 of ' || p_type",
    "images": """CASE WHEN n_images > 1 THEN ['/i/' || CAST(p_partkey AS VARCHAR) || '/1.jpg', '/i/é2.jpg']
      WHEN n_images = 1 THEN ['/i/' || CAST(p_partkey AS VARCHAR) || '/1.jpg'] END""",
    "total_area": "CAST(gross AS VARCHAR) || ' m²'",
    "internal_area": "CAST(inner_area AS VARCHAR) || ',5 m²'",
    "number_of_bedrooms": "CAST(beds AS VARCHAR)",
    "floor": "CAST(floor_no AS VARCHAR)",
    "statusi": "status_text",
    "lloji": "p_type",
    "mobilimi": "CASE WHEN p_partkey % 4 = 0 THEN 'Not Furnished' ELSE 'partly' END",
    "ka_hipoteke": "CASE WHEN p_partkey % 7 = 0 THEN 'Mortgage: po' ELSE 'jo' END",
    "ashensor": "yn",
    "number_of_toilets": "CAST(beds + 1 AS VARCHAR)",
    "karakteristikat": "CASE n_extras WHEN 0 THEN 'Lift' WHEN 1 THEN 'Lift, Pool <3' ELSE 'Lift, Pool <3, Garden' END",
}
_RAW_SQL = "SELECT p_partkey, " + ", ".join(f"{_EXPECTED[f]} AS {f}" for f in RAW_FIELDS) + " FROM listing_pieces"
_CLEAN_SQL = {
    "price_raw": sql_price,
    "statusi": sql_status,
    "ka_hipoteke": sql_yes_no,
    "ashensor": sql_yes_no,
    **dict.fromkeys(("title", "location", "description", "lloji", "mobilimi", "karakteristikat"), sql_clean),
    **dict.fromkeys(("total_area", "internal_area", "number_of_bedrooms", "floor", "number_of_toilets"), sql_number),
}
_NORMAL_SQL = (
    "SELECT p_partkey, "
    + ", ".join(f"{_CLEAN_SQL.get(f, str)(f)} AS {FIELD_RENAMES.get(f, f)}" for f in RAW_FIELDS)
    + f" FROM ({_RAW_SQL}) AS raw_fields"
)
PIECES = cte("listing_pieces")


def _raw(spark, sf_dir):
    return raw_listing(derived(spark, sf_dir, "listing_html", heavy=True), keep=("p_partkey",))


def _listings(spark, sf_dir):
    return normalize_listing(_raw(spark, sf_dir), keep=("p_partkey",))


def _joined_images(df):
    return df.withColumn("images", F.array_join("images", ","))


_JOIN_IMAGES = "* REPLACE (array_to_string(images, ',') AS images)"


@query("page_extract", f"{PIECES} SELECT {_JOIN_IMAGES} FROM ({_RAW_SQL}) AS r")
def page_extract(spark, sf_dir):
    return _joined_images(_raw(spark, sf_dir))


@query("normalize_listing", f"{PIECES} SELECT {_JOIN_IMAGES} FROM ({_NORMAL_SQL}) AS r")
def normalized(spark, sf_dir):
    return _joined_images(_listings(spark, sf_dir))


EXPORTED_SQL = f"""SELECT {', '.join(EXPORT_COLUMNS)} FROM
(SELECT * REPLACE (CAST(to_json(images) AS VARCHAR) AS images) FROM ({_NORMAL_SQL}) AS r) AS e"""


@query("export_rows", f"{PIECES} {EXPORTED_SQL}")
def exported(spark, sf_dir):
    return export_rows(_listings(spark, sf_dir))


_TOP_FIELDS = ("total_area", "internal_area", "number_of_bedrooms", "floor", "statusi", "lloji")


@query("label_map", f"{PIECES} SELECT p_partkey, {', '.join(_TOP_FIELDS)} FROM ({_RAW_SQL}) AS r")
def label_map(spark, sf_dir):
    pages = derived(spark, sf_dir, "listing_html", heavy=True).select("p_partkey", read_page("html", LISTING_RULES).alias("page"))
    pairs = pages.select("p_partkey", top_pairs(F.col("page.top")).alias("top"))
    return pairs.select("p_partkey", *[pair_value(F.col("top"), name).alias(name) for name in _TOP_FIELDS])


@query(
    "info_pairs",
    f"""{PIECES} SELECT p_partkey, ashensor, number_of_toilets, 'partly' AS mobilimi, 'jo' AS ka_hipoteke
FROM ({_RAW_SQL}) AS r""",
)
def info_fields(spark, sf_dir):
    pages = derived(spark, sf_dir, "listing_html", heavy=True).select("p_partkey", read_page("html", LISTING_RULES).alias("page"))
    pairs = pages.select("p_partkey", info_pairs(F.col("page.info")).alias("info"))
    info = F.col("info")
    return pairs.select(
        "p_partkey",
        pair_value(info, "ashensor").alias("ashensor"),
        pair_value(info, "number_of_toilets").alias("number_of_toilets"),
        pair_value(info, "mobilimi", last=False).alias("mobilimi"),
        pair_value(info, "ka_hipoteke", last=False).alias("ka_hipoteke"),
    )


@query("amenity_text", f"{PIECES} SELECT p_partkey, karakteristikat FROM ({_RAW_SQL}) AS r")
def amenities(spark, sf_dir):
    pages = derived(spark, sf_dir, "listing_html", heavy=True).select("p_partkey", read_page("html", LISTING_RULES).alias("page"))
    return pages.select("p_partkey", amenity_text(F.col("page.amenities")).alias("karakteristikat"))


# --- validation ---------------------------------------------------------------------

_ERRORS_SQL = """CASE WHEN coalesce(property_id, '') = '' THEN 'Missing required field: property_id' ELSE '' END"""


@query(
    "validate_required",
    f"{PIECES} SELECT p_partkey, property_id, {_ERRORS_SQL} = '' AS is_valid, {_ERRORS_SQL} AS errors FROM ({_NORMAL_SQL}) AS r",
)
def validate_required(spark, sf_dir):
    checked = quality.validate(_listings(spark, sf_dir))
    return checked.select(
        "p_partkey", "property_id", "validation.is_valid", F.array_join("validation.errors", "; ").alias("errors")
    )


@query(
    "quality_report",
    f"""{PIECES} SELECT error, count(*) AS n FROM (SELECT {_ERRORS_SQL} AS error FROM ({_NORMAL_SQL}) AS r) AS e
WHERE error <> '' GROUP BY error""",
)
def quality_counts(spark, sf_dir):
    return quality.quality_report(quality.validate(_listings(spark, sf_dir)))


_RATED = [name for name in EXPORT_COLUMNS if name != "images"]


@query(
    "field_null_rates",
    f"""{PIECES}, listing AS ({_NORMAL_SQL}) """
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS field, count(*) FILTER (WHERE coalesce(CAST({name} AS VARCHAR), '') = '') AS missing,
round(count(*) FILTER (WHERE coalesce(CAST({name} AS VARCHAR), '') = '') / count(*), 6) AS null_rate FROM listing"""
        for name in _RATED
    ),
)
def null_rates(spark, sf_dir):
    return quality.field_null_rates(_listings(spark, sf_dir), _RATED)


@query(
    "extraction_drift",
    f"""{PIECES}, now AS (SELECT p_partkey, title, total_area FROM ({_RAW_SQL}) AS r),
before AS (SELECT p_partkey, title, CASE WHEN p_partkey % 50 = 0 THEN 'moved' ELSE total_area END AS total_area FROM now)
SELECT *, 'now' AS side FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM before) AS a
UNION ALL SELECT *, 'before' AS side FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM now) AS b""",
)
def drift(spark, sf_dir):
    now = _raw(spark, sf_dir).select("p_partkey", "title", "total_area")
    stored = derived(spark, sf_dir, "listing_pieces").selectExpr(
        "p_partkey",
        "'“' || p_name || '”in ' || p_brand AS title",
        "CASE WHEN p_partkey % 50 = 0 THEN 'moved' ELSE CAST(gross AS STRING) || ' m²' END AS total_area",
    )
    return quality.extraction_drift(now, stored)


# --- articles -----------------------------------------------------------------------


def _decoded(text: str) -> str:
    """Character references as HTML reads them: these names need no semicolon."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return f"trim({text})"


def _articles(spark, sf_dir, rules: PageRules = ARTICLE_RULES):
    pages = derived(spark, sf_dir, "pages", heavy=True)
    return pages.select("page_id", "url", read_page("html", rules).alias("page"))


@query("pages_scan", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def pages_scan(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query(
    "page_title",
    f"""SELECT page_id, {_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
  {_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS headline,
  regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang FROM pages""",
)
def page_title(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", "page.title", "page.headline", "page.lang")


_SITES = {
    "example.com": PageRules({"text": Pick("h1"), "lang": Pick("html", attr="lang")}),
    "example.net": PageRules({"text": Pick("title"), "lang": Pick("html", attr="lang")}),
}


@query(
    "site_routing",
    f"""SELECT page_id, CASE WHEN regexp_matches(url, '^[a-z]+://[^/]*example.com') THEN {_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}
  WHEN regexp_matches(url, '^[a-z]+://[^/]*example.net') THEN {_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")} END AS text,
  CASE WHEN regexp_matches(url, '^[a-z]+://[^/]*example.(com|net)') THEN regexp_extract(html, '<html lang="([a-z]*)"', 1) END AS lang FROM pages""",
)
def site_routing(spark, sf_dir):
    pages = derived(spark, sf_dir, "pages", heavy=True)
    read = pages.select("page_id", read_page_of_site("html", "url", _SITES).alias("page"))
    return read.select("page_id", "page.text", "page.lang")


@query(
    "page_image_list",
    """SELECT page_id, nullif(array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ','), '') AS hrefs FROM pages""",
)
def page_hrefs(spark, sf_dir):
    return _articles(spark, sf_dir).select("page_id", F.array_join("page.links", ",").alias("hrefs"))


@query(
    "page_text_list",
    """SELECT page_id, array_to_string(list_filter(regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a>', 1), lambda x: x <> ''), ', ') AS texts
FROM pages""",
)
def page_texts(spark, sf_dir):
    named = F.filter("page.link_texts", lambda text: text != "")
    return _articles(spark, sf_dir).select("page_id", F.array_join(named, ", ").alias("texts"))


# --- link graph ---------------------------------------------------------------------

_LINK_SQL = """links AS (SELECT page_id, url, root || regexp_replace(href, '/+$', '') AS link, pos
  FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root, unnest(hrefs) AS href,
    unnest(range(len(hrefs))) AS pos FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages) AS h) AS x),
edges AS (SELECT page_id, url AS listing_url, link AS detail_url,
  row_number() OVER (PARTITION BY page_id ORDER BY min(pos)) - 1 AS position FROM links GROUP BY page_id, url, link)"""


def _edges(spark, sf_dir, referer: bool = True):
    pages = _articles(spark, sf_dir).select("page_id", "url", F.col("page.links").alias("hrefs"))
    return links.link_edges(pages, referer=referer)


@query("page_links", f"WITH {_LINK_SQL} SELECT listing_url, detail_url, position FROM edges")
def page_links(spark, sf_dir):
    return _edges(spark, sf_dir).select("listing_url", "detail_url", F.col("position").cast("long").alias("position"))


@query("frontier_edges", f"WITH {_LINK_SQL} SELECT detail_url, listing_url AS referer FROM edges")
def frontier_edges(spark, sf_dir):
    return _edges(spark, sf_dir).select("detail_url", "referer")


@query("frontier_edges_no_referer", f"WITH {_LINK_SQL} SELECT detail_url, CAST(NULL AS VARCHAR) AS referer FROM edges")
def frontier_without_referer(spark, sf_dir):
    return _edges(spark, sf_dir, referer=False).select("detail_url", "referer")


@query("pages_without_links", "SELECT url FROM pages WHERE NOT contains(html, '<a href=\"/de\"')")
def pages_without_links(spark, sf_dir):
    rules = PageRules({"hrefs": Pick("nav a[href='/de']", attr="href", many=True)})
    pages = _articles(spark, sf_dir, rules).select("url", "page.hrefs")
    return links.pages_without_links(pages)


@query(
    "crawl_funnel",
    f"""WITH {_LINK_SQL}, known AS (SELECT DISTINCT detail_url FROM edges WHERE page_id % 3 = 0)
SELECT CAST(sum(hits) AS BIGINT) AS discovered, count(*) AS distinct_urls, count(k.detail_url) AS known_urls,
  count(*) - count(k.detail_url) AS new_urls
FROM (SELECT detail_url, count(*) AS hits FROM edges WHERE page_id % 3 <> 0 GROUP BY detail_url) AS d
LEFT JOIN known AS k ON k.detail_url = d.detail_url""",
)
def crawl_funnel(spark, sf_dir):
    pages = _articles(spark, sf_dir).select("page_id", url_parts("url").alias("base"), F.col("page.links").alias("hrefs"))
    linked = pages.select("page_id", F.explode(links.page_link_array(F.col("base"), "hrefs")).alias("detail_url"))
    return links.crawl_funnel(linked, earlier=F.col("page_id") % 3 == 0)


_LISTING_RULES = PageRules({"links": Pick("li a", attr="href", many=True), "next": ARTICLE_RULES.picks["next"]})


def _listing_pages(spark, sf_dir):
    pages = derived(spark, sf_dir, "listing_pages", heavy=True)
    return pages.select("page_id", "url", read_page("html", _LISTING_RULES).alias("page")).select("url", "page.links", "page.next")


def _next_edges(spark, sf_dir):
    return links.next_edges(_listing_pages(spark, sf_dir))


@query("next_links", f"{cte('next_links')} SELECT url, next_url FROM next_links")
def next_links(spark, sf_dir):
    return _next_edges(spark, sf_dir)


def _walk_sql(max_pages: int) -> str:
    return f"""WITH RECURSIVE {cte('next_links', 'crawl_starts').removeprefix('WITH ')},
walk AS (SELECT crawl_id, CAST(1 AS BIGINT) AS page_no, url, [url] AS visited FROM crawl_starts
  UNION ALL SELECT w.crawl_id, w.page_no + 1, n.next_url, list_append(w.visited, n.next_url) FROM walk AS w JOIN next_links AS n ON n.url = w.url
  JOIN next_links AS p ON p.url = n.next_url WHERE w.page_no < {max_pages} AND NOT list_contains(w.visited, n.next_url))"""


@query("page_walk", _walk_sql(1000000000) + " SELECT crawl_id, page_no, url FROM walk")
def page_walk(spark, sf_dir):
    return links.page_walk(derived(spark, sf_dir, "crawl_starts"), _next_edges(spark, sf_dir))


@query("page_walk_max_pages", _walk_sql(7) + " SELECT crawl_id, page_no, url FROM walk")
def page_walk_max_pages(spark, sf_dir):
    return links.page_walk(derived(spark, sf_dir, "crawl_starts"), _next_edges(spark, sf_dir), max_pages=7)


@query(
    "walk_summary",
    _walk_sql(1000000000)
    + """ SELECT w.crawl_id, w.page_no AS pages, n.next_url IS NULL AS pages_exhausted
FROM walk AS w JOIN next_links AS n ON n.url = w.url
WHERE w.page_no = (SELECT max(page_no) FROM walk AS x WHERE x.crawl_id = w.crawl_id)""",
)
def walk_summary(spark, sf_dir):
    nexts = written(_next_edges(spark, sf_dir))
    return links.walk_summary(links.page_walk(derived(spark, sf_dir, "crawl_starts"), nexts), nexts)


_FRONTIER_SQL = f""", spots AS (SELECT section AS crawl_id, n + 1 AS page_no, list_url || '?page=' || CAST(n AS VARCHAR) AS referer,
  '{HOST}' || regexp_replace(href, '/+$', '') AS detail_url, pos
  FROM (SELECT section, n, list_url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos
    FROM (SELECT section, n, list_url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM paged) AS h) AS x),
frontier AS (SELECT crawl_id, page_no, row_number() OVER (PARTITION BY crawl_id, page_no ORDER BY min(pos)) - 1 AS position, detail_url, referer
  FROM spots GROUP BY crawl_id, page_no, detail_url, referer)"""


def _listing_edges(pages):
    return links.link_edges(pages.select(canonical_url("url").alias("url"), F.col("links").alias("hrefs")))


@query(
    "walk_enqueued",
    _walk_sql(1000000000)
    + _FRONTIER_SQL
    + """, counts AS (SELECT crawl_id, page_no, count(*) AS links FROM frontier GROUP BY crawl_id, page_no)
SELECT w.crawl_id, max(w.page_no) AS pages, bool_or(n.next_url IS NULL) AS pages_exhausted,
  CAST(sum(coalesce(c.links, 0)) AS BIGINT) AS enqueued
FROM walk AS w JOIN next_links AS n ON n.url = w.url
LEFT JOIN counts AS c ON c.crawl_id = w.crawl_id AND c.page_no = w.page_no GROUP BY w.crawl_id""",
)
def walk_enqueued(spark, sf_dir):
    pages = written(_listing_pages(spark, sf_dir))
    nexts = links.next_edges(pages)
    walk = links.page_walk(derived(spark, sf_dir, "crawl_starts"), nexts)
    return links.walk_summary(walk, nexts, _listing_edges(pages))


@query(
    "crawl_frontier",
    _walk_sql(1000000000)
    + _FRONTIER_SQL
    + """ SELECT f.* FROM frontier AS f JOIN walk AS w ON w.crawl_id = f.crawl_id AND w.page_no = f.page_no""",
)
def crawl_frontier(spark, sf_dir):
    """Listing pages to the links of all pages a crawl reaches by their next links, in its order."""
    pages = written(_listing_pages(spark, sf_dir))
    walk = links.page_walk(derived(spark, sf_dir, "crawl_starts"), links.next_edges(pages))
    frontier = links.crawl_frontier(walk, _listing_edges(pages))
    return frontier.withColumn("position", F.col("position").cast("long"))


# --- the whole way: pages to a clean, deduplicated table -----------------------------


@query(
    "crawl_to_table",
    f"""WITH canon AS ({sql_canonical('pages', 'page_id, html', 'url')}),
titled AS (SELECT page_id, canonical AS url, {sql_clean(_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))} AS title FROM canon)
SELECT url, title, title IS NOT NULL AS is_valid FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM titled) AS t
WHERE n = 1""",
)
def crawl_to_table(spark, sf_dir):
    """Pages to canonical URL, headline, cleaned title, validation, first page per URL."""
    rules = PageRules({"headline": Pick("h1")})
    pages = derived(spark, sf_dir, "pages", heavy=True).select(
        "page_id", canonical_url("url").alias("url"), read_page("html", rules).alias("page")
    )
    titled = pages.select("page_id", "url", tx.clean_text("page.headline").alias("title"))
    first = dedup_keep_first(titled, "url", ["page_id"])
    checked = first.withColumn("errors", quality.missing_fields(("url", "title")))
    return checked.select("url", "title", (F.size("errors") == 0).alias("is_valid"))
