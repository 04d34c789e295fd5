"""Crawl-shaped inputs derived from the driver's tables.

The listed tables hold no crawl, so each input is a projection of one of them,
written as SQL that Spark and the checking engine both read. ``CTE`` gives the
same input to the check; only the two dialects' time functions differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanframe.sources.readers import spread

HOST = "https://site.example"
FIRST_RUN = 199607  # ids seen before this month are the known ids
SECTION_PAGES = 12  # listing pages chained by next links


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- prices in eight spellings, and listing pages built around them -----------------

_MONEY = """SELECT *, CAST(floor(p_retailprice) AS STRING) AS hi,
  lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') AS lo,
  lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS STRING), 2, '0') AS cents
FROM (SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(floor(p_retailprice) AS BIGINT) AS whole, p_retailprice FROM part)"""
_MONEY = _MONEY.replace("CAST(floor(p_retailprice) AS STRING)", "CAST(whole AS STRING)")

RAW_PRICE = f"""SELECT p_partkey, p_name, p_brand, p_type, p_size, CASE p_partkey % 8
  WHEN 0 THEN '€ ' || hi || '.' || lo || ',' || cents
  WHEN 1 THEN hi || ',' || lo || '.' || cents || ' $'
  WHEN 2 THEN '£' || hi || ',' || lo
  WHEN 3 THEN hi || '.' || lo || ' all'
  WHEN 4 THEN '€' || hi || ',' || substr(cents, 1, 1)
  WHEN 5 THEN '1.' || lo || '.' || cents
  WHEN 6 THEN 'Call us' END AS raw
FROM ({_MONEY}) AS m"""

# pieces of a listing page; the same pieces are what the check expects back
_PIECES = """SELECT *,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'C-' || CAST(p_partkey AS STRING) END AS pid,
  p_size * 10 AS gross, p_size * 8 AS inner_area, p_size % 5 AS beds, p_size % 9 AS floor_no,
  p_size % 4 AS n_images, p_size % 3 AS n_extras,
  CASE WHEN p_partkey % 3 = 0 THEN 'Featured' ELSE 'Used' END AS status_text,
  CASE p_partkey % 5 WHEN 0 THEN 'Po' WHEN 1 THEN 'JO' WHEN 2 THEN 'yes' WHEN 3 THEN 'on request' END AS yn
FROM raw_price"""

_HTML = """
'<!DOCTYPE html><html><head><title>x</title>'
|| CASE WHEN pid IS NOT NULL AND p_partkey % 2 = 1 THEN '<meta name="crm-id" content=" ' || pid || ' ">' ELSE '' END
|| '<script>if (a < b) say("<h1>")</script></head><body>'
|| CASE WHEN pid IS NOT NULL AND p_partkey % 2 = 0 THEN '<h6 class="font-semibold x text-black-custom font-barlow">ID: <span class="text-gold-shade-55">' || pid || '</span></h6>' ELSE '' END
|| '<h1 class="big">no</h1><h1 class="font-extrabold"> “' || p_name || '” <b> in ' || p_brand || '</b></h1>'
|| CASE WHEN raw IS NULL THEN '' ELSE '<h2 class="text-gold-shade-55 font-bold">' || raw || '</h2>' END
|| '<div class="flex gap-1"><p>near</p><h6>' || p_type || ',  Zone&nbsp;' || CAST(p_size AS STRING) || '</h6></div>'
|| '<p class="paragraph-2 text-grey-shade-40">' || p_name || ' &amp; more<br>😀 of ' || p_type || '</p>'
|| '<div class="grid grid-cols-4 gap-2">'
|| CASE WHEN n_images > 0 THEN '<a href="/i/' || CAST(p_partkey AS STRING) || '/1.jpg"><img src="t"></a><a>none</a>' ELSE '' END
|| CASE WHEN n_images > 1 THEN '<a href="/i/é2.jpg">2</a>' ELSE '' END || '</div>'
|| '<div class="grid xl:grid-cols-5 font-oakes">'
|| '<div><p>Gross Area:&nbsp;<span>' || CAST(gross AS STRING) || ' m²</span></p></div>'
|| '<div><div><p>Interior area <span>' || CAST(inner_area AS STRING) || ',5 m²</span></p></div></div>'
|| '<div><p><b>Bedrooms</b>: <span>' || CAST(beds AS STRING) || '</span></p><p>Floor: <span>99</span></p></div>'
|| '<div><p>Floor: <span>77</span></p></div><div><p>Floor: <span>' || CAST(floor_no AS STRING) || '</span></p></div>'
|| '<div><p>Status <span>' || status_text || '</span></p></div><div><p>Type: <span>' || p_type || '</span></p></div>'
|| CASE WHEN p_partkey % 4 = 0 THEN '<div><p>Not Furnished</p></div>' WHEN p_partkey % 4 = 1 THEN '<div><p>Furnished: <span></span></p></div>' ELSE '' END
|| CASE WHEN p_partkey % 7 = 0 THEN '<div><p>Certificate: <span>Mortgage: po</span></p></div>' ELSE '' END
|| '</div><div class="lg:grid-cols-3 font-oakes">'
|| CASE WHEN yn IS NULL THEN '' ELSE '<div><p>Elevator: ' || yn || '</p></div>' END
|| '<div><p>Bathrooms: 9</p></div><div><p>Bath: ' || CAST(beds + 1 AS STRING) || '</p></div>'
|| '<div><p>Furnishing: partly</p></div><div><p>fully furnished</p></div><div><p>Mortgage: jo</p></div></div>'
|| '<div class="grid-cols-3 md:grid-cols-5"><div><p>Lift</p></div>'
|| CASE WHEN n_extras > 0 THEN '<div><p> </p></div><div><span>no</span></div><div><p>Pool &lt;3</p></div>' ELSE '' END
|| CASE WHEN n_extras > 1 THEN '<div><p>Gar<i>den</i></p></div>' ELSE '' END
|| '</div></body></html>'"""

LISTING_HTML = f"SELECT *, {_HTML} AS html, '{HOST}/p/' || CAST(p_partkey AS STRING) AS url FROM listing_pieces"

# --- runs of listing ids, from orders ----------------------------------------------

_RUN_ID = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)"
_ITEMS = f"""SELECT {_RUN_ID} AS run_id, o_orderdate, o_orderkey,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS property_id
FROM orders"""
ALL_ITEMS = f"SELECT * FROM ({_ITEMS}) AS i"
RUN_ITEMS = f"SELECT * FROM ({_ITEMS}) AS i WHERE run_id >= {FIRST_RUN}"
KNOWN_IDS = f"SELECT DISTINCT property_id FROM ({_ITEMS}) AS i WHERE run_id < {FIRST_RUN} AND property_id IS NOT NULL"
RUN_ORDER = ["o_orderdate", "o_orderkey"]

RUNS = f"""SELECT site, run_id, n % 2 = 0 AS stream_exhausted, n % 3 <> 0 AS pages_exhausted,
  n % 5 < 3 AS early_stop, CASE WHEN n % 4 = 0 THEN n % 7 ELSE 0 END AS errors
FROM (SELECT o_orderpriority AS site, {_RUN_ID} AS run_id, count(*) AS n FROM orders GROUP BY 1, 2) AS g"""

# --- request log, from events ------------------------------------------------------

_LOG = f"""SELECT event_id AS seq, t_us, t_us / 1e6 AS t, user_id % 20 AS host, event_type, value, k,
  '{HOST}/item/' || CAST(user_id AS STRING) AS url, event_id % 4 AS worker_id, value AS duration_secs,
  CASE WHEN event_id % 3 = 0 THEN 'retry' ELSE 'crawl' END AS phase,
  CAST(CASE WHEN event_type = 'signup' THEN 429 WHEN event_type <> 'error' THEN 200
    WHEN k % 6 = 0 THEN 503 WHEN k % 6 = 2 THEN 404 END AS INT) AS status
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, {{micros}} AS t_us FROM events) AS e"""
REQUEST_LOG = f"""SELECT *, error IS NOT NULL AS failed,
  CASE WHEN error IS NULL THEN 'success' WHEN status IN (429, 503) THEN 'rate_limited' ELSE 'error' END AS outcome
FROM (SELECT *, CASE WHEN status IN (429, 503, 404) THEN 'HTTP ' || CAST(status AS STRING) || ' for ' || url
  WHEN event_type <> 'error' THEN NULL WHEN k % 6 = 1 THEN 'Timeout 30000ms exceeded for ' || url
  WHEN k % 6 = 3 THEN 'Page.goto: Target closed' WHEN k % 6 = 4 THEN 'ParseError: bad grid'
  ELSE 'Connection reset by peer' END AS error FROM ({_LOG}) AS l) AS m"""
LOG_ORDER = ["t_us", "seq"]
_MICROS = {
    "spark": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)",
    "check": "epoch_us(ts)",
}

# what a retry of each logged URL gave, and the ids exported before it
RETRY_RESULTS = """SELECT url, CASE WHEN n % 7 = 0 THEN NULL ELSE 'C-' || CAST(n % 50 AS STRING) END AS property_id,
  CASE n % 5 WHEN 1 THEN 'Timeout 30000ms exceeded' WHEN 2 THEN 'HTTP 404 for ' || url END AS error, n % 11 <> 0 AS tried
FROM (SELECT DISTINCT url, CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) AS n FROM request_log) AS u"""
RETRY_KNOWN = "SELECT 'C-' || CAST(n_nationkey AS STRING) AS property_id FROM nation WHERE n_nationkey % 2 = 0"

# --- attempts of requests, from lineitem -------------------------------------------

NOW = 1445410800.0  # 2015-10-21 07:00:00 UTC, the reference time of the headers
ATTEMPTS = """SELECT l_orderkey AS request_id, l_linenumber AS attempt,
  CAST(CASE sup % 9 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 500 WHEN 4 THEN 404
    WHEN 5 THEN 418 WHEN 6 THEN 429 WHEN 7 THEN 502 ELSE 403 END AS INT) AS status,
  CASE part_key % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(sup AS STRING) WHEN 2 THEN '3.5' WHEN 3 THEN 'soon'
    ELSE 'Wed, 21 Oct 2015 0' || CAST(6 + part_key % 3 AS STRING) || ':' || lpad(CAST(part_key % 60 AS STRING), 2, '0') || ':00 GMT' END AS retry_after
FROM (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS sup, max(l_partkey) AS part_key FROM lineitem
      GROUP BY l_orderkey, l_linenumber) AS a"""

# --- URLs in many spellings, from pages and events ---------------------------------

RAW_URLS = """SELECT page_id AS id, url FROM pages
UNION ALL SELECT 1000000000 + event_id AS id, CASE event_id % 5
  WHEN 0 THEN ' HTTP://Site' || CAST(user_id AS STRING) || '.Example:80/Item/' || event_type || '//?utm_source=' || event_type || '&b=' || CAST(event_id AS STRING) || '&a=x%20' || event_type || '&c=#f'
  WHEN 1 THEN 'https://a.example:443?REF=1&q=a+' || event_type || '&q=%C3%A9*~'
  WHEN 2 THEN 'https://a.example:8443/' || event_type || '/'
  WHEN 3 THEN 'https://a.example/x?b&=' || event_type || '&_ga=2&z=1&a=' || CAST(user_id AS STRING)
  ELSE '/relative/' || event_type || '?x=' || CAST(user_id AS STRING) || '#top' END AS url
FROM events"""

# --- state table and merge batch, from customer, supplier and orders ---------------

STATE = """SELECT CASE WHEN c_custkey % 5 = 0 THEN 'run:' ELSE 'exported:' END || CAST(c_custkey AS STRING) AS key,
  '"' || c_mktsegment || '"' AS value_json, CAST(c_custkey AS BIGINT) AS updated_at FROM customer"""
STATE_CHANGES = """SELECT CASE WHEN o_custkey % 5 = 0 THEN 'run:' ELSE 'exported:' END || CAST(o_custkey * 2 AS STRING) AS key,
  '"' || o_orderpriority || '"' AS value_json, 1000000000 + o_orderkey AS updated_at FROM orders"""

STORED = """SELECT CAST(c_custkey AS STRING) AS property_id, c_name AS title, c_acctbal AS price,
  c_mktsegment AS location, CAST(c_nationkey AS STRING) AS floor, CAST(100 AS BIGINT) AS scraped_at FROM customer"""
MERGE_BATCH = """SELECT CAST(o_custkey + 50 AS STRING) AS property_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS title,
  o_totalprice AS price, CAST(NULL AS STRING) AS location, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS floor,
  o_orderkey AS seq FROM orders"""
MERGE_COLUMNS = ["property_id", "title", "price", "location", "floor"]

# --- pagination, from pages ---------------------------------------------------------

# fetched pages in sections, each with a next link in its HTML: spelled in six ways, leading to a
# page that was not fetched, back to the first page, nowhere (no address), or missing
_PAGED = f"""SELECT p.*, CAST(floor(page_id / {SECTION_PAGES}) AS BIGINT) AS section, page_id % {SECTION_PAGES} AS n,
  '{HOST}/list/' || CAST(CAST(floor(page_id / {SECTION_PAGES}) AS BIGINT) AS STRING) AS list_url,
  page_id % {SECTION_PAGES} = {SECTION_PAGES} - 1 OR page_id = (SELECT max(page_id) FROM pages) AS is_last,
  CAST(page_id % {SECTION_PAGES} + 1 AS STRING) AS following, CAST(CAST(floor(page_id / {SECTION_PAGES}) AS BIGINT) AS STRING) AS name
FROM pages AS p"""
LISTING_PAGES = f"""SELECT page_id, section, n,
  CASE n % 3 WHEN 0 THEN list_url || '?page=' || CAST(n AS STRING) WHEN 1 THEN list_url || '?utm_source=feed&page=' || CAST(n AS STRING)
    ELSE replace(list_url, 'https://site', 'HTTPS://Site') || '?page=' || CAST(n AS STRING) || '#top' END AS url,
  replace(html, '<nav>', '<!-- <a rel="next" href="/no"> --><a rel="next nofollow" href="/no">x</a><nav>'
    || CASE WHEN is_last AND section % 3 = 1 THEN '<a rel="prev" href="/no">x</a>' WHEN is_last AND section % 3 = 2 THEN '<a rel="next">x</a>'
      WHEN is_last THEN '<a href="?page=0" rel=next>x</a>' WHEN page_id % 119 = 17 THEN '<a rel="next" href="/gone">x</a>'
      ELSE '<a rel="next" href="' || CASE page_id % 6 WHEN 0 THEN '?page=' || following WHEN 1 THEN '/list/' || name || '?page=' || following
        WHEN 2 THEN 'https://SITE.example:443/list/' || name || '/?ref=x&amp;page=' || following
        WHEN 3 THEN '//site.example/list/' || name || '?page=' || following || '#top'
        WHEN 4 THEN '../list/' || name || '?page=' || following ELSE './' || name || '?page=' || following END || '">x</a>' END) AS html
FROM paged"""
# what the check expects those links to be
NEXT_LINKS = f"""SELECT list_url || '?page=' || CAST(n AS STRING) AS url, CASE WHEN is_last AND section % 3 = 1 THEN NULL
  WHEN is_last AND section % 3 = 2 THEN list_url || '?page=' || CAST(n AS STRING) WHEN is_last THEN list_url || '?page=0'
  WHEN page_id % 119 = 17 THEN '{HOST}/gone' ELSE list_url || '?page=' || following END AS next_url FROM paged"""
CRAWL_STARTS = "SELECT section AS crawl_id, list_url || '?page=0' AS url FROM paged WHERE n = 0"

# --- pages with an id, from pages: the number in their address; a twelfth of the ids is new ----

CRAWL_PAGES = """SELECT page_id, url, replace(html, '<meta charset="utf-8">', '<meta charset="utf-8"><meta name="crm-id" content="' || number || '">') AS html,
  number AS property_id FROM (SELECT *, regexp_extract(url, '/([0-9]+)', 1) AS number FROM pages) AS p"""
CRAWL_KNOWN = """SELECT DISTINCT property_id FROM (SELECT regexp_extract(url, '/([0-9]+)', 1) AS property_id FROM pages) AS p
WHERE property_id <> '' AND CAST(property_id AS BIGINT) % 12 <> 0"""

_DERIVED = {
    "raw_price": (RAW_PRICE, ("part",)),
    "listing_pieces": (_PIECES, ("raw_price",)),
    "listing_html": (LISTING_HTML, ("listing_pieces",)),
    "all_items": (ALL_ITEMS, ("orders",)),
    "run_items": (RUN_ITEMS, ("orders",)),
    "known_ids": (KNOWN_IDS, ("orders",)),
    "runs": (RUNS, ("orders",)),
    "request_log": (REQUEST_LOG, ("events",)),
    "retry_results": (RETRY_RESULTS, ("request_log",)),
    "retry_known": (RETRY_KNOWN, ("nation",)),
    "attempts": (ATTEMPTS, ("lineitem",)),
    "raw_urls": (RAW_URLS, ("pages", "events")),
    "state": (STATE, ("customer",)),
    "state_changes": (STATE_CHANGES, ("orders",)),
    "stored": (STORED, ("customer",)),
    "merge_batch": (MERGE_BATCH, ("orders",)),
    "crawl_pages": (CRAWL_PAGES, ("pages",)),
    "crawl_known": (CRAWL_KNOWN, ("pages",)),
    "paged": (_PAGED, ("pages",)),
    "listing_pages": (LISTING_PAGES, ("paged",)),
    "next_links": (NEXT_LINKS, ("paged",)),
    "crawl_starts": (CRAWL_STARTS, ("paged",)),
}


def derived(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """The derived input; ``heavy`` spreads its tables over all cores first."""
    if name not in _DERIVED:
        return spread(table(spark, sf_dir, name)) if heavy else table(spark, sf_dir, name)
    text, sources = _DERIVED[name]
    frames = {source: derived(spark, sf_dir, source, heavy) for source in sources}
    body = text.replace("{micros}", _MICROS["spark"])
    for source in sources:
        body = _bind(body, source)
    return spark.sql(body, **frames)


def _bind(text: str, source: str) -> str:
    """Make ``FROM source`` a named argument of ``spark.sql``."""
    for before in ("FROM ", "JOIN "):
        for after in (" ", ")", "\n"):
            text = text.replace(f"{before}{source}{after}", f"{before}{{{source}}}{after}")
        if text.endswith(before + source):
            text = text[: -len(source)] + f"{{{source}}}"
    return text


def cte(*names: str) -> str:
    """``WITH`` clause defining the derived inputs for the check, in order of need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in _DERIVED and name not in ordered:
            for source in _DERIVED[name][1]:
                need(source)
            ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{name} AS ({_DERIVED[name][0].replace('{micros}', _MICROS['check'])})" for name in ordered]
    return "WITH " + ",\n".join(parts)
