"""Queries over scalar functions: text, numbers, prices, URLs, request outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanframe.functions import net, text as tx, url as urls
from gleanframe.plans.inputs import NOW, cte, derived, table
from gleanframe.plans.registry import query

# --- pieces of checking SQL ---------------------------------------------------------

_SPACE, _EMOJI = tx.SPACE_CLASS, tx.EMOJI_CLASS


def sql_list(values) -> str:
    return ", ".join("'" + str(value).replace("'", "''") + "'" for value in values)


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def sql_clean(text: str) -> str:
    quotes = tx.QUOTE_MARKS.replace("'", "''")
    spaced = f"regexp_replace(regexp_replace({text}, '{_EMOJI}+', '', 'g'), '{_SPACE}+', ' ', 'g')"
    return f"nullif(trim(trim({spaced}, ' '), '{quotes}'), '')"


def sql_number(text: str) -> str:
    return f"replace(nullif(regexp_extract({text}, '[0-9]+(?:[.,][0-9]+)?'), ''), ',', '.')"


def sql_price(raw: str) -> str:
    k = f"regexp_replace({raw}, '[^0-9.,]', '', 'g')"
    return f"""TRY_CAST(CASE
  WHEN contains({k}, '.') AND contains({k}, ',') THEN CASE WHEN strpos({k}, '.') < strpos({k}, ',')
    THEN replace(replace({k}, '.', ''), ',', '.') ELSE replace({k}, ',', '') END
  WHEN contains({k}, ',') THEN CASE WHEN regexp_matches({k}, ',[0-9]{{3}}$') THEN replace({k}, ',', '') ELSE replace({k}, ',', '.') END
  WHEN regexp_matches({k}, '\\.[0-9]{{3}}$') THEN replace({k}, '.', '') ELSE {k} END AS DOUBLE)"""


def sql_currency(raw: str) -> str:
    return f"""CASE WHEN contains({raw}, '€') THEN 'EUR' WHEN contains({raw}, '$') THEN 'USD'
  WHEN contains({raw}, '£') THEN 'GBP' WHEN contains(upper({raw}), 'ALL') THEN 'ALL' END"""


def sql_status(text: str) -> str:
    return f"CASE WHEN lower({sql_clean(text)}) NOT IN ({sql_list(tx.PROMO_LABELS)}) THEN {sql_clean(text)} END"


def sql_yes_no(text: str) -> str:
    v = sql_strip(text)
    answer = f"CASE WHEN contains({v}, ':') THEN {sql_strip(f'substr({v}, strpos({v}, chr(58)) + 1)')} ELSE {v} END"
    return f"""CASE WHEN nullif({text}, '') IS NULL THEN NULL WHEN lower({answer}) IN ('po', 'yes') THEN 'Yes'
  WHEN lower({answer}) IN ('jo', 'no') THEN 'No' ELSE {answer} END"""


def sql_retryable(error: str) -> str:
    return (
        f"NOT regexp_matches(lower({error}), '{'|'.join(net.PERMANENT_FRAGMENTS)}') "
        f"AND regexp_matches(lower({error}), '{'|'.join(net.TRANSIENT_FRAGMENTS)}')"
    )


def sql_canonical(source: str, id_column: str, url: str) -> str:
    """A query giving ``id_column`` and ``canonical`` for each row of ``source``."""
    decode = lambda token: f"url_decode(replace({token}, '+', ' '))"
    encode = lambda token: f"replace(url_encode({token}), '%20', '+')"
    return f"""SELECT {id_column}, CASE WHEN text = '' THEN raw ELSE
    CASE WHEN scheme <> '' THEN scheme || ':' ELSE '' END
    || CASE WHEN host <> '' THEN '//' || host ELSE '' END || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN len(pairs) = 0 THEN '' ELSE '?' || array_to_string(list_transform(pairs,
         lambda p: {encode('p.k')} || '=' || {encode('p.v')}), '&') END END AS canonical
FROM (SELECT {id_column}, raw, text, scheme,
    CASE scheme WHEN 'http' THEN regexp_replace(host, ':0*80$', '') WHEN 'https' THEN regexp_replace(host, ':0*443$', '') ELSE host END AS host,
    regexp_replace(path, '/+$', '') AS path,
    list_sort(list_filter(list_transform(list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '^[^=]*=.')),
      lambda x: {{'k': {decode("split_part(x, '=', 1)")}, 'v': {decode("substr(x, strpos(x, '=') + 1)")}}}),
      lambda x: lower(x.k) NOT IN ({sql_list(urls.TRACKING_PARAMS)}))) AS pairs
  FROM (SELECT {id_column}, raw, text, lower(regexp_extract(text, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
      lower(regexp_extract(text, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host,
      regexp_extract(text, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
      regexp_extract(text, '^[^?#]*\\?([^#]*)', 1) AS q
    FROM (SELECT {id_column}, {url} AS raw, {sql_strip(url)} AS text FROM {source}) AS s0) AS s1) AS s2"""


# --- text and numbers ---------------------------------------------------------------


@query("clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return derived(spark, sf_dir, "documents", heavy=True).select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("first_number", f"SELECT doc_id, {sql_number('text')} AS number FROM documents")
def first_number(spark, sf_dir):
    return derived(spark, sf_dir, "documents", heavy=True).select("doc_id", tx.first_number("text").alias("number"))


@query("parse_price", f"{cte('raw_price')} SELECT p_partkey, raw, {sql_price('raw')} AS price FROM raw_price")
def parse_price(spark, sf_dir):
    return derived(spark, sf_dir, "raw_price").select("p_partkey", "raw", tx.parse_price("raw").alias("price"))


@query(
    "price_currency",
    f"""{cte('raw_price')} SELECT 'part' AS origin, p_partkey AS id, {sql_currency('raw')} AS currency FROM raw_price
UNION ALL SELECT 'document' AS origin, doc_id AS id, {sql_currency('text')} AS currency FROM documents""",
)
def price_currency(spark, sf_dir):
    parts = derived(spark, sf_dir, "raw_price").select(
        F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), tx.price_currency("raw").alias("currency")
    )
    texts = derived(spark, sf_dir, "documents", heavy=True).select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), tx.price_currency("text").alias("currency")
    )
    return parts.unionByName(texts)


_STATUS_TEXT = "CASE p_partkey % 4 WHEN 0 THEN ' “Featured” ' WHEN 1 THEN 'Recent  Listings' WHEN 2 THEN p_type ELSE '😀' END"


@query(
    "status_filter",
    f"SELECT p_partkey, {sql_status('v')} AS status FROM (SELECT p_partkey, {_STATUS_TEXT} AS v FROM part) AS s",
)
def status_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_STATUS_TEXT} AS v")
    return rows.select("p_partkey", tx.listing_status("v").alias("status"))


_YES_TEXT = """CASE p_partkey % 8 WHEN 0 THEN 'Po' WHEN 1 THEN ' JO ' WHEN 2 THEN 'Elevator: yes' WHEN 3 THEN 'X:'
  WHEN 4 THEN 'No: no: ' || p_name WHEN 5 THEN '' WHEN 6 THEN NULL ELSE p_name END"""


@query(
    "yes_no",
    f"SELECT p_partkey, {sql_yes_no('v')} AS answer FROM (SELECT p_partkey, {_YES_TEXT} AS v FROM part) AS s",
)
def yes_no(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_YES_TEXT} AS v")
    return rows.select("p_partkey", tx.yes_no("v").alias("answer"))


# --- URLs ---------------------------------------------------------------------------


@query("canonical_url", f"{cte('raw_urls')} {sql_canonical('raw_urls', 'id', 'url')}")
def canonical_url(spark, sf_dir):
    return derived(spark, sf_dir, "raw_urls", heavy=True).select("id", urls.canonical_url("url").alias("canonical"))


@query(
    "site_filter",
    """SELECT page_id, contains(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), 'example.com') AS on_site FROM pages""",
)
def site_filter(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.site_matches("url", "example.com").alias("on_site"))


# --- request outcomes ---------------------------------------------------------------


@query(
    "error_class",
    f"""{cte('request_log')} SELECT seq, {sql_retryable('error')} AS retryable,
  regexp_matches(error, '{'|'.join(net.DEAD_BROWSER_PHRASES)}') AS browser_dead FROM request_log WHERE failed""",
)
def error_class(spark, sf_dir):
    failures = derived(spark, sf_dir, "request_log").filter("failed")
    return failures.select(
        "seq", net.is_retryable("error").alias("retryable"), net.is_browser_death("error").alias("browser_dead")
    )


@query(
    "status_retryable",
    f"""{cte('attempts')} SELECT request_id, attempt, status, status NOT IN ({', '.join(map(str, net.PERMANENT_STATUS))})
  AND status IN ({', '.join(map(str, net.TRANSIENT_STATUS))}) AS retryable FROM attempts""",
)
def status_retryable(spark, sf_dir):
    rows = derived(spark, sf_dir, "attempts")
    return rows.select("request_id", "attempt", "status", net.should_retry_status("status").alias("retryable"))


@query(
    "http_outcome",
    f"""{cte('attempts')} SELECT request_id, attempt, CASE WHEN status IN (429, 503) THEN 'rate_limited'
  WHEN status >= 400 THEN 'error' ELSE 'success' END AS outcome FROM attempts""",
)
def http_outcome(spark, sf_dir):
    rows = derived(spark, sf_dir, "attempts")
    return rows.select("request_id", "attempt", net.http_outcome("status").alias("outcome"))


SQL_RETRY_AFTER = f"""coalesce(TRY_CAST(retry_after AS DOUBLE), greatest(0.0, epoch(TRY_STRPTIME(
  regexp_extract(retry_after, '([0-9]+ [A-Za-z]{{3}} [0-9]{{4}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})', 1), '%d %b %Y %H:%M:%S')) - {NOW}))"""
# greatest skips nulls: an unreadable date must stay null
SQL_RETRY_AFTER = f"CASE WHEN retry_after = 'soon' THEN NULL ELSE {SQL_RETRY_AFTER} END"
SQL_RETRY_AFTER = f"CASE WHEN retry_after IS NOT NULL THEN {SQL_RETRY_AFTER} END"


@query("retry_after", f"{cte('attempts')} SELECT request_id, attempt, {SQL_RETRY_AFTER} AS wait_secs FROM attempts")
def retry_after(spark, sf_dir):
    rows = derived(spark, sf_dir, "attempts")
    return rows.select("request_id", "attempt", net.parse_retry_after("retry_after", NOW).alias("wait_secs"))


@query(
    "backoff_delay",
    f"""{cte('attempts')} SELECT request_id, attempt,
  coalesce({SQL_RETRY_AFTER}, least(pow(2.0, attempt - 1), 20.0)) AS delay_secs FROM attempts""",
)
def backoff_delay(spark, sf_dir):
    header = net.parse_retry_after("retry_after", NOW)
    delay = net.backoff_delay(F.col("attempt") - 1, header, max_delay=20.0)
    return derived(spark, sf_dir, "attempts").select("request_id", "attempt", delay.alias("delay_secs"))


@query(
    "metric_key",
    f"""{cte('request_log')} SELECT seq, CASE WHEN k % 10 = 0 THEN event_type ELSE
  event_type || '{{host=' || CAST(host AS VARCHAR) || ',phase=' || phase || '}}' END AS metric FROM request_log""",
)
def metric_key(spark, sf_dir):
    labels = F.when(
        F.col("k") % 10 != 0,
        F.create_map(F.lit("phase"), F.col("phase"), F.lit("host"), F.col("host").cast("string")),
    )
    rows = derived(spark, sf_dir, "request_log").withColumn("labels", labels)
    return rows.select("seq", net.metric_key("event_type", "labels").alias("metric"))
