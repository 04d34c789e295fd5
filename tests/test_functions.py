"""Scalar rules on literal rows, expected values worked out by hand."""

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gleanframe.functions import net, text as tx, url as urls


def test_clean_text(apply):
    given = ["  a \n b ", "“x”", '" y "', "😀", "\xa0a b\x1f", "", None, "'q’"]
    assert apply(given, tx.clean_text) == ["a b", "x", " y ", None, "a b", None, None, "q"]


def test_first_number(apply):
    assert apply(["255 m²", "3,5", "1,200 m²", "n/a", None], tx.first_number) == ["255", "3.5", "1.200", None, None]


PRICES = {
    "150,000 €": 150000.0, "€ 1.250,50": 1250.5, "1,250.50": 1250.5, "92,000": 92000.0, "92.000": 92000.0,
    "92,5": 92.5, "92.50": 92.5, "1.250.000": 1250000.0, "12.345,678": 12345.678, "0,123": 123.0, "500.": 500.0,
    "€ 500 / month 2": 5002.0, "1.250.00": None, "1,250,00": None, ".": None, "Call": None, "": None, None: None,
}


def test_parse_price(apply):
    assert apply(list(PRICES), tx.parse_price) == list(PRICES.values())


def plain_price(raw):
    """The price rule once more, in plain Python."""
    kept = "".join(c for c in raw if c in "0123456789.,")
    dot, comma = kept.find("."), kept.find(",")
    if dot >= 0 and comma >= 0:
        kept = kept.replace(".", "").replace(",", ".") if dot < comma else kept.replace(",", "")
    elif max(dot, comma) >= 0:
        sign = "." if dot >= 0 else ","
        grouped = len(kept.rsplit(sign, 1)[1]) == 3
        kept = kept.replace(sign, "" if grouped else ".")
    try:
        return float(kept)
    except ValueError:
        return None


def test_parse_price_random(apply):
    draw = random.Random(1)
    given = ["".join(draw.choices("0123456789.,€ ", k=draw.randint(1, 9))) for _ in range(400)]
    assert apply(given, tx.parse_price) == [plain_price(raw) for raw in given]


def test_price_currency(apply):
    given = ["€ $", "$1", "£1", "100 all", "Call us", "100", None]
    assert apply(given, tx.price_currency) == ["EUR", "USD", "GBP", "ALL", "ALL", None, None]


def test_listing_status(apply):
    assert apply(["Featured", "Used", " “recent  listings”", None], tx.listing_status) == [None, "Used", None, None]


def test_yes_no(apply):
    given = ["Po", "PO", "Jo", "JO", "Elevator: yes", "X:", "maybe", None, "", "  ", "a: b: no"]
    assert apply(given, tx.yes_no) == ["Yes", "Yes", "No", "No", "Yes", "", "maybe", None, None, "", "b: no"]


URLS = {
    "HTTP://A.com:80/x//?utm_source=g&b=2&a=1&c=#f": "http://a.com/x?a=1&b=2",
    "https://a.com": "https://a.com/",
    "https://a.com:8443/": "https://a.com:8443/",
    "https://a.com:0443/x": "https://a.com/x",
    "http://a.com:443/x": "http://a.com:443/x",
    "https://a.com/?REF=1&q=a%20b": "https://a.com/?q=a+b",
    "https://a.com/p?x=~*a+b&y=%zz&=3&d": "https://a.com/p?=3&x=~%2Aa+b&y=%25zz",
    "https://a.com/?q=b&q=a&Q=1": "https://a.com/?Q=1&q=a&q=b",
    "http://[::1]:80/x": "http://[::1]/x",
    "http://[::1/x": "http://[::1/x",
    "": "",
    "  ": "  ",
    None: None,
}


def test_canonical_url(apply):
    assert apply(list(URLS), urls.canonical_url) == list(URLS.values())


def test_canonical_url_is_stable(apply):
    once = apply(list(URLS), urls.canonical_url)
    assert apply(once, urls.canonical_url) == once


def test_resolve_link(apply):
    base = "http://a.com/b/c/d;p?q=1#z"
    hrefs = ["g", "./g", "g/", "/g", "//g.com/x", "?y", "#s", "g?y#s", "../g", "../../g", "../../../g", ".", "..",
             "", "mailto:x@y", "g//h", "/a/../b/./c", "http://z.com/q", "../..//x/"]
    got = apply(hrefs, lambda href: urls.resolve_link(urls.url_parts(F.lit(base)), href))
    assert got == [urljoin(base, href) for href in hrefs]


def test_site_matches(apply):
    given = ["https://www.site.com/x", "https://notsite.com", "https://other.org/site.com", None]
    assert apply(given, lambda c: urls.site_matches(c, "site.com")) == [True, True, False, False]


def test_is_retryable(apply):
    given = ["timeout after 120.0s", "HTTP 503 for u", "HTTP 404 for u", "network 404", "boom",
             "All 4 attempts failed for http://x/5463404", "SSL handshake", None]
    assert apply(given, net.is_retryable) == [True, True, False, False, False, False, True, None]
    assert apply(["Target closed", "target closed"], net.is_browser_death) == [True, False]


def test_status_rules(apply):
    given = [403, 404, 429, 503, 418, 200]
    assert apply(given, net.should_retry_status, "int") == [False, False, True, True, False, False]
    outcomes = ["error", "error", "rate_limited", "rate_limited", "error", "success"]
    assert apply(given, net.http_outcome, "int") == outcomes


def test_retry_after(apply):
    given = ["30", "Wed, 21 Oct 2015 07:28:00 GMT", "Wed, 21 Oct 2015 09:28:00 +0200", "Mon, 1 Jan 2001 00:00:00 GMT", "x", None]
    assert apply(given, lambda c: net.parse_retry_after(c, 1445412480.0 - 90)) == [30.0, 90.0, 90.0, 0.0, None, None]


def test_retry_after_ignores_session_zone(spark, apply):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = apply(["Wed, 21 Oct 2015 07:28:00 GMT"], lambda c: net.parse_retry_after(c, 1445412480.0 - 90))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [90.0]


def test_backoff_delay(apply):
    assert apply([0, 1, 2, 3, 4], net.backoff_delay, "int") == [1, 2, 4, 8, 16]
    assert apply([100], lambda c: net.backoff_delay(c, max_delay=5.0), "int") == [5]
    assert apply([2], lambda c: net.backoff_delay(c, F.lit(30.0)), "int") == [30]
    jittered = apply([2] * 50, lambda c: net.backoff_delay(c, jitter_seed=3), "int")
    assert all(0 <= delay <= 4 for delay in jittered) and len(set(jittered)) > 10


def test_pacing_delay(apply):
    got = apply([1] * 200, lambda c: net.pacing_delay(3.0, 7.0, c, seed=5), "int")
    assert min(got) >= 3.0 and 4.5 < sum(got) / len(got) < 5.5


def test_metric_key(spark):
    rows = spark.createDataFrame(
        [("a", {"z": "1", "b": "2"}), ("a", {}), ("a", None)], "name string, labels map<string,string>"
    )
    got = [row.k for row in rows.select(net.metric_key("name", "labels").alias("k")).collect()]
    assert got == ["a{b=2,z=1}", "a", "a"]


@pytest.mark.parametrize("expression", [tx.clean_text, tx.parse_price, tx.yes_no, urls.canonical_url, net.is_retryable])
def test_no_python_in_plan(spark, expression):
    plan = spark.range(1).select(F.col("id").cast("string").alias("v")).select(expression(F.col("v")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
