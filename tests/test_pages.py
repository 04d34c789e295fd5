"""Extraction, cleaning, validation and link graph on small fixtures."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanframe.functions.url import canonical_url
from gleanframe.operators import links, markup, quality
from gleanframe.operators.extract import LISTING_RULES, export_rows, normalize_listing, raw_listing, read_page
from gleanframe.operators.markup import PageReader, PageRules, Pick
from gleanframe.plans import jobs
from gleanframe.schemas import EXPORT_COLUMNS, RAW_FIELDS

LISTING = """
<html><body>
  <h6 class="font-semibold text-black-custom font-barlow">Ref <span class="text-gold-shade-55">C-12345</span></h6>
  <h1 class="font-extrabold">Two rooms in the centre</h1>
  <h2 class="font-bold text-gold-shade-55">150,000 €</h2>
  <div class="flex gap-1"><h6>Old Town, Square</h6></div>
  <p class="paragraph-2 text-grey-shade-40">Bright flat with a view.</p>
  %s
</body></html>"""


def raw(spark, *bodies):
    pages = spark.createDataFrame([(i, f"http://t/{i}", body) for i, body in enumerate(bodies)], "n int, url string, html string")
    return [row.asDict() for row in raw_listing(pages, keep=("n",)).orderBy("n").collect()]


def test_listing_without_grids(spark):
    (row,) = raw(spark, LISTING % "")
    found = {k: v for k, v in row.items() if v is not None and k != "n"}
    assert found == {
        "property_id": "C-12345",
        "url": "http://t/0",
        "title": "Two rooms in the centre",
        "price_raw": "150,000 €",
        "price_currency": "EUR",
        "location": "Old Town, Square",
        "description": "Bright flat with a view.",
    }
    assert list(row)[1:] == list(RAW_FIELDS)


@pytest.mark.parametrize("html", ["<html><body></body></html>", "<<<not html>>>", "", None, "<div class='", "<a href=\"x"])
def test_unreadable_pages_give_nulls(spark, html):
    (row,) = raw(spark, html)
    assert {k for k, v in row.items() if v is not None} == {"n", "url"}


def test_meta_id_and_images(spark):
    html = """<meta name="crm-id" content=" 77 "><div class="gap-2 grid grid-cols-4"><a href="/a.jpg"><img></a><a></a>
    <div><a href='b.jpg'>x</a></div></div><a href="/outside">no</a>"""
    (row,) = raw(spark, html)
    assert row["property_id"] == "77" and row["images"] == ["/a.jpg", "b.jpg"]


def test_top_grid(spark):
    grid = """<div class="grid xl:grid-cols-5 font-oakes">
      <div><p>Gross&nbsp;Area:: <span>120 m²</span></p></div><div><p>Gross area: <span>130 m²</span></p></div>
      <div><p>Interior area</p></div><section><div><p>Floor: <span>9</span></p></div></section>
      <div><p><b>Bedrooms</b> <span>3</span></p></div><div><p>
        <i>Status</i> <span>hidden</span></p></div>
      <div><p>Type of floor: <span>parquet</span></p></div><div><h5>Type</h5></div>
      <div><p>Furnished</p></div><div><p>Energy certificate: <span>B</span></p></div></div>"""
    (row,) = raw(spark, LISTING % grid)
    assert row["total_area"] == "130 m²"  # "grossarea" names nothing
    assert row["internal_area"] == "Interior area"
    assert row["floor"] == "parquet"  # map order: floor before type
    assert row["number_of_bedrooms"] == "3"
    assert row["statusi"] is None  # blank text stands first in the paragraph
    assert row["lloji"] is None
    assert row["mobilimi"] == "Furnished" and row["ka_hipoteke"] == "B"


def test_info_container_and_fill(spark):
    info = """<div class="lg:grid-cols-3 font-oakes"><div><p>Elevator: Po: x</p></div><div><p>Bath: 1</p></div>
      <div><p>Baths:2</p></div><div><p>Furnishing: partly</p></div><div><p>Not furnished</p></div>
      <div><p>Mortgage: jo</p></div><div><p>Certificate: yes</p></div><div><p></p></div></div>"""
    top = '<div class="xl:grid-cols-5 font-oakes"><div><p>Furnished: <span></span></p></div><div><p>Mortgage <span>po</span></p></div></div>'
    alone, filled = raw(spark, LISTING % info, LISTING % (top + info))
    assert (alone["ashensor"], alone["number_of_toilets"]) == ("Po: x", "2")
    assert (alone["mobilimi"], alone["ka_hipoteke"]) == ("partly", "jo")
    assert (filled["mobilimi"], filled["ka_hipoteke"]) == ("partly", "po")


def test_sites_with_own_rules(spark):
    other = PageRules({**LISTING_RULES.picks, "title": Pick("h3")}, LISTING_RULES.grids)
    html = "<h1 class=font-extrabold>one</h1><h3>three</h3>"
    pages = spark.createDataFrame([(f"http://{host}/x", html) for host in ("www.a.com", "b.org", "c.net")], "url string, html string")
    rows = raw_listing(pages, sites={"a.com": LISTING_RULES, "b.org": other}).collect()
    assert {r.url: r.title for r in rows} == {"http://www.a.com/x": "one", "http://b.org/x": "three", "http://c.net/x": None}
    with pytest.raises(ValueError):
        raw_listing(pages, sites={"a.com": LISTING_RULES, "b.org": PageRules({"title": Pick("h3")})})


def test_amenities(spark):
    box = '<div class="md:grid-cols-5 grid-cols-3"><div><p>Pool</p></div><div><p> </p></div><div><p>Gym &amp; <i>Spa</i></p></div></div>'
    empty = '<div class="md:grid-cols-5 grid-cols-3"><div></div></div>'
    some, none = raw(spark, LISTING % box, LISTING % empty)
    assert some["karakteristikat"] == "Pool, Gym &Spa" and none["karakteristikat"] is None


def test_reader_tolerates_broken_nesting():
    rules = PageRules({"p": Pick("div.x p"), "all": Pick("p", many=True), "next": Pick("a[rel='next']", attr="href")})
    page = PageReader(rules).read(
        "<script>'<p>no</p>'</script><p><b>one<br><p>two<div class=x><p>th<!-- <p> -->ree</i></div></p>four"
        "<style>p{}</style><a rel='next prev' href=/no></a><a rel=next href=/2>n</a><p/>"
    )
    assert page == {"p": "three", "all": ["one", "two", "three", ""], "next": "/2", "read_error": None}


def test_normalized_and_exported(spark):
    pages = spark.createDataFrame([("http://t/1", LISTING % "")], "url string, html string")
    listing = normalize_listing(raw_listing(pages))
    row = export_rows(listing.withColumn("images", F.array(F.lit("é"), F.lit("b")))).first()
    assert (row.price, row.title, row.images) == (150000.0, "Two rooms in the centre", '["é","b"]')
    assert export_rows(listing).columns == list(EXPORT_COLUMNS)
    assert export_rows(listing.select("url")).first().asDict() == {c: "http://t/1" if c == "url" else None for c in EXPORT_COLUMNS}


def test_page_is_read_once(spark):
    pages = spark.createDataFrame([("http://t/1", LISTING % "")], "url string, html string")
    kept = quality.validate(normalize_listing(raw_listing(pages))).filter("price > 1 and validation.is_valid")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert kept.count() == 1


def test_validation(spark):
    rows = [("1", "u", "t"), (None, "u", ""), ("", None, "t")]
    checked = quality.validate(spark.createDataFrame(rows, "property_id string, url string, title string"))
    got = [(r.validation.is_valid, list(r.validation.errors)) for r in checked.collect()]
    missing = "Missing required field: "
    assert got == [(True, []), (False, [missing + "property_id", missing + "title"]), (False, [missing + "property_id", missing + "url"])]
    report = {r.error: r.n for r in quality.quality_report(checked).collect()}
    assert report == {missing + "property_id": 2, missing + "url": 1, missing + "title": 1}


def test_links(spark):
    html = "<a class='h-full x' href='/b/?utm_source=q'>1</a><a class=h-full href='/b'>2</a><a class=h-full>3</a><a class=h-full href='c?z=1#f'>4</a><a href=/no>5</a>"
    pages = spark.createDataFrame([("http://S.com/l/1", html), ("http://s.com/none", "")], "url string, html string")
    read = pages.select("url", read_page("html", LISTING_RULES).alias("page")).select("url", F.col("page.links").alias("hrefs"))
    edges = [tuple(r) for r in links.link_edges(read).orderBy("position").collect()]
    assert edges == [
        ("http://S.com/l/1", "http://s.com/b", "http://S.com/l/1", 0),
        ("http://S.com/l/1", "http://s.com/l/c?z=1", "http://S.com/l/1", 1),
    ]
    assert links.link_edges(read, referer=False).filter("referer is not null").isEmpty()
    assert [r.url for r in links.pages_without_links(read).collect()] == ["http://s.com/none"]


def test_next_edges(spark):
    rows = [
        ("http://S.com/l/1?utm_id=2", "2"), ("http://s.com/l/2#x", "../l/3/"), ("http://s.com/l/3", ""), ("http://s.com/l/4", None),
        ("http://s.com/l/5", "?page=2&ref=1"), ("http://s.com/l/6", "//T.com:80/a"), ("http://s.com/l/7", "#top"), (None, "x"),
    ]
    got = links.next_edges(spark.createDataFrame(rows, "url string, next string"))
    assert [tuple(r) for r in got.collect()] == [
        ("http://s.com/l/1", "http://s.com/l/2"), ("http://s.com/l/2", "http://s.com/l/3"), ("http://s.com/l/3", "http://s.com/l/3"),
        ("http://s.com/l/4", None), ("http://s.com/l/5", "http://s.com/l/5?page=2"), ("http://s.com/l/6", "http://t.com/a"),
        ("http://s.com/l/7", "http://s.com/l/7"), (None, None),
    ]


def test_walk_over_links_found_in_pages(spark):
    page = "<html><a rel='next' href='{}'>n</a><li><a href='/x{}'>x</a><a href='/x{}'>x</a></li></html>"
    urls = ["http://s.com/a", "http://s.com/b?utm_source=1", "http://s.com/c/"]
    rows = [(u, page.format(target, k, k + 1)) for k, (u, target) in enumerate(zip(urls, ["b", "./c#x", "/a"]))]
    rules = PageRules({"links": Pick("li a", attr="href", many=True), "next": Pick("a[rel='next']", attr="href")})
    pages = spark.createDataFrame(rows, "url string, html string").select("url", read_page("html", rules).alias("page"))
    pages = pages.select("url", "page.links", "page.next")
    starts = spark.createDataFrame([(1, "http://s.com/a"), (2, "http://s.com/c"), (3, "http://s.com/gone")], "crawl_id int, url string")
    walk = links.page_walk(starts, links.next_edges(pages))
    edges = links.link_edges(pages.select(canonical_url("url").alias("url"), F.col("links").alias("hrefs")))
    got = sorted((r.crawl_id, r.page_no, r.position, r.detail_url[-2:]) for r in links.crawl_frontier(walk, edges).collect())
    first = [(1, n, p, f"x{n - 1 + p}") for n in (1, 2, 3) for p in (0, 1)]
    assert got == first + [(2, 1, 0, "x2"), (2, 1, 1, "x3"), (2, 2, 0, "x0"), (2, 2, 1, "x1"), (2, 3, 0, "x1"), (2, 3, 1, "x2")]


def test_a_broken_page_gives_nulls_and_one_error(spark):
    good = '<meta name="crm-id" content="a"><h1 class="font-extrabold">t</h1>'
    broken = f'<meta name="crm-id" content="b"><h1 class="font-extrabold">half &#{"9" * 5000};</h1><h2 class="font-bold text-gold-shade-55">1</h2>'
    pages = spark.createDataFrame([(1, "http://s/1", good), (2, "http://s/2", broken), (3, "http://s/3", None)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in jobs.clean_listings(pages).collect()}
    assert (rows[1].title, rows[1].read_error) == ("t", None)
    assert (rows[2].property_id, rows[2].title, rows[2].price) == ("b", None, None)
    assert rows[2].read_error.startswith("ValueError")
    assert (rows[3].title, rows[3].read_error) == (None, None)
    counts = {r.error: r.n for r in quality.quality_report(jobs.clean_listings(pages)).collect()}
    assert counts == {"Missing required field: property_id": 1, "Missing required field: title": 2, quality.UNREAD: 1}


def test_page_walk(spark):
    chain = [("a1", "a2"), ("a2", "a3"), ("a3", None), ("b1", "b2"), ("b2", "gone"), ("c1", "c2"), ("c2", "c3"), ("c3", "c2"), ("d1", "d1")]
    nexts = spark.createDataFrame(chain, "url string, next_url string")
    starts = spark.createDataFrame([(k, k + "1") for k in "abcde"], "crawl_id string, url string")
    walk = links.page_walk(starts, nexts)
    got = {(r.crawl_id, r.page_no): r.url for r in walk.collect()}
    assert got == {
        ("a", 1): "a1", ("a", 2): "a2", ("a", 3): "a3", ("b", 1): "b1", ("b", 2): "b2",
        ("c", 1): "c1", ("c", 2): "c2", ("c", 3): "c3", ("d", 1): "d1",
    }
    ends = {r.crawl_id: (r.pages, r.pages_exhausted) for r in links.walk_summary(walk, nexts).collect()}
    assert ends == {"a": (3, True), "b": (2, False), "c": (3, False), "d": (1, False)}
    capped = links.page_walk(starts, nexts, max_pages=2)
    assert capped.count() == 7
    assert {r.crawl_id for r in links.walk_summary(capped, nexts).filter("pages_exhausted").collect()} == set()


def test_long_walk(spark):
    nexts = spark.range(200).selectExpr("'p' || id AS url", "if(id < 199, 'p' || (id + 1), null) AS next_url")
    starts = spark.createDataFrame([(1, "p0")], "crawl_id int, url string")
    walk = links.page_walk(starts, nexts)
    assert walk.count() == 200 and walk.filter("url <> 'p' || (page_no - 1)").isEmpty()


def test_funnel(spark):
    edges = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "detail_url string")
    known = spark.createDataFrame([("y",), ("y",), ("q",)], "detail_url string")
    assert tuple(links.crawl_funnel(edges, known).first()) == (4, 3, 1, 2)


def test_pages_are_read_a_few_at_a_time(monkeypatch):
    kind = pa.struct([("title", pa.string()), ("read_error", pa.string())])
    reader = markup.PageReader(PageRules({"title": Pick("h1")}))

    class Page(dict):
        alive = most = 0

        def __init__(self, *args):
            super().__init__(*args)
            Page.alive += 1
            Page.most = max(Page.most, Page.alive)

        def __del__(self):
            Page.alive -= 1

    read = reader.read
    monkeypatch.setattr(reader, "read", lambda html: Page(read(html)))
    pages = [None, "<h1 class='a'>one</h1>", "<h1 class='a'>two"] * 500
    got = reader.read_all(pa.array(pages).slice(1), kind).to_pylist()
    assert [p["title"] for p in got] == ([None, "one", "two"] * 500)[1:]
    assert Page.most <= 2 * markup.PAGES_AT_ONCE
    assert len(reader.read_all(pa.array([], pa.string()), kind)) == 0


def test_parsed_attributes_are_kept_within_bounds():
    reader = markup.PageReader(PageRules({"link": Pick("a.x", attr="href")}))
    for n in range(3 * markup.KEPT_ATTRS):
        assert reader.read(f"<a class='x' href='/{n}'>")["link"] == f"/{n}"
        assert len(reader._parsed) <= markup.KEPT_ATTRS
    reader.read(f"<a class='{'y' * markup.KEPT_LENGTH}'>")
    assert max(map(len, reader._parsed)) <= markup.KEPT_LENGTH
