"""Link graph: links of a page, frontier edges, pagination walk, funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gleanframe.functions.url import canonical_url, canonical_urls, resolve_link, url_parts
from gleanframe.session import cut_lineage


def page_link_array(base: Column, hrefs: Column | str) -> Column:
    """Canonical links of one page, each once, in order of first appearance.

    ``base`` holds the page's ``url_parts``.
    """
    resolved = F.transform(hrefs, lambda href: resolve_link(base, href))
    return F.array_distinct(F.coalesce(canonical_urls(resolved), F.array().cast("array<string>")))


def link_edges(pages: DataFrame, page_url: str = "url", hrefs: str = "hrefs", referer: bool = True) -> DataFrame:
    """``listing_url, detail_url, referer, position`` per link; no shuffle."""
    based = pages.select(F.col(page_url).alias("listing_url"), url_parts(page_url).alias("base"), F.col(hrefs).alias("hrefs"))
    exploded = based.select(
        "listing_url", F.posexplode(page_link_array(F.col("base"), "hrefs")).alias("position", "detail_url")
    )
    source = F.col("listing_url") if referer else F.lit(None).cast("string")
    return exploded.select("listing_url", "detail_url", source.alias("referer"), "position")


def pages_without_links(pages: DataFrame, page_url: str = "url", hrefs: str = "hrefs") -> DataFrame:
    """Pages whose link selector found nothing, the sign of a stale selector."""
    return pages.filter(F.coalesce(F.size(hrefs), F.lit(0)) <= 0).select(F.col(page_url).alias("url"))


def next_edges(pages: DataFrame, page_url: str = "url", next_href: str = "next") -> DataFrame:
    """``url, next_url`` of fetched pages: where the page's next link leads, both in canonical form.

    ``next_href`` is the link as the page has it. Null means no next link; a link without address
    leads to the page itself. No shuffle.
    """
    based = pages.select(F.col(page_url).alias("url"), url_parts(page_url).alias("base"), F.col(next_href).alias("href"))
    target = F.when(F.col("href").isNotNull(), canonical_url(resolve_link(F.col("base"), F.col("href"))))
    return based.select(canonical_url("url").alias("url"), target.alias("next_url"))


def crawl_frontier(walk: DataFrame, edges: DataFrame) -> DataFrame:
    """Links of the visited pages in the order a crawl meets them: ``crawl_id, page_no, position, detail_url, referer``.

    ``edges`` as ``link_edges`` gives them, with canonical ``listing_url``; a page fetched
    more than once counts with its distinct links.
    """
    visited = walk.select("crawl_id", "page_no", F.col("url").alias("listing_url"))
    first = edges.groupBy("listing_url", "detail_url").agg(F.min("position").alias("position"), F.min("referer").alias("referer"))
    return visited.join(first, "listing_url").select("crawl_id", "page_no", "position", "detail_url", "referer")


def _cut_and_count(rows: DataFrame) -> tuple[DataFrame, int]:
    counted = Observation()
    cut = cut_lineage(rows.observe(counted, F.count(F.lit(1)).alias("n")))
    return cut, counted.get["n"]


def page_walk(starts: DataFrame, nexts: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Follow next links from each crawl's start page: ``crawl_id, page_no, url``.

    ``starts(crawl_id, url)``, ``nexts(url, next_url)`` of the fetched pages; of a
    page's repeated rows the smallest next link counts. Steps are doubled each round, so depth d takes about log2(d) rounds of
    joins on the url. Stops at a page without next link, at a page not fetched,
    after ``max_pages``, and at a page already visited.
    """
    starts = starts.distinct()
    nexts = nexts.groupBy("url").agg(F.min("next_url").alias("next_url"))
    fetched = nexts.select("url")
    reached, size = _cut_and_count(
        starts.join(fetched, "url", "left_semi").select("crawl_id", F.lit(1).cast("long").alias("page_no"), "url")
    )
    # links to pages that were fetched, each as a jump of one step
    jumps = (
        nexts.filter("next_url is not null")
        .join(fetched.withColumnRenamed("url", "next_url"), "next_url", "left_semi")
        .select("url", F.col("next_url").alias("target"))
    )
    stride = 1
    while max_pages is None or stride < max_pages:
        jumps, n_jumps = _cut_and_count(jumps)
        if not n_jumps:
            break
        ahead = reached.join(jumps, "url").select(
            "crawl_id", (F.col("page_no") + stride).alias("page_no"), F.col("target").alias("url")
        )
        if max_pages is not None:
            ahead = ahead.filter(F.col("page_no") <= max_pages)
        reached, grown = _cut_and_count(
            reached.unionByName(ahead).groupBy("crawl_id", "url").agg(F.min("page_no").alias("page_no"))
        )
        if grown == size:
            break
        size, stride = grown, stride * 2
        onward = jumps.select(F.col("url").alias("target"), F.col("target").alias("beyond"))
        jumps = jumps.join(onward, "target").select("url", F.col("beyond").alias("target"))
    return reached.select("crawl_id", "page_no", "url")


def walk_summary(
    walk: DataFrame, nexts: DataFrame, edges: DataFrame | None = None, starts: DataFrame | None = None
) -> DataFrame:
    """Pages visited per crawl and whether it ended at a page without next link.

    With ``edges(listing_url, ...)`` also how many links the visited pages gave. With
    ``starts(crawl_id, ...)`` crawls whose start page was not fetched are told too: no
    pages, and not exhausted.
    """
    nexts = nexts.groupBy("url").agg(F.min("next_url").alias("next_url"))
    ends = walk.groupBy("crawl_id").agg(
        F.max("page_no").alias("pages"), F.max_by("url", "page_no").alias("url")
    )
    summary = ends.join(nexts, "url", "left").select(
        "crawl_id", "pages", F.col("next_url").isNull().alias("pages_exhausted")
    )
    if starts is not None:
        summary = starts.select("crawl_id").distinct().join(summary, "crawl_id", "left").select(
            "crawl_id",
            F.coalesce("pages", F.lit(0).cast("long")).alias("pages"),
            F.coalesce("pages_exhausted", F.lit(False)).alias("pages_exhausted"),
        )
    if edges is None:
        return summary
    per_page = edges.groupBy(F.col("listing_url").alias("url")).agg(F.count(F.lit(1)).alias("links"))
    per_crawl = walk.join(per_page, "url").groupBy("crawl_id").agg(F.sum("links").alias("links"))
    return summary.join(per_crawl, "crawl_id", "left").withColumn(
        "enqueued", F.coalesce("links", F.lit(0).cast("long"))
    ).drop("links")


def crawl_funnel(edges: DataFrame, known: DataFrame | None = None, earlier: Column | None = None) -> DataFrame:
    """Links discovered, distinct, already known and new.

    Known links come as ``known(detail_url)``, or are rows of ``edges`` that ``earlier``
    marks; these are read together with the others and are not discoveries.
    """
    if earlier is not None:
        counted = edges.groupBy("detail_url").agg(
            F.count_if(~earlier).alias("hits"), F.when(F.bool_or(earlier), True).alias("is_known")
        )
        marked = counted.filter("hits > 0")
    else:
        distinct = edges.groupBy("detail_url").agg(F.count(F.lit(1)).alias("hits"))
        marked = distinct.join(known.distinct().withColumn("is_known", F.lit(True)), "detail_url", "left")
    n_known = F.count("is_known")
    return marked.agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("discovered"),
        F.count(F.lit(1)).alias("distinct_urls"),
        n_known.alias("known_urls"),
        (F.count(F.lit(1)) - n_known).alias("new_urls"),
    )
