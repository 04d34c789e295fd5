"""Pages to raw fields to cleaned listings.

An Arrow UDF reads each page once and returns picks and card grids as one
struct; labels, currencies, fills and types are Column expressions on it. The
UDF is marked non-deterministic so that the planner never evaluates it twice;
for the same reason joins and filters that drop pages belong before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.functions import text as tx
from gleanframe.functions.url import site_matches
from gleanframe.operators import markup
from gleanframe.operators.markup import READ_ERROR, PageReader, PageRules, Pick
from gleanframe.schemas import EXPORT_COLUMNS, FIELD_RENAMES, RAW_FIELDS

# the reader travels with the UDF, so executors need no copy of this package
cloudpickle.register_pickle_by_value(markup)

# Where a listing page keeps its fields, and which label words
# name which field (first word found in the label counts).
LISTING_RULES = PageRules(
    picks={
        "property_id": Pick("h6.font-semibold.text-black-custom.font-barlow span.text-gold-shade-55"),
        "crm_id": Pick("meta[name='crm-id']", attr="content"),
        "title": Pick("h1.font-extrabold"),
        "price": Pick("h2.font-bold.text-gold-shade-55"),
        "location": Pick("div.flex.gap-1 h6"),
        "description": Pick("p.paragraph-2.text-grey-shade-40"),
        "images": Pick("div.grid.grid-cols-4.gap-2 a", attr="href", many=True),
        "links": Pick("a.h-full", attr="href", many=True),
        "next": Pick("a[rel='next']", attr="href"),
    },
    grids={
        "top": ("xl:grid-cols-5", "font-oakes"),
        "info": ("lg:grid-cols-3", "font-oakes"),
        "amenities": ("md:grid-cols-5", "grid-cols-3"),
    },
)
TOP_LABELS = (
    ("gross area", "total_area"),
    ("interior area", "internal_area"),
    ("bedrooms", "number_of_bedrooms"),
    ("floor", "floor"),
    ("status", "statusi"),
    ("type", "lloji"),
    ("furnished", "mobilimi"),
    ("mortgage", "ka_hipoteke"),
    ("certificate", "ka_hipoteke"),
)
INFO_LABELS = (
    ("elevator", "ashensor"),
    ("bath", "number_of_toilets"),
    ("furnish", "mobilimi"),
    ("mortgage", "ka_hipoteke"),
    ("certificate", "ka_hipoteke"),
)
# Rules for plain articles: headline, links and language instead of listing marks.
ARTICLE_RULES = PageRules(
    picks={
        "title": Pick("title"),
        "headline": Pick("h1"),
        "lang": Pick("html", attr="lang"),
        "links": Pick("a", attr="href", many=True),
        "link_texts": Pick("li a", many=True),
        "next": Pick("a[rel='next']", attr="href"),
    }
)

_CARD = T.StructType([T.StructField(name, T.StringType()) for name in ("first", "value", "text")])


def page_type(rules: PageRules) -> T.StructType:
    picks = [
        T.StructField(name, T.ArrayType(T.StringType()) if pick.many else T.StringType())
        for name, pick in rules.picks.items()
    ]
    grids = [T.StructField(name, T.ArrayType(_CARD)) for name in rules.grids]
    return T.StructType([*picks, *grids, T.StructField(READ_ERROR, T.StringType())])


def _arrow_type(rules: PageRules) -> pa.DataType:
    card = pa.struct([(name, pa.string()) for name in ("first", "value", "text")])
    return pa.struct(
        [(name, pa.list_(pa.string()) if pick.many else pa.string()) for name, pick in rules.picks.items()]
        + [(name, pa.list_(card)) for name in rules.grids]
        + [(READ_ERROR, pa.string())]
    )


def read_page(html: Column | str, rules: PageRules) -> Column:
    """All picks and grids of a page as one struct column.

    ``read_error`` tells why a page could not be read to its end; fields that were being read
    then are null, those read before stay.
    """
    arrow_type = _arrow_type(rules)

    @F.arrow_udf(page_type(rules))
    def reader(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pages = PageReader(rules)
        for batch in batches:
            yield pages.read_all(batch, arrow_type)

    return reader.asNondeterministic()(html)


def read_page_of_site(html: Column | str, url: Column | str, sites: dict[str, PageRules]) -> Column:
    """Like ``read_page``, with the rules of the first domain the URL's host contains.

    All rule sets must have the same pick and grid names. A page of no known
    site gives null and is not read.
    """
    rules = list(sites.values())
    if any(page_type(other) != page_type(rules[0]) for other in rules):
        raise ValueError("rule sets of all sites must have the same names")
    arrow_type = _arrow_type(rules[0])
    site = F.coalesce(*[F.when(site_matches(url, domain), domain) for domain in sites])

    @F.arrow_udf(page_type(rules[0]))
    def reader(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        readers = {domain: PageReader(own) for domain, own in sites.items()}
        for htmls, domains in batches:
            done = [pa.array([], arrow_type)]
            for at in range(0, len(htmls), markup.PAGES_AT_ONCE):
                some = [part.slice(at, markup.PAGES_AT_ONCE).to_pylist() for part in (htmls, domains)]
                done.append(pa.array([d and readers[d].read(html) for html, d in zip(*some)], arrow_type))
            yield pa.concat_arrays(done)

    return reader.asNondeterministic()(html, site)


def _field_of(label: Column, labels: tuple[tuple[str, str], ...]) -> Column:
    return F.coalesce(*[F.when(F.contains(label, F.lit(word)), name) for word, name in labels])


def top_pairs(cards: Column) -> Column:
    """Cards of the top grid as ``array<struct<field, value>>``."""

    def labelled(card: Column) -> Column:
        bare = tx.strip_space(F.replace(card["first"], F.lit("\u00a0"), F.lit("")))
        label = F.when(card.value.isNotNull(), F.regexp_replace(F.lower(bare), ":+$", ""))
        return F.struct(
            F.coalesce(label, F.lower(card.text)).alias("label"), F.coalesce(card.value, card.text).alias("value")
        )

    def named(pair: Column) -> Column:
        return F.struct(_field_of(pair.label, TOP_LABELS).alias("field"), pair.value.alias("value"))

    return F.transform(F.transform(cards, labelled), named)


def info_pairs(cards: Column) -> Column:
    """Cards of the info container as ``array<struct<field, value>>``."""

    def pair(card: Column) -> Column:
        has_colon = F.contains(card.text, F.lit(":"))
        label = F.lower(F.substring_index(card.text, ":", 1))
        value = tx.strip_space(F.substr(card.text, F.instr(card.text, ":") + 1))
        bare = F.when(F.contains(F.lower(card.text), F.lit("furnished")), "mobilimi")
        return F.struct(
            F.when(has_colon, _field_of(label, INFO_LABELS)).otherwise(bare).alias("field"), value.alias("value")
        )

    return F.transform(cards, pair)


def pair_value(pairs: Column, field: str, last: bool = True) -> Column:
    """Value of the last (or first) pair of that field."""
    values = F.filter(pairs, lambda pair: pair.field == field)
    return F.try_element_at(values, F.lit(-1 if last else 1)).getField("value")


def amenity_text(cards: Column) -> Column:
    named = F.filter(F.transform(cards, lambda card: card.text), lambda text: text != "")
    return F.when(F.size(named) > 0, F.array_join(named, ", "))


def raw_listing(
    pages: DataFrame,
    html: str = "html",
    url: str = "url",
    keep: tuple[str, ...] = (),
    sites: dict[str, PageRules] | None = None,
    error: str | None = None,
) -> DataFrame:
    """The 19 raw fields of each page; ``keep`` passes columns through.

    Pages are read by the listing rules, or by the rules of their site, with
    all fields but the URL null where no site fits. ``error`` names a column for why a page
    could not be read to its end.
    """
    page = read_page(html, LISTING_RULES) if sites is None else read_page_of_site(html, url, sites)
    read = pages.select(*keep, F.col(url).alias("url"), page.alias("page"))
    cards = read.select(
        *keep,
        "url",
        "page",
        top_pairs(F.col("page.top")).alias("top"),
        info_pairs(F.col("page.info")).alias("info"),
    )
    top, info = F.col("top"), F.col("info")
    fill = lambda name: F.coalesce(tx.blank_to_null(pair_value(top, name)), pair_value(info, name, last=False))
    fields = {
        "property_id": F.coalesce(F.col("page.property_id"), F.col("page.crm_id")),
        "url": F.col("url"),
        "title": F.col("page.title"),
        "price_raw": F.col("page.price"),
        "price_currency": tx.price_currency(F.col("page.price")),
        "location": F.col("page.location"),
        "description": F.col("page.description"),
        "images": F.col("page.images"),
        "mobilimi": fill("mobilimi"),
        "ka_hipoteke": fill("ka_hipoteke"),
        "ashensor": pair_value(info, "ashensor"),
        "number_of_toilets": pair_value(info, "number_of_toilets"),
        "karakteristikat": amenity_text(F.col("page.amenities")),
    }
    for name in ("total_area", "internal_area", "number_of_bedrooms", "floor", "statusi", "lloji"):
        fields[name] = pair_value(top, name)
    problem = [] if error is None else [F.col(f"page.{READ_ERROR}").alias(error)]
    return cards.select(*keep, *[fields[name].alias(name) for name in RAW_FIELDS], *problem)


_CLEANED = {
    "price_raw": tx.parse_price,
    "statusi": tx.listing_status,
    "ka_hipoteke": tx.yes_no,
    "ashensor": tx.yes_no,
    **dict.fromkeys(("title", "location", "description", "lloji", "mobilimi", "karakteristikat"), tx.clean_text),
    **dict.fromkeys(
        ("total_area", "internal_area", "number_of_bedrooms", "floor", "number_of_toilets"), tx.first_number
    ),
}


def normalize_listing(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw fields to the typed listing, one projection."""
    return raw.select(
        *keep,
        *[_CLEANED.get(name, F.col)(name).alias(FIELD_RENAMES.get(name, name)) for name in RAW_FIELDS],
    )


def export_rows(listings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The export columns in order, images as JSON text; columns not there are null."""
    have = set(listings.columns)

    def column(name: str) -> Column:
        if name not in have:
            return F.lit(None).cast("double" if name == "price" else "string").alias(name)
        is_array = name == "images" and isinstance(listings.schema[name].dataType, T.ArrayType)
        return (F.to_json(name) if is_array else F.col(name)).alias(name)

    return listings.select(*keep, *[column(name) for name in EXPORT_COLUMNS])
