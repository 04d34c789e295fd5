"""URL canonical form and link resolution as Column expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanframe.functions.text import _col, strip_space

# Query parameters dropped as tracking, default port per scheme.
TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "utm_id", "utm_source_platform", "utm_creative_format", "utm_marketing_tactic",
    "gclid", "gclsrc", "gbraid", "wbraid",
    "fbclid", "fb_action_ids", "fb_action_types", "fb_ref", "fb_source",
    "msclkid", "ref", "source", "campaign", "affiliate", "partner",
    "mc_cid", "mc_eid", "igshid", "twclid", "_ga", "_gl", "zanpid", "origin",
)
DEFAULT_PORTS = {"http": 80, "https": 443}

# scheme, authority with its slashes, authority, path, query, fragment (RFC 3986)
_PARTS = (
    r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"
)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def url_parts(url: Column | str) -> Column:
    """``struct<url, scheme, host, path, query>``, as written."""
    text = _col(url)
    return F.struct(
        text.alias("url"),
        _part(text, 1).alias("scheme"),
        _part(text, 3).alias("host"),
        _part(text, 4).alias("path"),
        _part(text, 5).alias("query"),
    )


def url_host(url: Column | str) -> Column:
    """The authority of the URL, letter case kept."""
    return _part(_col(url), 3)


def site_matches(url: Column | str, domain: str) -> Column:
    """Does the authority contain the domain; a missing URL does not."""
    return F.coalesce(F.contains(url_host(url), F.lit(domain)), F.lit(False))


def _decode(token: Column) -> Column:
    # a percent sign that starts no valid escape stands for itself
    return F.try_url_decode(F.regexp_replace(token, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(token: Column) -> Column:
    form = F.url_encode(token)
    return F.replace(F.replace(form, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_query(query: Column) -> Column:
    """Drop blank-valued and tracking parameters, sort the rest, encode again."""
    filled = F.filter(F.split(query, "&"), lambda pair: pair.rlike("^[^=]*=."))
    pairs = F.transform(
        filled,
        lambda pair: F.struct(
            _decode(F.substring_index(pair, "=", 1)).alias("k"),
            _decode(F.substr(pair, F.instr(pair, "=") + 1)).alias("v"),
        ),
    )
    wanted = F.array_sort(F.filter(pairs, lambda pair: ~F.lower(pair.k).isin(*TRACKING_PARAMS)))
    return F.array_join(F.transform(wanted, lambda pair: F.concat(_encode(pair.k), F.lit("="), _encode(pair.v))), "&")


def _rebuilt(parts: Column) -> Column:
    scheme, host = F.lower(parts.scheme), F.lower(parts.host)
    portless = F.coalesce(
        *[F.when(scheme == name, F.regexp_replace(host, f":0*{port}$", "")) for name, port in DEFAULT_PORTS.items()],
        host,
    )
    path = F.regexp_replace(parts.path, "/+$", "")
    unreadable = F.contains(host, F.lit("[")) != F.contains(host, F.lit("]"))
    spelled = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(host != "", F.concat(F.lit("//"), portless)).otherwise(""),
        F.coalesce(F.nullif(path, F.lit("")), F.lit("/")),
    )
    query = F.when(parts.query == "", "").otherwise(clean_query(parts.query))
    # removes the mark again where no parameter was left
    return F.when(~unreadable & (parts.url != ""), F.regexp_replace(F.concat(spelled, F.lit("?"), query), r"\?$", ""))


def canonical_url(url: Column | str) -> Column:
    """One spelling per address; a blank or unreadable URL comes back unchanged."""
    raw = _col(url)
    text = F.translate(strip_space(raw), "\t\r\n", "")
    spelled = _let(text, lambda stripped: _let(url_parts(stripped), _rebuilt))
    return F.coalesce(spelled, raw)


def canonical_urls(urls: Column) -> Column:
    """``canonical_url`` of each element of an array."""
    return F.transform(urls, canonical_url)


def _without_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of a path."""

    def walk(segments: Column) -> Column:
        kept = F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda done, segment: F.when(
                segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
            )
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment))),
        )
        # a path that ends in dots names a folder
        ending = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
        return F.regexp_replace(F.concat(F.lit("/"), F.array_join(kept, "/"), ending), "^//", "/")

    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), _let(F.split(path, "/"), walk)).otherwise(path)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on a page (RFC 3986 reference resolution).

    ``base`` holds the page's ``url_parts``.
    """
    root = F.concat(base.scheme, F.lit("://"), base.host)
    own_path = F.regexp_extract(href, "^[^?#]*", 0)
    tail = F.regexp_extract(href, r"[?#][\s\S]*$", 0)
    folder = F.regexp_replace(F.regexp_replace(base.path, "[^/]*$", ""), "/+", "/")
    merged = F.concat(F.coalesce(F.nullif(folder, F.lit("")), F.lit("/")), F.regexp_replace(own_path, "/+", "/"))
    return (
        F.when(F.coalesce(href, F.lit("")) == "", base.url)
        .when(href.startswith("//"), F.concat(base.scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, _without_dots(own_path), tail))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("?"), F.concat(root, base.path, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base.url, r"#[\s\S]*$", ""), href))
        .otherwise(F.concat(root, _without_dots(merged), tail))
    )
