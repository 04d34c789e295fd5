"""Request-outcome rules as Column expressions (no UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanframe.functions.text import _col, strip_space

# Error fragments (lower case; permanent ones are looked at first),
# phrases of a dead browser (case kept), HTTP status groups.
PERMANENT_FRAGMENTS = (
    "404", "not found", "validation", "parseerror", "parse error",
    "attributeerror", "keyerror", "valueerror",
)
TRANSIENT_FRAGMENTS = (
    "timeout", "timed out", "circuit breaker", "circuit open",
    "connection reset", "connectionreset", "connection refused", "connectionrefused",
    "connection error", "503", "429", "too many requests", "service unavailable",
    "browser has been closed", "browser appears dead", "target closed", "page crashed",
    "network", "eof occurred", "broken pipe", "ssl", "read timeout",
)
DEAD_BROWSER_PHRASES = (
    "Target page, context or browser has been closed",
    "Browser has been closed",
    "Connection closed",
    "Target closed",
)
PERMANENT_STATUS = (400, 401, 403, 404, 405, 410)
TRANSIENT_STATUS = (429, 500, 502, 503, 504)
RATE_LIMIT_STATUS = (429, 503)


def _names_any(text: Column, fragments: tuple[str, ...]) -> Column:
    # one pattern: the text, which may be long to work out, is worked out once
    return text.rlike("|".join(re.escape(fragment) for fragment in fragments))


def is_retryable(error: Column | str) -> Column:
    """Does the error text name a transient failure; permanent wording wins."""
    low = F.lower(_col(error))
    return ~_names_any(low, PERMANENT_FRAGMENTS) & _names_any(low, TRANSIENT_FRAGMENTS)


def is_browser_death(error: Column | str) -> Column:
    return _names_any(_col(error), DEAD_BROWSER_PHRASES)


def should_retry_status(status: Column | str) -> Column:
    return ~_col(status).isin(*PERMANENT_STATUS) & _col(status).isin(*TRANSIENT_STATUS)


def http_outcome(status: Column | str) -> Column:
    return (
        F.when(_col(status).isin(*RATE_LIMIT_STATUS), "rate_limited")
        .when(_col(status) >= 400, "error")
        .otherwise("success")
    )


def parse_retry_after(header: Column | str, now_epoch: Column | float) -> Column:
    """Seconds to wait from a Retry-After header: a number or an HTTP date.

    ``now_epoch`` is the reference time in epoch seconds; nothing reads a clock.
    """
    text = strip_space(header)
    stamp = F.regexp_extract(text, r"(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    zone = F.regexp_extract(text, r"([+-]\d{4})$", 1)
    when = F.try_to_timestamp(
        F.concat(stamp, F.lit(" "), F.when(zone == "", "+0000").otherwise(zone)),
        F.lit("d MMM yyyy HH:mm:ss xx"),
    )
    ahead = F.unix_micros(when) / 1e6 - now_epoch
    return F.coalesce(text.try_cast("double"), F.when(when.isNotNull(), F.greatest(F.lit(0.0), ahead)))


def backoff_delay(
    attempt: Column | str,
    retry_after: Column | None = None,
    base_delay: float = 1.0,
    max_delay: float = 60.0,
    jitter_seed: int | None = None,
) -> Column:
    """Seconds before the next try (``attempt`` from 0); Retry-After wins if given."""
    delay = F.least(F.lit(base_delay) * F.pow(F.lit(2.0), _col(attempt)), F.lit(max_delay))
    if jitter_seed is not None:
        delay = delay * F.rand(jitter_seed)
    return delay if retry_after is None else F.coalesce(retry_after, delay)


def pacing_delay(low: float, high: float, multiplier: Column | float, seed: int) -> Column:
    """Randomised pause between requests: a bell around the middle, floored at ``low``."""
    drawn = F.lit((low + high) / 2) + F.lit((high - low) / 4) * F.randn(seed)
    return F.greatest(F.lit(low), drawn) * multiplier


def metric_key(name: Column | str, labels: Column | str) -> Column:
    """``name`` or ``name{k=v,...}`` with the labels sorted by name."""
    entries = F.array_sort(F.map_entries(_col(labels)))
    joined = F.array_join(F.transform(entries, lambda e: F.concat(e.key, F.lit("="), e.value)), ",")
    return F.when(
        F.coalesce(F.size(_col(labels)), F.lit(0)) > 0, F.concat(_col(name), F.lit("{"), joined, F.lit("}"))
    ).otherwise(_col(name))
