"""Failure ledger: which URLs wait for a retry, folded from the request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions.net import is_retryable
from gleanframe.operators.dedup import new_records

MAX_RETRY_ATTEMPTS = 5


def with_timeouts(log: DataFrame, limit_secs: float) -> DataFrame:
    """Requests longer than the limit become failures with a retryable error text."""
    late = F.col("duration_secs") > limit_secs
    text = F.lit(f"timeout after {float(limit_secs)}s")
    return log.withColumn("error", F.when(late, text).otherwise(F.col("error"))).withColumn("timed_out", late)


def ledger_effect() -> Column:
    """What a log row does to its URL's entry: open, raise, remove, or null for nothing."""
    retry = F.col("phase") == "retry"
    return F.when(is_retryable("error"), F.when(retry, "raise").otherwise("open")).when(retry, "remove")


def ledger_changes(log: DataFrame, url: str = "url", order: list[str] = ["ts", "seq"]) -> DataFrame:
    """What a stretch of the log does to each URL's ledger entry.

    A retryable crawl failure opens or raises an entry and sets error and time;
    a retryable retry failure raises it; a retry that succeeds or fails for good
    removes it. So only rows after a URL's last removal count, and of raises for a
    URL that was not there before only those after its first opening.

    All that is kept of a URL are extremes and counts, which combine before the shuffle: its
    last removal, then what came after it, then the raises after the first opening. Rows
    meet these in joins against one row a URL, whose skewed side adaptive execution splits.
    """
    acts = (
        log.filter("error is not null or phase = 'retry'")  # a success in the crawl changes nothing
        .select(F.struct(url).alias("_of"), F.struct(*order).alias("_at"), "error", ledger_effect().alias("_effect"))
    )
    # no filter on the effect: pushed down to the scan it would be worked out several times a row
    removals = acts.groupBy("_of").agg(F.max(F.when(F.col("_effect") == "remove", F.col("_at"))).alias("_removed_at"))
    placed = acts.join(removals, "_of")
    live = F.col("_removed_at").isNull() | (F.col("_at") > F.col("_removed_at"))
    opening, raising = live & (F.col("_effect") == "open"), live & (F.col("_effect") == "raise")
    sums = placed.groupBy("_of").agg(
        F.bool_or(F.col("_removed_at").isNotNull()).alias("removed"),
        F.count_if(opening).alias("opened"),
        F.count_if(raising).alias("raised_all"),
        F.min(F.when(opening, F.col("_at"))).alias("_opened_at"),
        F.max(F.when(opening, F.struct("_at", "error"))).alias("_last"),
    )
    openings = sums.filter("opened > 0 AND raised_all > 0").select("_of", "_opened_at")
    raises = placed.filter(raising).select("_of", "_at").join(openings, "_of").filter("_at > _opened_at")
    raised = raises.groupBy("_of").agg(F.count(F.lit(1)).alias("raised"))
    return sums.join(raised, "_of", "left").select(
        F.col("_of")[url].alias(url),
        "removed",
        "opened",
        F.coalesce("raised", F.lit(0)).alias("raised"),
        "raised_all",
        F.col("_last.error").alias("error"),
        F.col("_last._at")[order[0]].alias(order[0]),
    )


def failure_ledger(log: DataFrame, url: str = "url", order: list[str] = ["ts", "seq"]) -> DataFrame:
    """Ledger after the whole log: ``url, error, attempts`` and last failure time."""
    changes = ledger_changes(log, url, order).filter("opened > 0")
    return changes.select(url, "error", (F.col("opened") + F.col("raised")).alias("attempts"), order[0])


def merge_ledger(ledger: DataFrame, changes: DataFrame, url: str = "url") -> DataFrame:
    """Stored ledger after the ``ledger_changes`` of one more stretch of the log."""
    new = changes.select(url, "removed", "opened", "raised", "raised_all", *[F.col(c).alias(f"_{c}") for c in ("error", "ts")])
    both = ledger.join(new, url, "full")
    had = F.coalesce(F.col("attempts"), F.lit(0)) * F.when(F.coalesce("removed", F.lit(False)), 0).otherwise(1)
    kept = had > 0
    opened = F.coalesce("opened", F.lit(0))
    added = F.when(kept, opened + F.coalesce("raised_all", F.lit(0))).otherwise(
        F.when(opened > 0, opened + F.coalesce("raised", F.lit(0))).otherwise(0)
    )
    return both.select(
        url,
        F.when(opened > 0, F.col("_error")).otherwise(F.col("error")).alias("error"),
        (had + added).cast("int").alias("attempts"),
        F.when(opened > 0, F.col("_ts")).otherwise(F.col("ts")).alias("ts"),
    ).filter("attempts > 0")


def pending(ledger: DataFrame, max_attempts: int = MAX_RETRY_ATTEMPTS) -> DataFrame:
    """Entries to retry; those over the limit stay in the ledger."""
    return ledger.filter(F.col("attempts") <= max_attempts)


def failure_summary(ledger: DataFrame, max_attempts: int = MAX_RETRY_ATTEMPTS) -> DataFrame:
    return ledger.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("attempts") <= max_attempts).alias("pending")
    )


def retry_exports(
    waiting: DataFrame, results: DataFrame, known: DataFrame, url: str = "url", tried: Column | None = None
) -> DataFrame:
    """Results of retried URLs that succeeded and whose id is not exported yet; ``tried`` as in ``retry_summary``."""
    succeeded = results.filter(F.col("error").isNull() & (F.lit(True) if tried is None else tried)).join(waiting.select(url), url, "left_semi")
    return new_records(succeeded, known)


def retry_summary(
    ledger: DataFrame,
    results: DataFrame,
    known: DataFrame,
    max_attempts: int = MAX_RETRY_ATTEMPTS,
    url: str = "url",
    tried: Column | None = None,
) -> DataFrame:
    """Counts of one retry run, one row; ``results`` has one row per retried URL.

    ``tried`` tells rows of URLs that the run did not come to, which count as not retried. An
    entry that failed again stays pending only while its raised count does.
    """
    reached = F.lit(True) if tried is None else F.coalesce(tried, F.lit(False))
    known_ids = known.select(F.col("property_id").alias("_known")).distinct()
    outcomes = (
        ledger.join(results.select(url, "property_id", F.col("error").alias("_error"), reached.alias("_tried")), url, "left")
        .join(known_ids, F.col("property_id") == F.col("_known"), "left")
    )
    due = F.col("attempts") <= max_attempts
    retried = due & F.coalesce(F.col("_tried"), F.lit(False))
    won = retried & F.col("_error").isNull()
    again = retried & F.coalesce(is_retryable("_error"), F.lit(False))
    for_good = retried & F.col("_error").isNotNull() & ~is_retryable("_error")
    stays = (due & ~retried) | (again & (F.col("attempts") + 1 <= max_attempts))
    count: dict[str, Column] = {
        "retried": due,
        "skipped": ~due,
        "succeeded": won,
        "exported": won & F.col("_known").isNull(),
        "failed_retryable": again,
        "failed_permanent": for_good,
        "remaining": stays,
    }
    return outcomes.agg(*[F.count_if(flag).alias(name) for name, flag in count.items()])
