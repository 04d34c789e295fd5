"""Continuous crawl: pages and request logs arrive as files, batches are idempotent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from gleanframe.operators.dedup import first_per_id, new_records
from gleanframe.operators.extract import export_rows, normalize_listing, raw_listing
from gleanframe.operators.markup import READ_ERROR
from gleanframe.operators.quality import validate
from gleanframe.operators.runs import EARLY_STOP_AFTER
from gleanframe.session import typed_state
from gleanframe.sources.sinks import Exporter, LedgerFeed
from gleanframe.streaming.control import ledger_entries, stop_early

PROGRESS = "crawl_progress"


def stream_listings(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Page stream to validated listings, with progress counters observed on it; ``keep`` passes columns through."""
    kept = ("page_id", *keep)
    raw = raw_listing(pages, keep=kept, error=READ_ERROR)
    listings = validate(normalize_listing(raw, keep=(*kept, READ_ERROR)), error=READ_ERROR)
    return listings.observe(
        PROGRESS,
        F.count(F.lit(1)).alias("scraped"),
        F.count_if(~F.col("validation.is_valid")).alias("invalid"),
        F.count(READ_ERROR).alias("unread"),
    ).drop(READ_ERROR)


def distinct_listings(
    listings: DataFrame, known: DataFrame | None = None, seen_at: str | None = None, within: str = "7 days"
) -> DataFrame:
    """First listing of each id within the query; listings without id all pass.

    With ``seen_at``, the time a listing was fetched, an id is remembered for ``within`` after
    its first listing and then leaves the state; ids exported before are left out by ``known``,
    so the state holds what is new in that span. Without it, ids are remembered for ever.
    """
    if known is not None:
        listings = new_records(listings, known)
    named = F.coalesce(F.col("property_id"), F.lit("")) != ""
    if seen_at is None:
        return listings.filter(named).dropDuplicates(["property_id"]).unionByName(listings.filter(~named))
    # rows of a micro-batch lie within the span of the watermark, so none of them is late
    timed = listings.withWatermark(seen_at, within)
    alone = F.when(~named, F.col("page_id"))
    return timed.withColumn("_alone", alone).dropDuplicatesWithinWatermark(["property_id", "_alone"]).drop("_alone")


def daily_listings(
    listings: DataFrame,
    known: DataFrame,
    crawl_id: int,
    threshold: int = EARLY_STOP_AFTER,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Listing stream of one daily crawl up to its early stop, without the known listings.

    ``known`` holds the ids exported before the crawl; an id that came earlier in the crawl is
    known too. Rows are export rows plus ``page_id`` and ``crawl_id``. The stop depends on the
    order of all rows of the crawl, so one task holds its rows of a micro-batch.
    """
    rows = export_rows(listings, keep=("page_id",))
    exported = known.select(F.col("property_id").alias("_known")).distinct()
    marked = rows.join(exported, F.nullif("property_id", F.lit("")) == F.col("_known"), "left").withColumns(
        {"crawl_id": F.lit(crawl_id).cast("long"), "seq": F.col("page_id"), "is_known": F.col("_known").isNotNull()}
    )
    examined = stop_early(marked.drop("_known"), threshold, repeats=True, ttl_ms=ttl_ms)
    return examined.filter("not is_known").drop("seq", "is_known", "streak")


def batch_tag(batch_id: int) -> str:
    return f"{batch_id:010d}"


def start_export(listings: DataFrame, exporter: Exporter, checkpoint: str) -> StreamingQuery:
    """Export what is new, batch by batch, until the files now there are used up.

    A batch that is run again after a failure gets the same tag: it overwrites
    its own files and does not see its own ids as known.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = first_per_id(batch.withColumn("_order", F.col("page_id")), ["page_id"])
        taken = exporter.export(rows, batch_tag(batch_id))
        missed = [name for name, count in taken.items() if count is None]
        if missed:
            # not committed: the batch comes again, and sinks that took it overwrite the same files
            raise RuntimeError(f"batch {batch_id} was not taken by {', '.join(missed)}")

    with typed_state(listings.sparkSession):
        return (
            listings.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def start_ledger(log: DataFrame, table: LedgerFeed, checkpoint: str) -> StreamingQuery:
    """Keep the failure ledger up to date from a request-log stream; a batch writes what it changes."""
    with typed_state(log.sparkSession):
        return (
            ledger_entries(log)
            .writeStream.outputMode("update")
            .foreachBatch(lambda changes, batch_id: table.add(changes, batch_tag(batch_id)))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


class ProgressCounters(StreamingQueryListener):
    """Adds up the observed counters of all batches and hands on each new total."""

    def __init__(self, report: Callable[[dict[str, int]], None] | None = None):
        self.totals: dict[str, int] = {"scraped": 0, "invalid": 0, "unread": 0}
        self._report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(PROGRESS)
        if row is None:
            return
        for name in self.totals:
            self.totals[name] += row[name]
        if self._report:
            self._report(dict(self.totals))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
