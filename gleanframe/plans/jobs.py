"""Whole jobs: a crawl run, a retry run, and dedup of an export."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.functions.text import blank_to_null
from gleanframe.functions.url import canonical_url
from gleanframe.operators import dedup, ledger as failures, quality, runs
from gleanframe.operators.extract import normalize_listing, raw_listing
from gleanframe.operators.markup import READ_ERROR
from gleanframe.session import written
from gleanframe.sources.readers import read_exported_csv
from gleanframe.sources.sinks import Exporter, SnapshotTable, write_csv

PAGE_ORDER = ["page_id"]


def unseen_pages(pages: DataFrame, known_urls: DataFrame | None) -> DataFrame:
    """Pages whose canonical URL is not known; runs before any page is read."""
    addressed = pages.withColumn("url", canonical_url("url"))
    return addressed if known_urls is None else dedup.new_ids(addressed, known_urls, "url")


def clean_listings(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Pages to validated listings in one pass, no shuffle."""
    raw = raw_listing(pages, keep=keep, error=READ_ERROR)
    return quality.validate(normalize_listing(raw, keep=(*keep, READ_ERROR)), error=READ_ERROR)


def crawl_run(
    pages: DataFrame,
    exporter: Exporter,
    known: DataFrame,
    run_id: str,
    mode: str | None = None,
    known_urls: DataFrame | None = None,
    pages_exhausted: bool = True,
    errors: int = 0,
    runs_path: str | None = None,
    started: float = 0.0,
    ended: float | None = None,
) -> dict:
    """One run: examine pages in order, stop early in daily mode, export what is new.

    Returns the run's flags, outcome, the mode of the next run, its counts and its elapsed time.
    With ``runs_path`` the runs table there gives the mode, unless ``mode`` does, and gets this
    run as it starts and again at its end. ``started`` and ``ended`` are the caller's times in
    seconds.
    """
    spark = pages.sparkSession
    if mode is None:
        mode = next_mode(spark, runs_path) if runs_path else "resume"
    report = {
        "run_id": run_id,
        "started": started,
        "mode": mode,
        **_ending(stopped=False, pages_exhausted=False, errors=errors),
        "stream_exhausted": False,
        "scraped": 0,
        "skipped": 0,
        "last_exported_id": None,
        "elapsed_secs": None,
    }
    if runs_path:
        # a run that dies stays on record as interrupted, and the next one resumes
        save_run(spark, runs_path, report)
    listings = written(clean_listings(unseen_pages(pages, known_urls)))
    # streaks and stops need ids only; whole rows are fetched once at the end
    items = listings.select(F.lit(run_id).alias("run_id"), "page_id", "property_id")
    marked = dedup.mark_known(items, known, PAGE_ORDER)
    if mode == "daily":
        examined = runs.early_stop(marked, PAGE_ORDER, mode=F.lit(mode), hit_name="stops")
    else:
        examined = marked.withColumn("stops", F.lit(False))
    examined = written(examined.select("page_id", "is_known", "stops"))
    counts = examined.agg(
        F.count(F.lit(1)).alias("scraped"),
        F.count_if("is_known").alias("skipped"),
        # the stop may come with the very last row and cut nothing
        F.coalesce(F.bool_or("stops"), F.lit(False)).alias("stopped"),
    ).first()
    new = listings.join(examined.filter(~F.col("is_known")), "page_id", "left_semi")
    has_id = blank_to_null("property_id")
    last_id = new.agg(F.max_by(has_id, F.when(has_id.isNotNull(), F.col("page_id")))).first()[0]
    taken = exporter.export(new.withColumn("_order", F.col("page_id")), run_id)
    report |= {
        **_ending(counts.stopped, pages_exhausted, errors),
        "scraped": counts.scraped,
        "skipped": counts.skipped,
        "exported": taken,
        "last_exported_id": last_id,
        "elapsed_secs": None if ended is None else ended - started,
    }
    if runs_path:
        save_run(spark, runs_path, report)
    return report


def _ending(stopped: bool, pages_exhausted: bool, errors: int) -> dict:
    """Flags of a run, its outcome, and the mode of the run after it."""
    outcome = "COMPLETED" if pages_exhausted and not stopped else "EARLY_STOP" if stopped else "INTERRUPTED"
    return {
        "stream_exhausted": not stopped,
        "pages_exhausted": pages_exhausted,
        "early_stop": stopped,
        "errors": errors,
        "outcome": outcome,
        "next_mode": "daily" if outcome != "INTERRUPTED" and errors == 0 else "resume",
    }


RUNS = (
    "run_id string, started double, elapsed_secs double, mode string, stream_exhausted boolean, pages_exhausted boolean, "
    "early_stop boolean, errors long, outcome string, next_mode string, scraped long, skipped long, last_exported_id string"
)


def save_run(spark: SparkSession, path: str, report: dict) -> None:
    """Write one run's row; a run that is run again overwrites its own."""
    row = tuple(report[field.split()[0]] for field in RUNS.split(", "))
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("overwrite").json(f"{path}/run={report['run_id']}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs written to ``path``; none if there is nothing yet."""
    try:
        return spark.read.schema(RUNS).json(f"{path}/run=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def next_mode(spark: SparkSession, path: str) -> str:
    """The mode that the latest run left for the next one; the first run resumes."""
    last = read_runs(spark, path).agg(F.max_by("next_mode", F.struct("started", "run_id")).alias("mode")).first()
    return last.mode or "resume"


def retry_run(
    ledger: SnapshotTable,
    results: DataFrame,
    exporter: Exporter,
    tag: str,
    max_attempts: int = failures.MAX_RETRY_ATTEMPTS,
) -> DataFrame:
    """Apply the results of retried URLs: export successes, update the ledger.

    ``results`` has the listing columns plus ``error``, one row per URL. Rows are
    written before the ledger changes. Returns the summary of the run.
    """
    before = ledger.read(before_tag=tag)
    waiting = failures.pending(before, max_attempts)
    won = results.filter("error is null").join(waiting.select("url"), "url", "left_semi").drop("error")
    sink = next(iter(exporter.sinks))
    # reads versions and parts that stay as they are, so it may be evaluated later
    summary = failures.retry_summary(before, results, exporter.known(sink, before_tag=tag), max_attempts)
    taken = exporter.export(won, tag)
    if any(count is None for count in taken.values()):
        # a sink missed the rows: their URLs stay on the ledger and are tried again
        results = results.filter("error is not null")
    tried = results.join(waiting.select("url"), "url", "left_semi").select("url", F.col("error").alias("_error"))
    after = before.join(tried.withColumn("_tried", F.lit(True)), "url", "left")
    again = failures.is_retryable("_error")
    stays = F.col("_tried").isNull() | F.coalesce(again, F.lit(False))
    ledger.replace(
        after.filter(stays).withColumn(
            "attempts", (F.col("attempts") + F.when(F.col("_tried"), 1).otherwise(0)).cast("int")
        ),
        tag,
    )
    return summary


def dedup_export(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Write an exported CSV with the first row per id only; returns the duplicate report."""
    rows = read_exported_csv(spark, source, position=True)
    write_csv(dedup.dedup_keep_first(rows, "property_id", ["_file", "_at"]), target, "overwrite")
    return dedup.duplicate_report(rows, "property_id")
