"""Queries over whole ways: runs one after another, streams over files, and files written and read back.

Each writes what Spark derives from the given tables to the shared folder, lets the job or
stream work on it there, and returns what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.plans import jobs
from gleanframe.plans.inputs import cte, derived
from gleanframe.plans.log_queries import LEDGER_SQL, log_ledger
from gleanframe.plans.page_queries import EXPORTED_SQL, PIECES, exported
from gleanframe.plans.registry import query
from gleanframe.schemas import FAILURE_LEDGER, PAGES, REQUEST_LOG
from gleanframe.session import shared_folder, written
from gleanframe.sources import readers, sinks
from gleanframe.streaming import crawl

# --- runs one after another -----------------------------------------------------------

# errors of each run, whether it saw all pages, and how many of four arrivals of pages were there
_RUNS = ((0, True, 0), (2, True, 1), (0, False, 2), (0, True, 3), (0, True, 3))
_ARRIVALS = 4


def _newest_first(arrived: int, page_id: str = "page_id") -> str:
    """Places of the pages that were there: those of the latest arrival come first."""
    return f"({arrived} - {page_id} % {_ARRIVALS}) * 1000000000 + {page_id}"


def _run_sql(k: int) -> str:
    errors, all_pages, arrived = _RUNS[k]
    before = f"(SELECT next_mode FROM r{k - 1})" if k else "'resume'"
    known = " UNION ".join(f"SELECT property_id FROM x{j}" for j in range(k)) or "SELECT '' AS property_id"
    return f"""i{k} AS (SELECT {_newest_first(arrived)} AS o, property_id FROM crawl_pages WHERE page_id % {_ARRIVALS} <= {arrived}),
m{k} AS (SELECT o, property_id, property_id <> '' AND (property_id IN ({known})
  OR row_number() OVER (PARTITION BY property_id ORDER BY o) > 1) AS is_known FROM i{k}),
l{k} AS (SELECT *, sum(CASE WHEN is_known THEN 0 ELSE 1 END) OVER (ORDER BY o ROWS UNBOUNDED PRECEDING) AS isl FROM m{k}),
s{k} AS (SELECT *, sum(CASE WHEN is_known THEN 1 ELSE 0 END) OVER (PARTITION BY isl ORDER BY o ROWS UNBOUNDED PRECEDING) AS streak FROM l{k}),
d{k} AS (SELECT {before} AS mode, (SELECT min(o) FROM s{k} WHERE streak >= 24) AS cut),
e{k} AS MATERIALIZED (SELECT s.*, mode, mode = 'daily' AND cut IS NOT NULL AS stopped FROM s{k} AS s, d{k} WHERE mode <> 'daily' OR cut IS NULL OR o <= cut),
x{k} AS MATERIALIZED (SELECT DISTINCT property_id FROM e{k} WHERE NOT is_known AND property_id <> ''),
q{k} AS (SELECT any_value(mode) AS mode, bool_or(stopped) AS early_stop, count(*) AS scraped, count(*) FILTER (WHERE is_known) AS skipped,
  max_by(property_id, o) FILTER (WHERE NOT is_known AND property_id <> '') AS last_exported_id FROM e{k}),
r{k} AS MATERIALIZED (SELECT 'r{k}' AS run_id, CAST({100 * k} AS DOUBLE) AS started, CAST({10 + k} AS DOUBLE) AS elapsed_secs, mode, NOT early_stop AS stream_exhausted,
  {all_pages} AS pages_exhausted, early_stop, CAST({errors} AS BIGINT) AS errors,
  CASE WHEN {all_pages} AND NOT early_stop THEN 'COMPLETED' WHEN early_stop THEN 'EARLY_STOP' ELSE 'INTERRUPTED' END AS outcome,
  CASE WHEN ({all_pages} OR early_stop) AND {errors} = 0 THEN 'daily' ELSE 'resume' END AS next_mode, scraped, skipped, last_exported_id FROM q{k})"""


@query(
    "run_lifecycle",
    f"{cte('crawl_pages')}, {', '.join(_run_sql(k) for k in range(len(_RUNS)))} "
    + " UNION ALL ".join(f"SELECT * FROM r{k}" for k in range(len(_RUNS))),
)
def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five runs, each with the mode, the known ids and the runs table that those before left."""
    out = shared_folder(spark, "lifecycle")
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "json", out), out)
    pages = derived(spark, sf_dir, "crawl_pages", heavy=True)
    for k, (errors, all_pages, arrived) in enumerate(_RUNS):
        there = pages.where(F.col("page_id") % _ARRIVALS <= arrived).withColumn("page_id", F.expr(_newest_first(arrived)))
        jobs.crawl_run(
            there, exporter, exporter.known("json"), f"r{k}", runs_path=f"{out}/runs",
            pages_exhausted=all_pages, errors=errors, started=100.0 * k, ended=10.0 + 101.0 * k,
        )
    return jobs.read_runs(spark, f"{out}/runs")


# --- streams over files ------------------------------------------------------------------


def _arrive(rows: DataFrame, at: str, path: str, parts: int, run) -> None:
    """Write ``rows`` in ``parts`` stretches of ``at`` and run the stream after each, from where it stopped."""
    cuts = rows.stat.approxQuantile(at, [k / parts for k in range(1, parts)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.where(F.col(at) > low)
        part = part if high is None else part.where(F.col(at) <= high)
        part.write.mode("append").parquet(path)
        run().awaitTermination()


@query(
    "stream_daily_stop",
    f"""{cte('crawl_pages', 'crawl_known')}, m AS (SELECT page_id, url, property_id, property_id <> '' AND (property_id IN (SELECT property_id FROM crawl_known)
  OR row_number() OVER (PARTITION BY property_id ORDER BY page_id) > 1) AS is_known FROM crawl_pages),
l AS (SELECT *, sum(CASE WHEN is_known THEN 0 ELSE 1 END) OVER (ORDER BY page_id ROWS UNBOUNDED PRECEDING) AS isl FROM m),
s AS (SELECT *, sum(CASE WHEN is_known THEN 1 ELSE 0 END) OVER (PARTITION BY isl ORDER BY page_id ROWS UNBOUNDED PRECEDING) AS streak FROM l),
c AS (SELECT min(page_id) AS cut FROM s WHERE streak >= 24)
SELECT url, nullif(property_id, '') AS property_id FROM s, c WHERE NOT is_known AND (cut IS NULL OR page_id <= cut)""",
)
def stream_daily_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page stream read, cut at the daily stop and exported in one query, started three times."""
    out = shared_folder(spark, "daily-stream")
    exporter = sinks.Exporter(spark, sinks.build_sinks(spark, "csv", out), out)
    known = derived(spark, sf_dir, "crawl_known")
    pages = derived(spark, sf_dir, "crawl_pages").select(*PAGES.names)

    def run():
        arriving = readers.stream_pages(spark, f"{out}/pages")
        daily = crawl.daily_listings(crawl.stream_listings(arriving), known, crawl_id=1)
        return crawl.start_export(daily, exporter, f"{out}/progress")

    _arrive(pages, "page_id", f"{out}/pages", 3, run)
    return readers.read_exported_csv(spark, f"{out}/csv").select("url", "property_id")


@query("stream_ledger", f"{LEDGER_SQL} SELECT url, error, attempts, t_us FROM ledger")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure ledger that a stream over three stretches of the log leaves."""
    out = shared_folder(spark, "ledger-stream")
    table = sinks.LedgerFeed(spark, f"{out}/ledger")
    log = derived(spark, sf_dir, "request_log").withColumn("ts", F.timestamp_micros("t_us"))
    log = log.select(*[F.col(f.name).cast(f.dataType) for f in REQUEST_LOG], "t_us")

    def run():
        arriving = spark.readStream.schema(REQUEST_LOG).parquet(f"{out}/log")
        return crawl.start_ledger(arriving, table, f"{out}/progress")

    _arrive(log, "t_us", f"{out}/log", 3, run)
    return table.read().select("url", "error", "attempts", F.unix_micros("ts").alias("t_us"))


@query(
    "stream_distinct",
    f"""{cte('crawl_pages', 'crawl_known')} SELECT property_id, count(*) AS n FROM (
  SELECT property_id, row_number() OVER (PARTITION BY property_id ORDER BY page_id) AS k FROM crawl_pages
  WHERE property_id NOT IN (SELECT property_id FROM crawl_known)) AS r WHERE k = 1 OR property_id = '' GROUP BY property_id""",
)
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of a stream, each id once; ids leave the state a week after they came."""
    out = shared_folder(spark, "distinct-stream")
    known = derived(spark, sf_dir, "crawl_known")
    pages = derived(spark, sf_dir, "crawl_pages").select(*PAGES.names)

    def run():
        arriving = readers.stream_pages(spark, f"{out}/pages", fetched="fetched_at")
        fresh = crawl.distinct_listings(crawl.stream_listings(arriving, keep=("fetched_at",)), known, seen_at="fetched_at")
        writer = fresh.select("property_id").writeStream.option("checkpointLocation", f"{out}/progress")
        return writer.option("path", f"{out}/ids").format("parquet").trigger(availableNow=True).start()

    _arrive(pages, "page_id", f"{out}/pages", 3, run)
    return spark.read.schema("property_id string").parquet(f"{out}/ids").groupBy("property_id").agg(F.count(F.lit(1)).alias("n"))


# --- files written and read back ------------------------------------------------------------


@query("csv_round_trip", f"{PIECES} {EXPORTED_SQL}")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    sinks.write_csv(exported(spark, sf_dir), path)
    return readers.read_exported_csv(spark, path)


@query("json_lines_round_trip", f"{PIECES} {EXPORTED_SQL}")
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "json")
    sinks.write_json_lines(exported(spark, sf_dir), path)
    return readers.read_exported_json(spark, path)


@query("ledger_round_trip", f"{LEDGER_SQL} SELECT url, error, attempts, t_us FROM ledger")
def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as JSON Lines, each entry twice: the later one counts."""
    path = shared_folder(spark, "ledger")
    entries = log_ledger(spark, sf_dir).withColumn("ts", F.timestamp_micros("t_us"))
    older = entries.select("url", F.lit("older").alias("error"), (F.col("attempts") + 1).alias("attempts"), F.expr("ts - INTERVAL 1 SECOND AS ts"))
    both = entries.unionByName(older, allowMissingColumns=True)
    sinks.write_ledger_json(both.select(*[F.col(f.name).cast(f.dataType) for f in FAILURE_LEDGER]), path)
    read = readers.read_failure_ledger(spark, path, lines=True)
    return read.select("url", "error", F.col("attempts").cast("long").alias("attempts"), F.unix_micros("ts").alias("t_us"))


@query("checkpoint_round_trip", f"{cte('state')} SELECT key, value_json FROM state")
def checkpoint_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state as JSON objects, one a line, read back as keys and values."""
    path = shared_folder(spark, "state")
    state = derived(spark, sf_dir, "state")
    state.select(F.to_json(F.create_map("key", F.parse_json("value_json"))).alias("value")).write.text(path)
    return readers.read_checkpoint(spark, path, lines=True)


@query(
    "log_lines_round_trip",
    f"""{cte('request_log')} SELECT CAST(t_us AS VARCHAR) AS ts, upper(outcome) AS level, phase AS logger, error AS msg, CAST(seq AS VARCHAR) AS seq
FROM request_log""",
)
def log_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows as JSON lines; a field beyond the fixed ones comes back from the map."""
    path = shared_folder(spark, "log")
    log = derived(spark, sf_dir, "request_log")
    line = F.struct(
        F.col("t_us").cast("string").alias("ts"), F.upper("outcome").alias("level"), F.col("phase").alias("logger"),
        F.col("error").alias("msg"), F.col("seq").cast("string").alias("seq"),
    )
    log.select(F.to_json(line).alias("value")).write.text(path)
    return readers.read_log_lines(spark, path).select("ts", "level", "logger", "msg", F.col("extra")["seq"].alias("seq"))


@query(
    "dedup_export",
    f"""{PIECES}, listing AS ({EXPORTED_SQL}) SELECT property_id, count(*) AS n FROM (SELECT DISTINCT property_id FROM listing) AS d GROUP BY property_id""",
)
def dedup_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export written twice, then written anew with the first row of each id."""
    source, target = shared_folder(spark, "export"), shared_folder(spark, "distinct-export")
    rows = written(exported(spark, sf_dir))
    for _ in range(2):
        sinks.write_csv(rows, source)
    jobs.dedup_export(spark, source, target)
    return readers.read_exported_csv(spark, target).groupBy("property_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "table_merge",
    f"""{PIECES}, listing AS ({EXPORTED_SQL}) SELECT property_id, title, CASE WHEN CAST(substr(property_id, 3) AS BIGINT) % 5 = 0 THEN price + 1 ELSE price END AS price
FROM listing WHERE property_id IS NOT NULL UNION ALL SELECT 'set aside', CAST(count(*) AS VARCHAR), NULL FROM listing WHERE property_id IS NULL""",
)
def table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table after all listings and then a batch that changes every fifth; rows without id are set aside."""
    out = shared_folder(spark, "table")
    table = sinks.ListingTable(spark, out)
    rows = written(exported(spark, sf_dir))
    table(rows, "0")
    changed = table.read().where("CAST(substr(property_id, 3) AS BIGINT) % 5 = 0").withColumn("price", F.col("price") + 1)
    table(changed.drop("scraped_at"), "1")
    aside = table.set_aside().agg(F.count(F.lit(1)).cast("string").alias("title"))
    aside = aside.select(F.lit("set aside").alias("property_id"), "title", F.lit(None).cast("double").alias("price"))
    return table.read().select("property_id", "title", "price").unionByName(aside)
