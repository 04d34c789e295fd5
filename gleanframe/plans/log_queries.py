"""Queries over the request log: ledger, retry, pacing, circuit, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanframe.operators import ledger, metrics, requestlog
from gleanframe.plans.inputs import LOG_ORDER, NOW, cte, derived
from gleanframe.plans.registry import query
from gleanframe.plans.text_queries import SQL_RETRY_AFTER, sql_retryable

_LOG = cte("request_log")
_RETRYABLE = f"coalesce({sql_retryable('error')}, false)"
MAX_TRIES = 2  # low, so that entries over the limit exist
RATE, BURST = 1 / 4000, 3.0
TRIP, RECOVERY = 3, 3600.0


def _log(spark, sf_dir):
    return derived(spark, sf_dir, "request_log")


def log_ledger(spark, sf_dir):
    return ledger.failure_ledger(_log(spark, sf_dir), order=LOG_ORDER)


# --- ledger -------------------------------------------------------------------------

LEDGER_SQL = f"""{cte('request_log', 'retry_results', 'retry_known')},
acts AS (SELECT url, (t_us, seq) AS o, t_us, error, phase = 'crawl' AND {_RETRYABLE} AS opens, phase = 'retry' AND {_RETRYABLE} AS raises,
  phase = 'retry' AND NOT {_RETRYABLE} AS removes FROM request_log),
resets AS (SELECT url, max(o) AS reset FROM acts WHERE removes GROUP BY url),
tail AS (SELECT a.* FROM acts AS a LEFT JOIN resets AS r ON r.url = a.url WHERE r.reset IS NULL OR a.o > r.reset),
firsts AS (SELECT url, min(o) AS first_open FROM tail WHERE opens GROUP BY url),
ledger AS (SELECT t.url, arg_max(error, o) FILTER (WHERE opens) AS error, count(*) FILTER (WHERE opens OR raises) AS attempts,
  max(t_us) FILTER (WHERE opens) AS t_us FROM tail AS t JOIN firsts AS f ON f.url = t.url AND t.o >= f.first_open GROUP BY t.url)"""


@query("failure_ledger", f"{LEDGER_SQL} SELECT url, error, attempts, t_us FROM ledger")
def failurelog_ledger(spark, sf_dir):
    return log_ledger(spark, sf_dir)


@query(
    "timeout_failures",
    f"""{_LOG} SELECT seq, duration_secs > 50 AS timed_out, CASE WHEN duration_secs > 50 THEN 'timeout after 50.0s' ELSE error END AS error
FROM request_log""",
)
def timeout_failures(spark, sf_dir):
    return ledger.with_timeouts(_log(spark, sf_dir), 50).select("seq", "timed_out", "error")


@query("retry_pending", f"{LEDGER_SQL} SELECT url, attempts FROM ledger WHERE attempts <= {MAX_TRIES}")
def retry_pending(spark, sf_dir):
    return ledger.pending(log_ledger(spark, sf_dir), MAX_TRIES).select("url", "attempts")


@query(
    "failure_summary",
    f"{LEDGER_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE attempts <= {MAX_TRIES}) AS pending FROM ledger",
)
def failure_summary(spark, sf_dir):
    return ledger.failure_summary(log_ledger(spark, sf_dir), MAX_TRIES)


@query(
    "retry_exports",
    f"""{LEDGER_SQL} SELECT r.url, r.property_id FROM retry_results AS r JOIN ledger AS l ON l.url = r.url AND l.attempts <= {MAX_TRIES}
WHERE r.tried AND r.error IS NULL AND (r.property_id IS NULL OR r.property_id NOT IN (SELECT property_id FROM retry_known))""",
)
def retry_exports(spark, sf_dir):
    waiting = ledger.pending(log_ledger(spark, sf_dir), MAX_TRIES)
    results, known = derived(spark, sf_dir, "retry_results"), derived(spark, sf_dir, "retry_known")
    return ledger.retry_exports(waiting, results, known, tried=F.col("tried")).select("url", "property_id")


@query(
    "retry_summary",
    f"""{LEDGER_SQL}, tried AS (SELECT l.attempts, l.attempts <= {MAX_TRIES} AS due, coalesce(r.tried, false) AND l.attempts <= {MAX_TRIES} AS tried,
  r.error, {_RETRYABLE.replace('error', 'r.error')} AS again, r.property_id,
  r.property_id IN (SELECT property_id FROM retry_known) AS known FROM ledger AS l LEFT JOIN retry_results AS r ON r.url = l.url)
SELECT count(*) FILTER (WHERE due) AS retried, count(*) FILTER (WHERE NOT due) AS skipped,
  count(*) FILTER (WHERE tried AND error IS NULL) AS succeeded,
  count(*) FILTER (WHERE tried AND error IS NULL AND NOT coalesce(known, false)) AS exported,
  count(*) FILTER (WHERE tried AND again) AS failed_retryable,
  count(*) FILTER (WHERE tried AND error IS NOT NULL AND NOT again) AS failed_permanent,
  count(*) FILTER (WHERE due AND (NOT tried OR (again AND attempts < {MAX_TRIES}))) AS remaining FROM tried""",
)
def retry_summary(spark, sf_dir):
    results, known = derived(spark, sf_dir, "retry_results"), derived(spark, sf_dir, "retry_known")
    return ledger.retry_summary(log_ledger(spark, sf_dir), results, known, MAX_TRIES, tried=F.col("tried"))


# --- pacing, circuit, delay ----------------------------------------------------------

_W = "PARTITION BY host ORDER BY t_us, seq"


@query(
    "politeness_schedule",
    f"""{_LOG}, numbered AS (SELECT *, row_number() OVER ({_W}) - 1 AS i FROM request_log),
due AS (SELECT *, (i + 1) * (1.0 / {RATE!r}) + max(t - i * (1.0 / {RATE!r})) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS tat FROM numbered),
sent AS (SELECT *, greatest(t, lag(tat) OVER ({_W}) - ({BURST} - 1) * (1.0 / {RATE!r})) AS granted FROM due)
SELECT seq, round(granted, 3) AS granted, round(granted - t, 3) AS waited, round({BURST} - (tat - granted) / (1.0 / {RATE!r}), 3) AS tokens_left FROM sent""",
)
def politeness_schedule(spark, sf_dir):
    rows = requestlog.politeness_schedule(_log(spark, sf_dir), RATE, BURST, order=LOG_ORDER)
    return rows.select("seq", *[F.round(name, 3).alias(name) for name in ("granted", "waited", "tokens_left")])


_CIRCUIT_SQL = f"""{_LOG}, isl AS (SELECT *, coalesce(sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS successes,
  max(CASE WHEN failed THEN t END) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_fail FROM request_log),
circuit AS (SELECT *, count(*) FILTER (WHERE failed) OVER (PARTITION BY host, successes ORDER BY t_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS in_row FROM isl)"""


@query(
    "circuit_state",
    f"""{_CIRCUIT_SQL} SELECT seq, coalesce(in_row, 0) AS failures_in_row, CASE WHEN coalesce(in_row, 0) < {TRIP} THEN 'CLOSED'
  WHEN t - last_fail >= {RECOVERY} THEN 'HALF_OPEN' ELSE 'OPEN' END AS state FROM circuit""",
)
def circuit_state(spark, sf_dir):
    rows = requestlog.circuit_state(_log(spark, sf_dir), TRIP, RECOVERY, order=LOG_ORDER)
    return rows.select("seq", "failures_in_row", "state")


@query(
    "outage_intervals",
    f"""{_CIRCUIT_SQL} SELECT host, min(t) FILTER (WHERE failed AND coalesce(in_row, 0) + 1 >= {TRIP}) AS opened_at,
  max(t) FILTER (WHERE NOT failed) AS closed_at, count(*) FILTER (WHERE failed) AS failures FROM circuit
GROUP BY host, successes HAVING count(*) FILTER (WHERE failed) >= {TRIP}""",
)
def outage_intervals(spark, sf_dir):
    return requestlog.outage_intervals(_log(spark, sf_dir), TRIP, RECOVERY, order=LOG_ORDER)


@query(
    "delay_multiplier",
    f"""{_LOG} SELECT host, count(*) AS requests, round(list_reduce(list(CAST(CASE outcome WHEN 'rate_limited' THEN 2.0 WHEN 'success' THEN 0.9 ELSE 1.0 END AS DOUBLE)
  ORDER BY t_us, seq), lambda m, x: least(20.0, greatest(1.0, m * x)), CAST(1.0 AS DOUBLE)), 6) AS multiplier FROM request_log GROUP BY host""",
)
def delay_multiplier(spark, sf_dir):
    rows = requestlog.delay_multiplier(_log(spark, sf_dir), order=LOG_ORDER)
    return rows.select("host", "requests", F.round("multiplier", 6).alias("multiplier"))


_SCHEDULE_SQL = f"""{cte('attempts')}, delays AS (SELECT *, CASE WHEN status < 400 OR attempt > 4 THEN 0.0
  WHEN status IN (429, 503) THEN coalesce({SQL_RETRY_AFTER}, %s least(pow(2.0, attempt - 1), 60.0))
  WHEN attempt = 4 THEN 0.0 ELSE least(pow(2.0, attempt - 1), 60.0) END AS delay_after FROM attempts)
SELECT request_id, attempt, delay_after, coalesce(sum(delay_after) OVER (PARTITION BY request_id ORDER BY attempt
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS not_before FROM delays"""
_SCHEDULE_OUT = ["request_id", "attempt", "delay_after", "not_before"]


@query("retry_schedule", _SCHEDULE_SQL.replace("%s", "10.0,"))
def retry_schedule(spark, sf_dir):
    return requestlog.retry_schedule(derived(spark, sf_dir, "attempts"), now=NOW).select(*_SCHEDULE_OUT)


@query("retry_schedule_backoff", _SCHEDULE_SQL.replace("%s", ""))
def retry_schedule_backoff(spark, sf_dir):
    rows = requestlog.retry_schedule(derived(spark, sf_dir, "attempts"), default_retry_after=None, now=NOW)
    return rows.select(*_SCHEDULE_OUT)


@query(
    "exhausted_urls",
    f"""{cte('attempts')} SELECT request_id, count(*) AS attempts, arg_max(status, attempt) AS last_status FROM attempts
GROUP BY request_id HAVING count(*) >= 4 AND count(*) FILTER (WHERE status < 400) = 0""",
)
def exhausted_urls(spark, sf_dir):
    return requestlog.exhausted_requests(derived(spark, sf_dir, "attempts"))


# --- metrics ------------------------------------------------------------------------

_METRICS_SQL = f"""{_LOG}, metrics AS (SELECT *, CASE WHEN event_type IN ('error', 'signup') THEN 'gauge' ELSE 'counter' END AS kind,
  event_type || '{{host=' || CAST(host AS VARCHAR) || ',phase=' || phase || '}}' AS key FROM request_log),
counters AS (SELECT key, round(sum(value), 2) AS value FROM metrics WHERE kind = 'counter' GROUP BY key),
gauges AS (SELECT key, round(arg_max(value, (t_us, seq)), 2) AS value FROM metrics WHERE kind = 'gauge' GROUP BY key)"""


def _metrics(spark, sf_dir):
    return _log(spark, sf_dir).select(
        *LOG_ORDER,
        F.when(F.col("event_type").isin("error", "signup"), "gauge").otherwise("counter").alias("kind"),
        F.col("event_type").alias("name"),
        F.create_map(F.lit("phase"), F.col("phase"), F.lit("host"), F.col("host").cast("string")).alias("labels"),
        "value",
    )


def _rounded(df, column):
    return df.withColumn(column, F.round(column, 2))


@query("counters", f"{_METRICS_SQL} SELECT key, value FROM counters")
def counters(spark, sf_dir):
    return _rounded(metrics.counters(_metrics(spark, sf_dir)), "value")


@query("gauges", f"{_METRICS_SQL} SELECT key, value FROM gauges")
def gauges(spark, sf_dir):
    return _rounded(metrics.gauges(_metrics(spark, sf_dir), LOG_ORDER), "value")


@query(
    "metric_snapshot",
    f"{_METRICS_SQL} SELECT key, value, 'counter' AS kind FROM counters UNION ALL SELECT key, value, 'gauge' AS kind FROM gauges",
)
def metric_snapshot(spark, sf_dir):
    return _rounded(metrics.snapshot(_metrics(spark, sf_dir), LOG_ORDER), "value")


@query(
    "duration_totals",
    f"{_LOG} SELECT event_type, count(*) AS calls, round(sum(duration_secs), 2) AS total_secs FROM request_log GROUP BY event_type",
)
def duration_totals(spark, sf_dir):
    return _rounded(metrics.duration_totals(_log(spark, sf_dir), "event_type", "duration_secs"), "total_secs")


@query(
    "worker_stats",
    f"""{_LOG} SELECT worker_id, count(*) FILTER (WHERE NOT failed) AS scraped, count(*) FILTER (WHERE failed) AS errors,
  count(*) FILTER (WHERE {_RETRYABLE}) AS retryable_errors, round(sum(duration_secs) FILTER (WHERE NOT failed), 2) AS total_duration
FROM request_log GROUP BY worker_id""",
)
def worker_stats(spark, sf_dir):
    return _rounded(metrics.worker_stats(_log(spark, sf_dir)), "total_duration")


@query(
    "crawl_report",
    f"""{_LOG}, per_url AS (SELECT url, count(*) FILTER (WHERE NOT failed) AS ok, bool_or(failed AND phase = 'crawl') AS lost,
  bool_or(NOT failed AND phase = 'retry') AS won, min(t) AS a, max(t) AS z FROM request_log GROUP BY url)
SELECT CAST(sum(ok) AS BIGINT) AS scraped, round(sum(ok) / ((max(z) - min(a)) / 60), 6) AS per_minute, count(*) FILTER (WHERE lost) AS failed_urls,
  count(*) FILTER (WHERE lost AND won) AS recovered_urls, round(count(*) FILTER (WHERE lost AND won) / count(*) FILTER (WHERE lost), 6) AS recovery_rate
FROM per_url""",
)
def crawl_report(spark, sf_dir):
    return metrics.crawl_report(_log(spark, sf_dir), F.col("t"))
