"""Pacing, circuit state, back-off and delay adaption replayed over a request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanframe.functions.net import RATE_LIMIT_STATUS, backoff_delay, parse_retry_after
from gleanframe.operators.ordered import (
    OrderedRows,
    running_count,
    running_last,
    running_max,
    running_sum,
)

FOLD_ROWS = 16384
MULTIPLIER_MAX = 20.0


def politeness_schedule(
    log: DataFrame,
    rate: float,
    burst: float | None = None,
    host: str = "host",
    time: str = "t",
    order: list[str] = ["t", "seq"],
    chunks: int | None = None,
) -> DataFrame:
    """Earliest send time per request under a token bucket (full at first, in order).

    With T = 1/rate and i counted from 0, the bucket is due again at
    ``(i+1)T + max over j<=i of (t_j - jT)``. Adds ``granted``, ``waited`` and
    ``tokens_left`` (seconds as in ``time``). The bucket holds one second's
    worth of requests, at least one, when ``burst`` is not given.
    """
    period = 1.0 / rate
    burst = burst or max(1, int(rate))
    numbered = OrderedRows.of(log, [host], order, chunks=chunks).running(_n=running_count())
    lead = F.col(time) - (F.col("_n") - 1) * period
    led = numbered.running(exclusive=True, _led=running_max(lead)).df
    # when the bucket was due again after the request before, and after this one
    ready = (F.col("_n") - 1) * period + F.col("_led")
    due = F.col("_n") * period + F.greatest("_led", lead)
    return (
        led.withColumn("granted", F.greatest(F.col(time), ready - (burst - 1) * period))
        .withColumn("waited", F.col("granted") - F.col(time))
        .withColumn("tokens_left", burst - (due - F.col("granted")) / period)
        .drop("_n", "_led")
    )


def _circuit(
    log: DataFrame, threshold: int, recovery_secs: float, host: str, time: str, order: list[str], chunks: int | None
) -> OrderedRows:
    failed = F.col("failed")
    counted = OrderedRows.of(log, [host], order, chunks=chunks).running(
        exclusive=True,
        _fails=running_sum(failed.cast("long")),
        _last_fail=running_last(F.when(failed, F.col(time))),
    )
    since = counted.running(exclusive=True, _at_success=running_max(F.when(~failed, F.col("_fails"))))
    in_row = F.col("_fails") - F.coalesce("_at_success", F.lit(0))
    state = (
        F.when(in_row < threshold, "CLOSED")
        .when(F.col(time) - F.col("_last_fail") >= recovery_secs, "HALF_OPEN")
        .otherwise("OPEN")
    )
    return since.with_columns(failures_in_row=in_row, state=state)


def circuit_state(
    log: DataFrame,
    threshold: int = 5,
    recovery_secs: float = 30.0,
    host: str = "host",
    time: str = "t",
    order: list[str] = ["t", "seq"],
    chunks: int | None = None,
) -> DataFrame:
    """Breaker state each logged request met; ``failed`` tells its own outcome."""
    rows = _circuit(log, threshold, recovery_secs, host, time, order, chunks)
    return rows.df.drop("_fails", "_last_fail", "_at_success")


def outage_intervals(
    log: DataFrame,
    threshold: int = 5,
    recovery_secs: float = 30.0,
    host: str = "host",
    time: str = "t",
    order: list[str] = ["t", "seq"],
    chunks: int | None = None,
) -> DataFrame:
    """When the breaker opened, the success that closed it (null while open), failures.

    A streak of failures and the success ending it share the number of
    successes before them, which makes that number the interval's key.
    """
    failed = F.col("failed")
    rows = _circuit(log, threshold, recovery_secs, host, time, order, chunks).running(
        exclusive=True, _successes=running_sum((~failed).cast("long"))
    )
    tripped = failed & (F.col("failures_in_row") + 1 >= threshold)
    spans = rows.df.groupBy(host, "_successes").agg(
        F.min(F.when(tripped, F.col(time))).alias("opened_at"),
        F.max(F.when(~failed, F.col(time))).alias("closed_at"),
        F.count_if(failed).alias("failures"),
    )
    return spans.filter("opened_at is not null").drop("_successes")


def _step(outcome: Column) -> Column:
    """A request's effect on the multiplier x: ``min(hi, max(lo, a*x))``."""
    factor = F.when(outcome == "rate_limited", 2.0).when(outcome == "success", 0.9).otherwise(1.0)
    return F.struct(factor.alias("a"), F.lit(1.0).alias("lo"), F.lit(MULTIPLIER_MAX).alias("hi"))


def _chained(first: Column, then: Column) -> Column:
    """Two effects in a row are one effect of the same form."""
    through = lambda bound: F.least(then.hi, F.greatest(then.lo, then.a * bound))
    # beyond these factors the bounds alone decide
    factor = F.least(F.greatest(first.a * then.a, F.lit(1e-6)), F.lit(1e6))
    return F.struct(factor.alias("a"), through(first.lo).alias("lo"), through(first.hi).alias("hi"))


def delay_multiplier(
    log: DataFrame,
    host: str = "host",
    outcome: str = "outcome",
    order: list[str] = ["t", "seq"],
    chunks: int | None = None,
) -> DataFrame:
    """Delay multiplier per host after its log: doubled (to 20) when rate limited,
    times 0.9 (down to 1) on success, kept on other errors; starts at 1.

    Effects chain associatively, so the log is folded in slices of FOLD_ROWS
    requests, then slices of slices; no list ever holds more than FOLD_ROWS.
    """
    folded = (
        OrderedRows.of(log.select(host, *order, outcome), [host], order, chunks=chunks)
        .running(_n=running_count())
        .df.select(host, (F.col("_n") - 1).alias("_n"), _step(F.col(outcome)).alias("effect"))
        .withColumn("requests", F.lit(1).cast("long"))
    )
    nothing = F.struct(F.lit(1.0).alias("a"), F.lit(1.0).alias("lo"), F.lit(MULTIPLIER_MAX).alias("hi"))
    for _ in range(3):  # FOLD_ROWS ** 3 requests per host
        slices = folded.groupBy(host, F.floor(F.col("_n") / FOLD_ROWS).alias("_n")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("_n").alias("n"), "effect"))).alias("steps"),
            F.sum("requests").alias("requests"),
        )
        effect = F.aggregate("steps", nothing, lambda done, step: _chained(done, step.effect))
        folded = slices.select(host, "_n", effect.alias("effect"), "requests")
    start = F.least(F.col("effect.hi"), F.greatest(F.col("effect.lo"), F.col("effect.a")))
    return folded.select(host, "requests", start.alias("multiplier"))


def retry_schedule(
    attempts: DataFrame,
    request: str = "request_id",
    attempt: str = "attempt",
    max_attempts: int = 4,
    base_delay: float = 1.0,
    max_delay: float = 60.0,
    default_retry_after: float | None = 10.0,
    now: Column | float = 0.0,
    jitter_seed: int | None = None,
) -> DataFrame:
    """Delay after each attempt (from 1) and when the attempt may start at the earliest.

    Rate-limited answers wait for their Retry-After header, or for
    ``default_retry_after`` without a readable one; other failures back off. After
    the last allowed attempt there is no delay; ``allowed`` tells attempts beyond
    ``max_attempts``, which were made outside the policy.
    """
    allowed = attempts.withColumn("allowed", F.col(attempt) <= max_attempts)
    limited = F.col("status").isin(*RATE_LIMIT_STATUS)
    header = F.coalesce(parse_retry_after("retry_after", now), F.lit(default_retry_after).cast("double"))
    delay = backoff_delay(F.col(attempt) - 1, F.when(limited, header), base_delay, max_delay, jitter_seed)
    failed = F.col("status") >= 400
    last = (F.col(attempt) > max_attempts) | ((F.col(attempt) == max_attempts) & ~limited)
    earlier = (
        Window.partitionBy(request).orderBy(attempt).rowsBetween(Window.unboundedPreceding, -1)
    )
    return allowed.withColumn("delay_after", F.when(failed & ~last, delay).otherwise(0.0)).withColumn(
        "not_before", F.coalesce(F.sum("delay_after").over(earlier), F.lit(0.0))
    )


def exhausted_requests(attempts: DataFrame, request: str = "request_id", max_attempts: int = 4) -> DataFrame:
    """Requests that failed at least ``max_attempts`` times and never succeeded."""
    tried = attempts.groupBy(request).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") < 400).alias("_ok"),
        F.max_by("status", "attempt").alias("last_status"),
    )
    return tried.filter((F.col("attempts") >= max_attempts) & (F.col("_ok") == 0)).drop("_ok")
