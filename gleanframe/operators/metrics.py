"""Counters, gauges, durations and reports as pre-aggregating groupings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions.net import is_retryable, metric_key


def counters(metrics: DataFrame) -> DataFrame:
    """Sum per metric key over the counter rows."""
    rows = metrics.filter("kind = 'counter'")
    return rows.groupBy(metric_key("name", "labels").alias("key")).agg(F.sum("value").alias("value"))


def gauges(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Last value per metric key over the gauge rows."""
    rows = metrics.filter("kind = 'gauge'")
    return rows.groupBy(metric_key("name", "labels").alias("key")).agg(
        F.max_by("value", F.struct(*order)).alias("value")
    )


def snapshot(metrics: DataFrame, order: list[str]) -> DataFrame:
    """Counters and gauges together, with their kind."""
    return counters(metrics).withColumn("kind", F.lit("counter")).unionByName(
        gauges(metrics, order).withColumn("kind", F.lit("gauge"))
    )


def duration_totals(rows: DataFrame, operation: str, seconds: str) -> DataFrame:
    return rows.groupBy(operation).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(seconds).alias("total_secs")
    )


def worker_stats(log: DataFrame) -> DataFrame:
    """Per worker: pages scraped, errors, retryable errors, seconds spent on scraped pages."""
    failed = F.col("error").isNotNull()
    return log.groupBy("worker_id").agg(
        F.count_if(~failed).alias("scraped"),
        F.count_if(failed).alias("errors"),
        F.count_if(failed & is_retryable("error")).alias("retryable_errors"),
        F.coalesce(F.sum(F.when(~failed, F.col("duration_secs"))), F.lit(0.0)).alias("total_duration"),
    )


def crawl_report(log: DataFrame, seconds: Column) -> DataFrame:
    """Throughput and recovery of a crawl from its request log, one row.

    ``seconds`` is the time stamp in epoch seconds. A URL counts as recovered
    when it failed in the crawl and a retry of it succeeded.
    """
    failed = F.col("error").isNotNull()
    retry = F.col("phase") == "retry"
    per_url = log.withColumn("_s", seconds).groupBy("url").agg(
        F.count_if(~failed).alias("ok"),
        F.count_if(failed & ~retry).alias("crawl_failures"),
        F.count_if(~failed & retry).alias("retry_ok"),
        F.min("_s").alias("first"),
        F.max("_s").alias("last"),
    )
    minutes = (F.max("last") - F.min("first")) / 60
    lost = F.col("crawl_failures") > 0
    n_failed, n_recovered = F.count_if(lost), F.count_if(lost & (F.col("retry_ok") > 0))
    return per_url.agg(
        F.sum("ok").alias("scraped"),
        F.round(F.sum("ok") / F.nullif(minutes, F.lit(0)), 6).alias("per_minute"),
        n_failed.alias("failed_urls"),
        n_recovered.alias("recovered_urls"),
        F.round(n_recovered / F.nullif(n_failed, F.lit(0)), 6).alias("recovery_rate"),
    )
