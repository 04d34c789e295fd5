"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanframe.operators.extract import export_rows
from gleanframe.plans import log_queries, page_queries, run_queries, text_queries, whole_queries  # noqa: F401  (they register)
from gleanframe.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to the export columns of a clean, deduplicated listing table."""
    return export_rows(page_queries.crawl_to_table(spark, sf_dir))
