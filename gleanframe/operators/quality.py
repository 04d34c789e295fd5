"""Completeness checks and reports; rows are annotated, never dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.schemas import REQUIRED_FIELDS


UNREAD = "Page could not be read to its end"


def missing_fields(required: tuple[str, ...] = REQUIRED_FIELDS) -> Column:
    """Error texts for required fields that are null or empty, in field order."""
    checks = [
        F.when(F.coalesce(F.col(name).cast("string"), F.lit("")) == "", f"Missing required field: {name}")
        for name in required
    ]
    return F.array_compact(F.array(*checks))


def validate(listings: DataFrame, error: str | None = None) -> DataFrame:
    """Add ``validation: struct<is_valid, errors>``.

    ``error`` names a column that tells why a page could not be read, which is an error of its own.
    """
    errors = missing_fields()
    if error is not None:
        unread = F.when(F.col(error).isNotNull(), F.array(F.lit(UNREAD))).otherwise(F.array().cast("array<string>"))
        errors = F.concat(errors, unread)
    return listings.withColumn(
        "validation", F.struct((F.size(errors) == 0).alias("is_valid"), errors.alias("errors"))
    )


def quality_report(validated: DataFrame) -> DataFrame:
    """How often each validation error occurs."""
    errors = validated.select(F.explode("validation.errors").alias("error"))
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def field_null_rates(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Share of missing values per field, in one pass over the rows."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.coalesce(F.col(name).cast("string"), F.lit("")) == "").alias(name) for name in fields],
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("missing")) for name in fields])
    )
    return counts.select("_rows", pairs.alias("f")).select(
        "f.field", "f.missing", F.round(F.col("f.missing") / F.greatest("_rows", F.lit(1)), 6).alias("null_rate")
    )


def extraction_drift(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows only in one of two extraction results, with the side they are on."""
    both = now.withColumn("_n", F.lit(1)).unionByName(before.withColumn("_n", F.lit(-1)))
    # rows that both have cancel out; what is left over comes as often as it is left
    left = both.groupBy(*now.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n")))
    side = F.when(F.col("_n") > 0, "now").otherwise("before").alias("side")
    return left.select(*now.columns, side, each.alias("_copy")).drop("_copy")
