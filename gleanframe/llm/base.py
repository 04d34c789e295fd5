"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.session import cut_lineage

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where body's lambdas use it per element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs of characters outside ``[\\x20\\x09-\\x0D]``; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    none = F.array().cast("array<string>")
    return let(trimmed, lambda t: F.when(t == "", none).otherwise(F.split(t, SPACE_RUN)))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; pure ASCII takes the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def positions(first: int | Column, last: Column) -> Column:
    """The whole numbers from ``first`` to ``last``; none if last is smaller."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the checkpoint folder that all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        cut_lineage(spark.range(1))  # settles the folder
    return f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
