"""Readers: fetched pages, failure ledger, checkpoint, exported CSV, log lines."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.functions.text import blank_to_null
from gleanframe.operators.dedup import _pick_row
from gleanframe.schemas import EXPORT, FAILURE_LEDGER, LOG_LINES, PAGES

logger = logging.getLogger(__name__)


def _or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """What ``read`` gives, or an empty frame when the path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with less partitions than cores is dealt out to all of them.

    Meant for scans ahead of heavy per-row work; a big table already has enough
    partitions and is left alone. Planning a scan's partitions runs no job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.schema(PAGES).parquet(path))


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 50, fetched: str | None = None) -> DataFrame:
    """Pages as they arrive; the number of files bounds a micro-batch.

    ``fetched`` adds a column with the time at which a page's file was written.
    """
    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    if fetched is None:
        return pages
    return pages.select("*", F.col("_metadata.file_modification_time").alias(fetched))


def read_failure_ledger(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Ledger from a JSON array file, or from JSON Lines; the last entry of a URL counts.

    The last is that with the latest time; of equal times the one farthest back by file
    name and place in the file.

    An array file is one document and so read by one task; ledgers of any size
    are kept as snapshots or JSON Lines. A missing file is an empty ledger; so is, with a warning, a file that is no
    valid JSON or has an entry without url.
    """
    stored = T.StructType([T.StructField("timestamp" if f.name == "ts" else f.name, f.dataType) for f in FAILURE_LEDGER])
    with_bad = T.StructType([*stored.fields, T.StructField("_bad", T.StringType())])
    rows = _or_empty(
        spark,
        lambda: spark.read.schema(with_bad)
        .options(multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")),
        T.StructType([*with_bad.fields, T.StructField("_file", T.StringType()), T.StructField("_block", T.LongType())]),
    )
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    if not rows.filter("_bad is not null or url is null").isEmpty():
        logger.warning("failure ledger at %s is corrupt, starting with an empty one", path)
        return spark.createDataFrame([], FAILURE_LEDGER)
    latest = _pick_row(rows, [F.col("url")], ["timestamp", "_file", "_block", "_at"], latest=True)
    return latest.select("url", "error", "attempts", F.col("timestamp").alias("ts"))


def read_checkpoint(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A JSON object file as ``key, value_json`` rows; nothing when missing or corrupt.

    The file is one document for one task; ``lines`` reads one object from each line instead.
    """
    text = T.StructType([T.StructField("value", T.StringType())])
    whole = _or_empty(spark, lambda: spark.read.text(path, wholetext=not lines), text)
    entries = whole.select(F.explode(F.from_json("value", "map<string,variant>")).alias("key", "value"))
    return entries.select("key", F.to_json("value").alias("value_json"))


def read_exported_csv(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """Exported listings with the fixed schema; empty fields are null.

    ``position`` adds ``_file`` and ``_at``, which order rows as they were written.
    """
    rows = spark.read.schema(EXPORT).options(
        header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", enforceSchema=True
    ).csv(path)
    placed = [F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at")]
    return rows.select(
        *[f.name if f.name == "price" else blank_to_null(f.name).alias(f.name) for f in EXPORT],
        *(placed if position else []),
    )


def read_exported_json(spark: SparkSession, path: str, corrupt: str | None = None) -> DataFrame:
    """Exported listings from JSON Lines; ``corrupt`` names a column for lines that are no valid listing."""
    schema = EXPORT if corrupt is None else T.StructType([*EXPORT.fields, T.StructField(corrupt, T.StringType())])
    options = {} if corrupt is None else {"columnNameOfCorruptRecord": corrupt}
    return _or_empty(spark, lambda: spark.read.schema(schema).options(**options).json(path), schema)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Structured log lines; fields beyond the fixed ones go to the map ``extra``."""
    fields = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("f"))
    names = [field.name for field in LOG_LINES]
    extra = F.map_filter("f", lambda key, _: ~key.isin(*names))
    return fields.select(*[F.try_element_at("f", F.lit(name)).alias(name) for name in names], extra.alias("extra"))
