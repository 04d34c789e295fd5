"""Sinks and the batch contract: write first, then mark; replays change nothing."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.operators.dedup import known_records, new_records
from gleanframe.operators.extract import export_rows
from gleanframe.operators.upsert import upsert_merge
from gleanframe.schemas import EXPORT, EXPORT_COLUMNS, FAILURE_LEDGER, INT, LONG, STRING, TIME, struct_of
from gleanframe.session import written
from gleanframe.sources.readers import _or_empty

logger = logging.getLogger(__name__)

# A sink takes a batch and its tag; writing the same tag again must replace it.
Sink = Callable[[DataFrame, str], None]


def write_csv(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Export columns as CSV parts: header, all fields quoted, null as empty."""
    export_rows(rows).write.mode(mode).options(
        header=True, quoteAll=True, quote='"', escape='"', nullValue="", emptyValue="", encoding="UTF-8"
    ).csv(path)


def write_json_lines(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Export columns as JSON Lines; nulls are written, letters are not escaped."""
    export_rows(rows).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_ledger_json(ledger: DataFrame, path: str) -> None:
    """Failure ledger as JSON Lines with the stored field names."""
    stamp = F.date_format(F.to_utc_timestamp("ts", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    ledger.select("url", "error", "attempts", stamp.alias("timestamp")).write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)


class SnapshotTable:
    """A table replaced as a whole: new version first, then one row that makes it current.

    A tag names the batch a version came from. A batch run again starts from
    the version before its own, so its effect is not applied twice; batches after
    it are then to be run again as well, as a restarted stream does.
    """

    _LOG = struct_of(version=LONG, tag=STRING)

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self._spark, self._path, self._schema = spark, path, schema

    def _versions(self) -> DataFrame:
        return _or_empty(
            self._spark, lambda: self._spark.read.schema(self._LOG).json(f"{self._path}/versions"), self._LOG
        )

    def read(self, before_tag: str | None = None) -> DataFrame:
        versions = self._versions()
        if before_tag is not None:
            own = versions.filter(F.col("tag") == before_tag).agg(F.min("version").alias("v")).first().v
            versions = versions if own is None else versions.filter(F.col("version") < own)
        current = versions.agg(F.max("version").alias("v")).first().v
        if current is None:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(f"{self._path}/data/v{current}")

    def replace(self, rows: DataFrame, tag: str = "") -> None:
        latest = self._versions().agg(F.max("version").alias("v")).first().v
        version = (latest or 0) + 1
        rows.select(*self._schema.names).write.mode("overwrite").parquet(f"{self._path}/data/v{version}")
        self._spark.createDataFrame([(version, tag)], self._LOG).write.mode("append").json(f"{self._path}/versions")

    def clear(self) -> None:
        self.replace(self._spark.createDataFrame([], self._schema))


class KnownIds:
    """Ids a sink has taken: one small part per batch, appended, never rewritten."""

    _IDS = struct_of(property_id=STRING, batch=STRING)

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def read(self, before_tag: str | None = None) -> DataFrame:
        """All ids; without those of the named batch, so that it can be run again."""
        ids = _or_empty(self._spark, lambda: self._spark.read.schema(self._IDS).parquet(self._path), self._IDS)
        if before_tag is not None:
            ids = ids.filter(F.col("batch") != before_tag)
        return ids.select("property_id")

    def add(self, rows: DataFrame, tag: str) -> None:
        ids = rows.select("property_id").filter("property_id <> ''").distinct()
        ids.write.mode("overwrite").parquet(f"{self._path}/batch={tag}")


class LedgerFeed:
    """The failure ledger as the changes of each batch; the latest change of a URL counts.

    A batch writes only the URLs it names; one that is run again overwrites its own part.
    """

    _CHANGES = struct_of(url=STRING, error=STRING, attempts=INT, ts=TIME, batch=STRING)

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def add(self, changes: DataFrame, tag: str) -> None:
        changes.select("url", "error", "attempts", "ts").write.mode("overwrite").parquet(f"{self._path}/batch={tag}")

    def read(self) -> DataFrame:
        changes = _or_empty(self._spark, lambda: self._spark.read.schema(self._CHANGES).parquet(self._path), self._CHANGES)
        entry = F.struct("error", "attempts", "ts")
        latest = changes.groupBy("url").agg(F.max_by(entry, "batch").alias("entry"))
        return latest.select("url", "entry.*").filter("attempts is not null")


class BucketedTable:
    """A keyed table in buckets by a hash of the key; a version replaces only the buckets it names.

    A version's files come first, then the rows that make it the current one of its buckets.
    Buckets it does not name keep their files. A tag names the batch a version came from, and a
    batch run again starts from what was there before it, as in ``SnapshotTable``.
    """

    _LOG = struct_of(version=LONG, tag=STRING, bucket=INT)

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self._spark, self._path, self._schema, self._key, self.buckets = spark, path, schema, key, buckets

    def bucket_of(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _versions(self) -> DataFrame:
        log = _or_empty(self._spark, lambda: self._spark.read.schema(self._LOG).json(f"{self._path}/versions"), self._LOG)
        return log

    def current(self, before_tag: str | None = None) -> dict[int, int]:
        """The current version of each bucket that has rows; as many entries as buckets at most."""
        log = self._versions()
        if before_tag is not None:
            own = log.filter(F.col("tag") == before_tag).agg(F.min("version").alias("v")).first().v
            log = log if own is None else log.filter(F.col("version") < own)
        return {row.bucket: row.v for row in log.groupBy("bucket").agg(F.max("version").alias("v")).collect()}

    def read(self, only: list[int] | None = None, before_tag: str | None = None) -> DataFrame:
        current = self.current(before_tag)
        paths = [f"{self._path}/data/v={v}/bucket={b}" for b, v in sorted(current.items()) if only is None or b in only]
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)

    def replace(self, rows: DataFrame, buckets: list[int], tag: str = "") -> None:
        """Make ``rows`` the content of ``buckets``, all of which must then hold some row."""
        latest = self._versions().agg(F.max("version").alias("v")).first().v
        version = (latest or 0) + 1
        placed = rows.select(*self._schema.names, self.bucket_of(self._key).alias("bucket"))
        spread = placed.repartition("bucket", F.pmod(F.xxhash64(self._key, F.lit(1)), F.lit(8)))
        spread.write.mode("overwrite").partitionBy("bucket").parquet(f"{self._path}/data/v={version}")
        entries = [(version, tag, bucket) for bucket in buckets]
        self._spark.createDataFrame(entries, self._LOG).coalesce(1).write.mode("append").json(f"{self._path}/versions")


class ListingTable:
    """The keyed listing table as a sink; a merge reads and writes only the buckets of its ids.

    Rows without id have no place in it and are set aside, batch by batch. ``_order`` tells
    which row of a repeated id is the last; without it the URL does.
    """

    def __init__(self, spark: SparkSession, path: str, now: Column | None = None, buckets: int = 64):
        schema = T.StructType([*EXPORT.fields, *struct_of(scraped_at=TIME).fields])
        self._spark, self._path, self._now = spark, path, now
        self._table = BucketedTable(spark, f"{path}/table", schema, "property_id", buckets)

    def read(self) -> DataFrame:
        return self._table.read()

    def set_aside(self) -> DataFrame:
        """The rows without id of all batches."""
        return _or_empty(self._spark, lambda: self._spark.read.schema(EXPORT).json(f"{self._path}/set_aside/batch=*"), EXPORT)

    def __call__(self, rows: DataFrame, tag: str) -> None:
        ordered = rows if "_order" in rows.columns else rows.withColumn("_order", F.col("url"))
        batch = export_rows(ordered, keep=("_order",))
        named = batch.filter("property_id <> ''")
        write_json_lines(batch.filter("property_id is null or property_id = ''"), f"{self._path}/set_aside/batch={tag}", "overwrite")
        touched = [row.b for row in named.select(self._table.bucket_of("property_id").alias("b")).distinct().collect()]
        if not touched:
            return
        now = self._now if self._now is not None else F.current_timestamp()
        # merging the same batch once more changes nothing, so no version is skipped
        merged = upsert_merge(self._table.read(touched), named, ["_order"], now, list(EXPORT_COLUMNS))
        self._table.replace(merged, touched, tag)


def build_sinks(spark: SparkSession, names: str | list[str], out: str) -> dict[str, Sink]:
    """Sinks by name (``csv``, ``json``, ``table``), from a list or a comma-separated text."""
    wanted = [n.strip().lower() for n in (names.split(",") if isinstance(names, str) else names) if n.strip()]
    makers: dict[str, Callable[[], Sink]] = {
        "csv": lambda: lambda rows, tag: write_csv(rows, f"{out}/csv/batch={tag}", "overwrite"),
        "json": lambda: lambda rows, tag: write_json_lines(rows, f"{out}/json/batch={tag}", "overwrite"),
        "table": lambda: ListingTable(spark, f"{out}/table"),
    }
    unknown = [name for name in wanted if name not in makers]
    if unknown:
        raise ValueError(f"unknown sinks: {', '.join(unknown)}")
    if not wanted:
        raise ValueError("no sinks configured")
    return {name: makers[name]() for name in wanted}


class Exporter:
    """Writes batches to all sinks; one failing sink does not stop the others.

    Each sink has its own known ids, marked only after it took the rows: what a
    failed sink missed is still new to it next time.
    """

    def __init__(self, spark: SparkSession, sinks: dict[str, Sink], state_path: str):
        if not sinks:
            raise ValueError("no sinks configured")
        self.sinks = sinks
        self._known = {name: KnownIds(spark, f"{state_path}/known_ids/{name}") for name in sinks}

    def known(self, sink: str, before_tag: str | None = None) -> DataFrame:
        return self._known[sink].read(before_tag)

    def export(self, rows: DataFrame, tag: str) -> dict[str, int | None]:
        """Rows each sink took, None for a sink that failed; raises if all failed."""
        # in the shared folder, so that no lost executor makes the pages be read again
        rows = written(rows)
        taken: dict[str, int | None] = {}
        failure: Exception | None = None
        if rows.isEmpty():
            return dict.fromkeys(self.sinks, 0)
        for name, sink in self.sinks.items():
            try:
                taken[name] = self._write(name, sink, rows, tag)
            except Exception as error:
                logger.error("sink %s failed on batch %s: %s", name, tag, error)
                taken[name], failure = None, error
        if failure is not None and all(count is None for count in taken.values()):
            raise failure
        return taken

    def _write(self, name: str, sink: Sink, rows: DataFrame, tag: str) -> int:
        # known ids outgrow any batch: first keep those the batch asks for, which
        # needs no shuffle of them while the ids of the batch fit a broadcast
        asked = rows.select("property_id").filter("property_id <> ''").distinct()
        fresh = written(new_records(rows, known_records(self.known(name, before_tag=tag), asked)))
        count = fresh.count()
        if count:
            sink(fresh, tag)
            self._known[name].add(fresh, tag)
        return count


def ledger_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, FAILURE_LEDGER)
