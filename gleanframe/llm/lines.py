"""Line dedup over levelled sorted runs of line hashes.

The lines seen so far are kept as runs: tables of (hash, documents, largest id), bucketed and
sorted by hash, in which each line has exactly one entry. A new batch of documents is aggregated
and merge-anti-joined with the runs there are: lines that no run holds become the entries of a
new run, the others are written as updates of the entry they have. When a level holds ``fanout``
runs they are compacted into one run of the next level. Buckets line up, so neither the anti
joins nor the final count move an entry; only the batch and the updates are shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm.base import SPACES, let, lower_ascii, shared_folder, stored

MIN_CHARS = 40
MIN_DOCUMENTS = 5
FANOUT = 2
KEY = ["h1", "h2"]
MANIFEST = "action string, name string, level int, buckets int, id_type string, at long"


class LineRuns:
    """Levelled sorted runs. ``fanout``: runs of one level that are compacted into one.

    With ``folder`` the runs stay there: opened again, they go on with what earlier batches
    left. Without it they are dropped by ``close``. Of a batch that fails halfway nothing counts.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, folder: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.kept, self.folder = folder is not None, folder or shared_folder(spark, "line-runs")
        #: Runs by level, oldest first, and updates: table or folder names below ``folder``.
        self.levels: list[list[str]] = [[]]
        self.updates: list[str] = []
        self.tables: set[str] = set()
        self.steps = 0
        if self.kept:
            self._open()

    # --- what is on record

    def _open(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return
        rows = self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest").orderBy("at").collect()  # a few for each batch
        gone = {r["name"] for r in rows if r["action"] == "drop"}
        for r in rows:
            self.steps = max(self.steps, r["at"] + 1)
            if r["name"] in gone or r["action"] == "drop":
                continue
            if r["action"] == "update":
                self.updates.append(r["name"])
                continue
            self.buckets = r["buckets"]
            self._level(r["level"]).append(r["name"])
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {r['name']} (h1 BIGINT, h2 INT, n BIGINT, last {r['id_type']}) USING parquet "
                f"CLUSTERED BY ({', '.join(KEY)}) SORTED BY ({', '.join(KEY)}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{r['name']}'"
            )
            self.tables.add(r["name"])

    def _record(self, *entries: tuple[str, str, int], id_type: str) -> None:
        if self.kept:
            rows = [(action, name, level, self.buckets, id_type, self.steps) for action, name, level in entries]
            self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(f"{self.folder}/manifest")
        self.steps += 1

    def _level(self, level: int) -> list[str]:
        while level >= len(self.levels):
            self.levels.append([])
        return self.levels[level]

    # --- runs

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        # one task for each bucket, so that a bucket is one file
        placed = rows.select(*KEY, "n", "last").repartition(self.buckets, *KEY)
        self.tables.add(name)
        placed.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Adds a batch of (h1, h2, doc_id), one row for each document that holds the line."""
        own = stored(batch.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last")), "line-batch")
        fresh, known = own, None
        for name in self._runs():
            run = self.spark.table(name).select(*KEY)
            fresh = fresh.join(run, KEY, "left_anti")
            found = own.join(run, KEY, "left_semi")  # a line is in one run only
            known = found if known is None else known.unionByName(found)
        entry = self._write(fresh)
        entries = [("run", entry, 0)]
        if known is not None:
            update = f"update_{uuid.uuid4().hex}"
            known.write.parquet(f"{self.folder}/{update}")
            entries.append(("update", update, 0))
            self.updates.append(update)
        self._record(*entries, id_type=own.schema["last"].dataType.simpleString())
        self.levels[0].append(entry)
        for level, names in enumerate(self.levels):
            if len(names) >= self.fanout:
                self._compact(level)

    def _compact(self, level: int) -> None:
        names = list(self.levels[level])
        # read as plain files: a union of bucketed tables counts as bucketed, yet holds a bucket once for each table
        rows = self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*[f"{self.folder}/{name}" for name in names])
        merged = self._write(rows)
        entries = [("run", merged, level + 1), *[("drop", name, level) for name in names]]
        self._record(*entries, id_type=rows.schema["last"].dataType.simpleString())
        self.levels[level].clear()
        self._level(level + 1).append(merged)
        self._forget(names)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.tables.discard(name)

    def frequent(self, min_documents: int) -> DataFrame:
        """(h1, h2, last): lines of at least so many documents and the largest id that holds each."""
        later = None
        if self.updates:
            rows = self.spark.read.parquet(*[f"{self.folder}/{name}" for name in self.updates])
            sums = rows.groupBy(*KEY).agg(F.sum("n").alias("more"), F.max("last").alias("later"))
            later = stored(sums, "line-updates")
        found = None
        for name in self._runs():
            run = self.spark.table(name)
            if later is None:
                total = run
            else:
                total = run.join(later, KEY, "left").select(
                    *KEY, (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), F.greatest("last", "later").alias("last")
                )
            part = total.where(F.col("n") >= min_documents).select(*KEY, "last")
            found = part if found is None else found.unionByName(part)
        return stored(found, "frequent-lines")

    def close(self) -> None:
        """Takes the tables off the catalog; the files of runs without a folder of their own are no longer used."""
        self._forget(list(self.tables))
        self.levels, self.updates = [[]], []


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2) once for each row and each of its keys of at least ``min_chars`` code points."""
    keys = F.filter(F.transform(_lines(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars)
    return docs.select("doc_id", F.explode(F.array_distinct(keys)).alias("k")).select(
        "doc_id", F.xxhash64("k").alias("h1"), F.hash("k").alias("h2")
    )


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    batches: int = 4,
    runs: LineRuns | None = None,
) -> DataFrame:
    """Each row of ``docs`` as struct ``row`` with its lines in ``lines`` and those that stay in ``kept``.

    A key of at least ``min_chars`` code points that at least ``min_documents`` rows hold loses
    all its lines, except those of the largest id that holds it. ``batches`` parts of the
    documents, by a hash of the id, go into the runs one after the other. With ``runs`` of the
    caller's, documents of earlier calls count too, and those of this one stay in them.

    Null and empty texts are one empty line. Rows that share an id are documents of their own
    to the count, and all of them keep the line if theirs is the largest id. Rows with a null
    id count but lose nothing. An empty table gives an empty result; further columns of any
    name stay untouched inside ``row``.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    path = shared_folder(spark, "line-hashes")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("part")
    hashes = line_hashes(given, min_chars).select("doc_id", *KEY, part)
    hashes.write.partitionBy("part").parquet(path)
    hashes = spark.read.schema(hashes.schema).parquet(path)
    own = LineRuns(spark) if runs is None else runs
    try:
        for k in range(batches):
            own.add(hashes.where(F.col("part") == k).drop("part"))
        frequent = own.frequent(min_documents)
    finally:
        if runs is None:
            own.close()
    drops = (
        hashes.join(frequent, KEY)
        .where(F.col("doc_id") < F.col("last"))
        .groupBy(F.col("doc_id").alias("drop_id"))
        .agg(F.collect_list("h1").alias("drops"))
    )
    rows = docs.select(F.col(id_col).alias("id"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = rows.join(drops, F.col("id") == F.col("drop_id"), "left")
    lines = _lines(F.col("row")[text_col])

    def stays(line: Column) -> Column:
        key = line_key(line)
        return let(key, lambda k: ~((F.char_length(k) >= min_chars) & F.array_contains(F.col("drops"), F.xxhash64(k))))

    both = let(
        lines,
        lambda x: F.struct(x.alias("lines"), F.when(F.col("drops").isNull(), x).otherwise(F.filter(x, stays)).alias("kept")),
    )
    return joined.select("row", both.alias("b")).select("row", "b.lines", "b.kept")
