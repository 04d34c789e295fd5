"""Target-distribution importance resampling: hashed n-gram weights, then an exact distributed draw.

Both corpora are counted into hashed buckets of word runs; a bucket's gain is the logarithm of
its smoothed target share over its smoothed share here. Documents sum their gains by array
look-ups, add Gumbel noise of their id, and the best are drawn. The last key that is drawn is
found by weighted medians of medians: each part of the remaining keys gives its median and size,
the weighted median of those has at least a quarter of the keys on either side, and the side
without the cutoff is discarded. Only the winners are sorted.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import stored
from gleanframe.llm.terms import byte_words
from gleanframe.operators.ordered import OrderedRows, running_count

# workers may lack this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
NOISE = "42"
#: Keys that one median stands for, at most; the memory of a task in a round.
PART_KEYS = 1 << 20
#: So few remaining keys are sorted outright.
LAST_KEYS = 4_096
#: Words whose features are hashed at a time.
SLICE = 1 << 16


def _hashes(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """The text's words and the CRC-32 of its runs of 1 to 3 words, in slices of bounded size."""
    words = byte_words(text)
    for start in range(0, len(words), SLICE):
        part = words[start : start + SLICE + 2]  # two words of the next slice, for runs that reach into it
        own = len(words[start : start + SLICE])
        spaced = [b" " + w for w in part]
        one = list(map(zlib.crc32, part))
        two = list(map(zlib.crc32, spaced[1:], one))
        three = list(map(zlib.crc32, spaced[2:], two))
        yield own, np.array(one[:own] + two[:own] + three[:own], np.int64)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    A task counts into one array; arrays are added bucket by bucket in the shuffle, and
    ``buckets`` sums come to the driver.
    """

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, hashes in _hashes(text.as_py()):
                    counts += np.bincount(hashes % buckets, minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], ["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("binary")).mapInArrow(run, "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed target share over its corpus share, rounded down."""
    s, t = corpus.astype(float), target.astype(float)
    ratio = ((t + 1) * (s.sum() + len(s))) / ((s + 1) * (t.sum() + len(s)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(id_text: Column, seed: str = NOISE) -> Column:
    """1000 times a Gumbel draw that depends on the id alone, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(id_text, F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches):
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), np.int64)
            for at, text in enumerate(batch.column(1)):
                for n, hashes in _hashes(text.as_py()):
                    rows[:, at] += n, len(hashes), gain[hashes % len(gain)].sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def _medians(side_key: DataFrame) -> DataFrame:
    """(side, n, k1, k2, k3): size and median key of each part of at most ``PART_KEYS`` keys."""

    def run(batches):
        held, rows = [], 0

        def close():
            table = pa.Table.from_batches(held)
            table = table.take(pc.sort_indices(table, [(name, "ascending") for name in ("side", "k1", "k2", "k3")]))
            sides, sizes = np.unique(table["side"].to_numpy(), return_counts=True)
            ends = np.cumsum(sizes)
            out = table.take(pa.array(ends - sizes + (sizes - 1) // 2))
            return out.append_column("n", pa.array(sizes, pa.int64())).to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PART_KEYS:
                yield from close()
                held, rows = [], 0
        if rows:
            yield from close()

    return side_key.mapInArrow(run, side_key.withColumn("n", F.lit(0).cast("long")).schema)


def cutoff(keys: DataFrame, wanted: int) -> tuple | None:
    """The ``wanted``-th smallest (k1, k2, k3), or None if there are not so many keys.

    A round reads the remaining keys once: it counts those before, at and after the last pivot
    and takes medians of both sides, so the side with the cutoff already has its next pivot.
    The rest is written down anew whenever it has shrunk to a quarter, which keeps the reading
    of all rounds in proportion to the keys. Parts, not keys, come to the driver.
    """
    names = ["k1", "k2", "k3"]
    spark = keys.sparkSession
    types = {f.name: f.dataType for f in keys.schema.fields}
    key = F.struct(*names)
    literal = lambda p: F.struct(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(names, p, strict=True)])
    size = keys.count()
    if not 0 < wanted <= size:
        return None
    rest, left, pivot = keys, size, None
    while left > LAST_KEYS:
        if pivot is None:
            side = F.lit(0)
        else:
            side = F.when(key < literal(pivot), -1).when(key > literal(pivot), 1).otherwise(0)
        found = _medians(rest.select(side.cast("int").alias("side"), *names)).collect()  # a row or three for each part
        by_side = {s: [(tuple(r[n] for n in names), r["n"]) for r in found if r["side"] == s] for s in (-1, 0, 1)}
        if pivot is None:
            chosen = by_side[0]
        else:
            before, same = (sum(n for _, n in by_side[s]) for s in (-1, 0))
            if before < wanted <= before + same:
                return pivot
            below = wanted <= before
            chosen = by_side[-1 if below else 1]
            rest = rest.where(key < literal(pivot) if below else key > literal(pivot))
            # the first column alone reaches the scan
            rest = rest.where(F.col("k1") <= pivot[0] if below else F.col("k1") >= pivot[0])
            wanted -= 0 if below else before + same
            left = sum(n for _, n in chosen)
            if left * 4 <= size:
                rest, size = stored(rest, "keys"), left
        half, seen = left / 2, 0
        for pivot, n in sorted(chosen):
            seen += n
            if seen >= half:
                break
    last = sorted(tuple(r) for r in rest.select(*names).collect())
    return last[wanted - 1]


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = NOISE,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; other columns are left out.

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) of the highest
    score are drawn and ranked from 1, equal scores by the smaller id; ``rank`` is null for all
    others. Null and empty texts have no features and weight 0. Null ids draw the noise of an
    empty id and come last among equal scores. Rows that share an id are rows of their own; if
    only some of several equal (score, id) fit, that many of them are drawn. An empty table
    gives an empty result, an empty target smooths to equal shares.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    score = F.col("weight") + noise(F.col("doc_id").cast("string"), seed)
    scored = weighed(docs, gain, id_col, text_col).withColumn("score", score)
    first = F.coalesce("doc_id", F.lit(0).cast(docs.schema[id_col].dataType))
    scored = scored.select(
        "*", (-F.col("score")).alias("k1"), F.col("doc_id").isNull().alias("k2"), first.alias("k3"), F.monotonically_increasing_id().alias("row")
    )
    scored = stored(scored, "scored")
    enough = F.col("n_words") >= min_words
    keys = scored.where(enough).select("k1", "k2", "k3")
    wanted = percent * keys.count() // 100
    last = cutoff(keys, wanted)
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    types = {f.name: f.dataType for f in keys.schema.fields}
    edge = F.struct(*[F.lit(v).cast(types[n]).alias(n) for n, v in zip(keys.columns, last, strict=True)])
    drawn = enough & (F.struct("k1", "k2", "k3") <= edge)
    winners = OrderedRows.of(scored.where(drawn), [], ["k1", "k2", "k3", "row"]).running(rank=running_count()).df
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long").alias("rank")
    losers = scored.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return losers.unionByName(winners.select(*out, rank))
