"""Document fingerprints: bottom-k sketches of shingle hashes, as column expressions.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's shingles.
Sketches of parts merge to the sketch of the whole (``merged`` for two columns,
``merge_groups`` for groups), and estimate resemblance, containment and distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanframe.llm.base import let, positions, stored, words

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
NULL_ID = -(2**63)


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """One hash for each place of ``n`` words; for fewer words one of them all; none without words."""

    def of(w: Column) -> Column:
        many = F.transform(positions(0, F.size(w) - n), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) == 0, none).when(F.size(w) < n, F.array(F.xxhash64(w))).otherwise(many)

    return let(F.transform(words(text), lambda x: F.xxhash64(x)), of)


def sketch(text: Column, k: int = SKETCH_SIZE, n: int = SHINGLE_WORDS) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, n))), 1, k)


def merged(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: list[str], sketch_col: str, k: int = SKETCH_SIZE) -> DataFrame:
    """The sketch of all parts of each group. Rows are cut to ``k`` for each task before they are shuffled."""
    hashes = df.select(*keys, F.explode(sketch_col).alias("h"))
    place = F.dense_rank().over(Window.partitionBy(*keys).orderBy("h"))
    smallest = hashes.withColumn("place", place).where(F.col("place") <= k)
    return smallest.groupBy(*keys).agg(F.sort_array(F.collect_set("h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard index of the shingle sets; 1 for two empty ones."""

    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(union, a), b))
        return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))

    return F.when(a == b, 1.0).otherwise(let(merged(a, b, k), share))


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    largest = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 if ``a`` has none."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Sixteen lowercase hex digits for each hash, joined."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def neighbours(ids: DataFrame) -> DataFrame:
    """(id, prev_id, prev_chars) for each of the distinct ``id`` with ``n_chars``; the first follows the last.

    Ids are range-partitioned and chained inside each range; the ranges' ends, one row each,
    are chained on their own.
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.groupBy("id").agg(F.max("n_chars").alias("n_chars")).repartitionByRange(n, "id")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "id-ranges")
    own = Window.partitionBy("part").orderBy("id")
    inside = ranged.select(
        "id", "part", F.lag("id").over(own).alias("prev_id"), F.lag("n_chars").over(own).alias("prev_chars")
    )
    ends = ranged.groupBy("part").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.max_by("n_chars", "id").alias("last_chars")
    )
    across, everything = Window.orderBy("part"), Window.orderBy(F.desc("part"))
    ends = ends.select(
        "first",
        F.coalesce(F.lag("last").over(across), F.first("last").over(everything)).alias("end_id"),
        F.coalesce(F.lag("last_chars").over(across), F.first("last_chars").over(everything)).alias("end_chars"),
    )
    joined = inside.join(ends, F.col("id") == F.col("first"), "left")
    return joined.select(
        "id",
        F.coalesce("prev_id", "end_id").alias("prev_id"),
        F.coalesce("prev_chars", "end_chars").alias("prev_chars"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH_SIZE) -> DataFrame:
    """Every text's sketch, that of its edited text, and that of the next document.

    The edited text has the last half of the code points replaced by as many first ones of the
    next document by ascending id (the first follows the last). Null texts are empty. A null
    id comes before all others. Of rows that share an id the smallest prefix stands for the
    id as next document; each keeps its own row. Other columns are left out; an empty table
    gives an empty result.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    chain = neighbours(rows.select("id", F.char_length("text").alias("n_chars"))).withColumnRenamed("id", "chain_id")
    half = lambda n: F.floor(n / 2).cast("int")
    sent = rows.join(chain, F.col("id") == F.col("chain_id")).select(
        F.col("prev_id").alias("to_id"),
        F.struct(F.substring("text", F.lit(1), half(F.col("prev_chars"))).alias("head"), sketch(F.col("text"), k).alias("s")).alias("m"),
    )
    # one row for each id; where ids repeat, the smallest
    sent = sent.groupBy("to_id").agg(F.min("m").alias("next"))
    n = F.char_length("text")
    edited = F.concat(
        F.substring("text", F.lit(1), (n - half(n)).cast("int")), F.substring(F.col("next.head"), F.lit(1), half(n))
    )
    return (
        rows.join(sent, F.col("id") == F.col("to_id"))
        .select("id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), F.col("next.s").alias("next_sketch"))
        .select(
            F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"),
            "n_chars",
            "edited",
            sketch(F.col("text"), k).alias("sketch"),
            sketch(F.col("edited"), k).alias("edited_sketch"),
            "next_sketch",
        )
    )
