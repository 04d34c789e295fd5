"""Ranked lexical search by presence masks.

Texts become postings of the queries' terms. A task takes postings in blocks: for each query,
bitmaps of its terms give every document of the block the mask of terms it holds, documents
of one mask form a group, and groups are taken by their highest possible score until that
falls below what the task's best documents have. Only documents of those groups are scored.
Each task hands on its best of every query, and the best of all tasks are merged.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanframe.llm.base import lower_ascii, stored
from gleanframe.llm.terms import byte_words

# workers may lack this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
#: A saturation of 1.2 and a length share of 0.25, in whole numbers.
SATURATION, LENGTH_PERCENT, UNIT = 12, 25, 1_000_000_000
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Pairs of query and term that are searched for at a time; more queries go in further blocks.
QUERY_TERMS = 200_000
#: Documents of one block of a task.
BLOCK = 8_192
#: Parts in which the best of all tasks are merged first.
MERGE_PARTS = 64


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, repeats); rows that share an id are one item."""
    terms = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TERM), F.lit(0))
    found = items.select(F.col(id_col).alias("item_id"), F.explode(terms).alias("term"))
    return found.groupBy("item_id", "term").agg(F.count("*").alias("repeats"))


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, at, tf) of every row: its number of terms, its vocabulary terms and how often it has them."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        known = vocabulary.keys()
        for batch in batches:
            sizes, ends, at, tf = [], [0], [], []
            for text in batch.column(1):
                words = byte_words(text.as_py())
                counts = Counter(words)
                held = counts.keys() & known
                sizes.append(len(words))
                at += [vocabulary[t] for t in held]
                tf += [counts[t] for t in held]
                ends.append(len(at))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (at, tf)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "at", "tf"])

    numbers = T.ArrayType(T.IntegerType())
    schema = given.select("doc_id").schema.add("n", "long").add("at", numbers).add("tf", numbers)
    return given.mapInArrow(run, schema)


class _Block:
    """Postings of one block of documents, by document and by term."""

    def __init__(self, batches: list, weight: np.ndarray, n_docs: int, n_terms: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.ids = table["doc_id"]
        n = table["n"].to_numpy()
        m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * n_docs) // max(n_terms, 1)
        sizes = table["at"].combine_chunks().value_lengths().to_numpy()
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.at = table["at"].combine_chunks().flatten().to_numpy()
        tf = table["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), sizes)
        self.value = weight[self.at] * ((UNIT * tf) // (1000 * tf + SATURATION * m[doc]))
        order = np.argsort(self.at, kind="stable")
        self.by_term = doc[order]
        values = self.value[order]
        starts = np.searchsorted(self.at[order], np.arange(len(weight) + 1))
        self.term_starts, self.term_ends = starts[:-1], starts[1:]
        self.highest = np.zeros(len(weight), np.int64)
        held = np.flatnonzero(self.term_ends > self.term_starts)
        if len(held):
            self.highest[held] = np.maximum.reduceat(values, self.term_starts[held])

    def groups(self, terms: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents with a term of the query, sorted by mask; where each mask starts; highest score of each mask."""
        # terms that score nothing tell no masks apart
        held = self.highest[terms] > 0
        terms, most = terms[held], (self.highest[terms] * repeats)[held]
        bits = np.zeros((len(self.ids), max(1, -(-len(terms) // 64))), np.uint64)
        for k, term in enumerate(terms):
            bits[self.by_term[self.term_starts[term] : self.term_ends[term]], k // 64] |= np.uint64(1 << (k % 64))
        docs = np.flatnonzero(bits.any(axis=1))
        bits = bits[docs]
        order = np.lexsort(bits.T)
        docs, bits = docs[order], bits[order]
        starts = np.flatnonzero(np.concatenate([[True], (bits[1:] != bits[:-1]).any(axis=1)])) if len(docs) else docs
        masks = bits[starts]
        highest = np.zeros(len(masks), np.int64)
        for k in range(len(terms)):
            highest += most[k] * (masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).astype(np.int64)
        return docs, starts, highest

    def scores(self, docs: np.ndarray, repeats_of: np.ndarray) -> np.ndarray:
        """Exact scores of documents that all have postings."""
        sizes = self.ends[docs + 1] - self.ends[docs]
        first = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.ends[docs] - first, sizes)
        return np.add.reduceat(self.value[at] * repeats_of[self.at[at]], first)


def _last_kept(best: list, top: int) -> int:
    """A score below which nothing can enter the best."""
    return max(1, -best[top - 1][0]) if len(best) >= top else 1


def _search(blocks, queries: list, weight: np.ndarray, n_docs: int, n_terms: int, top: int):
    """The best (-score, id is null, id) of each query in all blocks of a task, and how many documents were scored."""
    best: list[list] = [[] for _ in queries]
    repeats_of = np.zeros(len(weight), np.int64)
    scored = 0
    for batches in blocks:
        block = _Block(batches, weight, n_docs, n_terms)
        for number, (terms, repeats) in enumerate(queries):
            docs, starts, highest = block.groups(terms, repeats)
            ends = np.append(starts[1:], len(docs))
            repeats_of[terms] = repeats
            order = np.argsort(-highest, kind="stable")
            done, step = 0, 16
            while done < len(order) and highest[order[done]] >= _last_kept(best[number], top):
                masks = order[done : done + step]
                masks = masks[highest[masks] >= _last_kept(best[number], top)]
                chosen = np.concatenate([docs[starts[k] : ends[k]] for k in masks])
                scores = block.scores(chosen, repeats_of)
                scored += len(chosen)
                enter = scores >= _last_kept(best[number], top)
                ids = block.ids.take(pa.array(chosen[enter])).to_pylist()
                new = [(-int(s), i is None, i) for s, i in zip(scores[enter], ids, strict=True)]
                best[number] = sorted(best[number] + new)[:top]
                done, step = done + step, step * 2
            repeats_of[terms] = 0
    return best, scored


def _blocks(batches):
    """Lists of batches with about ``BLOCK`` documents in all."""
    held, rows = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            held.append(part)
            rows += part.num_rows
            if rows >= BLOCK:
                yield held
                held, rows = [], 0
    if rows:
        yield held


def _best_of_tasks(index: DataFrame, queries: list, weight: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, part, doc_id, score): each task's best."""

    def run(batches):
        kind = None

        def seen():
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("doc_id").type
                yield batch

        best, _ = _search(_blocks(seen()), queries, weight, n_docs, n_terms, top)
        rows = [(item, row) for item, found in enumerate(best) for row in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item for item, _ in rows], pa.int32()),
                    pa.array([row[2] for _, row in rows], kind),
                    pa.array([-row[0] for _, row in rows], pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    schema = index.select(F.lit(0).alias("item"), "doc_id", F.lit(0).cast("long").alias("score")).schema
    return index.mapInArrow(run, schema).withColumn("part", F.spark_partition_id() % MERGE_PARTS)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    query_terms_at_once: int = QUERY_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0.

    All rows of ``docs`` are searched for all items. Equal scores rank by ascending id, null ids
    last; rows that share an id rank each on their own. Null and empty texts have no terms: as
    documents they count nowhere, as items they find nothing. Items that share an id are one item
    with the terms of all their rows. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    wanted = stored(query_terms(items, item_col, item_text_col), "query-terms")
    blocks = max(1, math.ceil(wanted.count() / query_terms_at_once))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    results = []
    for block in range(blocks):
        # about ``query_terms_at_once`` rows, or one item's terms if it has more
        rows = wanted.where(F.col("block") == block).collect()
        vocabulary = {term: k for k, term in enumerate(sorted({r["term"].encode() for r in rows}))}
        by_item: dict = {}
        for r in rows:
            by_item.setdefault(r["item_id"], []).append((vocabulary[r["term"].encode()], r["repeats"]))
        queries = [tuple(np.array(sorted(pairs), np.int64).T) for pairs in by_item.values()]
        index = stored(postings(docs, vocabulary, id_col, text_col), "postings")
        total = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in index.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # a row for each term of the block
            df[r["at"]] = r["count"]
        weight = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)
        found = _best_of_tasks(index.where(F.size("at") > 0), queries, weight, total["docs"], total["terms"], top)
        for keys in (["item", "part"], ["item"]):
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(by_item)), _names_schema(wanted))
        found = found.join(F.broadcast(names), "item")  # as many rows as the block has items
        results.append(found.select("item_id", "rank", "doc_id", "score"))
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def _names_schema(wanted: DataFrame):
    return wanted.select(F.lit(0).alias("item"), "item_id").schema
