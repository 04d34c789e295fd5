"""Removal of repeated long strings by a partitioned suffix array.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.

1. Each text is read in segments. A rolling hash finds the strings that repeat within a
   segment; of each only the first goes on. Every string is assigned to an anchor, the place in
   it whose 32 bytes hash lowest, so equal strings have equal anchors.
2. Anchors whose bytes occur once in the corpus are dropped with their strings: an exact
   filter that leaves the suffixes that can have a partner.
3. Those suffixes, as bytes around each anchor, are range-partitioned by sampled splitters of
   their leading tokens: the anchor's first eight bytes, then the hash of all its bytes. Each
   bucket sorts its suffixes by these and then by multikey quicksort: the tied ones are split
   again and again by the hash of their next token of 100 bytes.
4. An anchor may lie across a boundary between buckets; the suffixes at the ends of the
   buckets are compared once more among all buckets. So a frequent anchor spreads over many.
   This goes by stretches of ``STRETCH`` neighbouring suffixes first: what these share, at a
   fixed distance from the anchor, must occur twice before single suffixes are looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
GRAM = 32
#: Bytes of an anchor that order the buckets, as a number.
LEAD = 8
TOKENS = 4
SEGMENT = 1 << 21
STRETCH = 12
#: Bytes of suffixes that one bucket holds, about; it is held by one task.
BUCKET = 64 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 23) - 1)


class Rolling:
    """Hashes of substrings of ``data`` by sums of byte values times powers, modulo 2**64.

    The byte values are random 64-bit numbers, so that the sums' low bits are mixed as well.
    """

    _values = np.random.default_rng(7).integers(0, 2**64, 256, np.uint64)
    _powers: np.ndarray = np.ones(1, np.uint64)
    _inverse: np.ndarray = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Rolling._powers) <= n:
            size = max(n + 1, 1 << 16)
            Rolling._powers = self._series(_BASE, size)
            Rolling._inverse = self._series(np.uint64(pow(int(_BASE), -1, 1 << 64)), size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._values[data] * Rolling._powers[:n], out=self.sums[1:])

    @staticmethod
    def _series(base: np.uint64, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def all(self, length: int) -> np.ndarray:
        """The hash of every substring of that length, by its start."""
        n = len(self.sums) - length
        return self.mixed((self.sums[length:] - self.sums[:n]) * Rolling._inverse[:n]) if n > 0 else np.zeros(0, np.uint64)

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        return self.mixed((self.sums[starts + length] - self.sums[starts]) * Rolling._inverse[starts])

    @staticmethod
    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def lowest(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the lowest hash among each ``width`` successive ones; the first of equal ones."""
    n = len(grams)
    keys = (grams & ~_PLACE) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = keys
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return (np.minimum(behind[:count], ahead[width - 1 : width - 1 + count]) & _PLACE).astype(np.int64)


def runs(places: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of stretches of successive ``places`` with equal ``same``."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(places) != 1
    for values in same:
        new |= np.diff(values) != 0
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    return first, np.concatenate([first[1:] - 1, [len(places) - 1]])


def scan(data: np.ndarray, owners: np.ndarray, length: int):
    """What a segment of texts says: repeats within it and anchors of the strings that go on.

    ``owners`` numbers the text of each byte. Gives (start, last start) of strings that repeat,
    and (anchor hash, first start, last start, anchor) of those to compare with other segments.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return (none, none), (np.zeros(0, np.uint64), none, none, none)
    rolling = Rolling(data)
    starts = np.flatnonzero(owners[:n] == owners[length - 1 :])
    hashes = rolling.all(length)[starts]
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    equal = ranked[1:] == ranked[:-1]
    later = np.zeros(len(starts), bool)
    later[order[1:][equal]] = True
    repeat = later.copy()
    repeat[order[:-1][equal]] = True
    found = starts[repeat]
    first, last = runs(found, owners[found])
    go_on = starts[~later]
    grams = rolling.all(GRAM)
    anchors = lowest(grams, length - GRAM + 1)[go_on]
    begin, end = runs(go_on, anchors, owners[go_on])
    return (found[first], found[last]), (grams[anchors[begin]], go_on[begin], go_on[end], anchors[begin])


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """Stored (doc_id, h, repeats, anchors) for each row, places in bytes of the text."""
    names = ["doc_id", "h", "repeats", "anchors"]

    def flush(held: list[tuple]) -> tuple[list, list]:
        """Places of the texts in ``held`` (bytes each), read in segments."""
        repeats, found = [[] for _ in held], [[] for _ in held]
        at, part, filled = 0, [], 0

        def close() -> None:
            nonlocal part, filled
            if not part:
                return
            data = np.concatenate([np.frombuffer(b, np.uint8) for _, _, b in part])
            sizes = [len(b) for _, _, b in part]
            owners = np.repeat(np.arange(len(part)), sizes)
            base = np.concatenate([[0], np.cumsum(sizes)[:-1]]) - np.array([start for _, start, _ in part])
            (first, last), (grams, begin, end, places) = scan(data, owners, length)
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                owner = owners[a]
                repeats[part[owner][0]].append((a - int(base[owner]), b - int(base[owner])))
            marks = zip(grams.view(np.int64).tolist(), begin.tolist(), end.tolist(), places.tolist(), strict=True)
            for g, a, b, p in marks:
                owner = owners[a]
                found[part[owner][0]].append((g, *(at - int(base[owner]) for at in (a, b, p))))
            part, filled = [], 0

        for at, text in enumerate(held):
            for start in range(0, max(1, len(text) - length + 1), SEGMENT):
                piece = text[start : start + SEGMENT + length - 1]
                if filled + len(piece) > SEGMENT:
                    close()
                part.append((at, start, piece))
                filled += len(piece)
        close()
        return repeats, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        marks = pa.list_(pa.struct([(name, pa.int64()) for name in "gabp"]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                repeats, found = flush([t.encode() for t in some.column(2).to_pylist()])
                columns = [some.column(0), some.column(1)]
                columns.append(pa.array([[{"a": a, "b": b} for a, b in r] for r in repeats], spans))
                columns.append(pa.array([[dict(zip("gabp", mark, strict=True)) for mark in f] for f in found], marks))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, h long, repeats array<struct<a:bigint,b:bigint>>, anchors array<struct<g:bigint,a:bigint,b:bigint,p:bigint>>"
    )
    return stored(docs.select("doc_id", "h", "text").mapInArrow(run, schema), "anchors")


def suffixes(docs: DataFrame, marked: DataFrame, length: int) -> DataFrame:
    """Stored (lead, g, doc_id, h, a, p, bytes, size): the bytes of all strings of each anchor that occurs twice or more."""
    rows = marked.select("doc_id", "h", F.explode("anchors").alias("m")).select("doc_id", "h", "m.*")
    often = rows.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    chosen = rows.join(often, "g", "left_semi").groupBy(F.col("doc_id").alias("i"), F.col("h").alias("k"))
    # a text's anchors; rows that share id and text have them once for each row
    chosen = chosen.agg(F.collect_list(F.struct("g", "a", "b", "p")).alias("marks"))
    unique = docs.groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    met = unique.join(chosen, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lead", "g", "doc_id", "h", "a", "p", "bytes", "size"]
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py().encode()
                marks = batch.column(3)[row].as_py()
                owner = pa.array([row] * len(marks), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int.from_bytes(text[m["p"] : m["p"] + LEAD], "big") - (1 << 63) for m in marks], pa.int64()),
                        pa.array([m["g"] for m in marks], pa.int64()),
                        batch.column(0).take(owner),
                        batch.column(1).take(owner),
                        pa.array([m["a"] for m in marks], pa.int64()),
                        pa.array([m["p"] for m in marks], pa.int64()),
                        pa.array([text[m["a"] : m["b"] + length] for m in marks], pa.binary()),
                        pa.array([m["b"] + length - m["a"] for m in marks], pa.int64()),
                    ],
                    names,
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = met.select("doc_id", "h", "text", "marks").mapInArrow(run, f"lead long, g long, doc_id {kind}, h long, a long, p long, bytes binary, size long")
    return stored(cut, "suffixes")


def multikey_quicksort(rolling: Rolling, starts: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Class of each suffix among those equal to it over ``length`` bytes; -1 if it is alone.

    Each round sorts the suffixes still tied by their next token and keeps the ties.
    """
    size = -(-length // TOKENS)
    tied, classes = np.arange(len(starts)), groups.astype(np.uint64)
    for token in range(TOKENS):
        offset = min(token * size, length - size)
        keys = Rolling.mixed(classes * _BASE + rolling.at(starts[tied] + offset, size))
        order = np.argsort(keys, kind="stable")
        keys, tied = keys[order], tied[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
        tied, classes = tied[many], number[many].astype(np.uint64)
    out = np.full(len(starts), -1, np.int64)
    out[tied] = classes.astype(np.int64)
    return out


def repeated(rows: DataFrame, length: int) -> DataFrame:
    """(doc_id, h, a, b): first and last start of repeated strings among ``rows`` of ``suffixes``."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    bucketed = rows.drop("size").repartitionByRange(n, "lead", "g", "h", "a")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "h", "a", "b", "k1", "k2", "single"]
    singles = pa.struct([("a", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not sum(b.num_rows for b in got):
            return
        # one bucket, of about ``BUCKET`` bytes
        table = pa.Table.from_batches(got).combine_chunks().sort_by([("lead", "ascending"), ("g", "ascending")])
        g, at = table["g"].to_numpy(), table["a"].to_numpy()
        low, high = g[0], g[-1]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]])
        begin = 0
        while begin < len(cuts) - 1:
            # as many anchors at a time as have about a segment of bytes, one at least
            end = begin + 1
            while end < len(cuts) - 1 and (cuts[end + 1] - cuts[begin]) * length * 2 < SEGMENT:
                end += 1
            part = slice(cuts[begin], cuts[end])
            begin = end
            some = table.slice(part.start, part.stop - part.start)
            values = [v.as_py() for v in some["bytes"]]
            data = np.frombuffer(b"".join(values), np.uint8)
            sizes = np.array([len(v) for v in values])
            offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            counts = sizes - length + 1
            owner = np.repeat(np.arange(len(values)), counts)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            starts = offsets[owner] + inside
            rolling = Rolling(data)
            group = np.cumsum(np.concatenate([[0], np.diff(g[part]) != 0]))
            classes = multikey_quicksort(rolling, starts, group[owner], length)
            places = at[part][owner] + inside
            hit = np.flatnonzero(classes >= 0)
            first, last = runs(places[hit], owner[hit])
            yield batch_of(some, owner[hit[first]], places[hit[first]], places[hit[last]])
            # the ends of the bucket: one suffix of each class goes to the comparison of all buckets
            edge = (g[part] == low) | (g[part] == high)
            if edge.any():
                _, one = np.unique(classes, return_index=True)
                go = np.zeros(len(classes), bool)
                go[one] = True
                go = np.flatnonzero((go | (classes < 0)) & edge[owner])
                half = -(-length // 2)
                c1, c2 = rolling.at(starts[go], half), rolling.at(starts[go] + length - half, half)
                # stretches by the distance of the anchor from the start; what all of a stretch hold
                anchor = some["p"].to_numpy()[owner[go]] - places[go]
                stretch = anchor // STRETCH
                head = np.flatnonzero(np.concatenate([[True], (np.diff(owner[go]) != 0) | (np.diff(stretch) != 0)])[: len(go)])
                shared = (starts[go] + anchor - stretch * STRETCH)[head]
                size = length - STRETCH + 1
                part = -(-size // 2)
                k1 = Rolling.mixed(rolling.at(shared, part) + stretch[head].astype(np.uint64) * _BASE)
                k2 = rolling.at(shared + size - part, part)
                values = [pa.array(v, pa.int64()) for v in (places[go], c1.view(np.int64), c2.view(np.int64))]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(head, len(go)), pa.int32()), pa.StructArray.from_arrays(values, fields=list(singles))
                )
                yield batch_of(some, owner[go][head], places[go][head], places[go][head], k1.view(np.int64), k2.view(np.int64), lists)

    def batch_of(table: pa.Table, owner: np.ndarray, a: np.ndarray, b: np.ndarray, k1=None, k2=None, lists=None) -> pa.RecordBatch:
        empty = pa.nulls(len(owner), pa.int64())
        taken = table.select(["doc_id", "h"]).take(pa.array(owner, pa.int64())).combine_chunks()
        columns = [taken["doc_id"].combine_chunks(), taken["h"].combine_chunks(), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
        columns += [empty if k is None else pa.array(k, pa.int64()) for k in (k1, k2)]
        columns.append(pa.nulls(len(owner), pa.list_(singles)) if lists is None else lists)
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, h long, a long, b long, k1 long, k2 long"
    found = stored(bucketed.mapInArrow(run, f"{schema}, single array<struct<a:bigint,c1:bigint,c2:bigint>>"), "repeats")
    stretches = found.where("k1 is not null")
    alive = stretches.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    edges = stretches.join(alive, ["k1", "k2"], "left_semi").select("doc_id", "h", F.explode("single").alias("s"))
    edges = edges.select("doc_id", "h", "s.*").withColumn("b", F.col("a"))
    across = edges.groupBy("c1", "c2").agg(F.count("*").alias("n")).where("n > 1").select("c1", "c2")
    shared = edges.join(across, ["c1", "c2"], "left_semi").select("doc_id", "h", "a", "b")
    return found.where("k1 is null").select("doc_id", "h", "a", "b").unionByName(shared)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row: the removed byte runs and the bytes that stay.

    Texts are UTF-8; strings are judged on the input and never go from one text to the next.
    Null texts are empty; texts shorter than ``length`` stay. Rows that share an id are texts
    of their own, and a text that stands in two rows repeats as a whole. Other columns are
    left out; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    marked = anchors(rows, length)
    within = marked.select("doc_id", "h", F.explode("repeats").alias("r")).select("doc_id", "h", "r.a", "r.b")
    spans = within.unionByName(repeated(suffixes(rows, marked, length), length))
    spans = spans.groupBy(F.col("doc_id").alias("i"), F.col("h").alias("k")).agg(F.collect_list(F.struct("a", "b")).alias("s"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("k")), "left")
    names = ["doc_id", "n_bytes", "spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some, out = batch.slice(at, 500), []
                for value, found in zip(some.column(1), some.column(2), strict=True):
                    data, merged, kept, end = value.as_py().encode(), [], [], 0
                    for a, b in sorted((s["a"], s["b"] + length) for s in found.as_py() or ()):
                        if merged and a <= merged[-1]["b"]:
                            merged[-1]["b"] = max(merged[-1]["b"], b)
                        else:
                            merged.append({"a": a, "b": b})
                    for span in merged:
                        kept.append(data[end : span["a"]])
                        end = span["b"]
                    out.append((len(data), merged, b"".join([*kept, data[end:]])))
                n, spans, kept = zip(*out, strict=True)
                columns = [some.column(0), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, spans array<struct<a:bigint,b:bigint>>, kept binary"
    return joined.select("doc_id", "text", "s").mapInArrow(run, schema)
