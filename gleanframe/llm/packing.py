"""Packing of token sequences by a configuration linear program over the length histogram.

The histogram of piece lengths has at most ``capacity`` rows, whatever the size of the corpus.
Its covering program (fewest sequences such that each length is covered as often as it occurs)
is solved in fractions by multiplicative weights: each round's knapsack dynamic program over
the current prices gives every open length its best configuration, a step takes as much of it
as is open, and the prices of what it covers fall by a factor. Prices over the value of the
best configuration bound the program from below. The solution is rounded down to whole
sequences; what that leaves, a few pieces for each configuration, is covered in whole steps of
the same kind. Pieces take their places by their rank among pieces of their length; ranks are
per-task counts plus sums over tasks, so no length is gathered in one place.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanframe.llm.base import stored
from gleanframe.llm.bpe import load_ranks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
END_ID = 0
#: What part of a length's demand a step may cover (one sequence at least), and how fast prices fall.
PART, FALL = 3, 0.2
#: First prices are lengths to this power: above 1, so that long pieces are not left without short ones.
STEEP = 1.2
_BIG = 1 << 40
#: A fraction of a sequence that counts as none.
_NOTHING = 1e-9


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """For each room, the last length (its index, or -1) of the configuration of the largest total value, and that value.

    An unbounded knapsack over ascending lengths.
    """
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := upto[room]:
            options = best[room - lengths[:n]] + values[:n]
            at = int(options.argmax())
            if options[at] > best[room]:
                best[room], last[room] = options[at], at
    return last, float(best[capacity])


def configuration(lengths: np.ndarray, last: np.ndarray, room: int) -> Counter:
    """How often each index of ``lengths`` is in the best configuration of a room."""
    out = Counter()
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            out[int(last[room])] += 1
            room -= int(lengths[last[room]])
    return out


def filled(config: Counter, lengths: np.ndarray, left: np.ndarray, capacity: int, whole: bool) -> Counter:
    """``config`` with the longest of the open pieces that fit into the room it leaves; ``whole``: no more than are left."""
    config = Counter(config)
    room = capacity - sum(int(lengths[k]) * n for k, n in config.items())
    k = int(np.searchsorted(lengths, room, "right")) - 1
    while room and k >= 0:
        fits = room // int(lengths[k]) if left[k] > 0 else 0
        fits = min(int(left[k]) - config[k], fits) if whole else fits
        if fits > 0:
            config[k] += fits
            room -= fits * int(lengths[k])
        k = min(k - 1, int(np.searchsorted(lengths, room, "right")) - 1)
    return +config


def cover(histogram: dict[int, int], capacity: int, whole: bool, rounds: int | None = None) -> tuple[Counter, float]:
    """How often each configuration ((length, count), ...) is used, and a lower bound of the program.

    Every length is covered exactly, unless ``rounds`` are given and run out: each round covers
    some of the longest open length, so the rounds come to an end. ``whole`` steps are whole
    sequences, others are fractions.
    """
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[int(x)] for x in lengths], np.int64 if whole else float)
    left, done = demand.copy(), 0
    uses: Counter = Counter()
    # two sets of prices under which no configuration is worth more than one sequence
    bound = max(float(demand @ lengths) / capacity, float(demand[2 * lengths > capacity].sum()))
    while left.any() and (rounds is None or done < rounds):
        done += 1
        open_ = np.flatnonzero(left)
        values = (lengths[open_] / capacity) ** STEEP * np.exp(-FALL * (1 - left[open_] / demand[open_]))
        last, most = price(lengths[open_], values, capacity)
        bound = max(bound, float(demand[open_] @ values) / most)
        for one in range(len(open_) - 1, -1, -1):
            config = configuration(lengths[open_], last, capacity - int(lengths[open_[one]]))
            config[one] += 1
            config = Counter({int(open_[k]): n for k, n in config.items()})
            if any(left[k] < n if whole else not left[k] for k, n in config.items()):
                if one < len(open_) - 1:
                    continue  # its time comes with the next prices
                config = Counter({k: min(n, int(left[k])) if whole else n for k, n in config.items() if left[k]})
            config = filled(config, lengths, left, capacity, whole)
            if whole:
                step = max(1, min(int(demand[k]) // n for k, n in config.items()) // PART)
                step = min(step, *(int(left[k]) // n for k, n in config.items()))
            else:
                step = min(float(left[k]) / n for k, n in config.items())
            for k, n in config.items():
                left[k] -= step * n
            if not whole:
                left[left < _NOTHING] = 0
            uses[tuple(sorted((int(lengths[k]), n) for k, n in config.items()))] += step
    return uses, bound


def solve(histogram: dict[int, int], capacity: int, rounds: int | None = None) -> list[tuple[int, Counter]]:
    """(copies, configuration) that cover every length exactly: the fractional solution rounded down, the rest in whole steps.

    With ``rounds``, neither part takes more of them, and what is then open stays so.
    """
    left = dict(histogram)
    uses, _ = cover(histogram, capacity, whole=False, rounds=rounds)
    out: Counter = Counter()
    for key, x in uses.items():
        if copies := min(int(x + _NOTHING), *(left[n] // c for n, c in key)):
            out[key] += copies
            for n, c in key:
                left[n] -= copies * c
    rest = {n: c for n, c in left.items() if c}
    if rest:
        out += cover(rest, capacity, whole=True, rounds=rounds)[0]
    return [(x, Counter(dict(key))) for key, x in out.items()]


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, Counter]]:
    """Best fit over a histogram: the longest piece, then always the longest that fits, as often as it lasts."""
    left = {n: c for n, c in left.items() if c}
    out = []
    while left:
        order, config, room = sorted(left, reverse=True), Counter(), capacity
        for length in order:
            fits = min(left[length], room // length)
            if fits:
                config[length] += fits
                room -= fits * length
        copies = min(left[n] // c for n, c in config.items())
        out.append((copies, config))
        for n, c in config.items():
            left[n] -= copies * c
            if not left[n]:
                del left[n]
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None) -> list[tuple[int, Counter]]:
    """(copies, configuration) such that each length is placed exactly as often as it occurs.

    Best fit places only what is open when given ``rounds`` run out.
    """
    left = {n: c for n, c in histogram.items() if c}
    out = []
    if full := left.pop(capacity, 0):
        out.append((full, Counter({capacity: 1})))
    for copies, config in sorted(solve(left, capacity, rounds) if left else [], key=lambda c: -c[0]):
        out.append((copies, config))
        for n, c in config.items():
            left[n] -= copies * c
    return out + best_fit(left, capacity)


def slots(configs: list[tuple[int, Counter]]) -> dict[str, np.ndarray]:
    """Places by length and rank: from rank ``first`` on, sequence ``base + rank - first`` at ``offset``."""
    rows, ranks, base = [], Counter(), 0
    for copies, config in configs:
        offset = 0
        for length in sorted(config, reverse=True):
            for _ in range(config[length]):
                rows.append((length * _BIG + ranks[length], ranks[length], base, offset))
                ranks[length] += copies
                offset += length
        base += copies
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("key", "first", "base", "offset"), columns, strict=True))


_encoders: dict[tuple, object] = {}


def encoder(json_path: str, ranks_path: str, pattern: str):
    """Text to ids of the tokenizer in ``json_path``, without added special tokens.

    ``ranks_path`` holds the same vocabulary as ranks for a faster library; texts with one of
    the tokenizer's special strings go through the tokenizer itself.
    """
    key = (json_path, ranks_path, pattern)
    if key not in _encoders:
        import json

        import tiktoken

        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        with open(json_path, encoding="utf-8") as file:
            special = [t["content"] for t in json.load(file).get("added_tokens", [])]
        exact = []

        def ids(text: str) -> np.ndarray:
            if any(s in text for s in special):
                if not exact:
                    from tokenizers import Tokenizer

                    exact.append(Tokenizer.from_file(json_path))
                return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)
            return fast.encode_to_numpy(text, disallowed_special=())

        _encoders[key] = ids
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Stored pieces with ``part`` (the task that made it) and ``idx`` (its count there among its length)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "idx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, seen = encoder(*tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            owner, rows = [], []
            for at, value in enumerate(batch.column(1)):
                ids = np.append(ids_of(value.as_py() or ""), END_ID).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    owner.append(at)
                    rows.append((piece, start, end - start, zlib.crc32(ids[start:end].tobytes()), part, seen[end - start]))
                    seen[end - start] += 1
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            for values, kind in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()), strict=True):
                columns.append(pa.array(values, kind))
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, idx long"
    return stored(chosen.mapInArrow(run, schema), "pieces")


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each document and its place in a sequence of at most ``capacity`` ids.

    A document is the ids of its text and one closing id. Null and empty texts are the closing
    id alone. Only longer documents are cut; the first piece may be shorter. Rows are packed
    one by one, so repeats and null ids need no rule; other columns are left out, and an empty
    table gives an empty result.
    """
    made = pieces(docs, (json_path, ranks_path, pattern), capacity, id_col, text_col)
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    places = slots(plan({row["length"]: row["n"] for row in by_length}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = made.join(earlier, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("idx"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(places["key"], length * _BIG + rank, "right") - 1
            sequence = places["base"][at] + rank - places["first"][at]
            columns = [*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(places["offset"][at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = made.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*names[:5], "rank").mapInArrow(run, schema)
