"""N-gram Jaccard join with signature trees: exact links, exact components.

1. Each text becomes a set of shingle hashes, and a row with its size, digest, a bitmap of its
   shingles and its prefix: the shingles of which a linked text must share one. The prefix is
   taken in one order for all texts: by hash, with shingles that a bounded sample shows to be
   frequent at the end, so that passages in many texts do not gather them all.
2. Texts meet at shared prefix shingles. Shingles with the same members count once.
3. Large groups of near copies become one component first: in rounds, each meeting compares a
   leader from its largest component with all members outside it, and what links is contracted.
   A round takes as many pairs as there are memberships, and the rounds go on while they link
   a fair share of what they compare.
4. A signature tree stands over the members of each meeting that still holds several
   components: nodes hold OR-combined bitmaps and size ranges, and two nodes are only looked
   into if their largest possible overlap can reach the threshold and they are not in one
   component already. Meetings of many members are split into blocks, and each two blocks meet.
   Two texts that share many tokens are a pair in the first meeting only, told from the tokens
   of earlier meetings that their rows list.
5. Pairs are verified on the whole sets.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import let, lower_ascii, stored
from gleanframe.llm.components import components
from gleanframe.llm.fingerprint import shingle_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PERCENT = 80
WORDS = 5
#: Bits of a bitmap for sets of up to as many shingles; larger sets have a power of two times it.
BITS = 1024
#: The sample that tells frequent shingles, and how many of its texts must share one.
SAMPLE, FREQUENT = 5000, 8
#: Members of a meeting that one task compares at once.
BLOCK = 4000
LEAF = 8
#: Meetings of up to so many members are compared as leaves, many meetings at once.
SMALL = 32
#: Tokens of earlier meetings that a member lists; two that have only later ones in common may pair again.
EARLIER = 64
#: Rounds of leaders end when fewer than one in so many compared pairs links.
FAIR = 10
#: Rows that a task describes at a time.
ROWS = 1_000
#: So many texts are looked up by broadcast, more by a shuffle of the texts.
FEW = 200_000


def shingle_set(text: Column, n: int = WORDS) -> Column:
    """Sorted distinct hashes of the shingles of a text with A-Z lower-cased."""
    return F.sort_array(F.array_distinct(shingle_hashes(lower_ascii(F.coalesce(text, F.lit(""))), n)))


def prefix_length(n: int, percent: int) -> int:
    return n + percent * -n // 100 + 1


def level_of(n: int) -> int:
    """The number of doublings of ``BITS`` until there is a bit for each shingle."""
    return max(0, (max(n, 1) - 1).bit_length() - (BITS - 1).bit_length())


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bits at the hashes' low digits; half as many bits are the OR of both halves."""
    bits = np.zeros(BITS << level_of(len(hashes)), np.uint8)
    bits[hashes.view(np.uint64) & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: list[bytes], level: int) -> np.ndarray:
    """Bitmaps of one level from bitmaps of that or the next level, as a matrix of words."""
    words = (BITS << level) // 64
    out = np.zeros((len(bits), words), np.uint64)
    for row, value in enumerate(bits):
        part = np.frombuffer(value, np.uint64)
        out[row] = part if len(part) == words else np.bitwise_or.reduce(part.reshape(-1, words))
    return out


def single(sizes: np.ndarray, bits: np.ndarray, labels: np.ndarray) -> tuple:
    """Texts as nodes: smallest and largest size, OR of bitmaps, largest size beyond the bitmap, extreme labels."""
    return sizes, sizes, bits, sizes - np.bitwise_count(bits).sum(1).astype(np.int64), labels, labels


class SignatureTree:
    """Nodes over texts sorted by size: arrays for each level, leaves of ``LEAF`` texts first."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, labels: np.ndarray):
        self.order = np.lexsort((bits[:, 0], sizes))
        sizes, bits, labels = sizes[self.order], bits[self.order], labels[self.order]
        level = single(sizes, bits, labels)
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), LEAF)
            joins = (np.minimum, np.maximum, np.bitwise_or, np.maximum, np.minimum, np.maximum)
            level = tuple(join.reduceat(values, starts, axis=0) for join, values in zip(joins, level, strict=True))
            self.levels.append(level)


def dual_traversal(a: SignatureTree, b: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of texts (indexes before sorting) that may link and are not in one component.

    Goes down both trees level by level; each level's pairs of nodes are tested at once.
    """
    top = max(len(a.levels), len(b.levels)) - 1
    x, y = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for depth in range(top, -1, -1):
        la, lb = a.levels[min(depth, len(a.levels) - 1)], b.levels[min(depth, len(b.levels) - 1)]
        keep = may_link(la, lb, x, y, percent)
        x, y = x[keep], y[keep]
        if a is b:
            x, y = x[x <= y], y[x <= y]
        if depth == 0:
            break
        x, y = _children(x, y, a, b, depth)
    if a is b:
        x, y = x[x < y], y[x < y]
    return a.order[x], b.order[y]


def may_link(la: tuple, lb: tuple, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes hold texts that may link; as many at once as have 8 MB of bitmaps."""
    size = max(64, (1 << 20) // la[2].shape[1])
    parts = [_may_link(la, lb, x[at : at + size], y[at : at + size], percent) for at in range(0, len(x), size)]
    return np.concatenate([np.zeros(0, bool), *parts])


def _may_link(la: tuple, lb: tuple, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    keep = (100 * la[1][x] >= percent * lb[0][y]) & (100 * lb[1][y] >= percent * la[0][x])
    keep &= ~((la[4][x] == la[5][x]) & (lb[4][y] == lb[5][y]) & (la[4][x] == lb[4][y]))
    some = np.flatnonzero(keep)
    shared = np.bitwise_count(la[2][x[some]] & lb[2][y[some]]).sum(1).astype(np.int64)
    most = shared + np.minimum(la[3][x[some]], lb[3][y[some]])
    keep[some] = (100 + percent) * most >= percent * (la[0][x[some]] + lb[0][y[some]])
    return keep


def _children(x: np.ndarray, y: np.ndarray, a: SignatureTree, b: SignatureTree, depth: int):
    spread = np.arange(LEAF)
    # a tree that is lower than the other waits at its root
    xs = x[:, None] * LEAF + spread if depth < len(a.levels) else x[:, None]
    ys = y[:, None] * LEAF + spread if depth < len(b.levels) else y[:, None]
    x = np.repeat(xs, ys.shape[1], axis=1).ravel()
    y = np.tile(ys, (1, xs.shape[1])).ravel()
    na = len(a.levels[min(depth - 1, len(a.levels) - 1)][0])
    nb = len(b.levels[min(depth - 1, len(b.levels) - 1)][0])
    real = (x < na) & (y < nb)
    return x[real], y[real]


def describe(docs: DataFrame, id_col: str, text_col: str, percent: int, sample: int = SAMPLE) -> DataFrame:
    """Stored (doc_id, rid, n, key, digest, bits, prefix); the last two only where a task first sees a digest."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marks = given.select(F.xxhash64("doc_id", "text").alias("mark"))
    drawn = F.broadcast(marks.orderBy("mark").limit(sample).distinct())  # at most ``sample`` numbers
    texts = given.withColumn("mark", F.xxhash64("doc_id", "text")).join(drawn, "mark", "left_semi")
    texts = texts.groupBy("mark").agg(F.max("text").alias("text"))  # rows that stand many times count once
    common = texts.select(F.explode(shingle_set(F.col("text"))).alias("h")).groupBy("h").count()
    # bounded by the shingles of the sample
    rows = common.where(F.col("count") >= FREQUENT).select("h").toPandas()
    frequent = np.sort(rows["h"].to_numpy(np.int64)) if len(rows) else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, seen = TaskContext.get().partitionId() << 33, 0, set()
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            lists = batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            out = []
            for at in range(batch.num_rows):
                s = flat[offsets[at] : offsets[at + 1]]
                digest, prefix, bits = hashlib.blake2b(s.tobytes(), digest_size=16).digest(), None, None
                if len(s) and digest not in seen:
                    seen.add(digest)
                    late = np.zeros(len(s), bool)
                    if len(frequent):
                        late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    prefix = np.concatenate([s[~late], s[late]])[: prefix_length(len(s), percent)]
                    bits = bitmap(s).tobytes()
                out.append((task | count, len(s), digest, bits, prefix))
                count += 1
            rid, n, digests, bits, prefixes = zip(*out, strict=True) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(rid, pa.int64()),
                    pa.array(n, pa.int64()),
                    batch.column(2),
                    pa.array(digests, pa.binary()),
                    pa.array(bits, pa.binary()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                ["doc_id", "rid", "n", "key", "digest", "bits", "prefix"],
            )

    sets = given.select("doc_id", shingle_set(F.col("text")).alias("s"))
    sets = sets.withColumn("key", F.xxhash64("s"))
    kind = sets.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rid long, n long, key long, digest binary, bits binary, prefix array<bigint>"
    return stored(sets.mapInArrow(run, schema), "shingle-sets")


def meetings(described: DataFrame, reps: DataFrame) -> DataFrame:
    """(token, rep, members) of shared prefix shingles; of those with the same members only one."""
    tokens = described.select("rid", F.explode("prefix").alias("token"))
    twice = tokens.groupBy("token").agg(F.count("*").alias("n_here")).where("n_here > 1")
    shared = tokens.join(twice, "token")
    rows = stored(shared.select("token", "rid").join(reps, "rid").select("token", "rep").distinct(), "meetings")
    signed = rows.groupBy("token").agg(
        F.count("*").alias("members"),
        F.sum(F.xxhash64("rep").bitwiseAND(2**40 - 1)).alias("s1"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"),
    )
    kept = signed.where("members > 1").groupBy("members", "s1", "s2").agg(F.min("token").alias("token"))
    return stored(rows.join(kept.select("token", "members"), "token"), "meetings")


def mixed(met: DataFrame, known: DataFrame) -> DataFrame:
    """The members, with what is ``known`` of them, of meetings that hold more than one component.

    ``before`` has the smallest tokens of a member's other such meetings, as far as they are
    smaller than the token itself; a member has no more tokens than its prefix.
    """
    named = met.join(known.select("rep", "label"), "rep")
    several = named.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("token")
    own = named.join(several, "token", "left_semi").groupBy("rep")
    own = own.agg(F.sort_array(F.collect_list(F.struct("token", "members"))).alias("own")).join(known, "rep")
    rows = own.select("rep", "n", "bits", "label", F.col("own.token").alias("tokens"), F.posexplode("own").alias("at", "here"))
    before = F.slice("tokens", F.lit(1), F.least("at", F.lit(EARLIER)))
    return rows.select("here.token", "rep", "here.members", "n", "bits", "label", before.alias("before"))


def leader_pairs(met: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(a, b): a leader of each meeting's largest component with every member outside it."""
    named = met.join(labels, "rep").select("token", "rep", "label")
    parts = named.groupBy("token", "label").agg(
        F.count("*").alias("size"), F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("leader")
    )
    largest = F.max_by(F.struct("label", "leader"), F.struct("size", -F.col("label"))).alias("main")
    mains = parts.groupBy("token").agg(F.count("*").alias("parts"), largest).where("parts > 1")
    mains = mains.select("token", F.col("main.label").alias("main"), F.col("main.leader").alias("leader"))
    outside = named.join(mains, "token").where("label <> main")
    return outside.select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct()


def leader_links(met: DataFrame, facts: DataFrame, sets: Sets, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that rounds of leaders find, and (rep, label) of all texts by them.

    The first round covers all meetings, later ones those of more than ``SMALL`` members.
    """
    ends = [facts.select(F.col("rep").alias(c), F.col("n").alias("n" + c), F.col("bits").alias("bits" + c)) for c in "ab"]
    labels, links, turn = facts.select("rep", F.col("rep").alias("label")), None, 0
    while True:
        pairs = leader_pairs(met if turn == 0 else met.where(F.col("members") > SMALL), labels, turn)
        pairs = pairs.join(ends[0], "a").join(ends[1], "b").where(bitmaps_allow(percent)("na", "bitsa", "nb", "bitsb"))
        pairs = stored(pairs.select("a", "b"), "leader-pairs")
        found = stored(linked(pairs, sets.of(pairs), percent), "leader-links")
        links = found if links is None else links.unionByName(found)
        compared, new, turn = pairs.count(), found.count(), turn + 1
        if new:
            labelled = facts.select("rep").join(components(links).withColumnRenamed("id", "rep"), "rep", "left")
            labels = stored(labelled.withColumn("label", F.coalesce("label", "rep")), "labels")
        if new * FAIR < compared or not new:
            return links, labels


def tree_pairs(rows: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Distinct pairs (a, b) that the trees leave of ``rows`` (token, rep, members, n, bits, label, before).

    Texts meet by token, by bitmap size and, where many meet, by pairs of blocks. A text whose
    size is just above a bitmap size also meets those just below.
    """
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BITS))).cast("int")
    also = F.array_compact(F.array(F.when((level > 0) & (F.col("n") * percent <= 100 * F.lit(BITS) * F.pow(2.0, level - 1)), level - 1)))
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    placed = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.withColumn("level", F.explode(F.concat(F.array(level), also)))
    keys = ["level", "token", "low", "high"]
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = placed.select(*keys, "own", "rep", "n", "label", "bits", "before").repartition(parts, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = 0
            marks = np.stack([held[k].to_numpy() for k in keys])
            if len(starts := np.flatnonzero((np.diff(marks) != 0).any(0))):
                last = int(starts[-1]) + 1  # the last meeting may go on
            if last:
                yield from compared(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from compared(held)

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        levels = table["level"].to_numpy()
        for value in np.unique(levels).tolist():
            first, end = np.searchsorted(levels, [value, value + 1])
            for at in meeting_slices(table.slice(first, end - first)):
                part = table.slice(first + at.start, at.stop - at.start)
                pairs = compare(part, value)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def meeting_slices(table: pa.Table) -> Iterator[slice]:
        """Whole meetings, some thousand rows at a time."""
        marks = np.stack([table[k].to_numpy() for k in keys])
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(marks) != 0).any(0)) + 1, [table.num_rows]])
        begin = 0
        for k in range(1, len(cuts)):
            if cuts[k] - cuts[begin] >= BLOCK or k == len(cuts) - 1:
                yield slice(int(cuts[begin]), int(cuts[k]))
                begin = k

    def compare(table: pa.Table, value: int) -> np.ndarray:
        nodes = single(table["n"].to_numpy(), folded(table["bits"].to_pylist(), value), table["label"].to_numpy())
        rep, own, low, high = (table[c].to_numpy() for c in ("rep", "own", "low", "high"))
        marks = np.stack([table[k].to_numpy() for k in keys])
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(marks) != 0).any(0)) + 1, [table.num_rows]])
        sizes, found = np.diff(cuts), []
        small = (sizes <= SMALL) & (low[cuts[:-1]] == high[cuts[:-1]])
        for size in np.unique(sizes[small]).tolist():
            i, j = np.triu_indices(size, 1)
            starts = cuts[:-1][small & (sizes == size)]
            x, y = (starts[:, None] + i).ravel(), (starts[:, None] + j).ravel()
            keep = may_link(nodes, nodes, x, y, percent)
            found.append((x[keep], y[keep]))
        for start, size in zip(cuts[:-1][~small].tolist(), sizes[~small].tolist(), strict=True):
            at = np.arange(start, start + size)
            left, right = at[own[at] == low[start]], at[own[at] == high[start]]
            if len(left) and len(right):
                one = SignatureTree(nodes[0][left], nodes[2][left], nodes[4][left])
                two = one if low[start] == high[start] else SignatureTree(nodes[0][right], nodes[2][right], nodes[4][right])
                x, y = dual_traversal(one, two, percent)
                found.append((left[x], right[y]))
        if not found:
            return np.zeros((0, 2), np.int64)
        x, y = (np.concatenate(side) for side in zip(*found, strict=True))
        keep = first_met(table["before"].combine_chunks(), x, y)
        a, b = rep[x[keep]], rep[y[keep]]
        return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)

    return sorted_rows.mapInArrow(run, "a long, b long").distinct()


def first_met(before: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of rows have no token of an earlier meeting in common; where they have, that meeting gave the pair."""
    offsets, tokens = before.offsets.to_numpy(), before.values.to_numpy()
    listed = {i: frozenset(tokens[offsets[i] : offsets[i + 1]].tolist()) for i in np.union1d(x, y).tolist()}
    out = np.zeros(len(x), bool)
    for at in range(0, len(x), 100_000):
        part = slice(at, at + 100_000)
        out[part] = [listed[i].isdisjoint(listed[j]) for i, j in zip(x[part].tolist(), y[part].tolist(), strict=True)]
    return out


def bitmaps_allow(percent: int):
    """Whether two texts may link by their sizes and bitmaps, as a column function."""

    @F.pandas_udf("boolean")
    def allow(na: pd.Series, bits_a: pd.Series, nb: pd.Series, bits_b: pd.Series) -> pd.Series:
        na, nb = na.to_numpy(np.int64), nb.to_numpy(np.int64)
        levels = np.array([level_of(n) for n in np.minimum(na, nb).tolist()])
        out = (100 * na >= percent * nb) & (100 * nb >= percent * na)
        for value in np.unique(levels[out]).tolist():
            at = np.flatnonzero(out & (levels == value))
            here = np.arange(len(at))
            a = single(na[at], folded(bits_a.iloc[at].tolist(), value), here)
            b = single(nb[at], folded(bits_b.iloc[at].tolist(), value), here + len(at))
            out[at] = may_link(a, b, here, here, percent)
        return pd.Series(out)

    return allow


class Sets:
    """Shingle sets by rep, made from the texts when a pair first needs them."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, members: DataFrame):
        self.texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.keys = members.select(F.col("doc_id").alias("i"), F.col("rid").alias("rep"), "key")
        self.made: DataFrame | None = None

    def of(self, pairs: DataFrame) -> DataFrame:
        """(rep, s), those of all texts in ``pairs`` among them.

        Rows may share an id: the key tells which is meant, the others have no set.
        """
        needed = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        if self.made is not None:
            needed = needed.join(self.made, "rep", "left_anti")
        wanted = stored(self.keys.join(needed, "rep"), "wanted")
        if (n := wanted.count()) == 0 and self.made is not None:
            return self.made
        if n <= FEW:
            wanted = F.broadcast(wanted)  # so few rows at most; the texts then stay where they are
        met = self.texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("i")))
        meant = let(shingle_set(F.col("text")), lambda s: F.when(F.xxhash64(s) == F.col("key"), s))
        new = stored(met.select("rep", meant.alias("s")).where("s is not null"), "pair-sets")
        self.made = new if self.made is None else self.made.unionByName(new)
        return self.made


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose sets reach the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(both * (100 + percent) >= (F.size("sa") + F.size("sb")) * percent).select("a", "b").distinct()


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    Two rows link when their shingle sets have a Jaccard index of at least ``percent``; rows
    with equal sets link too. ``component_id`` is the smallest id reachable. Null and empty
    texts, and those without words, have no shingles and are components of their own. Rows
    that share an id stay apart; null ids never are a component's smallest id unless all of
    its ids are null. Other columns are left out; an empty table gives an empty result.
    """
    rows = describe(docs, id_col, text_col, percent)
    first = rows.where("n > 0").groupBy("digest").agg(F.min("rid").alias("rep"))
    members = rows.select("doc_id", "rid", "n", "key", "digest").join(first, "digest", "left").drop("digest")
    members = stored(members.select("doc_id", "rid", "n", "key", F.coalesce("rep", "rid").alias("rep")), "members")
    reps = members.where("n > 0").select("rid", "rep")
    met = meetings(rows, reps)
    facts = rows.where("bits is not null").select(F.col("rid").alias("rep"), "n", "bits")
    facts = stored(facts.join(met.select("rep").distinct(), "rep"), "signatures")
    sets = Sets(docs, id_col, text_col, members)
    links, labels = leader_links(met, facts, sets, percent)
    known = stored(facts.join(labels, "rep"), "labelled")
    others = stored(tree_pairs(mixed(met, known), percent, block), "tree-pairs")
    labels = components(links.unionByName(linked(others, sets.of(others), percent))).withColumnRenamed("id", "rep")

    named = members.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
