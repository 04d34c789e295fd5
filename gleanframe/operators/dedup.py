"""Incremental dedup and the key-value state table.

Known-id lookups are plain semi/anti joins: Catalyst broadcasts the known side
only while its size allows, and beyond that adaptive execution splits skewed
partitions of the record side. "First" and "latest" are aggregates, which
combine before the shuffle, so copies of one key never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.functions.text import blank_to_null


def _order(order: list[str]) -> Column:
    return F.struct(*order)


def _pick_row(rows: DataFrame, keys: list[Column], order: list[str], latest: bool) -> DataFrame:
    """One whole row per key: the first or the latest by ``order``; null keys are equal."""
    pick = F.max_by if latest else F.min_by
    named = [key.alias(f"_key{i}") for i, key in enumerate(keys)]
    picked = rows.groupBy(*named).agg(pick(F.struct("*"), _order(order)).alias("_row"))
    return picked.select("_row.*")


def new_ids(ids: DataFrame, known: DataFrame, key: str = "property_id") -> DataFrame:
    """Ids not exported yet; meant to run before pages are parsed."""
    return ids.join(known.select(key), key, "left_anti")


def new_records(records: DataFrame, known: DataFrame, key: str = "property_id") -> DataFrame:
    """Records whose id is not known; records without an id always pass."""
    known_keys = known.select(F.col(key).alias("_known"))
    return records.join(known_keys, blank_to_null(key) == F.col("_known"), "left_anti")


def known_records(records: DataFrame, known: DataFrame, key: str = "property_id") -> DataFrame:
    return records.join(known.select(key), key, "left_semi")


def dedup_keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row per key in the given order; rows without a key count as one group."""
    return _pick_row(rows, [F.col(key)], order, latest=False)


def duplicate_report(rows: DataFrame, key: str) -> DataFrame:
    """Rows before, rows after, and duplicates; a missing key is one value."""
    groups = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.count(F.lit(1)).alias("after"),
    )


def first_per_id(records: DataFrame, order: list[str], within: tuple[str, ...] = (), key: str = "property_id") -> DataFrame:
    """First record of each id; records without id all stay."""
    has_id = blank_to_null(key)
    # a record without id is a group of its own
    alone = F.when(has_id.isNull(), _order(order))
    return _pick_row(records, [*[F.col(name) for name in within], has_id, alone], order, latest=False)


def run_new_records(
    records: DataFrame, known: DataFrame, order: list[str], run: str = "run_id", key: str = "property_id"
) -> DataFrame:
    """Per run, the first record of each id that is not known; id-less records all stay."""
    return first_per_id(new_records(records, known, key), order, (run,), key)


def mark_known(
    records: DataFrame, known: DataFrame, order: list[str], run: str = "run_id", key: str = "property_id"
) -> DataFrame:
    """Add ``is_known``: the id was exported before, or came earlier in the same run.

    The first place of each id in a run is a minimum that combines before the shuffle; known
    ids are looked up for ids, not for rows. Records without id are never known, and a hash of
    their place spreads them over the join.
    """
    has_id = blank_to_null(key)
    alone = F.when(has_id.isNull(), F.xxhash64(*order))
    identity = F.struct(F.col(run), has_id.alias("id"), alone.alias("alone"))
    # a single column is kept as it is: its minimum needs no sort
    place = F.col(order[0]) if len(order) == 1 else _order(order)
    firsts = records.where(has_id.isNotNull()).groupBy(identity.alias("_of")).agg(F.min(place).alias("_first"))
    exported = known.select(F.col(key).alias("_known")).distinct()
    firsts = firsts.join(exported, F.col("_of.id") == F.col("_known"), "left").select(
        "_of", "_first", F.col("_known").isNotNull().alias("_exported")
    )
    found = records.withColumn("_of", identity).join(firsts, "_of", "left")
    is_known = F.coalesce(F.col("_exported") | (place > F.col("_first")), F.lit(False))
    return found.withColumn("is_known", is_known).drop("_of", "_first", "_exported")


def state_upsert(
    state: DataFrame, changes: DataFrame, key: str = "key", updated: str = "updated_at", value: str = "value_json", sequence: str | None = None
) -> DataFrame:
    """State after the changes: the latest value per key.

    Of equal times a change counts before what was stored, then the change with the larger
    ``sequence`` (a column of the changes), then the larger value.
    """
    place = F.lit(0).cast("long") if sequence is None else F.col(sequence).cast("long")
    told = [state.withColumn("_turn", F.lit(-1).cast("long")), changes.withColumn("_turn", place).select(*state.columns, "_turn")]
    return _pick_row(told[0].unionByName(told[1]), [F.col(key)], [updated, "_turn", value], latest=True).drop("_turn")


def state_delete(state: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    return state.join(keys.select(key), key, "left_anti")


def state_prefix(state: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Entries whose key starts with the literal prefix."""
    return state.filter(F.col(key).startswith(prefix))


def state_lookup(state: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    return state.join(keys.select(key), key, "left_semi")
