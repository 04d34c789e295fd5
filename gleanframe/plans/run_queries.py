"""Queries over runs: dedup, early stop, batches, state, merge, run modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanframe.operators import dedup, runs
from gleanframe.operators.upsert import upsert_merge
from gleanframe.plans.inputs import MERGE_COLUMNS, RUN_ORDER, cte, derived
from gleanframe.plans.registry import query

_ITEMS = cte("run_items", "known_ids")
_ORDER = ", ".join(RUN_ORDER)
_KEYS = "run_id, o_orderkey, property_id"
_OUT = ["run_id", "o_orderkey", "property_id"]

_MARKED_SQL = f"""{_ITEMS}, marked AS (SELECT i.*, property_id IS NOT NULL AND (property_id IN (SELECT property_id FROM known_ids)
    OR row_number() OVER (PARTITION BY run_id, property_id ORDER BY {_ORDER}) > 1) AS is_known FROM run_items AS i),
islands AS (SELECT *, sum(CASE WHEN is_known THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS isl FROM marked),
streaks AS (SELECT *, CAST(sum(CASE WHEN is_known THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, isl ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM islands),
cuts AS (SELECT run_id, min((o_orderdate, o_orderkey)) AS cut FROM streaks WHERE streak >= 24 GROUP BY run_id),
examined AS (SELECT s.* FROM streaks AS s LEFT JOIN cuts AS c ON c.run_id = s.run_id WHERE c.cut IS NULL OR (o_orderdate, o_orderkey) <= c.cut),
batched AS (SELECT *, CAST((row_number() OVER (PARTITION BY run_id ORDER BY {_ORDER}) - 1) // 50 + 1 AS BIGINT) AS batch_no FROM examined WHERE NOT is_known)
"""


def _marked(spark, sf_dir):
    """Run items marked as known or not."""
    return dedup.mark_known(derived(spark, sf_dir, "run_items"), derived(spark, sf_dir, "known_ids"), RUN_ORDER)


def _examined(spark, sf_dir):
    return runs.scan_runs(_marked(spark, sf_dir), RUN_ORDER).filter("examined")


def _batched(spark, sf_dir):
    return _examined(spark, sf_dir).filter("batch_no is not null")


# --- dedup --------------------------------------------------------------------------


@query(
    "new_ids",
    f"""{_ITEMS} SELECT DISTINCT property_id FROM run_items WHERE property_id IS NOT NULL
AND property_id NOT IN (SELECT property_id FROM known_ids)""",
)
def new_ids(spark, sf_dir):
    ids = derived(spark, sf_dir, "run_items").select("property_id").filter("property_id is not null").distinct()
    return dedup.new_ids(ids, derived(spark, sf_dir, "known_ids"))


@query(
    "new_records",
    f"""{_ITEMS} SELECT {_KEYS} FROM run_items WHERE property_id IS NULL OR property_id NOT IN (SELECT property_id FROM known_ids)""",
)
def new_records(spark, sf_dir):
    return dedup.new_records(derived(spark, sf_dir, "run_items"), derived(spark, sf_dir, "known_ids")).select(*_OUT)


@query(
    "known_records",
    f"{_ITEMS} SELECT {_KEYS} FROM run_items WHERE property_id IN (SELECT property_id FROM known_ids)",
)
def known_records(spark, sf_dir):
    return dedup.known_records(derived(spark, sf_dir, "run_items"), derived(spark, sf_dir, "known_ids")).select(*_OUT)


@query(
    "dedup_keep_first",
    f"""{cte("all_items")} SELECT {_KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY {_ORDER}) AS n FROM all_items) AS r
WHERE n = 1""",
)
def dedup_keep_first(spark, sf_dir):
    return dedup.dedup_keep_first(derived(spark, sf_dir, "all_items"), "property_id", RUN_ORDER).select(*_OUT)


@query(
    "duplicate_report",
    f"""{cte("all_items")}, g AS (SELECT property_id, count(*) AS n FROM all_items GROUP BY property_id)
SELECT CAST(sum(n) - count(*) AS BIGINT) AS duplicates, CAST(sum(n) AS BIGINT) AS before, count(*) AS after FROM g""",
)
def duplicate_report(spark, sf_dir):
    return dedup.duplicate_report(derived(spark, sf_dir, "all_items"), "property_id")


@query(
    "run_new_records",
    f"""{_ITEMS} SELECT {_KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY run_id, property_id ORDER BY {_ORDER}) AS n FROM run_items) AS r
WHERE property_id IS NULL OR (n = 1 AND property_id NOT IN (SELECT property_id FROM known_ids))""",
)
def run_new_records(spark, sf_dir):
    items, known = derived(spark, sf_dir, "run_items"), derived(spark, sf_dir, "known_ids")
    return dedup.run_new_records(items, known, RUN_ORDER).select(*_OUT)


# --- state table --------------------------------------------------------------------

_STATE = cte("state", "state_changes")


@query(
    "state_upsert",
    f"""{_STATE} SELECT key, value_json, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY updated_at DESC) AS n
FROM (SELECT * FROM state UNION ALL SELECT * FROM state_changes) AS u) AS r WHERE n = 1""",
)
def state_upsert(spark, sf_dir):
    return dedup.state_upsert(derived(spark, sf_dir, "state"), derived(spark, sf_dir, "state_changes"))


@query("state_delete", f"{_STATE} SELECT * FROM state WHERE key NOT IN (SELECT key FROM state_changes)")
def state_delete(spark, sf_dir):
    return dedup.state_delete(derived(spark, sf_dir, "state"), derived(spark, sf_dir, "state_changes"))


@query("state_lookup", f"{_STATE} SELECT * FROM state WHERE key IN (SELECT key FROM state_changes)")
def state_lookup(spark, sf_dir):
    return dedup.state_lookup(derived(spark, sf_dir, "state"), derived(spark, sf_dir, "state_changes"))


@query("state_prefix", f"{_STATE} SELECT * FROM state WHERE starts_with(key, 'exported:')")
def state_prefix(spark, sf_dir):
    return dedup.state_prefix(derived(spark, sf_dir, "state"), "exported:")


@query(
    "upsert_merge",
    f"""{cte('stored', 'merge_batch')}, latest AS (SELECT * FROM
  (SELECT *, row_number() OVER (PARTITION BY property_id ORDER BY seq DESC) AS n FROM merge_batch) AS r WHERE n = 1)
SELECT coalesce(s.property_id, b.property_id) AS property_id,
  CASE WHEN b.property_id IS NOT NULL THEN b.title ELSE s.title END AS title,
  CASE WHEN b.property_id IS NOT NULL THEN b.price ELSE s.price END AS price, s.location AS location,
  CASE WHEN b.property_id IS NOT NULL THEN b.floor ELSE s.floor END AS floor, coalesce(s.scraped_at, 200) AS scraped_at
FROM stored AS s FULL JOIN latest AS b ON b.property_id = s.property_id""",
)
def merged(spark, sf_dir):
    batch = derived(spark, sf_dir, "merge_batch")
    now = F.lit(200).cast("long")
    return upsert_merge(derived(spark, sf_dir, "stored"), batch, ["seq"], now, MERGE_COLUMNS)


# --- within a run -------------------------------------------------------------------


@query("known_streak", f"{_MARKED_SQL} SELECT {_KEYS}, is_known, streak FROM streaks")
def known_streak(spark, sf_dir):
    marked = _marked(spark, sf_dir)
    return runs.known_streak(marked, RUN_ORDER).select(*_OUT, "is_known", "streak")


@query("early_stop", f"{_MARKED_SQL} SELECT {_KEYS}, streak FROM examined")
def early_stop(spark, sf_dir):
    return _examined(spark, sf_dir).select(*_OUT, "streak")


@query(
    "early_stop_daily_only",
    f"""{_MARKED_SQL} SELECT {_KEYS}, streak FROM examined WHERE run_id % 2 = 0
UNION ALL SELECT {_KEYS}, streak FROM streaks WHERE run_id % 2 = 1""",
)
def early_stop_daily_only(spark, sf_dir):
    mode = F.when(F.col("run_id") % 2 == 0, "daily").otherwise("resume")
    marked = _marked(spark, sf_dir)
    return runs.early_stop(marked, RUN_ORDER, mode=mode).select(*_OUT, "streak")


@query("export_batches", f"{_MARKED_SQL} SELECT {_KEYS}, batch_no FROM batched")
def export_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select(*_OUT, "batch_no")


@query(
    "last_exported",
    f"""{_MARKED_SQL}, ends AS (SELECT *, row_number() OVER (PARTITION BY run_id, batch_no ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM batched)
SELECT run_id, property_id AS last_exported_id FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY batch_no DESC) AS m
  FROM ends WHERE n = 1 AND property_id IS NOT NULL) AS e WHERE m = 1""",
)
def last_exported(spark, sf_dir):
    return runs.last_exported(_batched(spark, sf_dir), RUN_ORDER)


@query(
    "run_summary",
    f"""{_MARKED_SQL} SELECT e.run_id, scraped, skipped, coalesce(exported, 0) AS exported, coalesce(batches, 0) AS batches
FROM (SELECT run_id, count(*) AS scraped, count(*) FILTER (WHERE is_known) AS skipped FROM examined GROUP BY run_id) AS e
LEFT JOIN (SELECT run_id, count(*) AS exported, max(batch_no) AS batches FROM batched GROUP BY run_id) AS b ON b.run_id = e.run_id""",
)
def run_summary(spark, sf_dir):
    examined = _examined(spark, sf_dir)
    return runs.run_summary(examined)


# --- across runs --------------------------------------------------------------------

_OUTCOME_SQL = f"""{cte('runs')}, outcomes AS (SELECT *, CASE WHEN stream_exhausted AND pages_exhausted THEN 'COMPLETED'
  WHEN early_stop THEN 'EARLY_STOP' ELSE 'INTERRUPTED' END AS outcome FROM runs)"""


@query("run_outcome", f"{_OUTCOME_SQL} SELECT site, run_id, outcome FROM outcomes")
def run_outcome(spark, sf_dir):
    return derived(spark, sf_dir, "runs").select("site", "run_id", runs.run_outcome().alias("outcome"))


@query(
    "next_run_mode",
    f"""{_OUTCOME_SQL}, modes AS (SELECT *, CASE WHEN outcome <> 'INTERRUPTED' AND errors = 0 THEN 'daily' ELSE 'resume' END AS next_mode FROM outcomes)
SELECT site, run_id, outcome, next_mode, coalesce(lag(next_mode) OVER (PARTITION BY site ORDER BY run_id), 'resume') AS mode FROM modes""",
)
def next_run_mode(spark, sf_dir):
    moded = runs.run_modes(derived(spark, sf_dir, "runs"), started="run_id")
    return moded.select("site", "run_id", "outcome", "next_mode", "mode")
