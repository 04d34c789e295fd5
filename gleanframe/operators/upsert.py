"""Keyed merge of a batch into the listing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.operators.dedup import _pick_row


def upsert_merge(
    table: DataFrame, batch: DataFrame, order: list[str], now: Column, columns: list[str], key: str = "property_id"
) -> DataFrame:
    """Table after the batch: ``columns`` plus ``scraped_at``, set on first insert only.

    Only columns with some value in the batch are written; in those a null
    overwrites. A key repeated in the batch counts with its last row. A batch
    with a missing key is refused as a whole.
    """
    others = [name for name in columns if name != key]
    # one row: which columns the batch writes at all
    used = batch.agg(
        F.count_if(F.col(key).isNull()).alias("_no_key"), *[F.count(name).alias(name) for name in others]
    ).first()
    if used["_no_key"]:
        raise ValueError(f"{used['_no_key']} batch rows have no {key}")
    active = [name for name in others if used[name]]
    latest = _pick_row(batch.select(key, *active, *order), [F.col(key)], order, latest=True)
    incoming = latest.select(key, *[F.col(name).alias(f"_new_{name}") for name in active], F.lit(True).alias("_hit"))
    merged = table.join(incoming, key, "full")
    value = lambda name: (
        F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)) if name in active else F.col(name)
    )
    return merged.select(
        key, *[value(name).alias(name) for name in others], F.coalesce("scraped_at", now).alias("scraped_at")
    )
