"""Running values in row order per key, safe when one key holds most rows.

A window partitioned by the key would put each key into one task. ``OrderedRows``
range partitions the rows by (key, order), so that a big group is cut into chunks;
each chunk is scanned on its own and gets what its predecessors add up to from a
carry table with a row for each key and chunk.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanframe.session import written

CHUNK = "_chunk"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, count, max, min or last (last non-null)."""

    kind: str
    value: Column

    def windowed(self, window) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        plain = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[self.kind]
        value = plain(self.value).over(window)
        return F.coalesce(value, F.lit(0)) if self.kind in ("sum", "count") else value

    def summarised(self, order: Column, descending: bool) -> Column:
        """The value of a whole chunk."""
        if self.kind == "last":
            latest = F.min_by if descending else F.max_by
            return latest(self.value, F.when(self.value.isNotNull(), order))
        return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[self.kind](self.value)

    def merged(self, summary: Column, window) -> Column:
        """The value of all chunks in the window, from their summaries."""
        over_chunks = replace(self, kind="sum" if self.kind == "count" else self.kind, value=summary)
        return over_chunks.windowed(window)

    def combined(self, carry: Column, local: Column) -> Column:
        if self.kind in ("sum", "count"):
            return F.coalesce(carry, F.lit(0)) + local
        if self.kind == "last":
            return F.coalesce(local, carry)
        return (F.greatest if self.kind == "max" else F.least)(carry, local)


def running_sum(value: Column) -> Running:
    return Running("sum", value)


def running_count() -> Running:
    return Running("count", F.lit(1))


def running_max(value: Column) -> Running:
    return Running("max", value)


def running_last(value: Column) -> Running:
    return Running("last", value)


class OrderedRows:
    """Rows with keys and a total order; ``running`` adds columns, ``df`` ends it."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], descending: bool):
        self._df, self._keys, self._order, self._descending = df, keys, order, descending

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        descending: bool = False,
        chunks: int | None = None,
    ) -> "OrderedRows":
        """``order`` must tell all rows of a key apart; its last column usually is a row id.

        ``chunks`` is how many parts the rows are cut into, as many as shuffle
        partitions if not given.
        """
        chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sort = [F.col(name) for name in keys] + cls._sort(order, descending)
        cut = df.repartitionByRange(chunks, *sort).withColumn(CHUNK, F.spark_partition_id())
        # written down, so that a lost executor cannot move the chunk borders
        return cls(written(cut), keys, order, descending)

    @staticmethod
    def _sort(order: list[str], descending: bool) -> list[Column]:
        return [F.col(name).desc() if descending else F.col(name).asc() for name in order]

    @property
    def df(self) -> DataFrame:
        return self._df.drop(CHUNK)

    @property
    def chunked(self) -> DataFrame:
        """The rows with the number of their chunk in ``CHUNK``; chunks of a key follow its order."""
        return self._df

    def running(self, exclusive: bool = False, **values: Running) -> "OrderedRows":
        """Add running columns; ``exclusive`` leaves out the row itself."""
        last_row = -1 if exclusive else Window.currentRow
        window = (
            Window.partitionBy(*self._keys, CHUNK)
            .orderBy(*self._sort(self._order, self._descending))
            .rowsBetween(Window.unboundedPreceding, last_row)
        )
        local = self._df.withColumns({name: value.windowed(window) for name, value in values.items()})
        return self._with(self._carry_over(local, values))

    def previous(self, **columns: Column) -> "OrderedRows":
        """Add the value each column had one row earlier (null on the first row)."""
        boxed = {name: running_last(F.struct(column.alias("v"))) for name, column in columns.items()}
        unboxed = self.running(exclusive=True, **boxed)
        return unboxed._with(unboxed._df.withColumns({name: F.col(name).getField("v") for name in columns}))

    def with_columns(self, **columns: Column) -> "OrderedRows":
        return self._with(self._df.withColumns(columns))

    def _with(self, df: DataFrame) -> "OrderedRows":
        return OrderedRows(df, self._keys, self._order, self._descending)

    def _carry_over(self, local: DataFrame, values: dict[str, Running]) -> DataFrame:
        order = F.struct(*self._order)
        chunk_totals = self._df.groupBy(*self._keys, CHUNK).agg(
            *[value.summarised(order, self._descending).alias(name) for name, value in values.items()]
        )
        in_order = Window.partitionBy(*self._keys).orderBy(CHUNK)
        before = in_order.rowsBetween(Window.unboundedPreceding, -1)
        carry = (
            chunk_totals.select(
                *[F.col(key).alias(f"_k_{key}") for key in self._keys],
                F.col(CHUNK).alias("_k_chunk"),
                F.row_number().over(in_order).alias("_nth"),
                *[value.merged(F.col(name), before).alias(f"_c_{name}") for name, value in values.items()],
            )
            .filter("_nth > 1")
            .drop("_nth")
        )
        same = [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in self._keys]
        on = reduce(Column.__and__, same, F.col(CHUNK) == F.col("_k_chunk"))
        joined = local.join(carry, on, "left")
        merged = joined.withColumns(
            {name: value.combined(F.col(f"_c_{name}"), F.col(name)) for name, value in values.items()}
        )
        return merged.drop("_k_chunk", *[f"_k_{key}" for key in self._keys], *[f"_c_{name}" for name in values])
