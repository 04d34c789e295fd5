"""Stateful streaming control: early stop per crawl, ledger entries, admission and delay per host.

State is a few numbers per key, kept in the state store between micro-batches
(needs the RocksDB state store). These effects depend on row order, so a task
sorts one key's rows of one micro-batch; ``maxFilesPerTrigger`` bounds those.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleanframe.operators.ledger import ledger_effect
from gleanframe.operators.requestlog import MULTIPLIER_MAX
from gleanframe.operators.runs import EARLY_STOP_AFTER
from gleanframe.schemas import DOUBLE, FLAG, LONG, STRING, struct_of

# the processors travel with the query, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STREAK_STATE = struct_of(streak=LONG, stopped=FLAG)
SEEN_KEY, SEEN_VALUE = struct_of(property_id=STRING), struct_of(seq=LONG)
LEDGER_STATE = struct_of(error=STRING, attempts=LONG, ts_micros=LONG)
LEDGER_OUTPUT = struct_of(url=STRING, error=STRING, attempts=LONG, ts_micros=LONG)
ADMISSION_OUTPUT = struct_of(
    host=LONG, seq=LONG, t=DOUBLE, outcome=STRING, state=STRING, admitted=FLAG, multiplier=DOUBLE
)
ADMISSION_STATE = struct_of(failures=LONG, last_fail=DOUBLE, multiplier=DOUBLE)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values("seq", ignore_index=True)


class EarlyStop(StatefulProcessor):
    """Passes a crawl's rows on until ``threshold`` known rows came in a row.

    With ``repeats`` the ids of the crawl's new rows are kept, and a row whose id came
    earlier in the crawl counts as known. They expire after ``ttl_ms`` if that is set.
    """

    def __init__(self, names: list[str], threshold: int = EARLY_STOP_AFTER, repeats: bool = False, ttl_ms: int | None = None):
        self.names, self.threshold, self.repeats, self.ttl_ms = names, threshold, repeats, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("streak", STREAK_STATE)
        self._seen = handle.getMapState("seen", SEEN_KEY, SEEN_VALUE, self.ttl_ms) if self.repeats else None

    def _is_known(self, rows: pd.DataFrame) -> pd.Series:
        known = rows["is_known"].astype(bool)
        if self._seen is None:
            return known
        asked = ~known & rows["property_id"].fillna("").ne("")
        again = rows["property_id"].where(asked).duplicated() & asked
        for at in rows.index[asked & ~again]:
            key = (rows.at[at, "property_id"],)
            if self._seen.containsKey(key):
                again[at] = True
            else:
                self._seen.updateValue(key, (int(rows.at[at, "seq"]),))
        return known | again

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        streak, stopped = self._state.get() if self._state.exists() else (0, False)
        if not stopped:
            chunk = _in_order(rows)
            known = chunk["is_known"] = self._is_known(chunk)
            # rows since the last new one, or since the state was taken
            last_new = known.index.to_series().where(~known).ffill()
            since = known.index.to_series() - last_new
            since = since.where(last_new.notna(), known.index.to_series() + 1 + streak).astype("int64")
            chunk["streak"] = since
            hits = chunk.index[chunk["streak"] >= self.threshold]
            if len(hits):
                chunk, stopped = chunk.iloc[: hits[0] + 1], True
            streak = int(chunk["streak"].iloc[-1]) if len(chunk) else streak
            yield chunk[self.names]
        self._state.update((streak, stopped))

    def close(self) -> None:
        pass


class LedgerEntry(StatefulProcessor):
    """One URL's ledger entry, and what it is after each micro-batch that names the URL.

    ``attempts`` is null in a change that removes the entry.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("entry", LEDGER_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._state.get() if self._state.exists() else None
        entry = before
        acts = pd.concat(list(rows)).sort_values(["ts_micros", "seq"])
        for effect, error, at in zip(acts["effect"], acts["error"], acts["ts_micros"]):
            if effect == "remove":
                entry = None
            elif effect == "open":
                entry = (error, (entry[1] if entry else 0) + 1, int(at))
            elif entry:
                entry = (entry[0], entry[1] + 1, entry[2])
        if entry == before:
            return
        if entry is None:
            self._state.clear()
        else:
            self._state.update(entry)
        error, attempts, at = entry or (None, None, None)
        change = pd.DataFrame([(key[0], error, attempts, at)], columns=LEDGER_OUTPUT.names)
        yield change.astype({"attempts": "Int64", "ts_micros": "Int64"})

    def close(self) -> None:
        pass


class Admission(StatefulProcessor):
    """Replays breaker and delay multiplier: a request met by an open breaker is
    refused and leaves no outcome, so the state depends on every request before."""

    def __init__(self, threshold: int = 5, recovery_secs: float = 30.0):
        self.threshold, self.recovery_secs = threshold, recovery_secs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("breaker", ADMISSION_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failures, last_fail, multiplier = self._state.get() if self._state.exists() else (0, 0.0, 1.0)
        requests = _in_order(rows)
        states, multipliers = [], []
        for t, outcome in zip(requests["t"], requests["outcome"]):
            tripped = failures >= self.threshold
            state = "CLOSED" if not tripped else "HALF_OPEN" if t - last_fail >= self.recovery_secs else "OPEN"
            if state != "OPEN":
                if outcome == "success":
                    failures, multiplier = 0, max(1.0, multiplier * 0.9)
                else:
                    failures, last_fail = failures + 1, t
                    if outcome == "rate_limited":
                        multiplier = min(MULTIPLIER_MAX, multiplier * 2.0)
            states.append(state)
            multipliers.append(multiplier)
        replayed = requests.assign(state=states, multiplier=multipliers)
        yield replayed.assign(admitted=replayed["state"] != "OPEN")[ADMISSION_OUTPUT.names]
        self._state.update((failures, last_fail, multiplier))

    def close(self) -> None:
        pass


def stop_early(
    marked: DataFrame, threshold: int = EARLY_STOP_AFTER, repeats: bool = False, ttl_ms: int | None = None
) -> DataFrame:
    """Stream of rows with ``crawl_id, seq, property_id, is_known``, cut at each crawl's early stop.

    All columns pass, ``streak`` is added. With ``repeats`` an id that came earlier in its crawl
    is known too; ``is_known`` then says so.
    """
    output = T.StructType([*[f for f in marked.schema.fields if f.name != "streak"], T.StructField("streak", LONG)])
    return marked.groupBy("crawl_id").transformWithStateInPandas(
        EarlyStop(output.names, threshold, repeats, ttl_ms),
        output,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


def ledger_entries(log: DataFrame) -> DataFrame:
    """Stream of request-log rows to the entries they change: ``url, error, attempts, ts``.

    The state is one entry a URL on the ledger; ``attempts`` is null where it left the ledger.
    """
    acts = log.select("url", "seq", F.unix_micros("ts").alias("ts_micros"), "error", ledger_effect().alias("effect"))
    changed = acts.filter("effect is not null").groupBy("url").transformWithStateInPandas(
        LedgerEntry(), LEDGER_OUTPUT, outputMode="Update", timeMode="None"
    )
    return changed.select("url", "error", F.col("attempts").cast("int").alias("attempts"), F.timestamp_micros("ts_micros").alias("ts"))


def admit_requests(log: DataFrame, threshold: int = 5, recovery_secs: float = 30.0) -> DataFrame:
    """Stream of ``host, seq, t, outcome`` with breaker state, admission and multiplier."""
    return log.groupBy("host").transformWithStateInPandas(
        Admission(threshold, recovery_secs), ADMISSION_OUTPUT, outputMode="Append", timeMode="None"
    )
