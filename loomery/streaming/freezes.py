"""The freeze log as a stream with keyed state: who is frozen now, and which bypasses still hold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "entity_id string, at timestamp, change string, status string, bypassed boolean"
EVENT = "at long, type string, new_status string"


def _frame(entity: str, rows: list[tuple]) -> pd.DataFrame:
    text = lambda values: pd.Series(values, dtype="object")
    at, change, status, bypassed = zip(*rows) if rows else ((), (), (), ())
    return pd.DataFrame({"entity_id": text([entity] * len(rows)), "at": pd.Series(pd.to_datetime(list(at), unit="ms")), "change": text(change), "status": text(status), "bypassed": pd.Series(bypassed, dtype="bool")})


class FreezeState(StatefulProcessor):
    """Events wait in state until the watermark has passed them, and then act in the order of their times.

    So the rows don't depend on how events are cut into batches, nor on a restart. A bypass
    holds for ``hours`` and is ended by a timer, unless a newer one holds by then.
    """

    def __init__(self, hours: float) -> None:
        self.hold = int(hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", EVENT)
        self.now = handle.getValueState("now", "status string, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for at, kind, status in zip(frame["event_time"], frame["type"], frame["new_status"]):
                ms = int(at.timestamp() * 1000)
                self.waiting.appendValue((ms, kind, status if isinstance(status, str) else None))
                self.handle.registerTimer(ms)
        yield _frame(key[0], [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        held = [tuple(e) for e in self.waiting.get()] if self.waiting.exists() else []
        due = sorted((e for e in held if e[0] <= at), key=lambda e: (e[0], e[1], e[2] or ""))
        later = [e for e in held if e[0] > at]
        status, until = tuple(self.now.get()) if self.now.exists() else ("auto", 0)
        out = []
        if until and until <= at and not (due and due[0][0] < until):
            out.append((until, "bypass-ended", status, False))
            until = 0
        for when, kind, new in due:
            if kind == "bypass":
                until = when + self.hold
                self.handle.registerTimer(until)
            else:
                status = new or status
            out.append((when, kind, status, until > when))
        self.now.update((status, until))
        if due:
            if later:
                self.waiting.put(later)
            else:
                self.waiting.clear()
        yield _frame(key[0], out)

    def close(self) -> None:
        pass


def status_changes(events: DataFrame, hours: float = 24, late: str = "1 hour") -> DataFrame:
    """(entity_id, at, change, status, bypassed) as a stream, from one of entity_id, event_time, type, new_status.

    A row for every event that the watermark has passed, and one (bypass-ended) for each bypass that ran out. Events that come
    after the watermark are dropped. Needs the RocksDB state store.
    """
    given = events.select("entity_id", "event_time", "type", "new_status").withWatermark("event_time", late)
    return given.groupBy("entity_id").transformWithStateInPandas(FreezeState(hours), OUT, "Append", "EventTime")


def status_history(events: DataFrame, hours: float = 24, until: str | None = None) -> DataFrame:
    """The same rows from a whole log, as a batch; ``until`` leaves out what is later."""
    ordered = Window.partitionBy("entity_id").orderBy("event_time", "type", F.coalesce("new_status", F.lit("")))
    given = events.select("entity_id", "event_time", "type", "new_status")
    if until is not None:
        given = given.where(F.col("event_time") <= F.to_timestamp(F.lit(until)))
    set_to = F.when((F.col("type") != "bypass") & (F.nullif("new_status", F.lit("")).isNotNull()), F.col("new_status"))
    ends = F.when(F.col("type") == "bypass", F.col("event_time") + F.make_dt_interval(hours=F.lit(int(hours)), mins=F.lit(int(hours * 60) % 60)))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = given.select("*", F.coalesce(F.last(set_to, True).over(upto), F.lit("auto")).alias("status"), F.max(ends).over(upto).alias("bypass_until"), ends.alias("own_end"))
    changes = known.select("entity_id", F.col("event_time").alias("at"), F.col("type").alias("change"), "status", F.coalesce(F.col("bypass_until") > F.col("event_time"), F.lit(False)).alias("bypassed"))
    # a bypass runs out unless a newer one begins before its end; the status then is that of the last event before
    after = Window.partitionBy("entity_id").orderBy("at", F.col("change") == "bypass-ended", "change", F.coalesce("status", F.lit("")))
    bypasses = known.where("type = 'bypass'").select("entity_id", "own_end", F.lead("event_time").over(Window.partitionBy("entity_id").orderBy("event_time")).alias("following"))
    ended = bypasses.where("following is null or following >= own_end").select("entity_id", F.col("own_end").alias("at"), F.lit("bypass-ended").alias("change"), F.lit(None).cast("string").alias("status"), F.lit(False).alias("bypassed")).distinct()
    if until is not None:
        ended = ended.where(F.col("at") <= F.to_timestamp(F.lit(until)))
    return changes.unionByName(ended).withColumn("status", F.last("status", True).over(after.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
