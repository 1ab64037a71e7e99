"""Attempt ladders as keyed state (K11, K14): attempts, label and since when, with timers and a first state from a table.

A key's rows say when it was tried and whether that failed. A success puts it at the foot of its ladder (`ok`); each
failure is a step (`retrying`), and from `most` failures on it is `exhausted`. A retrying key that isn't tried again
within `patience` is `overdue` from then on, until its next row. `since` moves only when the label does.

Rows may come in any order within the stream's watermark: those newer than it wait in a list, those it has passed are
folded into one value, so that state is bounded by the watermark's delay whatever a key's history. A key at the foot of
its ladder without waiting rows needs no state but its first `since`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = T.StructType([T.StructField("attempts", T.LongType()), T.StructField("label", T.StringType()), T.StructField("since", T.LongType()), T.StructField("last", T.LongType()), T.StructField("seen", T.LongType())])
ROW = T.StructType([T.StructField("at", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("failed", T.BooleanType())])
OUT = "key {kind}, attempts long, label string, since timestamp, seen long"
State = tuple[int, str | None, int | None, int | None, int]  # attempts, label, since, last row (both in microseconds), rows seen
NEW: State = (0, None, None, None, 0)


class Ladder:
    """The rules of a ladder, over one key's rows in order."""

    def __init__(self, most: int, patience: int):
        self.most, self.patience = most, patience

    def idle(self, s: State, now: int) -> State:
        """The state when nothing has come until now."""
        attempts, label, since, last, seen = s
        if label == "retrying" and last is not None and last + self.patience < now:
            return attempts, "overdue", last + self.patience, last, seen
        return s

    def tried(self, s: State, at: int, failed: bool) -> State:
        attempts, label, since, _, seen = self.idle(s, at)
        attempts = attempts + 1 if failed else 0
        new = "ok" if not attempts else "retrying" if attempts < self.most else "exhausted"
        return attempts, new, since if new == label else at, at, seen + 1

    def fold(self, s: State, rows: Iterable[tuple[int, int, bool]]) -> State:
        for at, _, failed in rows:
            s = self.tried(s, at, failed)
        return s


def micros(x: pd.Timestamp) -> int:
    return int(pd.Timestamp(x).value // 1000)


class Ladders(StatefulProcessor):
    """The ladder of each key over all batches; a row of output for each key that a batch or a timer touches."""

    def __init__(self, most: int, patience: int):
        self.rules = Ladder(most, patience)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", STATE)
        self.waiting = handle.getListState("waiting", ROW)

    def _out(self, key: tuple, s: State) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "attempts": [s[0]], "label": [s[1]], "since": [pd.Timestamp(s[2], unit="us")], "seen": [s[4]]})

    def _timer(self, s: State) -> None:
        """One timer a key: when it would be overdue."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if s[1] == "retrying":
            self.handle.registerTimer((s[3] + self.rules.patience) // 1000 + 1)  # timers count milliseconds

    def handleInitialState(self, key: tuple, initial: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        r = initial.iloc[0]
        s = (int(r["attempts"]), str(r["label"]), micros(r["since"]), micros(r["last"]), int(r["seen"]))
        self.settled.update(s)
        self._timer(s)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [r for batch in rows for r in zip(batch["ts"].to_numpy().astype("datetime64[us]").astype("int64").tolist(), batch["tie"].tolist(), batch["failed"].tolist(), strict=True)]
        waiting = sorted([*((int(a), int(i), bool(f)) for a, i, f in (self.waiting.get() if self.waiting.exists() else ())), *new])
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready = [r for r in waiting if r[0] < passed]
        waiting = waiting[len(ready) :]
        settled = self.rules.fold(tuple(self.settled.get()) if self.settled.exists() else NEW, ready)
        if settled[4]:
            self.settled.update(settled)
        if waiting:
            self.waiting.put(waiting)
        else:
            self.waiting.clear()
        now = self.rules.fold(settled, waiting)
        self._timer(now)
        yield self._out(key, now)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        settled = tuple(self.settled.get()) if self.settled.exists() else NEW
        waiting = sorted((int(a), int(i), bool(f)) for a, i, f in (self.waiting.get() if self.waiting.exists() else ()))
        now = self.rules.idle(self.rules.fold(settled, waiting), expiredTimerInfo.getExpiryTimeInMs() * 1000)
        if now[1] == "overdue":
            yield self._out(key, now)

    def close(self) -> None:
        pass


def batch_state(rows: DataFrame, most: int = 3, patience: str = "1 day") -> DataFrame:
    """The state of every key after rows (key, ts, tie, failed) of a table, by windows: key, attempts, label, since, last,
    seen. Whether a key is overdue after its last row is for the stream to say that goes on from here."""
    order = W.partitionBy("key").orderBy("ts", "tie")
    run = F.sum((~F.col("failed")).cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("_run", run).withColumn("attempts", F.when(F.col("failed"), F.row_number().over(W.partitionBy("key", "_run", "failed").orderBy("ts", "tie"))).otherwise(0))
    label = F.when(F.col("attempts") == 0, "ok").when(F.col("attempts") < most, "retrying").otherwise("exhausted")
    rows = rows.withColumn("label", label).withColumns({"_was": F.lag("label").over(order), "_then": F.lag("ts").over(order)})
    overdue = (F.col("_was") == "retrying") & (F.col("_then") + F.expr(f"INTERVAL '{int(pd.Timedelta(patience).total_seconds())}' SECOND") < F.col("ts"))
    moved = F.col("_was").isNull() | (F.col("_was") != F.col("label")) | overdue
    last = F.max_by(F.struct("attempts", "label"), F.struct("ts", "tie"))
    out = rows.groupBy("key").agg(last.alias("x"), F.max(F.when(moved, F.col("ts"))).alias("since"), F.max("ts").alias("last"), F.count("*").alias("seen"))
    return out.select("key", F.col("x.attempts").cast("long").alias("attempts"), "x.label", "since", "last", "seen")


def ladders(events: DataFrame, delay: str, most: int = 3, patience: str = "1 day", initial: DataFrame | None = None) -> DataFrame:
    """(key, ts, tie, failed) rows of a stream to the ladder of every key that a batch or a timer touches.

    `delay` is the watermark's; `initial` has a row for each key that has a state already, as `batch_state` makes them."""
    kind = events.schema["key"].dataType.simpleString()
    processor = Ladders(most, int(pd.Timedelta(patience).total_seconds() * 1_000_000))
    start = initial.groupBy("key") if initial is not None else None
    return events.withWatermark("ts", delay).groupBy("key").transformWithStateInPandas(processor, outputStructType=OUT.format(kind=kind), outputMode="Update", timeMode="EventTime", initialState=start)


def latest(states: DataFrame) -> DataFrame:
    """The last state of each key among those that a stream gave out: more rows seen, and overdue after that."""
    return states.groupBy("key").agg(F.max_by(F.struct("attempts", "label", "since", "seen"), F.struct("seen", F.col("label") == "overdue")).alias("x")).select("key", "x.*")
