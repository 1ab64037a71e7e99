"""Request budgets counted from the log (K13): which requests a rolling hour and a day's ceiling would have let through.

Admission is greedy: a request goes out if fewer than `hourly` admitted ones of its owner lie in the hour before it and
fewer than `daily` in its day, else it is refused and counts for nothing. That is a fold over an owner's requests, but a
day of it depends on the day before only through the requests admitted in that day's last hour. So days are folded at
once, each as a sorted stream with at most `hourly` instants in memory, and days whose last hour came out differently
than the next day assumed have that next day folded again, until nothing changes; only those days are read again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.session import forget, written

HOUR = 3_600_000_000  # microseconds
DAY = 24 * HOUR


def _folded(rows: DataFrame, hourly: int, daily: int) -> DataFrame:
    """`ok` for every row of blocks (owner, day), which begin with the admitted instants in `before`."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, recent, used = None, deque(), 0
        for b in batches:
            ok = []
            for owner, day, at, before in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("owner", "day", "at", "before")), strict=True):
                if (owner, day) != block:
                    block, recent, used = (owner, day), deque(before or ()), 0
                while recent and recent[0] <= at - HOUR:
                    recent.popleft()
                go = len(recent) < hourly and used < daily
                if go:
                    recent.append(at)
                    used += 1
                ok.append(go)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ok, pa.bool_())], [*b.schema.names, "ok"])

    ordered = rows.repartition("owner", "day").sortWithinPartitions("owner", "day", "at", "tie")
    return ordered.mapInArrow(run, T.StructType([*schema.fields, T.StructField("ok", T.BooleanType())]))


def admitted(log: DataFrame, owner: str, ts: str, tie: str, hourly: int, daily: int) -> DataFrame:
    """owner, ts, tie (which orders requests of one instant), and whether the request is `admitted`.

    Requests without an instant are not admitted. Days are those of the instants in UTC."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = log.select(F.col(owner).alias("owner"), F.col(ts).alias("ts"), F.col(tie).alias("tie"), at.alias("at"))
    timeless = rows.filter("at IS NULL").select("owner", "ts", "tie", F.lit(False).alias("admitted"))
    rows = rows.filter("at IS NOT NULL").withColumn("day", F.floor(F.col("at") / DAY)).withColumn("before", F.array().cast("array<bigint>"))
    done = written(_folded(rows, hourly, daily), "budget")
    while True:
        late = done.filter(F.col("ok") & (F.col("at") > (F.col("day") + 1) * DAY - HOUR))
        tails = late.groupBy("owner", (F.col("day") + 1).alias("day")).agg(F.sort_array(F.collect_list("at")).alias("tail"))  # at most `hourly` each
        assumed = done.groupBy("owner", "day").agg(F.any_value("before").alias("assumed"))
        same = F.col("a.owner").eqNullSafe(F.col("t.owner")) & (F.col("a.day") == F.col("t.day"))
        wrong = assumed.alias("a").join(tails.alias("t"), same, "left").select("a.owner", "a.day", F.coalesce("t.tail", F.array().cast("array<bigint>")).alias("tail"), "assumed").filter("tail <> assumed")
        wrong = written(wrong.drop("assumed"), "budget-days")
        if wrong.isEmpty():
            forget(done.sparkSession, wrong.written_at)
            break
        block = done.alias("d"), wrong.alias("w"), F.col("d.owner").eqNullSafe(F.col("w.owner")) & (F.col("d.day") == F.col("w.day"))
        again = block[0].join(block[1], block[2]).select("d.owner", "d.ts", "d.tie", "d.at", "d.day", F.col("w.tail").alias("before"))
        before, done = done, written(block[0].join(block[1], block[2], "left_anti").unionByName(_folded(again, hourly, daily)), "budget")
        forget(done.sparkSession, before.written_at, wrong.written_at)
    return done.select("owner", "ts", "tie", F.col("ok").alias("admitted")).unionByName(timeless)


def used(log: DataFrame, owner: str, ts: str, now: Column) -> DataFrame:
    """What each owner has used of its hour and its day at an instant: owner, hour_used, day_used."""
    at, now = F.col(ts).cast("timestamp"), now.cast("timestamp")
    seen = log.filter((at <= now) & (at > F.least(now - F.expr("INTERVAL 1 HOUR"), F.date_trunc("day", now) - F.expr("INTERVAL 1 SECOND"))))
    return seen.groupBy(F.col(owner).alias("owner")).agg(F.count_if(at > now - F.expr("INTERVAL 1 HOUR")).alias("hour_used"), F.count_if(at >= F.date_trunc("day", now)).alias("day_used"))
