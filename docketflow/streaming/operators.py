"""Incremental operators on streams (K1-K18): each takes and gives streaming DataFrames, or writes micro-batches idempotently.

Timestamps must be TIMESTAMP, not TIMESTAMP_NTZ, for watermarks. Late rows are never dropped in the record
path: only bounded variants carry a watermark.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampType

from docketflow.session import exists

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_table(spark: SparkSession, path: str, files_per_trigger: int = 1, schema: StructType | None = None) -> DataFrame:
    """A Parquet table as a stream; progress lives in the checkpoint, files a trigger bound the rate."""
    kind = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, ts: str, width: str, *keys: str, watermark: str | None = None) -> DataFrame:
    """K8: counts by window and keys."""
    e = events.withWatermark(ts, watermark) if watermark else events
    g = e.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("window_start"), *keys, "n")


def sliding(events: DataFrame, ts: str, width: str, slide: str, *keys: str, watermark: str | None = None) -> DataFrame:
    """K9: trailing windows, such as 24 hours ending every hour."""
    e = events.withWatermark(ts, watermark) if watermark else events
    g = e.groupBy(F.window(ts, width, slide).alias("w"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("w.end").alias("window_end"), *keys, "n")


def sessions(events: DataFrame, ts: str, gap: str, key: str, watermark: str | None = "1 hour") -> DataFrame:
    """Sessions of a key by a gap in event time. Without a watermark (complete mode) none is left out, late rows neither."""
    e = events.withWatermark(ts, watermark) if watermark else events
    g = e.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")


def journal_once(events: DataFrame, keys: list[str], ts: str | None = None, watermark: str | None = None) -> DataFrame:
    """K5: each key and event once. With a watermark the state is bounded and only duplicates within it are dropped."""
    if watermark and ts:
        return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


class Streaks(StatefulProcessor):
    """Consecutive failures of a worker and since when its state has held, over all batches.

    Rows may come in any order: the rows of the last run are kept, and the place of the last row before it. A row
    before that place changes no result but the count; any other is put where it belongs.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("worker", StructType([StructField("bad", BooleanType()), StructField("ts", TimestampType()), StructField("event_id", LongType()), StructField("rows", LongType())]))
        self.run = handle.getListState("run", StructType([StructField("ts", TimestampType()), StructField("event_id", LongType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bad, edge_ts, edge_id, seen = self.state.get() if self.state.exists() else (None, None, None, 0)
        run = [(pd.Timestamp(ts), i, bad) for ts, i in self.run.get()] if self.run.exists() else []
        batch = pd.concat(list(rows))
        seen += len(batch)
        new = [(ts, i, bool(b)) for ts, i, b in zip(batch["ts"], batch["event_id"], batch["bad"], strict=True)]
        if edge_ts is not None:
            new = [r for r in new if r[:2] > (pd.Timestamp(edge_ts), edge_id)]
        run = sorted(run + new, key=lambda r: r[:2])
        bad = run[-1][2]
        start = len(run)
        while start and run[start - 1][2] == bad:
            start -= 1
        if start:
            edge_ts, edge_id = run[start - 1][:2]
        run = run[start:]
        self.state.update((bad, edge_ts, edge_id, seen))
        if new:
            self.run.put([r[:2] for r in run])
        yield pd.DataFrame({"worker": [key[0]], "streak": [len(run) if bad else 0], "bad": [bad], "since": [run[0][0]], "rows": [seen]})

    def close(self) -> None:
        pass


def worker_state(events: DataFrame) -> DataFrame:
    """(worker, event_id, ts, bad) rows to the state of every worker that a batch touches."""
    return events.groupBy("worker").transformWithStateInPandas(Streaks(), outputStructType="worker long, streak long, bad boolean, since timestamp, rows long", outputMode="Update", timeMode="None")


@contextlib.contextmanager
def rocks(spark: SparkSession):
    """The state store that transformWithState needs, for the queries started inside; the old setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def append_new(path: str, keys: list[str], parts: int = 64) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that appends rows whose key the table lacks, so a replayed batch adds nothing.

    A batch is one folder, which is overwritten when the batch is replayed. Its rows are in order of a hash of the key, so
    that a later batch skips the row groups that it has no key of. Before the first batch there is no table; any other
    error of a read fails the batch, as rows would else be written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys).withColumn("part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
        if exists(spark, path):
            mine = [r.part for r in new.select("part").distinct().collect()]  # at most `parts` numbers
            have = spark.read.parquet(path).filter(F.col("part").isin(mine) & (F.col("batch_id") != number)).select(*keys)
            new = new.join(have, keys, "left_anti")
        new = new.withColumn("batch_id", F.lit(number)).repartitionByRange("part").sortWithinPartitions("part")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write


def on_change(action: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run an action only for batches with rows."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            action(batch, number)

    return write


def split_poison(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the side output of those that didn't."""
    return rows.filter(F.col(error).isNull()).drop(error), rows.filter(F.col(error).isNotNull())


def late(events: DataFrame, filed: str, claimed: str) -> DataFrame:
    """K6: the filing day never moves; rows that claim an earlier day are kept and flagged."""
    return events.withColumn("is_backfill", F.coalesce(F.col(claimed) < F.col(filed), F.lit(False)))


def poll_interval(minutes: F.Column, errors: F.Column, used: F.Column, budget: F.Column) -> F.Column:
    """The next interval: doubled for each of up to three errors, and once more from 70 % of the budget on."""
    return minutes * F.pow(F.lit(2), F.least(errors, F.lit(3))) * F.when(used >= 0.7 * budget, 2).otherwise(1)


def finalizable(day: F.Column, now_ny: F.Column, done: F.Column, failures: F.Column, grace_hours: int = 6) -> F.Column:
    """A closed New York day that isn't finalised and has failed fewer than three times."""
    return (now_ny >= F.date_add(day, 1).cast("timestamp_ntz") + F.expr(f"INTERVAL {grace_hours} HOURS")) & ~F.coalesce(done, F.lit(False)) & (F.coalesce(failures, F.lit(0)) < 3)
