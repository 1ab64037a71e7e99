"""Streaming queries over the event table: run to completion with availableNow, results as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.session import forget, shared_dir
from docketflow.streaming import operators as ops

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


def _is_folder(spark: SparkSession, d: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{d}/events.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def file_stream(spark: SparkSession, d: str) -> DataFrame:
    """The event table as a stream. A single file can't be a streaming source by its name, so its folder is read
    with a name filter."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    path = f"{d}/events.parquet" if _is_folder(spark, d) else d
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    if path == d:
        reader = reader.option("pathGlobFilter", "events.parquet")
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def finished(stream: DataFrame, mode: str) -> DataFrame:
    """All rows of a stream run over what is there now, as a Parquet table: a folder a batch, of which complete mode reads the last."""
    spark, path, done = stream.sparkSession, f"{shared_dir(stream.sparkSession)}/docketflow/stream-{uuid.uuid4().hex}", []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{number}")
        done.append(number)

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    forget(spark, f"{path}/progress", *(f"{path}/batch-{n}" for n in set(done[:-1]) - set(done[-1:]) if mode == "complete"))
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{path}/batch-{n}" for n in (done[-1:] if mode == "complete" else sorted(set(done)))])


@query("stream_tumbling_counts", "SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling_counts(spark, d):
    """Hourly counts; complete mode, so windows still open are there."""
    out = finished(ops.tumbling(file_stream(spark, d), "ts", "1 hour", "event_type"), "complete")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_sliding_counts", "SELECT CAST(e AS TIMESTAMP) AS window_end, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR * k FOR k IN range(1, 5)]) AS e FROM events) GROUP BY ALL")
def stream_sliding_counts(spark, d):
    """K9: 24 hours ending every six."""
    out = finished(ops.sliding(file_stream(spark, d), "ts", "24 hours", "6 hours", "event_type"), "complete")
    return out.withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("stream_dedupe_keys", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe_keys(spark, d):
    """K5: each key and event once."""
    return finished(ops.journal_once(file_stream(spark, d).select("user_id", "event_type"), ["user_id", "event_type"]), "append")


@query(
    "stream_session_windows",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""",
)
def stream_session_windows(spark, d):
    """Sessions by a gap of six hours; complete mode, so sessions still open at the end and late rows are there."""
    return finished(ops.sessions(file_stream(spark, d), "ts", "6 hours", "user_id", None), "complete").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@query(
    "stream_keyed_state",
    """WITH e AS (SELECT event_id, user_id, ts, event_type IN ('error', 'view') AS bad FROM events), i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island, lag(bad) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM e)
    SELECT user_id AS worker, CASE WHEN last(bad ORDER BY ts, event_id) THEN (sum(bad::INT) FILTER (WHERE island = m))::BIGINT ELSE 0 END AS streak, last(bad ORDER BY ts, event_id) AS bad, max(CASE WHEN was IS NULL OR was <> bad THEN ts END) AS since, count(*) AS rows
    FROM (SELECT *, max(island) OVER (PARTITION BY user_id) AS m FROM i) GROUP BY user_id""",
)
def stream_keyed_state(spark, d):
    """Streaks and `since` kept by worker across batches; the last state of each worker."""
    e = file_stream(spark, d).select(F.col("user_id").alias("worker"), "event_id", "ts", F.col("event_type").isin("error", "view").alias("bad"))
    with ops.rocks(spark):
        out = finished(ops.worker_state(e), "update")
    last = out.groupBy("worker").agg(F.max_by(F.struct("streak", "bad", "since", "rows"), "rows").alias("x"))
    return last.select("worker", "x.streak", "x.bad", F.col("x.since").cast("timestamp_ntz").alias("since"), "x.rows")
