"""Session defaults and table access shared by every module."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "docketflow", cores: str | None = None) -> SparkSession:
    """A session with the settings the library is tested under: UTC and AQE. With `cores`, a local one with few shuffle
    partitions for small data; without, master, partitions and memory are what spark-submit or the caller has set."""
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt over tasks by keys, ahead of work that takes long for each of them: a scan has no more tasks than
    the table has row groups, and a table of short rows may have a few of millions of rows each."""
    return rows.repartition(tasks(rows.sparkSession), *keys)


def tasks(spark: SparkSession) -> int:
    """Parts that `spread` makes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where that is unset and both are one
    process (local mode, as in tests) a temporary one is set; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() or ""
    if not folder:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):  # local-cluster has executors of its own
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docketflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads; errors of the store rise."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more; those that aren't there are none."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/docketflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out
