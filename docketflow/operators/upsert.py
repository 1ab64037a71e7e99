"""Writes by key without a table format (B1-B11, B20, B21): each gives the new state of a target.

Keys are unique in the target. A null key matches nothing. Updates with several rows for a key: the last by
`order` counts. Writers overwrite only the partitions they touch (`replace_partitions`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key, the last by `order`."""
    rest = [c for c in updates.columns if c not in keys]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert_revisions(target: DataFrame, updates: DataFrame, key: str = "package_id") -> DataFrame:
    """B1: package rows (key, last_modified, date_issued, digest_day, title, fetch_status, attempts) merged with a listing.

    A newer last_modified makes the package pending again with no attempts; last_modified never falls; the
    listing's values win where it has them; the filing day is written once.
    """
    t, u = target.alias("t"), latest(updates, [key], "last_modified").alias("u")
    newer = F.col("u.last_modified") > F.col("t.last_modified")
    both = F.col(f"t.{key}").isNotNull() & F.col(f"u.{key}").isNotNull()
    j = t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full")
    return j.select(
        F.coalesce(f"t.{key}", f"u.{key}").alias(key), F.greatest("t.last_modified", "u.last_modified").alias("last_modified"),
        F.coalesce("u.date_issued", "t.date_issued").alias("date_issued"), F.coalesce("t.digest_day", "u.digest_day").alias("digest_day"), F.coalesce("u.title", "t.title").alias("title"),
        F.when(both & newer, "pending").otherwise(F.coalesce("t.fetch_status", F.lit("pending"))).alias("fetch_status"), F.when(both & newer, 0).otherwise(F.coalesce("t.attempts", F.lit(0))).alias("attempts"),
    )


def get_or_create(target: DataFrame, rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows whose key the target lacks, the first writer of each key."""
    new = rows.join(target.select(*keys), keys, "left_anti")
    rest = [c for c in rows.columns if c not in keys]
    return new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def replaced(target: DataFrame, rows: DataFrame, key: str, touched: DataFrame | None = None) -> DataFrame:
    """All rows of the touched keys replaced by the new ones; keys touched without rows lose theirs."""
    gone = (touched if touched is not None else rows).select(key).distinct()
    return target.join(gone, key, "left_anti").unionByName(rows.select(*target.columns))


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrite only the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def failed(rows: DataFrame, ids: DataFrame, key: str, ceiling: int = 48) -> DataFrame:
    """One more attempt for the keys that failed; exhausted at the ceiling."""
    j = rows.join(ids.select(key).distinct().withColumn("_f", F.lit(True)), key, "left")
    n = F.col("attempts") + F.when(F.col("_f"), 1).otherwise(0)
    status = F.when(F.col("_f"), F.when(n >= ceiling, "exhausted").otherwise("failed")).otherwise(F.col("fetch_status"))
    return j.withColumn("fetch_status", status).withColumn("attempts", n).select(*rows.columns)


def skip_old(rows: DataFrame, cutoff: Column) -> DataFrame:
    """Pending packages from before the fetch window, or without a date, are skipped."""
    old = (F.col("fetch_status") == "pending") & (F.col("date_issued").isNull() | (F.col("date_issued") < cutoff))
    return rows.withColumn("fetch_status", F.when(old, "skipped").otherwise(F.col("fetch_status")))


def withdrawn(layer: DataFrame, dependents: DataFrame, ids: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both layers without the withdrawn keys."""
    return layer.join(ids, keys, "left_anti"), dependents.join(ids, keys, "left_anti")


def stale(compositions: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    """Compositions with an input newer than they are, at second precision."""
    newest = inputs.groupBy(key).agg(F.max("created_at").alias("_newest"))
    return compositions.join(newest, key).filter(F.date_trunc("second", "_newest") > F.date_trunc("second", "created_at")).drop("_newest")


def set_value(rows: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """A column set by key after the fact; other rows keep theirs."""
    v = values.select(key, F.col(column).alias("_v"))
    return rows.join(v, key, "left").withColumn(column, F.coalesce("_v", column)).select(*rows.columns)


def backfilled(rows: DataFrame, column: str, value: Column) -> DataFrame:
    """A missing column's values filled in; the number of rows stays."""
    return rows.withColumn(column, F.coalesce(F.col(column) if column in rows.columns else F.lit(None), value))
