"""Source health (E9-E11, E22, J14-J16): outcome rates by host, ordered labels, day and hour grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.hashing import percent

#: Thresholds of the labels.
MIN_ATTEMPTS = 5
DEGRADED_RATE = 0.10
DEGRADED_STREAK = 3
QUIET_DAYS = 7
BUSY_ITEMS = 3
HEALTH_ORDER = ("delivering", "quiet", "degraded", "no-response", "no-data")


def outcomes(log: DataFrame, *keys: str) -> DataFrame:
    """Attempts, answered, unanswered, error rate and last good answer by keys. A null status is no response."""
    ok = F.col("status").between(200, 399)
    g = log.groupBy(*keys).agg(
        F.count("*").alias("attempts"), F.count_if(F.coalesce(ok, F.lit(False))).alias("answered"),
        F.max(F.when(ok, F.col("ts"))).alias("last_ok_at"),
    )
    g = g.withColumn("unanswered", F.col("attempts") - F.col("answered"))
    return g.withColumn("error_rate", F.when(F.col("attempts") > 0, F.col("unanswered") / F.col("attempts")).otherwise(0.0)).withColumn("error_rate_pct", percent(F.col("unanswered"), F.col("attempts")))


def label(items: Column, attempts: Column, answered: Column, error_rate: Column, streak: Column, days_since: Column, is_email: Column | None = None) -> Column:
    """The worst of what is observed, first match wins. Mail sources have no request facts."""
    mail = is_email if is_email is not None else F.lit(False)
    attempts, answered, error_rate, streak, items = (F.coalesce(x, F.lit(0)) for x in (attempts, answered, error_rate, streak, items))
    return (
        F.when((items == 0) & (attempts == 0) & ~mail, "no-data")
        .when(mail & (items == 0) & days_since.isNull(), "no-data")
        .when((attempts >= MIN_ATTEMPTS) & (answered == 0), "no-response")
        .when(streak >= DEGRADED_STREAK, "degraded")
        .when((attempts >= MIN_ATTEMPTS) & (error_rate >= DEGRADED_RATE), "degraded")
        .when(days_since.isNull() | (days_since > QUIET_DAYS), "quiet")
        .otherwise("delivering")
    )


def day_status(items: Column, requests: Column, failed: Column, measured: Column | None = None) -> Column:
    """The label of one day. Any failure degrades it."""
    out = F.when(failed > 0, "degraded").when(items >= BUSY_ITEMS, "high-active").when((items >= 1) | (requests > 0), "delivering").otherwise("quiet")
    return out if measured is None else F.when(measured, out).otherwise("unmeasured")


def hour_status(items: Column, requests: Column, failed: Column) -> Column:
    """The label of one hour."""
    return F.when(failed > 0, "err").when(items >= 1, "high").when(requests > 0, "ok").otherwise("quiet")


def by_host_once(sources: DataFrame, hosts: DataFrame) -> DataFrame:
    """Totals over sources with each host's requests counted once."""
    used = sources.select("host").distinct()
    return hosts.join(used, "host", "left_semi").agg(F.sum("attempts").alias("requests"), F.sum("unanswered").alias("unanswered"), F.count("*").alias("hosts"))


def streaks(events: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """Consecutive failures up to each row, by gaps and islands."""
    from pyspark.sql import Window as W

    w = W.partitionBy(key).orderBy(*order)
    out = events.withColumn("_bad", failed).withColumn("_island", F.sum(F.when(~F.col("_bad"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return out.withColumn("streak", F.sum(F.col("_bad").cast("int")).over(W.partitionBy(key, "_island").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))).drop("_bad", "_island")


def records(sources: DataFrame, volume: DataFrame, hosts: DataFrame, collectors: DataFrame, today: Column, window_days: int = 14) -> DataFrame:
    """The health record of every registered source; only active ones are measured, others have no figures.

    sources: id, name, status, host, worker, is_email. volume: id, items, last_day of the window. hosts: `outcomes` by host;
    a host's figures are those of all sources that share it. collectors: worker, streak.
    """
    on = F.col("status") == "active"
    shared = sources.filter(on).groupBy("host").agg((F.count("*") - 1).alias("shared_with"))
    j = sources.join(volume, "id", "left").join(hosts, "host", "left").join(shared, "host", "left").join(collectors, "worker", "left")
    since = F.datediff(today, F.col("last_day"))
    web = on & ~F.col("is_email")
    figures = {
        "items": F.when(on, F.coalesce("items", F.lit(0))), "last_day": F.when(on, F.col("last_day")), "days_since_item": F.when(on, since), "items_per_day": F.when(on, F.bround(F.coalesce("items", F.lit(0)) / window_days, 1)),
        "attempts": F.when(web, F.col("attempts")), "unanswered": F.when(web, F.col("unanswered")), "error_rate_pct": F.when(web, F.col("error_rate_pct")), "shared_with": F.when(web & F.col("attempts").isNotNull(), F.col("shared_with")),
        "streak": F.when(on, F.coalesce("streak", F.lit(0))), "health": F.when(on, label(F.col("items"), F.when(web, F.col("attempts")), F.when(web, F.col("answered")), F.when(web, F.col("error_rate")), F.col("streak"), since, F.col("is_email"))),
    }
    return j.select("id", "name", "host", on.alias("measured"), *[c.alias(k) for k, c in figures.items()])


def summary(rows: DataFrame, window_days: int = 14) -> DataFrame:
    """The directory's totals in one row; requests of a host count once, however many sources share it."""
    on = rows.filter("measured")
    counts = on.agg(*[F.count_if(F.col("health") == x).alias(x) for x in HEALTH_ORDER])
    labels = counts.select(F.map_from_arrays(F.array(*map(F.lit, HEALTH_ORDER)), F.array(*[F.col(f"`{x}`") for x in HEALTH_ORDER])).alias("health_counts"))
    total = rows.agg(F.count("*").alias("sources_registered"), F.count_if("measured").alias("sources_measured"), F.coalesce(F.sum("items"), F.lit(0)).alias("items_window"), F.count_if(F.col("unanswered") > 0).alias("sources_with_fetch_errors"))
    by_host = on.filter("attempts IS NOT NULL").groupBy("host").agg(F.max("attempts").alias("a"), F.max("unanswered").alias("u"))
    fetched = by_host.agg(F.count("*").alias("hosts_measured"), F.coalesce(F.sum("a"), F.lit(0)).alias("requests_window"), F.array_sort(F.collect_list(F.when(F.col("u") > 0, F.col("host")))).alias("hosts_with_fetch_errors"))
    return total.crossJoin(labels).crossJoin(fetched).withColumn("items_per_day", F.bround(F.col("items_window") / window_days, 1))  # one row each


def observed(state: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """Id, label, since, last_checked, changed after an observation. `since` moves when the label does; sources
    that are measured no more keep their row, whose last_checked tells it."""
    seen = rows.filter(F.col("measured") & F.col("health").isNotNull()).select(F.col("id").alias("_id"), "health")
    j = state.join(seen, F.col("id") == F.col("_id"), "full")
    moved = F.col("health").isNotNull() & ~F.col("health").eqNullSafe(F.col("label"))
    return j.select(F.coalesce("id", "_id").alias("id"), F.coalesce("health", "label").alias("label"), F.when(moved, now).otherwise(F.col("since")).alias("since"), F.when(F.col("health").isNotNull(), now).otherwise(F.col("last_checked")).alias("last_checked"), moved.alias("changed"))
