"""All queries outside the training-data subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.plans import domain, progress, published, readers, records, relational, sourced, streams, whole

MODULES = (relational, domain, readers, records, sourced, published, progress, streams, whole)
#: Columns that hold days are given as text on both sides, as clients map DATE to different types.
DAYS = {
    "coverage_by_day": ["day"], "daily_latency_series": ["day"], "dense_day_grid": ["day"], "holiday_calendar": ["day"], "newest_complete_day": ["day"], "newest_first_queue": ["day"],
    "publication_day_ny": ["day"], "union_events": ["day"], "upsert_revision": ["digest_day"], "window_volume_range": ["first_day", "last_day"],
}


def _as_text(f: Callable, days: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in days})

    run.__doc__ = f.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _as_text(f, DAYS[name]) if name in DAYS else f for m in MODULES for name, (f, _) in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    out = {name: sql for m in MODULES for name, (_, sql) in m.Q.items() if sql}
    for name, days in DAYS.items():
        casts = ", ".join(f"{c}::DATE::VARCHAR AS {c}" for c in days)
        out[name] = f"SELECT * REPLACE ({casts}) FROM ({out[name]})"
    return out
