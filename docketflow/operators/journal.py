"""Journal, pending work and triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Spacing, backlog and age of the work trigger; attempts after which an item is left; age of an assessment.
SPACING_MIN, BACKLOG, AGE_MIN = 15, 6, 60
MOST_ATTEMPTS = 3
ASSESSMENT_DAYS = 30


def unjournaled(facts: DataFrame, journal: DataFrame, keys: list[str], event: str) -> DataFrame:
    """Journal rows to append for facts that have none of this event yet; running it again gives none."""
    have = journal.filter(F.col("event") == event).select(*keys)
    return facts.dropDuplicates(keys).join(have, keys, "left_anti").withColumn("event", F.lit(event))


def model_events(layers: dict[str, DataFrame], journal: DataFrame, keys: list[str], inherit: list[str]) -> DataFrame:
    """Journal rows for several model layers, their attributes from the item's ingest row."""
    base = journal.filter("event = 'ingested'").select(*keys, *inherit)
    out = None
    for event, rows in layers.items():
        new = unjournaled(rows.select(*keys), journal, keys, event).join(base, keys, "left")
        out = new if out is None else out.unionByName(new)
    return out


def pending(selected: DataFrame, done: DataFrame, attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Selected items without a summary and with attempts left."""
    spent = attempts.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= MOST_ATTEMPTS)
    return selected.join(done, keys, "left_anti").join(spent, keys, "left_anti")


def fires(pending_count: Column, minutes_since_cycle: Column, oldest_minutes: Column) -> Column:
    """Whether the model work runs: spaced, something pending, and enough of it or old enough."""
    spaced = F.coalesce(minutes_since_cycle >= SPACING_MIN, F.lit(True))
    return spaced & (pending_count > 0) & ((pending_count >= BACKLOG) | F.coalesce(oldest_minutes >= AGE_MIN, F.lit(False)))


def regeneration(generated: Column, label: Column, previous: Column, age_days: Column) -> Column:
    """Initial, then health-change, then age; null to skip."""
    return F.when(generated.isNull(), "initial").when(label != previous, "health-change").when(age_days >= ASSESSMENT_DAYS, f"age-{ASSESSMENT_DAYS}d")


def batches(rows: DataFrame, order: list[str], size: int, *within: str) -> DataFrame:
    """`batch` numbers of at most `size` items, in order within each group (a day, a collection)."""
    return rows.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*within).orderBy(*order)) - 1) / size).cast("int"))


def progress(journal: DataFrame, keys: list[str], first: str, later: list[str], at: str = "observed_at") -> DataFrame:
    """The rows of the first event, each with the time of the same item's later events (null where it has none).

    A self join by the pivot's way: the journal is grouped by item once, whatever the number of events."""
    when = lambda e: F.min(F.when(F.col("event") == e, F.col(at)))
    g = journal.groupBy(*keys).agg(when(first).alias(first), *[when(e).alias(e) for e in later])
    return g.filter(F.col(first).isNotNull())
