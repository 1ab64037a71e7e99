"""One document seen through several channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.functions.urls import canonical


def corroborate(entries: DataFrame, url: str, is_email: Column, order: list[str], within: list[str], item: str) -> DataFrame:
    """Every entry with the primary of its group, `duplicate_of` (null for a primary) and `corroborated_by`
    (how many others the primary has).

    Groups share the canonical URL within the same day (`within`); the primary is the first entry that isn't
    mail, else the first. Entries without a canonical URL stay alone. No row is dropped: this is presentation.
    """
    e = entries.withColumn("canonical", canonical(url)).withColumn("_mail", is_email.cast("int"))
    key = F.coalesce("canonical", F.concat(F.lit("\u0000"), F.col(item).cast("string")))
    first = W.partitionBy(*within, key).orderBy("_mail", *order)
    e = e.withColumn("primary", F.first(item).over(first)).withColumn("_n", F.count("*").over(W.partitionBy(*within, key)))
    same = F.col("primary") == F.col(item)
    return e.withColumn("duplicate_of", F.when(~same, F.col("primary"))).withColumn("corroborated_by", F.when(same, F.col("_n") - 1).otherwise(0)).drop("_mail", "_n")


def observation_record(entries: DataFrame, claimed: Column, day: Column) -> DataFrame:
    """Listed entries, their duplicates, then backfill, each flagged; `place` is that order.

    An entry is backfill when its claimed day is known and is another day."""
    late = F.coalesce(claimed != day, F.lit(False))
    return entries.withColumn("is_backfill", late).withColumn("place", F.when(late, 2).when(F.col("duplicate_of").isNotNull(), 1).otherwise(0))
