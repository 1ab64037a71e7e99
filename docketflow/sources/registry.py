"""The source registry (A17, J29, M16, E12): rows with nested maps, validated as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCHEMA = "id string, name string, branch string, parent_org string, description string, type string, tier int, urls map<string, string>, method string, status string, added date, sender array<string>, adapter string"
#: The allowed values of the enumerated fields.
ENUMS = {"branch": ("legislative", "executive", "judicial", "independent"), "method": ("api", "rss", "atom", "html", "email"), "status": ("active", "planned", "blocked", "retired")}


def load(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows from JSON lines, in the registry's schema."""
    return spark.read.schema(SCHEMA).json(path)


def problems(rows: DataFrame) -> DataFrame:
    """Id and problem of every broken rule; must be empty."""
    bad = [F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), f"{c} is missing") for c in ("id", "name", "branch", "type", "method", "status")]
    bad += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*v), F.concat(F.lit(f"{c} is unknown: "), c)) for c, v in ENUMS.items()]
    bad += [
        F.when(~F.col("id").rlike(r"^[a-z0-9]+(?:-[a-z0-9]+)*$"), "id is not kebab-case"),
        F.when(F.coalesce(~F.col("tier").between(1, 4), F.lit(True)), "tier is not 1 to 4"),
        F.when((F.col("method") == "email") & (F.coalesce(F.size("sender"), F.lit(0)) <= 0), "email sources need a sender"),
        F.when(F.col("method").isin("rss", "atom") & F.col("urls")["feed"].isNull(), "feed sources need a feed url"),
        F.when((F.col("status") == "active") & (F.col("method") != "email") & (F.coalesce(F.size("urls"), F.lit(0)) <= 0), "active sources need a url"),
        F.when(F.col("_same") > 1, "id is not unique"),
    ]
    numbered = rows.withColumn("_same", F.count("*").over(W.partitionBy("id")))
    found = numbered.withColumn("problem", F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull()))).select("id", "problem")
    senders = rows.select("id", F.explode("sender").alias("s")).withColumn("n", F.count("*").over(W.partitionBy(F.lower("s")))).filter("n > 1")
    return found.union(senders.select("id", F.concat(F.lit("sender is not unique: "), F.lower("s"))))


def counts(rows: DataFrame) -> DataFrame:
    """Status counts by branch and by tier."""
    return rows.groupingSets([[F.col("branch"), F.col("status")], [F.col("tier"), F.col("status")]], "branch", "tier", "status").agg(F.count("*").alias("n"))
