"""Views of the test tables as the model's tables (packages, texts, request log, journal, registry, ledger)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.session import table

DAYS = 30
#: The same bindings in SQL, as common table expressions of the oracles.
TEXTS_SQL = "texts AS (SELECT doc_id, source AS collection, lang AS doc_type, n_chars AS char_count, text, DATE '2024-01-01' + (doc_id % 30)::INTEGER AS digest_day FROM documents)"
LOG_SQL = """log AS (SELECT event_id, ts, user_id, 'h' || (user_id % 20)::VARCHAR AS host, value AS elapsed_ms, json_extract_string(props, '$.k')::INTEGER AS attempt, event_type,
  CASE WHEN user_id % 20 = 19 THEN NULL WHEN event_type = 'error' AND user_id % 4 = 0 THEN NULL WHEN event_type = 'error' AND user_id % 4 = 1 THEN 503
       WHEN event_type = 'error' AND value > 60 THEN 404 ELSE 200 END AS status,
  CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN 'probe' ELSE 'agency' END AS client FROM events)"""
SUMMARIES_SQL = "summaries AS (SELECT DISTINCT doc_id, quality = 1 AS plain, toxic = 1 AS withdrawn FROM labels)"
REGISTRY_SQL = """registry AS (SELECT s_suppkey AS id, s_name AS name, n_name AS parent, r_name AS branch, 1 + s_suppkey % 3 AS tier,
  CASE WHEN s_acctbal < 0 THEN 'blocked' WHEN s_suppkey % 5 = 0 THEN 'planned' ELSE 'active' END AS status, 'h' || (s_suppkey % 20)::VARCHAR AS host
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def texts(spark: SparkSession, d: str) -> DataFrame:
    """M3: one extracted text a row."""
    return table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("collection"), F.col("lang").alias("doc_type"), F.col("n_chars").alias("char_count"), "text",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % DAYS).cast("int")).alias("digest_day"),
    )


def request_log(spark: SparkSession, d: str) -> DataFrame:
    """One request a row; a null status is no response, a null client a row older than the column."""
    u, e = F.col("user_id"), F.col("event_type")
    status = F.when(u % 20 == 19, None).when((e == "error") & (u % 4 == 0), None).when((e == "error") & (u % 4 == 1), 503).when((e == "error") & (F.col("value") > 60), 404).otherwise(200)
    client = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 7 == 1, "probe").otherwise("agency")
    return table(spark, d, "events").select("event_id", "ts", "user_id", F.concat(F.lit("h"), (u % 20).cast("string")).alias("host"), F.col("value").alias("elapsed_ms"), F.get_json_object("props", "$.k").cast("int").alias("attempt"), "event_type", status.alias("status"), client.alias("client"))


def summaries(spark: SparkSession, d: str) -> DataFrame:
    """M7: a row where a document has a summary; whether it has a plain one, and whether it was withdrawn."""
    return table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("plain"), (F.col("toxic") == 1).alias("withdrawn")).distinct()


def registry(spark: SparkSession, d: str) -> DataFrame:
    """Sources with branch, parent organisation, tier, status and host."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    status = F.when(F.col("s_acctbal") < 0, "blocked").when(F.col("s_suppkey") % 5 == 0, "planned").otherwise("active")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("parent"), F.col("r_name").alias("branch"), (1 + F.col("s_suppkey") % 3).alias("tier"), status.alias("status"), F.concat(F.lit("h"), (F.col("s_suppkey") % 20).cast("string")).alias("host"))


def ledger(spark: SparkSession, d: str) -> DataFrame:
    """One model call a row."""
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", F.concat_ws(":", "role", (F.col("turn") % 3).cast("string")).alias("purpose"), F.length("text").cast("long").alias("tokens"))
