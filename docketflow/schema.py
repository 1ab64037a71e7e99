"""Schemas of the model tables, their enumerations, and additive migration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "packages": "package_id string, collection string, title string, date_issued date, digest_day date, last_modified timestamp, first_seen_at timestamp, fetched_at timestamp, fetch_status string, attempts int",
    "granules": "package_id string, granule_id string, granule_class string, title string, first_seen_at timestamp",
    "extracted_texts": "package_id string, granule_id string, collection string, doc_type string, title string, agency string, metadata string, text string, char_count long, extracted_at timestamp, extractor_version int",
    "graphic_assets": "id long, package_id string, granule_id string, gid string, classification string, page int, asset_path string, status string",
    "documents": "document_id string, source_id string, stable_id string, url string, claimed_published_at string, first_observed_at timestamp, state string",
    "captures": "id long, document_id string, observed_at timestamp, status int, content_sha string, text_sha string, normalizer_version int, kind string, prev_capture_id long, archive_url string",
    "summaries": "package_id string, granule_id string, prompt_version int, method string, model string, inclusion_rule string, summary string, created_at timestamp",
    "item_journal": "observed_at timestamp, source_class string, package_id string, granule_id string, collection string, source_id string, digest_date date, event string, cycle_id string",
    "collector_state": "worker string, last_cycle_at timestamp, last_ok_at timestamp, consecutive_errors int",
    "fetch_log": "ts timestamp, url string, status int, bytes long, elapsed_ms double, attempt int, error string, client string",
    "llm_calls": "ts timestamp, purpose string, model string, input_tokens long, output_tokens long, duration_ms long, error string",
    "tags": "package_id string, granule_id string, section string, tag string, tag_kind string, method string, version int",
}
#: What the enumerated columns may hold.
ENUMS = {
    ("packages", "fetch_status"): ("pending", "fetched", "failed", "exhausted", "skipped"),
    ("graphic_assets", "classification"): ("substantive", "decorative"),
    ("graphic_assets", "status"): ("pending", "extracted", "failed"),
    ("captures", "kind"): ("new", "unchanged", "bytes_changed", "modified", "unchanged_304", "missing", "removed", "restored"),
    ("summaries", "method"): ("official", "llm"),
    ("item_journal", "event"): ("ingested", "summarized", "plain"),
}
KEYS = {"packages": ["package_id"], "granules": ["package_id", "granule_id"], "extracted_texts": ["package_id", "granule_id"], "summaries": ["package_id", "granule_id", "prompt_version"], "item_journal": ["package_id", "granule_id", "event"], "collector_state": ["worker"]}


def empty(spark: SparkSession, name: str) -> DataFrame:
    """A model table without rows."""
    return spark.createDataFrame([], TABLES[name])


def conformed(df: DataFrame, name: str) -> DataFrame:
    """Rows of an older schema in today's: columns it lacks are null, others are cast; columns beyond it go.

    The empty string stays what it is: a granule id of '' is the whole package."""
    have = set(df.columns)
    fields = empty(df.sparkSession, name).schema.fields
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def violations(df: DataFrame, name: str) -> DataFrame:
    """Rows with a value outside an enumeration or a key that isn't unique: column, value, n; must be empty."""
    out = empty(df.sparkSession, "collector_state").select(F.lit("").alias("column"), F.lit("").alias("value"), F.lit(0).cast("long").alias("n")).limit(0)
    for (table, column), allowed in ENUMS.items():
        if table == name:
            bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
            out = out.unionByName(bad.groupBy(F.lit(column).alias("column"), F.col(column).alias("value")).agg(F.count("*").alias("n")))
    if name in KEYS:
        twice = df.groupBy(*KEYS[name]).agg(F.count("*").alias("n")).filter("n > 1")
        out = out.unionByName(twice.select(F.lit("key").alias("column"), F.concat_ws("/", *KEYS[name]).alias("value"), "n"))
    return out


def append(df: DataFrame, path: str, name: str) -> None:
    """Rows added to a log; nothing is read back or rewritten."""
    conformed(df, name).write.mode("append").parquet(path)
