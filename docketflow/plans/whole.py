"""Change kinds, writes and model work over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketflow.functions import text
from docketflow.operators import change, journal, model, overlap, presentation, upsert
from docketflow.plans import bind
from docketflow.session import table

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


@query("reply_keys_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def reply_keys_difference(spark, d):
    """Keys of all documents without an answer."""
    return table(spark, d, "documents").select("doc_id").distinct().join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("title_chain")
def title_chain(spark, d):
    """The title of every text, re-cased (which SQL can't, so without SQL)."""
    own = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Granule "), F.col("doc_id").cast("string")))
    return bind.texts(spark, d).select("doc_id", presentation.title(own, F.col("text"), F.col("doc_id").cast("string"), 60).alias("title"))


@query("model_batches")
def model_batches(spark, d):
    """Model work over all texts of all sources (words as Python splits them, so without SQL)."""
    return model.answered(bind.texts(spark, d).select(F.col("doc_id").alias("key"), "text", "digest_day"), model.echo, model.FIRST, "digest_day")


@query("best_word_overlap")
def best_word_overlap(spark, d):
    """The anchor that shares most significant words of the whole text (too slow in SQL, so without)."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("id"), text.significant_words("text").alias("words"))
    anchors = table(spark, d, "benchmark").select(F.col("item_id").alias("item"), text.significant_words("text").alias("words"))
    return overlap.best_overlap(texts, anchors).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score")


@query(
    "change_kind",
    """WITH c AS (SELECT page_id AS id, lower(regexp_extract(url, '//(?:www\\.)?([^/?#]*)', 1)) AS doc, md5(html) AS content, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS t FROM pages),
    p AS (SELECT *, last_value(CASE WHEN content IS NOT NULL THEN id END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM c)
    SELECT p.id, p.prev AS prev_id, CASE WHEN p.content IS NULL THEN NULL WHEN prev IS NULL THEN 'new' WHEN q.content = p.content THEN 'unchanged' WHEN q.t IS NOT DISTINCT FROM p.t THEN 'bytes_changed' ELSE 'modified' END AS kind FROM p LEFT JOIN c q ON q.id = p.prev""",
)
def change_kind(spark, d):
    """What changed since the last content of the same host, by whole pages and their whole text."""
    host = F.lower(F.regexp_extract("url", r"//(?:www\.)?([^/?#]*)", 1))
    md5 = lambda s: F.md5(s.cast("binary"))
    c = table(spark, d, "pages").select(F.col("page_id").alias("id"), host.alias("document_id"), md5(F.col("html")).alias("content_sha"), md5(F.regexp_replace("html", "<[^>]*>", "")).alias("text_sha"), F.lit(1).alias("version"))
    return change.change_kind(c).select("id", "prev_id", "kind")


@query(
    "upsert_revision",
    """WITH t AS (SELECT o_orderkey AS id, o_orderdate AS lm, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS title FROM orders WHERE o_orderstatus <> 'P'), u AS (SELECT l_orderkey AS id, max(l_shipdate) AS lm, NULLIF(max(l_returnflag), 'N') AS title FROM lineitem GROUP BY 1)
    SELECT coalesce(t.id, u.id) AS package_id, greatest(t.lm, u.lm) AS last_modified, coalesce(t.day, CAST(u.lm AS DATE))::VARCHAR AS digest_day, coalesce(u.title, t.title) AS title, CASE WHEN t.id IS NULL OR u.lm > t.lm THEN 'pending' ELSE 'fetched' END AS fetch_status,
    CASE WHEN t.id IS NULL OR u.lm > t.lm THEN 0 ELSE 2 END AS attempts FROM t FULL JOIN u ON t.id = u.id""",
)
def upsert_revision(spark, d):
    """A listing of all line items merged into the packages, which are the orders past their pending status."""
    none = F.lit(None).cast("date")
    t = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("package_id"), F.col("o_orderdate").alias("last_modified"), none.alias("date_issued"), F.col("o_orderdate").cast("date").alias("digest_day"), F.col("o_orderstatus").alias("title"), F.lit("fetched").alias("fetch_status"), F.lit(2).alias("attempts"))
    line = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("package_id")).agg(F.max("l_shipdate").alias("last_modified"), F.nullif(F.max("l_returnflag"), F.lit("N")).alias("title"))
    u = line.select("package_id", "last_modified", none.alias("date_issued"), F.col("last_modified").cast("date").alias("digest_day"), "title")
    return upsert.upsert_revisions(t, u).select("package_id", "last_modified", F.col("digest_day").cast("string").alias("digest_day"), "title", "fetch_status", "attempts")


@query(
    "journal_reconcile",
    "WITH j AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-03') SELECT DISTINCT e.user_id, 'summarized' AS event FROM events e JOIN labels l ON l.doc_id = e.user_id WHERE e.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM j WHERE j.user_id = e.user_id)",
)
def journal_reconcile(spark, d):
    """The journal rows still to be written; the journal is that of the purchases up to a day."""
    e = table(spark, d, "events")
    have = e.filter("event_type = 'purchase' AND ts < TIMESTAMP_NTZ '2024-01-03 00:00:00'").select("user_id", F.lit("summarized").alias("event"))
    facts = e.filter("event_type = 'view'").select("user_id").join(table(spark, d, "labels").select(F.col("doc_id").alias("user_id")), "user_id", "left_semi")
    return journal.unjournaled(facts, have, ["user_id"], "summarized")
