"""Progress and evidence over the bound tables: budgets, ladders, checked manifests, instants, discovered feeds, inventories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.functions import times
from docketflow.operators import budgets, change
from docketflow.plans.streams import finished
from docketflow.session import shared_dir, spread, table, tasks
from docketflow.sources import feeds, packages
from docketflow.streaming import ladders as steps
from docketflow.streaming import operators as ops

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


@query(
    "admitted_requests",
    """WITH RECURSIVE e AS (SELECT 'h' || (user_id % 20)::VARCHAR AS owner, ts, event_id, row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS r FROM events),
    a AS (SELECT owner, r, true AS ok, [ts] AS kept, ts::DATE AS day, 1 AS used, event_id FROM e WHERE r = 1
      UNION ALL SELECT owner, r, ok, CASE WHEN ok THEN list_append(kept, ts) ELSE kept END, ts::DATE, used + ok::INT, event_id FROM (
        SELECT *, len(kept) < 2 AND used < 12 AS ok FROM (
          SELECT e.owner, e.r, e.ts, e.event_id, list_filter(a.kept, lambda x: x > e.ts - INTERVAL 1 HOUR) AS kept, CASE WHEN e.ts::DATE = a.day THEN a.used ELSE 0 END AS used FROM a JOIN e ON e.owner = a.owner AND e.r = a.r + 1)))
    SELECT owner, event_id, ok AS admitted FROM a""",
)
def admitted_requests(spark: SparkSession, d: str) -> DataFrame:
    """The requests of the log that two an hour and twelve a day would let through, by host."""
    log = table(spark, d, "events").select(F.concat(F.lit("h"), (F.col("user_id") % 20).cast("string")).alias("host"), "ts", "event_id")
    return budgets.admitted(log, "host", "ts", "event_id", 2, 12).select("owner", F.col("tie").alias("event_id"), "admitted")


#: Parts of the table's time; the first makes the state that the stream begins with.
SLICES, PATIENCE = 4, 3


@query(
    "stream_ladders",
    f"""WITH e AS (SELECT user_id AS key, ts, event_id AS tie, event_type IN ('error', 'view') AS failed FROM events),
    w AS (SELECT max(ts) - to_seconds(floor(epoch(max(ts) - min(ts)) / {SLICES}) + 1) AS w FROM events),
    i AS (SELECT *, sum((NOT failed)::INT) OVER (PARTITION BY key ORDER BY ts, tie) AS run FROM e),
    a AS (SELECT *, CASE WHEN failed THEN row_number() OVER (PARTITION BY key, run, failed ORDER BY ts, tie) ELSE 0 END AS attempts FROM i),
    l AS (SELECT *, CASE WHEN attempts = 0 THEN 'ok' WHEN attempts < 3 THEN 'retrying' ELSE 'exhausted' END AS label FROM a),
    c AS (SELECT *, lag(label) OVER o AS was, lag(ts) OVER o AS was_ts, row_number() OVER (PARTITION BY key ORDER BY ts DESC, tie DESC) AS back, count(*) OVER (PARTITION BY key) AS seen FROM l WINDOW o AS (PARTITION BY key ORDER BY ts, tie)),
    s AS (SELECT key, max(CASE WHEN was IS NULL OR was <> label OR (was = 'retrying' AND was_ts + INTERVAL {PATIENCE} DAY < ts) THEN ts END) AS since FROM c GROUP BY key)
    SELECT c.key, attempts, CASE WHEN label = 'retrying' AND ts + INTERVAL {PATIENCE} DAY < w THEN 'overdue' ELSE label END AS label, CASE WHEN label = 'retrying' AND ts + INTERVAL {PATIENCE} DAY < w THEN ts + INTERVAL {PATIENCE} DAY ELSE since END AS since, seen
    FROM c JOIN s USING (key), w WHERE back = 1""",
)
def stream_ladders(spark: SparkSession, d: str) -> DataFrame:
    """Attempt ladders of all users. The first quarter of the time is folded as a table, whose states the stream of the
    other three begins with; timers find who is overdue at the end."""
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("tie"), F.col("event_type").isin("error", "view").alias("failed"))
    span = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if span.lo is None:
        return steps.batch_state(e).drop("last")
    width = (span.hi - span.lo) / SLICES
    # slices are written one after the other, so a stream of files meets them in this order; in a slice, any order will do.
    # A trigger takes a slice's files, whatever the table's size: each batch costs every key it touches a visit of its state
    folder = f"{shared_dir(spark)}/docketflow/journal-{uuid.uuid4().hex}"
    for k in range(1, SLICES):
        part = e.filter((F.col("ts") >= F.lit(span.lo + k * width)) & ((F.col("ts") < F.lit(span.lo + (k + 1) * width)) | F.lit(k == SLICES - 1)))
        spread(part, "key").write.mode("append").parquet(folder)
    first = steps.batch_state(e.filter(F.col("ts") < F.lit(span.lo + width)), patience=f"{PATIENCE} days")
    stream = ops.read_table(spark, folder, tasks(spark), e.schema)
    with ops.rocks(spark):
        out = finished(steps.ladders(stream, f"{int(width.total_seconds()) + 1} seconds", patience=f"{PATIENCE} days", initial=first), "update")
    return steps.latest(out.unionByName(first.drop("last"))).withColumn("since", F.col("since").cast("timestamp_ntz"))


# --- evidence ---


@query(
    "checked_evidence",
    """WITH d AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events), n AS (SELECT day, row_number() OVER (ORDER BY day) AS k, count(*) OVER () AS days FROM d)
    SELECT day, CASE k % 10 WHEN 3 THEN 'body' WHEN 5 THEN 'missing' WHEN 6 THEN 'link' WHEN 8 THEN 'header' END AS problem FROM n WHERE k % 10 IN (3, 5, 6, 8)
    UNION ALL SELECT day, CASE k % 10 WHEN 8 THEN 'link' ELSE 'rows' END FROM n WHERE k % 10 IN (8, 9) UNION ALL SELECT day, 'body' FROM n WHERE k % 10 = 9""",
)
def checked_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Stored headers held against the attempts of every day, after some were changed: of ten days one has an
    attempt with another type, one no header, one a forged predecessor, and one lost an attempt."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type", "user_id")
    order, fields = ["event_id"], ["event_id", "event_type", "user_id"]
    whole = change.day_digests(e, "day", order, fields).collect()  # one row a day
    headers = change.chain((r.day, r.rows, r.body_sha) for r in whole)
    kept = [(day, rows, body, "0" * 64 if k % 10 == 8 else prev, sha) for k, (day, rows, body, prev, sha) in enumerate(headers, 1) if k % 10 != 5]
    stored = spark.createDataFrame(kept, "day string, rows long, body_sha string, prev string, sha string")
    number = spark.createDataFrame([(h[0], k % 10) for k, h in enumerate(headers, 1)], "day string, k int")
    first = e.groupBy("day").agg(F.min("event_id").alias("first"))
    now = e.join(first, "day").join(F.broadcast(number), "day")
    touched = F.col("event_id") == F.col("first")
    now = now.filter(~(touched & (F.col("k") == 9))).withColumn("event_type", F.when(touched & (F.col("k") == 3), "forged").otherwise(F.col("event_type")))
    return change.checked_chain(now.select("day", *fields), stored, "day", order, fields)


@query("lost_objects", "SELECT doc_id FROM documents WHERE doc_id % 50 = 7 AND length(text) > 0")
def lost_objects(spark: SparkSession, d: str) -> DataFrame:
    """Stored objects whose bytes no longer have their hash: of fifty texts one has lost its last character."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.when(F.col("doc_id") % 50 == 7, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text")).alias("body"))
    return change.mismatched(docs, "body").select("doc_id")


# --- instants and watermarks ---

STAMPED = """CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '-05:00' WHEN 2 THEN strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') || '.250+0000' ELSE strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') END"""


def stamps():  # noqa: ANN201
    """An order's time, five hours on, in four dialects."""
    k, t = F.col("o_orderkey") % 4, F.col("o_orderdate")
    later = t + F.expr("INTERVAL 5 HOURS")
    return (
        F.when(k == 0, F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00")))
        .when(k == 2, F.concat(F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250+0000"))).otherwise(F.date_format(later, "yyyy-MM-dd HH:mm"))
    )


@query("instants", f"SELECT o_orderkey, {STAMPED} AS stamp, CASE o_orderkey % 4 WHEN 3 THEN date_trunc('minute', o_orderdate + INTERVAL 5 HOUR) ELSE date_trunc('second', o_orderdate + INTERVAL 5 HOUR) END AS instant FROM orders")
def instants(spark: SparkSession, d: str) -> DataFrame:
    """Stamps with and without zones, offsets and parts of a second, as UTC instants."""
    o = table(spark, d, "orders").select("o_orderkey", stamps().alias("stamp"))
    return o.withColumn("instant", times.instant("stamp").cast("timestamp_ntz"))


@query(
    "listing_watermarks",
    """WITH o AS (SELECT o_custkey AS source_id, o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN date_trunc('minute', o_orderdate + INTERVAL 5 HOUR) ELSE date_trunc('second', o_orderdate + INTERVAL 5 HOUR) END AS t FROM orders),
    g AS (SELECT source_id, max(t) AS t, count(DISTINCT o_orderkey % 3) AS pages, source_id % 5 AS k FROM o GROUP BY 1)
    SELECT source_id, (k <> 2 OR pages < 2) AND k <> 3 AS whole, CASE WHEN (k <> 2 OR pages < 2) AND k <> 3 THEN greatest(t, TIMESTAMP '1995-01-01') ELSE TIMESTAMP '1995-01-01' END AS watermark FROM g""",
)
def listing_watermarks(spark: SparkSession, d: str) -> DataFrame:
    """A watermark moves to the latest instant of a listing only if all of its pages were read: of five sources one
    lacks its first page of several, and one's last page names another that wasn't read."""
    o = table(spark, d, "orders").withColumn("source_id", F.col("o_custkey"))
    one = F.struct(F.concat(F.lit("P-"), F.col("o_orderkey").cast("string")).alias("packageId"), stamps().alias("lastModified"))
    pages = o.groupBy("source_id", (F.col("o_orderkey") % 3).alias("part")).agg(F.collect_list(one).alias("packages"))  # a customer's orders
    w = W.partitionBy("source_id")
    pages = pages.withColumns({"page": F.row_number().over(w.orderBy("part")), "n": F.count("*").over(w)})
    more = (F.col("page") < F.col("n")) | (F.col("source_id") % 5 == 3)
    body = F.to_json(F.struct("packages", F.when(more, "next").alias("nextPage")))
    read = pages.filter(~((F.col("source_id") % 5 == 2) & (F.col("page") == 1) & (F.col("n") > 1))).select("source_id", "page", body.alias("body"))
    state = o.select("source_id", F.lit("1995-01-01").cast("timestamp").alias("watermark")).distinct()
    return feeds.advanced(read, state).withColumn("watermark", F.col("watermark").cast("timestamp_ntz"))


# --- discovery and inventory ---


@query(
    "discovered_feeds",
    """SELECT c_custkey AS source_id, CASE c_custkey % 6 WHEN 2 THEN 'not-a-feed' WHEN 4 THEN 'unreachable' WHEN 5 THEN 'undated-items' ELSE 'usable' END AS verdict,
    'https://s' || c_custkey::VARCHAR || '.gov' || CASE c_custkey % 6 WHEN 0 THEN '/about/feeds/all.xml' WHEN 1 THEN '/feed' WHEN 3 THEN '/rss.xml' END AS feed FROM customer""",
)
def discovered_feeds(spark: SparkSession, d: str) -> DataFrame:
    """The feed of every source, from what its page names and from common places: of six sources one names a good feed,
    one a dead one but has a good one at a common place, one names a page, one names none but has one, one was not
    captured at all, and one has items without dates."""
    c = spread(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 6).alias("m")), "k")
    at = lambda path: F.concat(F.lit("https://s"), F.col("k").cast("string"), F.lit(f".gov{path}"))
    names = F.when(F.col("m").isin(0, 1, 2, 5), '<link rel="stylesheet" href="x.css"><LINK REL="home Alternate" TYPE="application/rss+xml; charset=utf-8" HREF="feeds/all.xml" title="All"><link rel=alternate type="text/html" href="/es">').otherwise("")
    homes = c.select(F.col("k").alias("source_id"), at("/about/").alias("url"), F.concat(F.lit("<html><head>"), names, F.lit("</head><body>x</body></html>")).alias("page"))
    feed = lambda day: F.concat(F.lit("<rss><channel><item><title>t</title><guid>"), F.col("k").cast("string"), F.lit(f"</guid>{day}</item></channel></rss>"))
    good, undated = feed("<pubDate>2024-01-02</pubDate>"), feed("")
    answer = lambda m, path, status, body: F.struct(F.lit(m).alias("of"), at(path).alias("url"), F.lit(status).alias("status"), (F.lit(body) if isinstance(body, str) else body).alias("body"))
    own = "/about/feeds/all.xml"
    answers = F.array(answer(0, own, 200, good), answer(0, "/feed", 200, good), answer(1, own, 404, "gone"), answer(1, "/feed", 200, good), answer(2, own, 200, "<html><p>A page</p></html>"), answer(3, "/rss", 403, "no"), answer(3, "/rss.xml", 200, good), answer(5, own, 200, undated))
    samples = c.withColumn("x", F.explode(answers)).filter("x.of = m").select("x.url", "x.status", "x.body")
    return feeds.discovered(homes, samples)


@query(
    "graphic_inventory",
    """WITH l AS (SELECT l_orderkey AS package, l_linenumber AS member, l_quantity::INT AS q, 'G' || l_partkey::VARCHAR AS gid FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity::INT, l_partkey DESC) = 1),
    p AS (SELECT *, q % 7 = 0 AS broken, last_value(CASE WHEN q % 3 = 0 AND q % 7 <> 0 THEN q END IGNORE NULLS) OVER (PARTITION BY package ORDER BY member ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page FROM l)
    SELECT package, member, CASE WHEN NOT broken THEN gid END AS gid, CASE WHEN NOT broken THEN page END AS page, broken FROM p""",
)
def graphic_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Graphics of packages of several members, each with the page printed last before it, be that in another
    member; every member whose page divides by seven is broken and prints none."""
    line = table(spark, d, "lineitem").repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("package"), F.col("l_linenumber").alias("member")).agg(F.min(F.struct(F.col("l_quantity").cast("int").alias("q"), (-F.col("l_partkey")).alias("k"))).alias("x"))
    gid = F.concat(F.lit("<GPH><GID>G"), (-F.col("x.k")).cast("string"), F.lit("</GID></GPH>"))
    mark = F.when(F.col("x.q") % 3 == 0, F.concat(F.lit('<PRTPAGE P="'), F.col("x.q").cast("string"), F.lit('"/>'))).otherwise("")
    body = F.concat(F.lit("<RULE><P>words "), mark, F.lit("</P>"), gid, F.when(F.col("x.q") % 7 == 0, "</RULE").otherwise("</RULE>"))
    got = packages.inventory(line.select("package", "member", body.alias("body")), "body", "package", "member")
    return got.select("package", "member", "gid", F.col("page").cast("int").alias("page"), F.col("error").isNotNull().alias("broken"))
