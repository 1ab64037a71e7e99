"""Projections, filters, joins and aggregations over the bound tables (C, D, E, G, H)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.functions import hashing, text
from docketflow.operators import health, lexicon, model, rules
from docketflow.plans import bind
from docketflow.session import table

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


T, L, S, R = bind.TEXTS_SQL, bind.LOG_SQL, bind.SUMMARIES_SQL, bind.REGISTRY_SQL


@query("day_filter_join", f"WITH {T}, {S} SELECT doc_id, collection, char_count FROM texts JOIN summaries USING (doc_id) WHERE digest_day = DATE '2024-01-08'")
def day_filter_join(spark, d):
    """One filing day's documents that have a summary."""
    t = bind.texts(spark, d).filter(F.col("digest_day") == F.lit("2024-01-08").cast("date"))
    return t.join(bind.summaries(spark, d), "doc_id").select("doc_id", "collection", "char_count")


@query(
    "window_volume_range",
    f"""WITH {T} SELECT collection, count(*) AS items, min(digest_day) AS first_day, max(digest_day) AS last_day, count(CASE WHEN digest_day >= DATE '2024-01-20' AND digest_day < DATE '2024-01-25' THEN 1 END) AS half_open
    FROM texts WHERE digest_day >= DATE '2024-01-10' AND digest_day <= DATE '2024-01-24' GROUP BY collection""",
)
def window_volume_range(spark, d):
    """An inclusive day range, a half-open one inside it, first and last day."""
    day = F.col("digest_day")
    t = bind.texts(spark, d).filter(day.between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-24").cast("date")))
    half = (day >= F.lit("2024-01-20").cast("date")) & (day < F.lit("2024-01-25").cast("date"))
    return t.groupBy("collection").agg(F.count("*").alias("items"), F.min("digest_day").alias("first_day"), F.max("digest_day").alias("last_day"), F.count_if(half).alias("half_open"))


@query(
    "class_in_notin_null_safe",
    f"""WITH {L} SELECT coalesce(client, 'legacy') AS client, event_type, count(*) AS n FROM log
    WHERE (client IS NULL OR client <> 'probe') AND event_type IN ('view', 'click', 'error', 'purchase') AND host NOT IN ('h1', 'h2') GROUP BY ALL""",
)
def class_in_notin_null_safe(spark, d):
    """List predicates, a null-tolerant exclusion, defaults."""
    log = bind.request_log(spark, d)
    keep = ~F.col("client").eqNullSafe("probe") & F.col("event_type").isin("view", "click", "error", "purchase") & ~F.col("host").isin("h1", "h2")
    return log.filter(keep).groupBy(F.coalesce("client", F.lit("legacy")).alias("client"), "event_type").agg(F.count("*").alias("n"))


STAGE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Enrolled-Bill' WHEN '2-HIGH' THEN 'Reported-in-House' WHEN '3-MEDIUM' THEN 'ih' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Engrossed-in-Senate' END"


@query(
    "stage_case_buckets",
    f"""WITH b AS (SELECT lower(coalesce({STAGE}, '')) AS t, o_orderstatus AS st FROM orders)
    SELECT CASE WHEN t IN ('ih', 'is') OR t LIKE 'introduced%' THEN 'Introduced' WHEN t IN ('rh', 'rs') OR t LIKE '%reported%' THEN 'Reported' WHEN t IN ('eh', 'es') OR t LIKE '%engrossed%' THEN 'Engrossed'
      WHEN t = 'enr' OR t LIKE '%enrolled%' THEN 'Enrolled' ELSE 'Other' END AS stage, st ILIKE 'f%' AS finished, count(*) AS n FROM b GROUP BY ALL""",
)
def stage_case_buckets(spark, d):
    """Case-insensitive stage buckets."""
    p = F.col("o_orderpriority")
    t = F.when(p == "1-URGENT", "Enrolled-Bill").when(p == "2-HIGH", "Reported-in-House").when(p == "3-MEDIUM", "ih").when(p == "4-NOT SPECIFIED", None).otherwise("Engrossed-in-Senate")
    return table(spark, d, "orders").groupBy(rules.bill_stage(t).alias("stage"), F.col("o_orderstatus").ilike("f%").alias("finished")).agg(F.count("*").alias("n"))


@query("json_path_projection", "SELECT json_extract_string(props, '$.k')::INTEGER AS k, count(*) AS n, count(json_extract_string(props, '$.missing.deep')) AS deep FROM events GROUP BY 1")
def json_path_projection(spark, d):
    """JSON paths, absent ones null."""
    e = table(spark, d, "events").select(F.get_json_object("props", "$.k").cast("int").alias("k"), F.get_json_object("props", "$.missing.deep").alias("deep"))
    return e.groupBy("k").agg(F.count("*").alias("n"), F.count("deep").alias("deep"))


@query(
    "left_chain_versioned_on",
    """SELECT o_orderkey, c_name, l.l_linenumber, q.quality FROM orders o LEFT JOIN customer c ON c_custkey = o_custkey
    LEFT JOIN lineitem l ON l.l_orderkey = o_orderkey AND l.l_returnflag = 'R' AND l.l_linenumber = 1 LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) q ON q.doc_id = o_orderkey AND q.quality = 1
    WHERE o_totalprice > 100000""",
)
def left_chain_versioned_on(spark, d):
    """A chain of left joins; the version predicates belong to the right sides."""
    line = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    q = table(spark, d, "labels").filter("quality = 1").select(F.col("doc_id").alias("o_orderkey"), "quality").distinct()
    o = table(spark, d, "orders").filter("o_totalprice > 100000").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.join(line, "o_orderkey", "left").join(q, "o_orderkey", "left").select("o_orderkey", "c_name", "l_linenumber", "quality")


@query(
    "stale_packages",
    """SELECT o_orderkey, strftime(newest, '%Y-%m-%d') AS extracted FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS newest, min(l_linenumber) AS version FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    WHERE newest IS NULL OR newest < o_orderdate + INTERVAL 30 DAY OR version > 1""",
)
def stale_packages(spark, d):
    """Left join to an aggregate, then a disjunction of staleness."""
    made = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("newest"), F.min("l_linenumber").alias("version"))
    o = table(spark, d, "orders").join(made, "o_orderkey", "left")
    stale = F.col("newest").isNull() | (F.col("newest") < F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")) | (F.col("version") > 1)
    return o.filter(stale).select("o_orderkey", F.date_format("newest", "yyyy-MM-dd").alias("extracted"))


@query("unsummarized_anti", f"WITH {T}, {S} SELECT collection, count(*) AS pending FROM texts t WHERE NOT EXISTS (SELECT 1 FROM summaries s WHERE s.doc_id = t.doc_id AND NOT s.withdrawn) AND char_count >= 200 GROUP BY 1")
def unsummarized_anti(spark, d):
    """Documents still to be summarised."""
    return bind.texts(spark, d).filter("char_count >= 200").join(bind.summaries(spark, d).filter("NOT withdrawn"), "doc_id", "left_anti").groupBy("collection").agg(F.count("*").alias("pending"))


@query("has_newer_semi", "SELECT o_orderpriority, count(*) AS stale FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND date_trunc('second', l.l_shipdate) > date_trunc('second', o.o_orderdate) + INTERVAL 60 DAY) GROUP BY 1")
def has_newer_semi(spark, d):
    """Compositions that a newer input makes stale."""
    newest = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("newest"))
    later = F.date_trunc("second", "newest") > F.date_trunc("second", "o_orderdate") + F.expr("INTERVAL 60 DAYS")
    return table(spark, d, "orders").join(newest, "o_orderkey").filter(later).groupBy("o_orderpriority").agg(F.count("*").alias("stale"))


@query(
    "coverage_by_day",
    """WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day, max(event_type = 'view')::INT AS ingested, max(event_type = 'click')::INT AS summarised, max(event_type = 'purchase')::INT AS plain FROM events GROUP BY 1, 2)
    SELECT day, sum(ingested)::BIGINT AS ingested, sum(ingested * summarised)::BIGINT AS summarised, sum(ingested * summarised * plain)::BIGINT AS plain FROM f GROUP BY day""",
)
def coverage_by_day(spark, d):
    """How many of a day's items reached each event; the self join is a pivot of flags."""
    flag = lambda e: F.max((F.col("event_type") == e).cast("int"))
    f = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(flag("view").alias("i"), flag("click").alias("s"), flag("purchase").alias("p"))
    return f.groupBy("day").agg(F.sum("i").alias("ingested"), F.sum(F.expr("i * s")).alias("summarised"), F.sum(F.expr("i * s * p")).alias("plain"))


@query(
    "graphic_range_join",
    """WITH span AS (SELECT l_partkey, min(l_quantity)::INT AS first_page, max(l_quantity)::INT AS last_page FROM lineitem GROUP BY 1)
    SELECT p_partkey, p_size AS page, first_page, last_page FROM part JOIN span ON l_partkey = p_partkey AND p_size BETWEEN first_page AND last_page""",
)
def graphic_range_join(spark, d):
    """A point in an interval; the equal key keeps it a hash join."""
    span = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_quantity").cast("int").alias("first_page"), F.max("l_quantity").cast("int").alias("last_page"))
    return table(spark, d, "part").join(span, "p_partkey").filter(F.col("p_size").between(F.col("first_page"), F.col("last_page"))).select("p_partkey", F.col("p_size").alias("page"), "first_page", "last_page")


@query(
    "asof_previous_event",
    """SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM events""",
)
def asof_previous_event(spark, d):
    """The last earlier row with content."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    return table(spark, d, "events").select("event_id", "user_id", F.last(F.when(F.col("event_type") != "error", F.col("event_id")), ignorenulls=True).over(w).alias("previous"))


@query("latest_per_key", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, d):
    """The newest row of each key, by an aggregate that combines before the shuffle."""
    new = F.max_by(F.struct("event_id", "event_type", "value"), F.struct("ts", "event_id")).alias("x")
    return table(spark, d, "events").groupBy("user_id").agg(new).select("user_id", "x.event_id", "x.event_type", "x.value")


HOST_SQL = """h AS (SELECT host, count(*) AS attempts, count(CASE WHEN status BETWEEN 200 AND 399 THEN 1 END) AS answered, max(CASE WHEN status BETWEEN 200 AND 399 THEN ts END) AS last_ok_at FROM log WHERE client IS NULL OR client <> 'probe' GROUP BY host)"""


@query(
    "host_outcome_health",
    f"""WITH {L}, {HOST_SQL} SELECT host, attempts, answered, attempts - answered AS unanswered, round_even(100.0 * (attempts - answered) / attempts, 1)::DOUBLE AS error_rate_pct, last_ok_at,
    CASE WHEN attempts >= 5 AND answered = 0 THEN 'no-response' WHEN attempts >= 5 AND (attempts - answered) / attempts >= 0.10 THEN 'degraded' ELSE 'delivering' END AS label FROM h""",
)
def host_outcome_health(spark, d):
    """Request outcomes and the health label of every host (the flagship query)."""
    log = bind.request_log(spark, d).filter(~F.col("client").eqNullSafe("probe"))
    h = health.outcomes(log, "host")
    label = health.label(F.lit(1), F.col("attempts"), F.col("answered"), F.col("error_rate"), F.lit(0), F.lit(0))
    return h.select("host", "attempts", "answered", "unanswered", "error_rate_pct", "last_ok_at", label.alias("label"))


@query(
    "registry_health_join",
    f"""WITH {L}, {R}, {HOST_SQL}, j AS (SELECT r.*, coalesce(attempts, 0) AS attempts, coalesce(answered, 0) AS answered FROM registry r LEFT JOIN h USING (host)),
    s AS (SELECT branch, count(*) AS sources, count(CASE WHEN status = 'active' THEN 1 END) AS active FROM j GROUP BY 1), o AS (SELECT DISTINCT branch, host, attempts, answered FROM j)
    SELECT s.branch, any_value(sources) AS sources, any_value(active) AS active, count(*) AS hosts, sum(attempts)::BIGINT AS requests, sum(attempts - answered)::BIGINT AS unanswered FROM s JOIN o ON o.branch = s.branch GROUP BY 1""",
)
def registry_health_join(spark, d):
    """Sources joined with host figures; a host counts once however many sources share it."""
    h = health.outcomes(bind.request_log(spark, d).filter(~F.col("client").eqNullSafe("probe")), "host")
    j = bind.registry(spark, d).join(h, "host", "left").fillna(0, ["attempts", "answered"])
    s = j.groupBy("branch").agg(F.count("*").alias("sources"), F.count_if(F.col("status") == "active").alias("active"))
    o = j.dropDuplicates(["branch", "host"]).groupBy("branch").agg(F.count("*").alias("hosts"), F.sum("attempts").alias("requests"), F.sum(F.col("attempts") - F.col("answered")).alias("unanswered"))
    return s.join(o, "branch")


@query("official_span_containment", "SELECT item_id, doc_id, strpos(d.text, b.text)::INT AS at FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def official_span_containment(spark, d):
    """Which official string stands in which document, and where."""
    official = table(spark, d, "benchmark").select("item_id", F.col("text").alias("official"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return lexicon.contained(docs, official).select("item_id", "doc_id", F.expr("instr(text, official)").alias("at"))


@query(
    "term_hits",
    "WITH h AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\b(that|with|this|from)\\b', 1)) AS term FROM documents) SELECT term, count(*) AS hits, count(DISTINCT doc_id) AS docs FROM h GROUP BY 1",
)
def term_hits(spark, d):
    """Hits of a list of terms, counted in place: a task sends on one row, whatever its texts hold."""
    terms = ("that", "with", "this", "from")
    n = table(spark, d, "documents").select(*(F.regexp_count("text", F.lit(rf"(?i)\b{t}\b")).alias(t) for t in terms))
    found = n.agg(*(F.struct(F.lit(t).alias("term"), F.sum(t).alias("hits"), F.count_if(F.col(t) > 0).alias("docs")).alias(t) for t in terms))
    return found.select(F.explode(F.array(*terms)).alias("x")).select("x.*").filter("docs > 0")


@query(
    "glossary_terms",
    "SELECT DISTINCT term FROM (SELECT unnest(regexp_extract_all(lower(text), '\\b(quorum|cloture|the|der|with|motion)\\b', 1)) AS term FROM documents)",
)
def glossary_terms(spark, d):
    """Glossary terms that occur."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b(quorum|cloture|the|der|with|motion)\b"), F.lit(1)))
    return table(spark, d, "documents").select(F.explode(found).alias("term")).distinct()


@query("mechanical_counts", f"WITH {T} SELECT collection, coalesce(doc_type, '?') AS doc_type, count(*) AS n FROM texts GROUP BY ALL")
def mechanical_counts(spark, d):
    """Counts by class, a missing class as `?`."""
    return bind.texts(spark, d).groupBy("collection", F.coalesce("doc_type", F.lit("?")).alias("doc_type")).agg(F.count("*").alias("n"))


@query("top_agencies", f"WITH {T} SELECT collection, count(*) AS n FROM texts WHERE collection IS NOT NULL GROUP BY 1 ORDER BY n DESC, collection LIMIT 3")
def top_agencies(spark, d):
    """The three largest groups, ties by name."""
    return bind.texts(spark, d).filter(F.col("collection").isNotNull()).groupBy("collection").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "collection").limit(3)


@query(
    "conditional_outcomes",
    f"""WITH {L} SELECT host, count(CASE WHEN status BETWEEN 200 AND 299 THEN 1 END) AS ok, count(CASE WHEN status BETWEEN 400 AND 499 THEN 1 END) AS client_errors, count(CASE WHEN status >= 500 THEN 1 END) AS server_errors,
    count(CASE WHEN status IS NULL THEN 1 END) AS silent, count(CASE WHEN attempt > 1 THEN 1 END) AS retries, sum(CASE WHEN status = 404 THEN 1 END)::BIGINT AS missing_or_null FROM log GROUP BY host""",
)
def conditional_outcomes(spark, d):
    """Conditional counts; the last column is a sum, so null over no rows."""
    s = F.col("status")
    return bind.request_log(spark, d).groupBy("host").agg(
        F.count_if(s.between(200, 299)).alias("ok"), F.count_if(s.between(400, 499)).alias("client_errors"), F.count_if(s >= 500).alias("server_errors"),
        F.count_if(s.isNull()).alias("silent"), F.count_if(F.col("attempt") > 1).alias("retries"), F.sum(F.when(s == 404, 1)).alias("missing_or_null"),
    )


@query("daily_latency_series", f"WITH {L} SELECT host, CAST(ts AS DATE) AS day, count(*) AS requests, round_even(avg(CASE WHEN status IS NOT NULL THEN floor(elapsed_ms) END), 0)::BIGINT AS mean_ms FROM log GROUP BY ALL")
def daily_latency_series(spark, d):
    """Requests and mean answer time by host and day; days without answers have no mean."""
    mean = F.bround(F.avg(F.when(F.col("status").isNotNull(), F.floor("elapsed_ms"))), 0).cast("long")
    return bind.request_log(spark, d).groupBy("host", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("requests"), mean.alias("mean_ms"))


@query(
    "length_stats",
    f"WITH {T} SELECT collection, round_even(avg(char_count), 0)::BIGINT AS mean, round_even(median(char_count), 0)::BIGINT AS median, min(char_count) AS least, max(char_count) AS most FROM texts GROUP BY 1",
)
def length_stats(spark, d):
    """Mean and exact median lengths, rounded half to even. Lengths are counted first, so that a group's median
    is found among its different lengths, however many rows it has."""
    counted = bind.texts(spark, d).groupBy("collection", F.col("char_count").alias("v")).agg(F.count("*").alias("k"))
    w = W.partitionBy("collection").orderBy("v")
    known = F.when(F.col("v").isNotNull(), F.col("k")).otherwise(0)
    c = counted.withColumns({"upto": F.sum(known).over(w), "n": F.sum(known).over(W.partitionBy("collection"))})
    # of n values in order, the middle one (n odd) or the two around the middle
    at = lambda place: F.max(F.when((F.col("v").isNotNull()) & (F.col("upto") - F.col("k") < place) & (F.col("upto") >= place), F.col("v")))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    g = c.groupBy("collection").agg((F.sum(F.col("v") * F.col("k")) / F.sum(known)).alias("mean"), at(low).alias("low"), at(high).alias("high"), F.min("v").alias("least"), F.max("v").alias("most"))
    return g.select("collection", F.bround("mean", 0).cast("long").alias("mean"), F.bround((F.col("low") + F.col("high")) / 2, 0).cast("long").alias("median"), "least", "most")


@query(
    "delivery_mode",
    """WITH m AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 'feed-fallback' WHEN value >= 80 THEN 'full' WHEN value >= 40 THEN 'email-full' WHEN value >= 20 THEN 'email-teaser' ELSE 'feed-only' END AS mode FROM events), c AS (SELECT user_id, mode, count(*) AS n FROM m GROUP BY ALL)
    SELECT user_id, mode, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, mode DESC) = 1""",
)
def delivery_mode(spark, d):
    """Each source's most frequent delivery mode; ties to the last by name."""
    v = F.col("value")
    mode = F.when(F.col("event_type") == "error", "feed-fallback").when(v >= 80, "full").when(v >= 40, "email-full").when(v >= 20, "email-teaser").otherwise("feed-only")
    c = table(spark, d, "events").groupBy("user_id", mode.alias("mode")).agg(F.count("*").alias("n"))
    return c.groupBy("user_id").agg(F.max(F.struct("n", "mode")).alias("x")).select("user_id", "x.mode", "x.n")


@query(
    "hour_day_rollup",
    """SELECT CAST(ts AS DATE)::VARCHAR AS day, hour(ts)::INT AS hour, grouping(CAST(ts AS DATE), hour(ts))::BIGINT AS level, count(*) AS n, round_even(sum(value), 2)::DOUBLE AS total FROM events GROUP BY ROLLUP (CAST(ts AS DATE), hour(ts))""",
)
def hour_day_rollup(spark, d):
    """Hours, days and all in one pass."""
    e = table(spark, d, "events").select(F.col("ts").cast("date").alias("day"), F.hour("ts").alias("hour"), F.col("value").cast("decimal(18,6)").alias("v"))
    return e.rollup("day", "hour").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.bround(F.sum("v"), 2).cast("double").alias("total")).withColumn("day", F.col("day").cast("string"))


@query(
    "branch_tier_grouping_sets",
    f"WITH {R} SELECT branch, tier, status, count(*) AS n FROM registry GROUP BY GROUPING SETS ((branch, status), (tier, status))",
)
def branch_tier_grouping_sets(spark, d):
    """Status counts by branch and by tier."""
    return bind.registry(spark, d).groupingSets([[F.col("branch"), F.col("status")], [F.col("tier"), F.col("status")]], "branch", "tier", "status").agg(F.count("*").alias("n")).select("branch", "tier", "status", "n")


@query(
    "purpose_spend",
    """WITH l AS (SELECT role || ':' || (turn % 3)::VARCHAR AS purpose, length(text) AS tokens FROM conversations)
    SELECT split_part(purpose, ':', 1) AS purpose, count(*) AS calls, coalesce(sum(tokens), 0)::BIGINT AS tokens, CASE WHEN (SELECT sum(tokens) FROM l) > 0 THEN round_even(100.0 * sum(tokens) / (SELECT sum(tokens) FROM l), 1) ELSE 0 END::DOUBLE AS share, (sum(tokens) // count(*))::BIGINT AS each FROM l GROUP BY 1""",
)
def purpose_spend(spark, d):
    """Spend by purpose prefix, its share, and an even split by integer division."""
    g = bind.ledger(spark, d).groupBy(text.purpose("purpose").alias("purpose")).agg(F.count("*").alias("calls"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
    total = F.sum("tokens").over(W.partitionBy())  # one row a purpose
    return g.select("purpose", "calls", "tokens", hashing.percent(F.col("tokens"), total).alias("share"), F.expr("tokens div calls").alias("each"))


@query(
    "facet_counts",
    f"""WITH {T}, f AS (SELECT unnest([collection, doc_type, CASE WHEN char_count >= 15000 THEN 'long' ELSE 'short' END]) AS facet FROM texts)
    SELECT facet, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, facet)::INT AS place FROM f GROUP BY 1""",
)
def facet_counts(spark, d):
    """Facet counts in display order."""
    tags = F.array("collection", "doc_type", F.when(F.col("char_count") >= 15000, "long").otherwise("short"))
    c = bind.texts(spark, d).select(F.explode(tags).alias("facet")).groupBy("facet").agg(F.count("*").alias("n"))
    return c.withColumn("place", F.row_number().over(W.orderBy(F.desc("n"), "facet")))  # one row a facet


@query(
    "dense_day_grid",
    f"""WITH {L}, c AS (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, count(*) AS requests, count(CASE WHEN status IS NULL OR status >= 400 THEN 1 END) AS failed, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS items FROM log WHERE host = 'h3' GROUP BY ALL),
    g AS (SELECT day::DATE AS day, hour FROM generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY) a(day), generate_series(0, 23) b(hour)),
    x AS (SELECT g.day, g.hour::INT AS hour, coalesce(requests, 0) AS requests, coalesce(failed, 0) AS failed, coalesce(items, 0) AS items FROM g LEFT JOIN c ON c.day = g.day AND c.hour = g.hour)
    SELECT *, CASE WHEN failed > 0 THEN 'err' WHEN items >= 1 THEN 'high' WHEN requests > 0 THEN 'ok' ELSE 'quiet' END AS status,
    CASE WHEN sum(failed) OVER (PARTITION BY day) > 0 THEN 'degraded' WHEN sum(items) OVER (PARTITION BY day) >= 3 THEN 'high-active' WHEN sum(requests) OVER (PARTITION BY day) > 0 THEN 'delivering' ELSE 'quiet' END AS day_status FROM x""",
)
def dense_day_grid(spark, d):
    """Seven days by 24 hours, zero-filled, with hour and day labels."""
    log = bind.request_log(spark, d).filter("host = 'h3'")
    c = log.groupBy(F.col("ts").cast("date").alias("day"), F.hour("ts").alias("hour")).agg(F.count("*").alias("requests"), F.count_if(F.col("status").isNull() | (F.col("status") >= 400)).alias("failed"), F.count_if(F.col("event_type") == "purchase").alias("items"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-24").cast("date"), F.lit("2024-01-30").cast("date"))).alias("day"))
    grid = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    x = grid.join(c, ["day", "hour"], "left").fillna(0, ["requests", "failed", "items"])
    w = W.partitionBy("day")
    return x.select("day", "hour", "requests", "failed", "items", health.hour_status(F.col("items"), F.col("requests"), F.col("failed")).alias("status"), health.day_status(F.sum("items").over(w), F.sum("requests").over(w), F.sum("failed").over(w)).alias("day_status"))


@query(
    "all_time_host_stats",
    f"WITH {L} SELECT host, count(*) AS requests, count(CASE WHEN status BETWEEN 200 AND 399 THEN 1 END) AS ok, count(CASE WHEN status IS NULL OR status >= 400 THEN 1 END) AS failures, min(ts) AS first_seen FROM log WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY host",
)
def all_time_host_stats(spark, d):
    """Figures since a floor date."""
    log = bind.request_log(spark, d).filter(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
    return log.groupBy("host").agg(F.count("*").alias("requests"), F.count_if(F.col("status").between(200, 399)).alias("ok"), F.count_if(F.col("status").isNull() | (F.col("status") >= 400)).alias("failures"), F.min("ts").alias("first_seen"))


@query(
    "endpoints_and_errors",
    f"""WITH {L} SELECT host || '/' || event_type AS endpoint, count(*) AS errors, max(event_id) AS newest, count(DISTINCT user_id) AS repeats FROM log WHERE status IS NULL OR status >= 400 GROUP BY 1 HAVING count(*) > 1 ORDER BY errors DESC, endpoint LIMIT 10""",
)
def endpoints_and_errors(spark, d):
    """The ten endpoints with most errors."""
    bad = bind.request_log(spark, d).filter(F.col("status").isNull() | (F.col("status") >= 400))
    g = bad.groupBy(F.concat_ws("/", "host", "event_type").alias("endpoint")).agg(F.count("*").alias("errors"), F.max("event_id").alias("newest"), F.countDistinct("user_id").alias("repeats"))
    return g.filter("errors > 1").orderBy(F.desc("errors"), "endpoint").limit(10)


@query(
    "domain_ordered_topk",
    """WITH p AS (SELECT p_partkey, p_brand, p_type, p_size, regexp_extract(p_name, '([0-9]+)$', 1) AS suffix FROM part)
    SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY coalesce(list_position(['SMALL', 'MEDIUM', 'LARGE'], split_part(p_type, ' ', 1)), 99), TRY_CAST(suffix AS INT) NULLS LAST, p_size DESC, p_partkey)::INT AS place FROM p QUALIFY place <= 3""",
)
def domain_ordered_topk(spark, d):
    """Top three of a group in a fixed list's order, unknown last, then numeric suffix, missing last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ("SMALL", "MEDIUM", "LARGE"))), F.split_part("p_type", F.lit(" "), F.lit(1))), F.lit(0)), F.lit(99))
    suffix = F.expr("try_cast(regexp_extract(p_name, '([0-9]+)$', 1) AS int)")
    w = W.partitionBy("p_brand").orderBy(place, suffix.asc_nulls_last(), F.desc("p_size"), "p_partkey")
    return table(spark, d, "part").select("p_partkey", "p_brand", F.row_number().over(w).alias("place")).filter("place <= 3")


@query("newest_first_queue", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 25")
def newest_first_queue(spark, d):
    """The download queue, newest first, up to the allowance left."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey").limit(25)
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@query("newest_complete_day", "SELECT CAST(max(o_orderdate) AS DATE) AS day FROM orders WHERE o_orderdate < (SELECT date_trunc('month', max(o_orderdate)) FROM orders)")
def newest_complete_day(spark, d):
    """The newest day before a bound that is itself an aggregate."""
    o = table(spark, d, "orders")
    bound = o.agg(F.date_trunc("month", F.max("o_orderdate")).alias("bound"))
    return o.join(F.broadcast(bound), F.col("o_orderdate") < F.col("bound")).agg(F.max("o_orderdate").cast("date").alias("day"))


@query("dedupe_first_wins", f"WITH {T} SELECT md5(text) AS key, min(doc_id) AS doc_id, count(*) AS copies FROM texts GROUP BY 1")
def dedupe_first_wins(spark, d):
    """H3-H6: the first recorded of each identity."""
    return bind.texts(spark, d).groupBy(F.md5(F.col("text").cast("binary")).alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("union_events", "SELECT kind, day, count(*) AS n FROM (SELECT 'event' AS kind, CAST(ts AS DATE) AS day FROM events UNION ALL SELECT 'order', CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL")
def union_events(spark, d):
    """Two event tables as one."""
    e = table(spark, d, "events").select(F.lit("event").alias("kind"), F.col("ts").cast("date").alias("day"))
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderdate").cast("date").alias("day"), F.lit("order").alias("kind"))
    return e.unionByName(o).groupBy("kind", "day").agg(F.count("*").alias("n"))


@query("allowlist_semi", "SELECT c_custkey, lower(c_name) AS sender FROM customer WHERE lower(c_mktsegment) IN (SELECT lower(s) FROM (VALUES ('Building'), ('MACHINERY')) v(s)) AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 3))")
def allowlist_semi(spark, d):
    """Senders on an allowlist, case folded. Both lists are the registry's own, so short."""
    allowed = spark.createDataFrame([("Building",), ("MACHINERY",)], "s string").select(F.lower("s").alias("seg"))
    nations = table(spark, d, "nation").filter(F.col("n_regionkey").isin(1, 3))
    c = table(spark, d, "customer").withColumn("seg", F.lower("c_mktsegment"))
    return c.join(F.broadcast(allowed), "seg", "left_semi").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", F.lower("c_name").alias("sender"))


@query(
    "two_key_lookup",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_linenumber <= 3), t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'substantive' ELSE 'decorative' END AS class FROM lineitem)
    SELECT class, l_returnflag AS flag, count(*) AS n, count(p_partkey) AS found, array_to_string(list_sort(list_distinct(list(p_brand) FILTER (WHERE p_size > 48))), ',') AS brands FROM s JOIN t USING (l_orderkey, l_linenumber) LEFT JOIN part ON p_partkey = l_partkey AND p_size > 10 GROUP BY ALL""",
)
def two_key_lookup(spark, d):
    """A join on two keys, a lookup, counts by class, and a sorted set."""
    line = table(spark, d, "lineitem")
    s = line.filter("l_linenumber <= 3").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("flag"))
    t = line.select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 25, "substantive").otherwise("decorative").alias("class"))
    p = table(spark, d, "part").filter("p_size > 10").select("p_partkey", F.lit(1).alias("found"), "p_brand", "p_size")
    g = s.join(t, ["l_orderkey", "l_linenumber"]).join(p, "p_partkey", "left").groupBy("class", "flag")
    out = g.agg(F.count("*").alias("n"), F.count("found").alias("found"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("p_size") > 48, F.col("p_brand")))), ",").alias("brands"))
    return out.orderBy(F.when(F.col("class") == "substantive", 0).otherwise(1), "flag")
