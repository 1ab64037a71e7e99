"""Windows, text, URLs, dates, selection, evidence and writes over the bound tables (F, I, J, B)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.functions import hashing, text, times, urls
from docketflow.operators import change, corroborate, health, journal, lexicon, presentation, rules, upsert
from docketflow.plans import bind
from docketflow.session import table

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


T, L, S, R = bind.TEXTS_SQL, bind.LOG_SQL, bind.SUMMARIES_SQL, bind.REGISTRY_SQL

# --- selection and coverage ---

#: The bound texts carry no class of the real collections, so these rules stand in: same operators, patterns found in the data.
VOTE = r"(?i)licensed under[\s\S]{1,2000}?license"


def stand_in_rules():
    c, t = F.col("collection"), F.coalesce("doc_type", F.lit(""))
    return [("SEL-LONG", (t == "en") & (F.col("char_count") >= 15000)), ("SEL-VOTE", (t == "en") & F.col("text").rlike(VOTE)), ("SEL-DE", (c == "src1") & (t == "de")), ("SEL-FR", (t == "fr") & (F.col("char_count") > 3000)), ("SEL-ALL", c == "src2")]


def stand_in_exclusions():
    t = F.coalesce("doc_type", F.lit(""))
    return [("EX-NOTICE", t == "es"), ("EX-FLOOR", t == "en"), ("EX-NEVER", t == "xx"), ("EX-REST", F.lit(True))]


RULE_SQL = "CASE WHEN doc_type = 'en' AND char_count >= 15000 THEN 'SEL-LONG' WHEN doc_type = 'en' AND regexp_matches(text, '(?i)licensed under(.|\\n){1,2000}?license') THEN 'SEL-VOTE' WHEN collection = 'src1' AND doc_type = 'de' THEN 'SEL-DE' WHEN doc_type = 'fr' AND char_count > 3000 THEN 'SEL-FR' WHEN collection = 'src2' THEN 'SEL-ALL' END"
# DuckDB's expression engine allows 1,000 repeats at most, so its oracle states the same span by positions.
RULE_SQL = RULE_SQL.replace("regexp_matches(text, '(?i)licensed under(.|\\n){1,2000}?license')", "len(list_filter(string_split(lower(text), 'licensed under')[2:], lambda x: strpos(x[2:], 'license') BETWEEN 1 AND 2000)) > 0")
SELECTED = f"{T}, sel AS (SELECT *, {RULE_SQL} AS rule FROM texts)"


@query("rule_first_match", f"WITH {SELECTED} SELECT doc_id, rule FROM sel WHERE rule IS NOT NULL")
def rule_first_match(spark, d):
    """The first matching rule of an ordered registry, regular expression included."""
    return rules.select_items(bind.texts(spark, d), stand_in_rules()).filter(F.col("rule").isNotNull()).select("doc_id", "rule")


@query(
    "exclusions_zero_filled",
    f"""WITH {SELECTED}, x AS (SELECT CASE WHEN doc_type = 'es' THEN 'EX-NOTICE' WHEN doc_type = 'en' THEN 'EX-FLOOR' WHEN doc_type = 'xx' THEN 'EX-NEVER' ELSE 'EX-REST' END AS exclusion FROM sel WHERE rule IS NULL)
    SELECT e.exclusion, count(x.exclusion) AS n FROM (VALUES ('EX-NOTICE'), ('EX-FLOOR'), ('EX-NEVER'), ('EX-REST')) e(exclusion) LEFT JOIN x ON x.exclusion = e.exclusion GROUP BY 1""",
)
def exclusions_zero_filled(spark, d):
    """Exclusion counts with every name present."""
    chosen = rules.select_items(bind.texts(spark, d), stand_in_rules(), stand_in_exclusions())
    return rules.zero_filled(spark, chosen.filter(F.col("exclusion").isNotNull()), "exclusion", [n for n, _ in stand_in_exclusions()])


COVER = f"""{SELECTED}, {S}, f AS (SELECT sel.collection, rule, s.doc_id IS NOT NULL AS summarised FROM sel LEFT JOIN (SELECT DISTINCT doc_id FROM summaries WHERE NOT withdrawn) s ON s.doc_id = sel.doc_id),
 c AS (SELECT collection, count(*) AS packages, count(CASE WHEN summarised THEN 1 END) AS summarised, count(CASE WHEN NOT summarised AND rule IS NOT NULL THEN 1 END) AS counted FROM f GROUP BY 1)"""


def _facts(spark, d):
    done = bind.summaries(spark, d).filter("NOT withdrawn").select("doc_id").distinct().withColumn("_s", F.lit(True))
    return rules.select_items(bind.texts(spark, d), stand_in_rules()).join(done, "doc_id", "left").withColumn("summarised", F.coalesce("_s", F.lit(False)))


@query("coverage_accounting", f"WITH {COVER} SELECT collection, packages, summarised, counted, packages - summarised - counted AS excluded FROM c")
def coverage_accounting(spark, d):
    """Coverage by collection, the excluded as remainder."""
    return rules.coverage(_facts(spark, d), ["collection"])


@query("coverage_reconcile", f"WITH {COVER} SELECT count(*) AS wrong FROM c WHERE summarised + counted + (packages - summarised - counted) <> packages")
def coverage_reconcile(spark, d):
    """Rows of the coverage table that don't add up or differ from the facts (none)."""
    facts = _facts(spark, d)
    return rules.unreconciled(rules.coverage(facts, ["collection"]), facts, ["collection"]).agg(F.count("*").alias("wrong"))


@query(
    "excluded_floor_items",
    f"""WITH {SELECTED}, {S}, done AS (SELECT DISTINCT doc_id FROM summaries WHERE NOT withdrawn), x AS (SELECT collection, rule IS NULL AS by_rule, coalesce(char_count, 0) < 15000 AND doc_id NOT IN (SELECT doc_id FROM done) AS by_summary FROM sel WHERE doc_type = 'en')
    SELECT collection, count(*) FILTER (WHERE by_rule) AS by_rule, count(*) FILTER (WHERE by_summary) AS by_summary, count(*) FILTER (WHERE by_rule <> by_summary) AS differ FROM x GROUP BY 1""",
)
def excluded_floor_items(spark, d):
    """Q1: floor items excluded by rule and by missing summary, and where the two differ, by collection."""
    by_rule, by_summary = rules.excluded_floor(F.col("rule"), F.col("char_count"), F.col("summarised"))
    x = _facts(spark, d).filter("doc_type = 'en'").select("collection", by_rule.alias("r"), by_summary.alias("s"))
    return x.groupBy("collection").agg(F.count_if("r").alias("by_rule"), F.count_if("s").alias("by_summary"), F.count_if(F.col("r") != F.col("s")).alias("differ"))


@query("section_routing", f"WITH {SELECTED} SELECT CASE WHEN rule LIKE 'SEL-LONG%' AND doc_type = 'en' THEN 'house' WHEN rule LIKE 'SEL-DE%' THEN 'rules' WHEN rule LIKE 'SEL-%' AND rule <> 'SEL-VOTE' THEN 'agency' END AS section, count(*) AS n FROM sel WHERE rule IS NOT NULL GROUP BY 1")
def section_routing(spark, d):
    """The first section whose rule prefix and class match; items chosen for a vote alone go nowhere."""
    chosen = rules.select_items(bind.texts(spark, d), stand_in_rules()).filter(F.col("rule").isNotNull())
    sections = [("house", F.col("rule").startswith("SEL-LONG") & (F.col("doc_type") == "en")), ("rules", F.col("rule").startswith("SEL-DE")), ("agency", F.col("rule").startswith("SEL-") & (F.col("rule") != "SEL-VOTE"))]
    return chosen.groupBy(rules.first_match(sections).alias("section")).agg(F.count("*").alias("n"))


@query("citation_gate", "SELECT DISTINCT l_orderkey + 100000 * (l_linenumber = 7)::INT AS package FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey + 100000 * (l_linenumber = 7)::INT)")
def citation_gate(spark, d):
    """Packages that rendered lines cite but that don't exist."""
    n = F.col("l_orderkey") + F.when(F.col("l_linenumber") == 7, 100000).otherwise(0)
    bodies = table(spark, d, "lineitem").select(F.concat(F.lit("see https://www.govinfo.gov/app/details/"), n.cast("string"), F.lit(" (line)")).alias("body"))
    known = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("package"))
    return lexicon.uncited(bodies, "body", r"https://www\.govinfo\.gov/app/details/([^/()\s]+)", known, "package").select(F.col("package").cast("long").alias("package"))


@query(
    "lexicon_gate_positional",
    """WITH t AS (SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?i)\\b(?:that|with)\\b')), o AS (SELECT t.doc_id, string_agg(b.text, '') AS off, list(b.text) AS l FROM t JOIN benchmark b ON contains(t.text, b.text) GROUP BY 1),
    c AS (SELECT t.doc_id, coalesce(list_reduce(list_prepend(t.text, list_sort(l, 'ASC')), lambda a, b: replace(a, b, '#')), t.text) AS rest FROM t LEFT JOIN o ON o.doc_id = t.doc_id)
    SELECT doc_id, len(regexp_extract_all(rest, '(?i)\\b(?:that|with)\\b'))::BIGINT AS hits FROM c WHERE regexp_matches(rest, '(?i)\\b(?:that|with)\\b')""",
)
def lexicon_gate_positional(spark, d):
    """Banned terms outside the official strings that each document quotes."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    official = lexicon.contained(docs, table(spark, d, "benchmark").select(F.col("text").alias("official"))).select("doc_id", "official")
    return lexicon.violations(docs, official, "doc_id", terms=("that", "with")).groupBy("doc_id").agg(F.count("*").alias("hits"))


# --- evidence and corroboration ---


CANON = """lower(regexp_replace(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1), '^www\\.', '')) || rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') ||
  coalesce('?' || nullif(array_to_string(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')), '&'), ''), '')"""


@query(
    "corroborate_urls",
    f"""WITH e AS (SELECT page_id, {CANON} AS k, page_id % 3 = 0 AS mail, page_id % 2 AS day, page_id AS pos FROM pages UNION ALL SELECT page_id + 100000, {CANON}, false, page_id % 2, page_id + 100000 FROM pages WHERE page_id % 4 = 0),
    g AS (SELECT *, first_value(page_id) OVER (PARTITION BY day, k ORDER BY mail, pos) AS first, count(*) OVER (PARTITION BY day, k) AS n FROM e)
    SELECT page_id, first AS "primary", CASE WHEN first <> page_id THEN first END AS duplicate_of, CASE WHEN first = page_id THEN n - 1 ELSE 0 END AS corroborated_by FROM g""",
)
def corroborate_urls(spark, d):
    """Documents seen through several channels; nothing is dropped."""
    p = table(spark, d, "pages").select("page_id", "url")
    e = p.withColumn("mail", F.col("page_id") % 3 == 0).withColumn("day", F.col("page_id") % 2)
    again = p.filter("page_id % 4 = 0").select((F.col("page_id") + 100000).alias("page_id"), F.upper(F.substring("url", 1, 5)).alias("a"), F.expr("substring(url, 6)").alias("b"), (F.col("page_id") % 2).alias("day"))
    e = e.unionByName(again.select("page_id", F.concat(F.lower("a"), "b").alias("url"), F.lit(False).alias("mail"), "day"))
    return corroborate.corroborate(e, "url", F.col("mail"), ["page_id"], ["day"], "page_id").select("page_id", "primary", "duplicate_of", "corroborated_by")


@query("content_hash_dedupe", "SELECT sha256(text) AS sha, substr(sha256(text), 1, 2) || '/' || sha256(text) || '.bin' AS path FROM documents GROUP BY text")
def content_hash_dedupe(spark, d):
    """One stored object for each content."""
    return change.store_by_hash(table(spark, d, "documents").select("text"), "text").select("sha", "path")


def header_sql(prev: str) -> str:
    return f"""'{{"body_sha":"' || d.body_sha || '","day":"' || d.day || '","prev":' || {prev} || ',"rows":' || d.rows || '}}'"""


@query(
    "manifest_chain",
    f"""WITH RECURSIVE l AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_id, sha256('{{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}}') AS sha FROM events),
    b AS (SELECT day, sha[1:2] AS bin, count(*) AS n, sha256(string_agg(sha, chr(10) ORDER BY event_id, sha)) AS h FROM l GROUP BY ALL), d AS (SELECT day, sum(n)::BIGINT AS rows, sha256(string_agg(bin || ':' || h, chr(10) ORDER BY bin)) AS body_sha, row_number() OVER (ORDER BY day) AS k FROM b GROUP BY day),
    c AS (SELECT k, day, rows, body_sha, NULL::VARCHAR AS prev, sha256({header_sql("'null'")}) AS sha FROM d WHERE k = 1 UNION ALL SELECT d.k, d.day, d.rows, d.body_sha, c.sha, sha256({header_sql("""'"' || c.sha || '"'""")}) FROM c JOIN d ON d.k = c.k + 1)
    SELECT day, rows, body_sha, prev, sha FROM c""",
)
def manifest_chain(spark, d):
    """A hash chain over days."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type", "user_id")
    days = change.day_digests(e, "day", ["event_id"], ["event_id", "event_type", "user_id"]).collect()  # one row a day
    return spark.createDataFrame(change.chain((r.day, r.rows, r.body_sha) for r in days), "day string, rows long, body_sha string, prev string, sha string")


# --- windows ---


@query(
    "error_streaks",
    """WITH e AS (SELECT event_id, user_id, ts, event_type IN ('error', 'view') AS bad FROM events), i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e)
    SELECT event_id, user_id, sum(bad::INT) OVER (PARTITION BY user_id, island ORDER BY ts, event_id)::BIGINT AS streak FROM i""",
)
def error_streaks(spark, d):
    """Consecutive failures up to each event."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return health.streaks(e, "user_id", ["ts", "event_id"], F.col("event_type").isin("error", "view")).select("event_id", "user_id", "streak")


@query(
    "label_transitions",
    """WITH l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events)
    SELECT user_id, last(event_type ORDER BY ts, event_id) AS label, max(CASE WHEN was IS NULL OR was <> event_type THEN ts END) AS since, count(CASE WHEN was <> event_type THEN 1 END) AS changes FROM l GROUP BY user_id""",
)
def label_transitions(spark, d):
    """the label now, since when, and how often it changed."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("was", F.lag("event_type").over(w))
    moved = F.col("was").isNull() | (F.col("was") != F.col("event_type"))
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("label"), F.max(F.when(moved, F.col("ts"))).alias("since"), F.count_if(F.col("was") != F.col("event_type")).alias("changes"))


@query("repeat_link_filter", "SELECT page_id, url FROM pages QUALIFY count(*) OVER (PARTITION BY regexp_extract(url, '//([^/?#]*)', 1)) <= 2")
def repeat_link_filter(spark, d):
    """F8: anchors whose host repeats at most twice. Hosts are counted in tasks first, and only the rare ones meet rows."""
    p = table(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "//([^/?#]*)", 1).alias("host"))
    return p.join(p.groupBy("host").count().filter("count <= 2"), "host", "left_semi").select("page_id", "url")


@query("batch_numbering", f"WITH {T} SELECT doc_id, ((row_number() OVER (PARTITION BY digest_day ORDER BY collection, doc_id) - 1) // 6)::INT AS batch FROM texts")
def batch_numbering(spark, d):
    """Batches of six within a filing day."""
    return journal.batches(bind.texts(spark, d), ["collection", "doc_id"], 6, "digest_day").select("doc_id", "batch")


@query("carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page, lead(event_id, 1, -1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS segment_end FROM events")
def carry_forward(spark, d):
    """The last printed page carried forward, and the start of the next segment."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    page = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    return table(spark, d, "events").select("event_id", page.alias("page"), F.lead("event_id", 1, -1).over(w).alias("segment_end"))


@query(
    "nearest_event",
    """WITH p AS (SELECT event_id, user_id, epoch(ts) AS s FROM events WHERE event_type = 'purchase'), v AS (SELECT event_id AS near, user_id, epoch(ts) AS t, event_type FROM events WHERE event_type IN ('view', 'click'))
    SELECT p.event_id, near FROM p JOIN v ON v.user_id = p.user_id QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY abs(t - s), event_type <> 'view', near) = 1""",
)
def nearest_event(spark, d):
    """The nearest event of another kind, ties to views then to the first. Nearest before and after come
    from windows over the merged events, so no pairs are made."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("purchase", "view", "click")).select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_type")
    cand = F.struct("t", (F.col("event_type") != "view").cast("int").alias("k"), "event_id")
    other = F.col("event_type") != "purchase"
    w = W.partitionBy("user_id").orderBy("t")
    # all events of one instant are seen from both sides, as the frames are by value
    same = lambda k: F.when(other & (F.col("event_type") == k), cand)
    # a frame that begins at the first row grows row by row, one that ends at the last is made anew for each: so both begin, in opposite orders
    back, ahead = w.rangeBetween(W.unboundedPreceding, 0), W.partitionBy("user_id").orderBy(F.desc("t")).rangeBetween(W.unboundedPreceding, 0)
    cols = {}
    for k in ("view", "click"):
        x = same(k)
        cols[f"b_{k}"] = F.max_by(x, F.when(x.isNotNull(), F.struct(F.col("t"), -F.col("event_id")))).over(back)
        cols[f"a_{k}"] = F.min_by(x, F.when(x.isNotNull(), F.struct(F.col("t"), F.col("event_id")))).over(ahead)
    got = e.withColumns(cols).filter(~other)
    options = F.filter(F.array(*cols), lambda x: x.isNotNull())
    ranked = F.transform(options, lambda x: F.struct(F.abs(x["t"] - F.col("t")).alias("gap"), x["k"].alias("k"), x["event_id"].alias("near")))
    return got.withColumn("near", F.array_min(ranked)["near"]).filter("near IS NOT NULL").select("event_id", "near")


@query("tag_cooccurrence", f"WITH {T}, x AS (SELECT doc_id, unnest(list_distinct([collection, doc_type, CASE WHEN char_count >= 3000 THEN 'long' ELSE 'short' END])) AS tag FROM texts) SELECT a.tag, b.tag AS other, count(*) AS n FROM x a JOIN x b ON a.doc_id = b.doc_id AND a.tag < b.tag GROUP BY ALL")
def tag_cooccurrence(spark, d):
    """Pairs of tags on one item; a row's few tags pair up inside the row, so nothing is joined."""
    tags = F.array_sort(F.array_distinct(F.array("collection", "doc_type", F.when(F.col("char_count") >= 3000, "long").otherwise("short"))))
    x = bind.texts(spark, d).select(tags.alias("t")).select(F.posexplode("t").alias("i", "tag"), "t").select("tag", F.explode(F.slice("t", F.col("i") + 2, F.size("t"))).alias("other"))
    return x.groupBy("tag", "other").agg(F.count("*").alias("n"))


# --- dates ---

NY = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York')"


@query("publication_day_ny", f"SELECT event_id, CAST({NY} AS DATE) AS day, strftime({NY}, '%H:%M:%S') AS clock, strftime(date_trunc('hour', {NY}), '%Y-%m-%d %H') AS hour FROM events")
def publication_day_ny(spark, d):
    """Day, clock and hour in New York."""
    return table(spark, d, "events").select("event_id", times.publication_day("ts").alias("day"), times.clock("ts").alias("clock"), F.date_format(F.date_trunc("hour", times.local("ts")), "yyyy-MM-dd HH").alias("hour"))


@query(
    "claimed_day_split",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS claimed, CASE WHEN o_orderkey % 5 = 4 THEN false ELSE o_orderkey % 3 = 0 END AS is_backfill FROM orders",
)
def claimed_day_split(spark, d):
    """The claimed day from five written forms; another day than the filing day is backfill."""
    o, k = F.col("o_orderdate"), F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.concat(F.date_format(o, "EEE"), F.lit(", "), F.date_format(o, "d MMM yyyy"), F.lit(" 20:30:00 -0400"))).when(k % 5 == 1, F.date_format(o, "yyyy-MM-dd'T'HH:mm")).when(k % 5 == 2, F.concat(F.lit("Released "), F.date_format(o, "MMMM d, yyyy"))).when(k % 5 == 3, F.concat(F.lit("Wed, "), F.date_format(o, "MM/dd/yyyy"), F.lit(" - 08:00"))).otherwise("no date here")
    claimed = times.claimed_day(raw)
    e = table(spark, d, "orders").select("o_orderkey", claimed.alias("c"), F.date_add(o.cast("date"), F.when(k % 3 == 0, 1).otherwise(0)).alias("day"), F.lit(None).cast("long").alias("duplicate_of"))
    return corroborate.observation_record(e, F.col("c"), F.col("day")).select("o_orderkey", F.col("c").cast("string").alias("claimed"), "is_backfill")


@query(
    "holiday_calendar",
    """WITH y AS (SELECT unnest(range(1990, 2032)) AS y), fix AS (SELECT make_date(y, m, d) AS day, n FROM y, (VALUES (1, 1, 'New Year''s Day'), (6, 19, 'Juneteenth National Independence Day'), (7, 4, 'Independence Day'), (11, 11, 'Veterans Day'), (12, 25, 'Christmas Day')) v(m, d, n)),
    obs AS (SELECT CASE isodow(day) WHEN 6 THEN day - 1 ELSE day + 1 END AS day, n || ' (observed)' AS n FROM fix WHERE isodow(day) >= 6),
    flo AS (SELECT CASE WHEN k > 0 THEN make_date(y, m, 1) + ((w - isodow(make_date(y, m, 1)) + 7) % 7)::INT + 7 * (k - 1) ELSE last_day(make_date(y, m, 1)) - ((isodow(last_day(make_date(y, m, 1))) - w + 7) % 7)::INT END AS day, n
      FROM y, (VALUES (1, 1, 3, 'Birthday of Martin Luther King, Jr.'), (2, 1, 3, 'Washington''s Birthday'), (5, 1, -1, 'Memorial Day'), (9, 1, 1, 'Labor Day'), (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving Day')) v(m, w, k, n)),
    h AS (SELECT day::DATE AS day, n AS holiday FROM fix UNION ALL SELECT day::DATE, n FROM obs UNION ALL SELECT day::DATE, n FROM flo), o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
    SELECT o.day, orders, holiday, CASE WHEN isodow(o.day) >= 6 THEN 'weekend' WHEN holiday IS NOT NULL THEN 'holiday' ELSE 'normal' END AS publishing FROM o LEFT JOIN h ON h.day = o.day""",
)
def holiday_calendar(spark, d):
    """Days with their holiday and publishing state."""
    o = table(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("orders"))
    span = table(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    return o.join(times.holidays(spark, span.a, span.b), "day", "left").select("day", "orders", "holiday", times.publishing("day", "holiday").alias("publishing"))


# --- text and URLs ---


@query("prose_gate", "WITH w AS (SELECT doc_id, text, list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents) SELECT doc_id FROM w WHERE len(w) >= 8 AND regexp_matches(text, '[.!?](\\s|$)') AND len(list_filter(w, lambda x: regexp_matches(x, '^[a-z]'))) * 2 >= len(w)")
def prose_gate(spark, d):
    """C17: documents that read like prose."""
    return table(spark, d, "documents").filter(text.looks_like_prose("text")).select("doc_id")


@query("sentence_clip", "WITH h AS (SELECT doc_id, text, left(text, 500) AS h, regexp_extract(left(text, 500), '(?s)^(.+[.?!]) ', 1) AS c FROM documents) SELECT doc_id, CASE WHEN length(text) <= 500 THEN text ELSE CASE WHEN c <> '' THEN c ELSE h END || ' [clipped]' END AS clipped, CASE WHEN length(text) > 80 THEN rtrim(left(text, 79), ' ') || '…' ELSE text END AS short FROM h")
def sentence_clip(spark, d):
    """Clipped at a sentence, and truncated with an ellipsis."""
    return table(spark, d, "documents").select("doc_id", text.sentence_clip("text", 500, " [clipped]").alias("clipped"), text.truncate("text", 80).alias("short"))


@query("whitespace_norm", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS line, trim(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[1]) AS first_line, length(text) AS chars FROM documents")
def whitespace_norm(spark, d):
    """White space collapsed, the first line, the length in code points."""
    return table(spark, d, "documents").select("doc_id", F.md5(text.one_line("text").cast("binary")).alias("line"), text.first_line("text").alias("first_line"), F.length("text").cast("long").alias("chars"))


@query("slugs_and_ids", "SELECT p_partkey, trim(regexp_replace(lower(p_type || ' & ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') AS slug, 'PR-' || p_brand || '-' || substr(sha256(p_name), 1, 8) AS package_id, p_size::VARCHAR || CASE WHEN p_size % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal, replace(p_type, ' ', '|') AS cell FROM part")
def slugs_and_ids(spark, d):
    """Slugs, ordinals, cell escapes and derived ids."""
    cell = F.replace(text.table_cell(F.replace("p_type", F.lit(" "), F.lit("|"))), F.lit("\\|"), F.lit("|"))
    return table(spark, d, "part").select("p_partkey", text.slug(F.concat("p_type", F.lit(" & "), "p_brand")).alias("slug"), hashing.package_id("p_brand", F.col("p_name")).alias("package_id"), text.ordinal("p_size").alias("ordinal"), cell.alias("cell"))


@query("redacted_addresses", "SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))::BIGINT AS found, md5(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[address]', 'g')) AS redacted FROM documents WHERE contains(text, '@')")
def redacted_addresses(spark, d):
    """E-mail addresses taken out."""
    docs = table(spark, d, "documents").filter(F.contains("text", F.lit("@")))
    return docs.select("doc_id", F.regexp_count("text", F.lit(text.EMAIL)).cast("long").alias("found"), F.md5(text.redact("text").cast("binary")).alias("redacted"))


@query("url_identities", f"SELECT page_id, {CANON} AS canonical, regexp_replace(url, '[?#].*$', '') AS without_query, regexp_replace(url, '#.*$', '') AS without_fragment, regexp_extract(url, '//([^/?#]*)', 1) AS host, regexp_matches(lower(regexp_extract(url, '//([^/?#:]*)', 1)), '\\.(gov|mil)$') AS publisher FROM pages")
def url_identities(spark, d):
    """The identities of a URL."""
    return table(spark, d, "pages").select("page_id", urls.canonical("url").alias("canonical"), urls.without_query("url").alias("without_query"), urls.without_fragment("url").alias("without_fragment"), urls.part("url", "AUTHORITY").alias("host"), urls.publisher("url").alias("publisher"))


# --- triggers ---


@query(
    "regeneration_trigger",
    """WITH l AS (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) AS generated, last(event_type ORDER BY ts, event_id) AS label, min(event_type) AS previous FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN generated IS NULL THEN 'initial' WHEN label <> previous THEN 'health-change' WHEN date_diff('day', CAST(generated AS DATE), DATE '2024-02-20') >= 30 THEN 'age-30d' END AS reason FROM l""",
)
def regeneration_trigger(spark, d):
    """Why an assessment is made anew."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("g"), F.max_by("event_type", F.struct("ts", "event_id")).alias("label"), F.min("event_type").alias("previous"))
    age = F.datediff(F.lit("2024-02-20").cast("date"), F.col("g").cast("date"))
    return e.select("user_id", journal.regeneration(F.col("g"), F.col("label"), F.col("previous"), age).alias("reason"))


@query(
    "analyze_trigger",
    """WITH p AS (SELECT user_id, count(*) AS n, min(ts) AS oldest FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-29' GROUP BY 1), c AS (SELECT user_id, max(ts) AS cycle FROM events WHERE event_type = 'click' GROUP BY 1)
    SELECT c.user_id, coalesce(n, 0) AS pending, epoch(TIMESTAMP '2024-01-30 23:59:00' - cycle) / 60 >= 15 AND coalesce(n, 0) > 0 AND (coalesce(n, 0) >= 6 OR coalesce(epoch(TIMESTAMP '2024-01-30 23:59:00' - oldest) / 60 >= 60, false)) AS fires FROM c LEFT JOIN p ON p.user_id = c.user_id""",
)
def analyze_trigger(spark, d):
    """Whether model work runs, by the oldest pending item."""
    e, now = table(spark, d, "events"), F.lit("2024-01-30 23:59:00").cast("timestamp_ntz")
    minutes = lambda c: (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(c).cast("timestamp"))) / 60e6
    p = e.filter((F.col("event_type") == "view") & (F.col("ts") >= F.lit("2024-01-29").cast("timestamp_ntz"))).groupBy("user_id").agg(F.count("*").alias("pending"), F.min("ts").alias("oldest"))
    c = e.filter("event_type = 'click'").groupBy("user_id").agg(F.max("ts").alias("cycle")).join(p, "user_id", "left").fillna(0, ["pending"])
    return c.select("user_id", "pending", journal.fires(F.col("pending"), minutes("cycle"), minutes("oldest")).alias("fires"))


# --- writes ---


@query("replace_on_rerun", f"WITH {T} SELECT doc_id, collection, char_count FROM texts WHERE collection NOT IN ('src1', 'src2') UNION ALL SELECT doc_id, collection, char_count * 2 FROM texts WHERE collection = 'src1' AND char_count > 1000")
def replace_on_rerun(spark, d):
    """The rows of two collections replaced by their new extraction."""
    t = bind.texts(spark, d).select("doc_id", "collection", "char_count")
    new = t.filter("collection = 'src1' AND char_count > 1000").withColumn("char_count", F.col("char_count") * 2)
    return upsert.replaced(t, new, "collection", t.filter("collection IN ('src1', 'src2')"))


@query(
    "failure_ladder",
    "WITH f AS (SELECT user_id AS id, count(*) FILTER (WHERE event_type = 'error') AS n FROM events GROUP BY 1) SELECT id AS package_id, (n % 50 + (id % 2 = 0)::INT)::BIGINT AS attempts, CASE WHEN id % 2 = 0 THEN CASE WHEN n % 50 + 1 >= 20 THEN 'exhausted' ELSE 'failed' END ELSE 'pending' END AS fetch_status FROM f",
)
def failure_ladder(spark, d):
    """One more failure for half of the packages, with a ceiling."""
    f = table(spark, d, "events").groupBy(F.col("user_id").alias("package_id")).agg((F.count_if(F.col("event_type") == "error") % 50).alias("attempts")).withColumn("fetch_status", F.lit("pending"))
    return upsert.failed(f, f.filter("package_id % 2 = 0"), "package_id", 20).select("package_id", "attempts", "fetch_status")


# --- presentation ---


@query(
    "mechanical_tags",
    f"""WITH {T}, x AS (SELECT doc_id, list_distinct([CASE WHEN collection IN ('src1', 'src2') THEN 'executive' WHEN collection = 'src3' THEN 'judicial' ELSE 'cross-branch' END, doc_type, collection]) AS t FROM texts)
    SELECT tag, count(*) AS n FROM (SELECT unnest(t) AS tag FROM x) GROUP BY 1""",
)
def mechanical_tags(spark, d):
    """Branch, type and source tags, counted."""
    section = F.when(F.col("collection") == "src1", "rules").when(F.col("collection") == "src2", "agency").when(F.col("collection") == "src3", "judicial").otherwise("none")
    t = bind.texts(spark, d).select(presentation.mechanical_tags(section, F.col("doc_type"), F.lit(None).cast("string"), F.col("collection")).alias("tags"))
    return presentation.facets(t, "tags")


@query(
    "floored_series",
    f"""WITH {L}, f AS (SELECT CAST(ts AS DATE) AS day, count(*) AS requests, round_even(avg(CASE WHEN status IS NOT NULL THEN floor(elapsed_ms) END), 0)::BIGINT AS mean_ms FROM log WHERE host = 'h19' GROUP BY 1)
    SELECT strftime(d.day, '%Y-%m-%d') AS day, coalesce(requests, 0) AS requests, mean_ms FROM (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-02-03', INTERVAL 1 DAY))::DATE AS day) d LEFT JOIN f ON f.day = d.day""",
)
def floored_series(spark, d):
    """A dense series that starts at a floor date; a silent host has counts but no mean."""
    log = bind.request_log(spark, d).filter("host = 'h19'").select(F.col("ts").cast("date").alias("day"), F.when(F.col("status").isNotNull(), F.floor("elapsed_ms")).alias("elapsed_ms"))
    day = lambda x: F.lit(x).cast("date")
    return presentation.floored_series(log, "day", day("2024-01-05"), day("2024-02-03"), day("2024-01-10")).withColumn("day", F.col("day").cast("string"))


@query(
    "live_arrivals",
    """WITH i AS (SELECT o_orderkey, o_orderdate, NULLIF(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'Order ' || o_orderkey::VARCHAR END, '') AS t FROM orders WHERE o_orderstatus = 'P'), g AS (SELECT l_orderkey, 'Line ' || l_partkey::VARCHAR AS gt FROM lineitem WHERE l_linenumber = 1)
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, coalesce(t, gt, o_orderkey::VARCHAR) AS title, s.quality::VARCHAR AS summary FROM i LEFT JOIN g ON l_orderkey = o_orderkey LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE toxic = 0) s ON doc_id = o_orderkey""",
)
def live_arrivals(spark, d):
    """Arrivals with titles coalesced and summaries of the current version attached."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'")
    items = o.select("o_orderkey", F.col("o_orderdate").alias("observed_at"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"))).alias("title"))
    g = table(spark, d, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("Line "), F.col("l_partkey").cast("string")).alias("title"))
    s = table(spark, d, "labels").select(F.col("doc_id").alias("o_orderkey"), F.col("toxic").alias("version"), F.col("quality").cast("string").alias("summary")).distinct()
    out = presentation.arrivals(items.withColumn("title", F.col("title")), g, s, ["o_orderkey"], 0)
    return out.select("o_orderkey", F.date_format("observed_at", "yyyy-MM-dd").alias("day"), F.col("title"), "summary")


@query(
    "known_gaps",
    """WITH p AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'P' THEN 'failed' ELSE 'skipped' END AS st FROM orders WHERE o_orderpriority = '2-HIGH')
    SELECT 'unfetched' AS gap, count(*) AS n FROM p WHERE st NOT IN ('fetched', 'skipped') UNION ALL SELECT 'unextracted', count(*) FROM p WHERE st = 'fetched' AND id NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'failed graphics', count(*) FROM lineitem JOIN p ON id = l_orderkey WHERE l_returnflag = 'R'""",
)
def known_gaps(spark, d):
    """What is unfetched, unextracted or failed."""
    st = F.when(F.col("o_orderstatus") == "F", "fetched").when(F.col("o_orderstatus") == "P", "failed").otherwise("skipped")
    p = table(spark, d, "orders").select(F.col("o_orderkey").alias("package_id"), st.alias("fetch_status"), F.col("o_orderpriority").alias("digest_day"))
    line = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("package_id"), F.when(F.col("l_returnflag") == "R", "failed").otherwise("ok").alias("status"))
    return presentation.known_gaps(p, line, line, F.lit("2-HIGH"))


@query(
    "digest_document",
    f"""WITH {SELECTED}, i AS (SELECT CASE WHEN rule = 'SEL-LONG' THEN 'house' WHEN rule = 'SEL-DE' THEN 'rules' ELSE 'agency' END AS section, doc_id, rule FROM sel WHERE rule IS NOT NULL),
    n AS (SELECT *, 'Document ' || doc_id::VARCHAR AS title, 'https://example.gov/' || doc_id::VARCHAR AS link FROM i)
    SELECT section, row_number() OVER (PARTITION BY section ORDER BY title, link)::INT AS place, '### ' || title || chr(10) || 'Included: ' || rule || chr(10) || 'Source: ' || link AS line FROM n UNION ALL SELECT DISTINCT section, 0, '## ' || upper(section[1]) || section[2:] FROM n""",
)
def digest_document(spark, d):
    """The ordered lines of a digest, a reason with every item."""
    chosen = rules.select_items(bind.texts(spark, d), stand_in_rules()).filter(F.col("rule").isNotNull())
    section = F.when(F.col("rule") == "SEL-LONG", "house").when(F.col("rule") == "SEL-DE", "rules").otherwise("agency")
    none = F.lit(None).cast("string")
    items = chosen.select(section.alias("section"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), none.alias("summary"), none.alias("plain"), "rule", F.concat(F.lit("https://example.gov/"), F.col("doc_id").cast("string")).alias("link"))
    return presentation.digest_lines(items, ["house", "rules", "agency"]).select("section", "place", "line")
