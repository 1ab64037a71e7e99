"""Readers of whole records, columns of text, dates and URLs, and writes by key, over the bound tables (A, B, C, E, I, J, K)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow import schema
from docketflow.functions import hashing, text, times, urls
from docketflow.operators import corroborate, health, journal, lexicon, presentation, upsert
from docketflow.plans import bind
from docketflow.session import exists, shared_dir, spread, table
from docketflow.sources import base, feeds, listing, mail, packages
from docketflow.streaming import operators as streaming

Q: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


T, L, S, R = bind.TEXTS_SQL, bind.LOG_SQL, bind.SUMMARIES_SQL, bind.REGISTRY_SQL
PAGE = 250  # rows that a built body holds at most


def s(name: str):
    return F.col(name).cast("string")


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd")


def lit(x: str):
    return F.lit(x)


# --- readers ---


@query("paged_listing", "SELECT 'P-' || o_orderkey::VARCHAR AS package_id, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS title FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'")
def paged_listing(spark, d):
    """A1: packages of overlapping JSON pages since a watermark, each once."""
    o = table(spark, d, "orders").withColumn("page", F.explode(F.array(F.floor(F.col("o_orderkey") / PAGE), F.floor(F.col("o_orderkey") / PAGE) + 1)))
    one = F.struct(F.concat(lit("P-"), s("o_orderkey")).alias("packageId"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastModified"), day("o_orderdate").alias("dateIssued"), F.col("o_orderstatus").alias("title"))
    pages = o.groupBy("page").agg(F.to_json(F.struct(F.collect_list(one).alias("packages"), lit("next").alias("nextPage"))).alias("body"))
    return feeds.paged(pages, lit("1996-01-01").cast("timestamp")).select(F.col("packageId").alias("package_id"), F.col("dateIssued").alias("day"), "title")


@query("first_offered", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'xml' WHEN p_retailprice > 1000 THEN 'txt' ELSE 'pdf' END AS format, CASE WHEN p_size > 25 THEN p_name WHEN p_retailprice > 1000 THEN p_type ELSE p_brand END AS link FROM part")
def first_offered(spark, d):
    """A2: the first offered format of a package in order of preference."""
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_name")).alias("x"), F.when(F.col("p_retailprice") > 1000, F.col("p_type")).alias("t"), F.col("p_brand").alias("p"))
    return p.select("p_partkey", base.first_offered({"xml": "x", "txt": "t", "pdf": "p"}, ["xml", "txt", "pdf"]).alias("f")).select("p_partkey", "f.format", "f.link")


@query("bill_round_trip", "SELECT o_orderkey, 'Introduced-' || o_orderstatus AS stage, 'To settle order ' || o_orderkey::VARCHAR AS title, 'Clerk A; Clerk B' AS sponsors, CASE WHEN o_orderkey % 2 = 0 THEN 'hjres' ELSE 'sres' END AS type, o_custkey::VARCHAR AS number, CASE WHEN o_orderkey % 2 = 0 THEN 'house' ELSE 'senate' END AS chamber FROM orders")
def bill_round_trip(spark, d):
    """Bills: stage, title, distinct sponsors, and the parts of the package id."""
    kind = F.when(F.col("o_orderkey") % 2 == 0, "hjres").otherwise("sres")
    body = F.concat(lit('<bill bill-stage="Introduced-'), "o_orderstatus", lit('"><metadata>no</metadata><form><official-title>To settle <b>order</b> '), s("o_orderkey"), lit("</official-title><sponsor>Clerk A</sponsor><cosponsor>Clerk B</cosponsor><cosponsor>Clerk A</cosponsor></form></bill>"))
    rows = table(spark, d, "orders").select("o_orderkey", F.concat(lit("BILLS-119"), kind, s("o_custkey"), lit("is1")).alias("package_id"), body.alias("body"))
    got = packages.bills(rows, "body", ["o_orderkey", "package_id"])
    parts = packages.bill_id(F.col("package_id"))
    return got.select("o_orderkey", F.col("doc_type").alias("stage"), "title", F.col("metadata")["sponsors"].alias("sponsors"), *[parts[k].alias(k) for k in ("type", "number", "chamber")])


@query("law_round_trip", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'PRIVATE' WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'PRIVATE' ELSE 'PUBLIC' END AS class, CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey::VARCHAR END AS law_number, CASE WHEN o_orderkey % 3 = 1 THEN '138 Stat. 1; 138 Stat. 2' END AS citations, CASE WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS approved FROM orders")
def law_round_trip(spark, d):
    """Laws by their stated type or package id, never by laws that the text cites; plain text where it isn't XML."""
    k = F.col("o_orderkey")
    kind = F.when(k % 2 == 0, "Private Law").otherwise("Public Law")
    xml = F.concat(lit('<law xmlns="http://schemas.gpo.gov/xml/uslm" xmlns:dc="http://purl.org/dc/elements/1.1/"><meta><dc:title>T</dc:title><dc:type>'), kind, lit("</dc:type><docNumber>"), s("o_orderkey"), lit("</docNumber><citableAs>138 Stat. 1</citableAs><citableAs>138 Stat. 2</citableAs><approvedDate>"), day("o_orderdate"), lit("</approvedDate></meta><main>See Private Law 7 and Public Law 8</main></law>"))
    body = F.when(k % 3 == 1, xml).otherwise("See Private Law 7 & Public Law 8")
    code = F.concat(lit("PLAW-119"), F.when(k % 3 == 0, "pvtl").otherwise("publ"), s("o_orderkey"))
    got = packages.laws(table(spark, d, "orders").select("o_orderkey", code.alias("package_id"), body.alias("body")), "body", ["o_orderkey", "package_id"])
    m = F.col("metadata")
    return got.select("o_orderkey", F.col("doc_type").alias("class"), m["law_number"].alias("law_number"), m["citations"].alias("citations"), m["approved_date"].alias("approved"))


@query(
    "case_round_trip",
    """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, strftime(min(l_shipdate), '%Y-%m-%d') AS filed, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2)
    SELECT k AS o_orderkey, 'USCOURTS-ca' || (k % 9)::VARCHAR || '-' || k::VARCHAR || '-' || n::VARCHAR AS opinion, (row_number() OVER (PARTITION BY k ORDER BY n) - 1)::INT AS place, CASE WHEN k % 4 <> 0 THEN 'Case ' || k::VARCHAR END AS title,
    CASE WHEN k % 4 = 0 THEN 'APPELLATE' ELSE 'DISTRICT' END AS court, CASE WHEN k % 4 <> 0 THEN filed END AS filed, CASE WHEN k % 4 <> 0 THEN flag <> 'N' END AS precedential, flag || ' words' AS text FROM l""",
)
def case_round_trip(spark, d):
    """Case packages with a mods.xml (absent from every fourth) and PDF members; texts come beside them."""
    line = spread(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"), "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(day(F.min("l_shipdate")).alias("filed"), F.min("l_returnflag").alias("l_returnflag"))
    stem = F.concat(lit("USCOURTS-ca"), (F.col("l_orderkey") % 9).cast("string"), lit("-"), s("l_orderkey"), lit("-"), s("l_linenumber"))
    docket = F.when(F.col("l_returnflag") == "N", "NOT FOR PUBLICATION").otherwise("Published opinion")
    item = F.concat(lit('<relatedItem type="constituent"><extension><accessId>'), "stem", lit("</accessId><courtName>Court</courtName><docketText>"), docket, lit("</docketText></extension><originInfo><dateIssued>"), "filed", lit("</dateIssued></originInfo></relatedItem>"))
    mods = F.concat(lit('<mods xmlns="http://www.loc.gov/mods/v3"><titleInfo><title>Case '), s("l_orderkey"), lit("</title></titleInfo><extension><courtType>District</courtType></extension>"), F.concat_ws("", F.collect_list(item)), lit("</mods>"))
    line = line.withColumn("stem", stem)
    rows = line.groupBy("l_orderkey").agg(F.when(F.col("l_orderkey") % 4 != 0, mods).alias("mods"), F.sort_array(F.collect_list("stem"), asc=False).alias("stems"), F.map_from_entries(F.collect_list(F.struct("stem", F.concat("l_returnflag", lit(" words"))))).alias("texts"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for m, stems in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                of_case = [("x/mods.xml", m.encode())] if m else []
                out.append(packages.stored_zip(of_case + [(f"x/pdf/{k}.pdf", b"%PDF") for k in stems]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(out, pa.binary())], names=["o_orderkey", "texts", "body"])

    zips = rows.select("l_orderkey", "mods", "stems", "texts").mapInArrow(pack, "o_orderkey long, texts map<string, string>, body binary")
    zips = zips.withColumn("package_id", F.concat(lit("USCOURTS-ca"), (F.col("o_orderkey") % 9).cast("string"), lit("-"), s("o_orderkey")))
    got = packages.case_zips(zips, "body", ["o_orderkey", "package_id", "texts"], texts="texts")
    return got.select("o_orderkey", F.col("granule_id").alias("opinion"), F.col("pos").alias("place"), "title", F.col("doc_type").alias("court"), F.col("metadata")["date_filed"].alias("filed"), "precedential", "text")


@query("vote_round_trip", "SELECT o_custkey AS number, count(*) FILTER (WHERE o_orderstatus = 'F') AS yeas, coalesce(array_to_string(list_sort(list('M' || o_orderkey::VARCHAR) FILTER (WHERE o_orderstatus <> 'F')), ','), '') AS nays, CASE WHEN o_custkey % 5 = 0 THEN 'nays: published 99, roster ' || (count(*) FILTER (WHERE o_orderstatus <> 'F'))::VARCHAR END AS note FROM orders GROUP BY 1")
def vote_round_trip(spark, d):
    """Roll calls with members by position, and a note where tally and roster disagree."""
    yea = F.col("o_orderstatus") == "F"
    member = F.concat(lit("<member><member_full>M"), s("o_orderkey"), lit("</member_full><vote_cast>"), F.when(yea, "Yea").otherwise("Nay"), lit("</vote_cast></member>"))
    count = lambda c: F.count_if(c).cast("string")
    body = F.concat(lit("<v><vote_number>"), s("o_custkey"), lit("</vote_number><count><yeas>"), count(yea), lit("</yeas><nays>"), F.when(F.col("o_custkey") % 5 == 0, "99").otherwise(count(~yea)), lit("</nays></count><members>"), F.concat_ws("", F.collect_list(member)), lit("</members></v>"))
    got = feeds.votes(table(spark, d, "orders").groupBy("o_custkey").agg(body.alias("body")).select("body"), "body", [])
    return got.select(F.col("number").cast("long").alias("number"), F.col("yeas").cast("long").alias("yeas"), F.coalesce(F.array_join(F.col("positions")["Nay"], ","), lit("")).alias("nays"), "note")


@query("adapter_classes", "SELECT p_partkey, CASE WHEN lower(split_part(p_type, ' ', 1)) = 'promo' THEN 'news' WHEN lower(split_part(p_type, ' ', 1)) IN ('small', 'medium') THEN 'speech' ELSE 'other' END AS class, 'feed' AS reader FROM part")
def adapter_classes(spark, d):
    """The class that the publisher's categories name; the reader of a registry row by its adapter's name."""
    words = F.transform(F.split("p_type", " "), lambda x: F.concat(lit(" "), F.upper(x)))
    classes = {"promo": "news", "SMALL": "speech", "Medium": "speech"}
    name = next(k for k, f in feeds.READERS.items() if f is feeds.reader_for("feed"))
    return table(spark, d, "part").select("p_partkey", feeds.item_class(F.slice(words, 1, 1), classes, "other").alias("class"), lit(name).alias("reader"))


@query("feed_verdicts", "SELECT o_custkey, count(*) AS items, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS with_guid, count(*) FILTER (WHERE o_orderstatus <> 'P') AS with_date, sum(length(o_orderpriority))::BIGINT // count(*) AS mean_chars, CASE WHEN o_custkey % 10 = 3 THEN 'blocked' WHEN o_custkey % 10 = 4 THEN 'missing' WHEN o_custkey % 10 = 5 THEN 'unreachable' WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') < count(*) THEN 'undated-items' ELSE 'usable' END AS verdict FROM orders GROUP BY 1")
def feed_verdicts(spark, d):
    """Quality of a source's sample, and what it shows."""
    items = table(spark, d, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, s("o_orderkey")).alias("guid"), F.when(F.col("o_orderstatus") != "P", day("o_orderdate")).alias("claimed_date"), F.col("o_orderpriority").alias("description"))
    q, k = feeds.feed_quality(items, "o_custkey"), F.col("o_custkey") % 10
    status = F.when(k == 3, 403).when(k == 4, 404).when(k != 5, 200)
    return q.withColumn("verdict", feeds.verdict(status, F.col("items"), F.col("with_date"), F.lit(True)))


@query("charset_ladder", "SELECT n_nationkey, n_name || ' déjà' AS words FROM nation")
def charset_ladder(spark, d):
    """Bytes as text: by the header's charset, by the page's, as UTF-8."""
    k, words = F.col("n_nationkey") % 3, F.concat("n_name", lit(" déjà"))
    body = F.when(k == 0, F.encode(words, "ISO-8859-1")).when(k == 1, F.encode(F.concat(lit('<meta charset="iso-8859-1">'), words), "ISO-8859-1")).otherwise(F.encode(words, "UTF-8"))
    rows = table(spark, d, "nation").select("n_nationkey", F.struct(body.alias("body"), F.when(k == 0, "latin-1").alias("header")).alias("x"))
    got = base.parsed(rows, "x", ["n_nationkey"], "words string", lambda x: [{"words": listing.html_text(listing.decoded(bytes(x["body"]), x["header"]))}])
    return got.select("n_nationkey", "words")


@query("mail_cursor", "SELECT 'same' AS mailbox, count(*) AS n FROM customer WHERE c_custkey > 700 UNION ALL SELECT 'renumbered', count(*) FROM customer")
def mail_cursor(spark, d):
    """K4: messages after the cursor; all of them when the mailbox was renumbered."""
    c = table(spark, d, "customer")
    n = lambda box, validity: mail.since(c, "c_custkey", 700, validity, 1).agg(F.count("*").alias("n")).select(lit(box).alias("mailbox"), "n")
    return n("same", 1).unionByName(n("renumbered", 2))


@query(
    "conditional_polls",
    """WITH p AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'e' || s_suppkey::VARCHAR END AS etag, CASE s_suppkey % 4 WHEN 0 THEN 304 WHEN 1 THEN 200 WHEN 2 THEN 503 END AS status FROM supplier)
    SELECT id, CASE WHEN status = 200 THEN 'new' ELSE etag END AS etag, CASE WHEN status IN (200, 304) THEN 'now' ELSE 'before' END AS checked_at, CASE WHEN status = 200 THEN 'now' ELSE 'before' END AS changed_at, coalesce(status = 200, false) AS work, CASE WHEN etag IS NOT NULL THEN 'If-None-Match' ELSE '' END AS asked FROM p""",
)
def conditional_polls(spark, d):
    """K3: conditional requests; a 304 has no work and keeps the validators."""
    k = F.col("s_suppkey")
    state = table(spark, d, "supplier").select(k.alias("source_id"), F.when(k % 2 == 0, F.concat(lit("e"), s("s_suppkey"))).alias("etag"), F.lit(None).cast("string").alias("modified"), lit("before").alias("checked_at"), lit("before").alias("changed_at"))
    asked = state.select("source_id", F.array_join(F.map_keys(base.conditions(F.col("etag"), F.col("modified"))), ",").alias("asked"))
    answers = state.filter("source_id % 4 < 3").select("source_id", F.element_at(F.array(F.lit(304), F.lit(200), F.lit(503)), (F.col("source_id") % 4 + 1).cast("int")).alias("status"), lit("new").alias("etag"), F.lit(None).cast("string").alias("modified"), lit("now").alias("at"))
    return base.polled(state, answers).join(asked, "source_id").select(F.col("source_id").alias("id"), "etag", "checked_at", "changed_at", "work", "asked")


# --- writes ---


@query("first_writers", "SELECT l_orderkey, min(l_linenumber) AS line, list(l_returnflag ORDER BY l_linenumber, l_returnflag)[1] AS flag FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def first_writers(spark, d):
    """Rows whose key the target lacks, the first writer of each."""
    have = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"))
    return upsert.get_or_create(have, rows.withColumn("at", F.struct("line", "flag")), ["l_orderkey"], "at").drop("at")


@query("skipped_old", "SELECT CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 'skipped' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'fetched' END AS fetch_status, count(*) AS n FROM orders GROUP BY 1")
def skipped_old(spark, d):
    """Pending packages from before the fetch window are skipped."""
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date_issued"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("fetched").alias("fetch_status"))
    return upsert.skip_old(o, lit("1997-01-01").cast("date")).groupBy("fetch_status").agg(F.count("*").alias("n"))


@query("withdrawn_layers", "SELECT 'layer' AS layer, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT 'dependents', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'")
def withdrawn_layers(spark, d):
    """Withdrawn keys go from a layer and from the one that depends on it."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    layer, dependents = upsert.withdrawn(o, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), o.filter("o_orderstatus = 'P'").select("k"), ["k"])
    n = lambda x, name: x.agg(F.count("*").alias("n")).select(lit(name).alias("layer"), "n")
    return n(layer, "layer").unionByName(n(dependents, "dependents"))


@query("appended_log", f"WITH {L} SELECT 'https://' || host || '/' AS url, status, count(*) * 2 AS n FROM log GROUP BY ALL")
def appended_log(spark, d):
    """Two appends of rows of an older schema to a log, read back in today's."""
    path = f"{shared_dir(spark)}/docketflow/log-{uuid.uuid4().hex}"
    rows = bind.request_log(spark, d).select(F.concat(lit("https://"), "host", lit("/")).alias("url"), "status")
    for _ in range(2):
        schema.append(rows, path, "fetch_log")
    return schema.conformed(spark.read.parquet(path), "fetch_log").filter("client IS NULL").groupBy("url", "status").agg(F.count("*").alias("n"))


@query("filled_columns", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS digest_day, CASE WHEN o_orderstatus = 'P' THEN 'https://archive/' || o_orderkey::VARCHAR END AS archive_url FROM orders")
def filled_columns(spark, d):
    """A missing column filled in once, and a column set by key after the fact."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, day("o_orderdate")).alias("digest_day"), day("o_orderdate").alias("day"), F.lit(None).cast("string").alias("archive_url"))
    values = o.filter("o_orderstatus = 'P'").select("o_orderkey", F.concat(lit("https://archive/"), s("o_orderkey")).alias("archive_url"))
    return upsert.set_value(upsert.backfilled(o, "digest_day", F.col("day")), values, "o_orderkey", "archive_url").select("o_orderkey", "digest_day", "archive_url")


@query("written_once", "SELECT DISTINCT user_id, event_type FROM events")
def written_once(spark, d):
    """Batches appended by key, one replayed and one empty; nothing is written twice."""
    path = f"{shared_dir(spark)}/docketflow/once-{uuid.uuid4().hex}"
    e = table(spark, d, "events").select("user_id", "event_type")
    write = streaming.on_change(streaming.append_new(path, ["user_id", "event_type"]))
    half = F.pmod(F.col("user_id"), F.lit(2))
    for number, batch in ((0, e.filter(half == 0)), (1, e), (1, e), (2, e.limit(0))):
        write(batch, number)
    return spark.read.parquet(path).select("user_id", "event_type") if exists(spark, path) else e.distinct()


# --- selection and columns ---


@query("admissible_anchors", "SELECT page_id, regexp_matches(url, '^https?://') AND length(regexp_replace(url, '^https?://', '')) >= 12 AND page_id % 3 <> 0 AS item FROM pages")
def admissible_anchors(spark, d):
    """Anchors that may be items: HTTP, the listing's own host, a long enough title."""
    p = table(spark, d, "pages").select("page_id", "url", F.regexp_replace("url", "^https?://", "").alias("title"))
    own = F.when(F.col("page_id") % 3 == 0, "https://elsewhere.example/").otherwise(F.regexp_replace("url", r"://(?:www\.)?", "://www."))
    return p.withColumn("base", own).select("page_id", urls.article_anchor("url", "title", "base").alias("item"))


@query("mail_text", "SELECT c_custkey, c_custkey % 3 = 0 AS administrative, 'News of ' || c_mktsegment AS kept FROM customer")
def mail_text(spark, d):
    """Subjects that manage a subscription; text up to the footer rule without view-online lines."""
    subject = F.when(F.col("c_custkey") % 3 == 0, "Please confirm your subscription").otherwise("Order news")
    body = F.concat(lit("View this email in your browser\nNews of "), "c_mktsegment", lit("\n-----\nfooter\nUnsubscribe"))
    return table(spark, d, "customer").select("c_custkey", text.administrative(subject).alias("administrative"), text.strip_boilerplate(body).alias("kept"))


@query("relative_days", "SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-06-01' - 30 AND DATE '1996-06-01'")
def relative_days(spark, d):
    """Rows of the last thirty days before a day."""
    return table(spark, d, "orders").filter(times.within_days(F.col("o_orderdate").cast("date"), lit("1996-06-01").cast("date"), 30)).select("o_orderkey")


@query("method_counts", "SELECT CASE WHEN quality = 1 THEN 'official' ELSE 'llm' END AS method, count(*) AS n FROM labels WHERE doc_id % 30 = 4 GROUP BY 1")
def method_counts(spark, d):
    """Stored summaries of a day by method."""
    rows = table(spark, d, "labels").select(F.when(F.col("quality") == 1, "official").otherwise("llm").alias("method"), F.date_add(lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("digest_day"))
    return presentation.methods(rows, lit("2024-01-05").cast("date"))


@query("tag_pivot", "SELECT source AS section, coalesce(array_to_string(list_sort(list_distinct(list(lang) FILTER (WHERE doc_id % 2 = 0 AND lang IS NOT NULL))), ','), '') AS mechanical, coalesce(array_to_string(list_sort(list_distinct(list(lang) FILTER (WHERE doc_id % 6 = 1 AND lang IS NOT NULL))), ','), '') AS llm FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 <> 2 GROUP BY 1")
def tag_pivot(spark, d):
    """Sorted tags of every section by method; model tags of the current version only."""
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.col("source").alias("section"), F.col("lang").alias("tag"), F.when(k % 2 == 0, "mechanical").otherwise("llm").alias("method"), F.when(k % 2 == 0, None).otherwise(k % 3).cast("int").alias("version"))
    rows = rows.withColumn("tag", F.when((F.col("method") == "llm") & (F.col("version") == 0), None).otherwise(F.col("tag"))).withColumn("version", F.when(F.col("version") == 0, 1).otherwise(F.col("version")))
    got = presentation.pivot_tags(rows, 1)
    return got.select("section", F.array_join("mechanical", ",").alias("mechanical"), F.array_join("llm", ",").alias("llm"))


@query(
    "text_shapes",
    """SELECT p_partkey, 'size ' || p_size::VARCHAR || chr(10) || chr(10) || p_type AS lines, p_name AS title, CASE WHEN p_size >= 10 THEN array_to_string(list_slice(string_split(repeat('w ', p_size)[:-2], ' '), 1, 30), ' ') END AS bounded, 'First of ' || p_brand || '.' AS teaser,
    CASE WHEN p_partkey % 2 = 0 THEN '{"a":' || p_size::VARCHAR || '}' ELSE '{}' END AS reply FROM part""",
)
def text_shapes(spark, d):
    """Line normalisation, boilerplate prefixes, word bounds, teasers, replies in fences."""
    p = table(spark, d, "part")
    lines = F.concat(lit("\r\nsize "), s("p_size"), lit("  \r\n\r\n\t\r\n\r\n"), "p_type", lit("\n\n"))
    reply = F.when(F.col("p_partkey") % 2 == 0, F.concat(lit('```json\n{"a": '), s("p_size"), lit("}\n```"))).otherwise("sorry, none")
    return p.select("p_partkey", text.normal_lines(lines).alias("lines"), text.strip_prefix(F.concat(lit("Press Release: "), "p_name"), "Press Release", "News").alias("title"), text.word_bounds(F.repeat(lit("w "), F.col("p_size")), 10, 30).alias("bounded"), text.teaser(F.concat(lit("# Head\n- item\nFirst of "), F.regexp_replace("p_brand", r"\.", ""), lit(". Second."))).alias("teaser"), text.json_reply(reply).alias("reply"))


@query("link_targets", "SELECT page_id, split_part(split_part(url, '//', 2), '/', 1) AS host, CASE WHEN contains(split_part(url, '//', 2), '/') THEN regexp_extract(url, '//[^/]*(/.*)$', 1) ELSE '/' END AS path, 'https://site.gov/news/' || page_id::VARCHAR AS interstitial, 'https://x.gov/a/' || page_id::VARCHAR AS tracked, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/y?p=1' AS resolved FROM pages")
def link_targets(spark, d):
    """Hosts and paths by slashes, interstitial and tracking links, relative links."""
    host, path = text.host_and_path("url")
    k = s("page_id")
    top = F.concat(F.regexp_extract("url", r"^(https?://[^/?#]*)", 1), lit("/a/b/c.html"))
    return table(spark, d, "pages").select("page_id", host.alias("host"), path.alias("path"), urls.interstitial(F.concat(lit("https://site.gov/go?nr=%2Fnews%2F"), k)).alias("interstitial"), urls.tracked(F.concat(lit("https://t.example/L/https%3A%2F%2Fx.gov%2Fa%2F"), k, lit("/1/abc"))).alias("tracked"), urls.resolved(top, lit("../../y?p=1")).alias("resolved"))


@query(
    "stamps_and_windows",
    """WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders), w AS (SELECT *, (d::TIMESTAMP AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC') AS a, ((d + 1)::TIMESTAMP AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC') + INTERVAL 6 HOUR AS b FROM o)
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS iso, strftime(d, '%Y-%m-%d') AS short, strftime(d, '%Y-%m-%d') || ' 15:05' AS stamp, strftime(a, '%Y-%m-%d %H:%M') AS opens, strftime(least(b, TIMESTAMP '1997-01-01 12:00:00'), '%Y-%m-%d %H:%M') AS closes FROM w""",
)
def stamps_and_windows(spark, d):
    """ISO prefixes, months by three letters with a header's year, mail stamps, and the work window of a day in New York."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    opens, closes = times.work_window("d", lit("1997-01-01 12:00:00").cast("timestamp"))
    minute = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return o.select("o_orderkey", times.iso_day(F.concat(day("d"), lit("T00:00"))).cast("string").alias("iso"), times.month_day(F.date_format("d", "d-MMM"), F.year("d")).cast("string").alias("short"), minute(times.bulletin_stamp(F.concat(lit("Sent "), F.date_format("d", "MM/dd/yyyy"), lit(" 03:05 PM EST")))).alias("stamp"), minute(opens).alias("opens"), minute(closes).alias("closes"))


@query("json_hashes", """SELECT p_partkey, sha256('{"a":' || p_size::VARCHAR || ',"b":"' || p_brand || '"}') AS sha, '{"brand":"' || p_brand || '","size":' || p_size::VARCHAR || '}' AS sorted, p_size // 7 AS share FROM part""")
def json_hashes(spark, d):
    """Canonical JSON and its hash, sorted keys, whole shares."""
    p, raw = table(spark, d, "part"), F.concat(lit('{"b": "'), "p_brand", lit('",  "a": '), s("p_size"), lit("}"))
    return p.select("p_partkey", hashing.canonical_json_hash(raw).alias("sha"), hashing.sorted_json(size=F.col("p_size"), brand=F.col("p_brand")).alias("sorted"), hashing.split_evenly(F.col("p_size"), F.lit(7)).cast("int").alias("share"))


@query("graphic_classes", "SELECT l_returnflag, CASE WHEN l_linenumber % 2 = 0 THEN 'substantive' ELSE 'decorative' END AS class, count(*) AS n FROM lineitem GROUP BY ALL")
def graphic_classes(spark, d):
    """Graphics by the class that their id codes."""
    gid = F.when(F.col("l_linenumber") % 2 == 0, F.concat(lit("ER01JA24."), F.lpad(s("l_suppkey"), 3, "0"))).otherwise(F.concat(lit("LOGO"), s("l_suppkey")))
    return table(spark, d, "lineitem").groupBy("l_returnflag", packages.graphic_class(gid).alias("class")).agg(F.count("*").alias("n"))


@query("corrections", "WITH f AS (SELECT min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P') SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'keep' WHEN o_orderkey % 4 < 2 THEN 'correct' ELSE 'withdraw' END AS step, o_orderkey = k AS first FROM orders, f")
def corrections(spark, d):
    """The first violation in order, and what happens to an item's layer after an attempt."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "A landmark order.").otherwise("An order.").alias("text"))
    found = lexicon.violations(o, o.limit(0).select("o_orderkey", F.col("text").alias("official")), "o_orderkey").select("o_orderkey").distinct()
    first = lexicon.first_violation(found, ["o_orderkey"]).select("o_orderkey", F.lit(True).alias("first"))
    j = o.join(found.withColumn("bad", F.lit(True)), "o_orderkey", "left").join(F.broadcast(first), "o_orderkey", "left")
    return j.select("o_orderkey", lexicon.correction_step(F.col("o_orderkey") % 4, F.col("bad").isNull()).alias("step"), F.coalesce("first", F.lit(False)).alias("first"))


@query("official_first", "SELECT p_partkey, CASE WHEN p_size > 20 THEN p_name END AS summary, CASE WHEN p_size > 20 THEN 'official' ELSE 'llm' END AS method FROM part")
def official_first(spark, d):
    """The publisher's own summary where it has one, else a model's turn."""
    metadata = F.to_json(F.struct(F.when(F.col("p_size") > 20, F.col("p_name")).otherwise(" ").alias("summary")))
    summary, method = presentation.official_first(metadata, F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", summary.alias("summary"), method.alias("method"))


@query("observation_order", "SELECT page_id, page_id % 5 = 0 AS is_backfill, CASE WHEN page_id % 5 = 0 THEN 2 WHEN page_id % 3 = 0 THEN 1 ELSE 0 END AS place FROM pages")
def observation_order(spark, d):
    """Listed entries, then duplicates, then backfill."""
    k = F.col("page_id")
    p = table(spark, d, "pages").select("page_id", F.when(k % 3 == 0, k - 1).alias("duplicate_of"), F.when(k % 5 == 0, lit("2024-01-01")).when(k % 5 == 1, lit("2024-01-02")).alias("claimed"))
    return corroborate.observation_record(p, F.col("claimed"), lit("2024-01-02")).select("page_id", "is_backfill", "place")


@query("journal_progress", "SELECT user_id, min(ts) FILTER (WHERE event_type = 'view') AS view, min(ts) FILTER (WHERE event_type = 'click') AS click, min(ts) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1 HAVING view IS NOT NULL")
def journal_progress(spark, d):
    """The first event of an item with the times of its later ones."""
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("event"), F.col("ts").alias("observed_at"))
    return journal.progress(e, ["user_id"], "view", ["click", "purchase"])


@query("late_rows", "SELECT o_orderkey, o_orderkey % 3 = 0 AS is_backfill FROM orders")
def late_rows(spark, d):
    """K6: the filing day never moves; rows that claim an earlier day are flagged."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("filed"))
    return streaming.late(o.withColumn("claimed", F.date_sub("filed", F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(0))), "filed", "claimed").select("o_orderkey", "is_backfill")


@query("poll_plans", "SELECT s_suppkey, 10.0::DOUBLE * 2 ** least(s_suppkey % 5, 3) * CASE WHEN s_acctbal >= 3500 THEN 2 ELSE 1 END AS minutes, s_suppkey % 2 = 0 AND s_suppkey % 7 < 3 AS final FROM supplier")
def poll_plans(spark, d):
    """Intervals by errors and budget, and days to finalise once their grace is over."""
    k = F.col("s_suppkey")
    minutes = streaming.poll_interval(F.lit(10.0), (k % 5).cast("int"), F.col("s_acctbal"), F.lit(5000.0))
    today = lit("2024-01-05").cast("date")
    return table(spark, d, "supplier").select("s_suppkey", minutes.alias("minutes"), streaming.finalizable(F.when(k % 2 == 0, today).otherwise(F.date_add(today, 1)), lit("2024-01-06 06:00:00").cast("timestamp_ntz"), F.lit(False), (k % 7).cast("int")).alias("final"))


# --- health and machine forms ---

TODAY, WINDOW = "1996-06-30", 30
HEALTH = f"""{R}, {L}, v AS (SELECT l_suppkey AS id, count(*) AS items, max(l_shipdate)::DATE AS last_day FROM lineitem WHERE l_shipdate::DATE > DATE '{TODAY}' - {WINDOW} AND l_shipdate::DATE <= DATE '{TODAY}' GROUP BY 1),
 h AS (SELECT host, count(*) AS attempts, count(*) FILTER (WHERE status BETWEEN 200 AND 399) AS answered FROM log GROUP BY 1), n AS (SELECT host, count(*) - 1 AS shared FROM registry WHERE status = 'active' GROUP BY 1),
 rec AS (SELECT r.id, r.name, r.host, r.status = 'active' AS measured, CASE WHEN measured THEN coalesce(items, 0) END AS items, CASE WHEN measured THEN date_diff('day', last_day, DATE '{TODAY}') END AS days_since_item, CASE WHEN measured THEN attempts END AS attempts, CASE WHEN measured THEN attempts - answered END AS unanswered, CASE WHEN measured AND attempts IS NOT NULL THEN shared END AS shared_with,
  CASE WHEN NOT measured THEN NULL WHEN coalesce(items, 0) = 0 AND coalesce(attempts, 0) = 0 THEN 'no-data' WHEN attempts >= 5 AND answered = 0 THEN 'no-response' WHEN r.id % 4 >= 3 THEN 'degraded' WHEN attempts >= 5 AND (attempts - answered) / attempts >= 0.1 THEN 'degraded' WHEN last_day IS NULL OR date_diff('day', last_day, DATE '{TODAY}') > 7 THEN 'quiet' ELSE 'delivering' END AS health
  FROM registry r LEFT JOIN v ON v.id = r.id LEFT JOIN h ON h.host = r.host LEFT JOIN n ON n.host = r.host)"""


def _records(spark, d) -> DataFrame:
    today = lit(TODAY).cast("date")
    sources = bind.registry(spark, d).select("id", "name", "status", "host", F.concat(lit("w"), (F.col("id") % 4).cast("string")).alias("worker"), F.lit(False).alias("is_email"))
    shipped = F.col("l_shipdate").cast("date")
    volume = table(spark, d, "lineitem").filter((shipped > F.date_sub(today, WINDOW)) & (shipped <= today)).groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("items"), F.max(shipped).alias("last_day"))
    collectors = spark.range(4).select(F.concat(lit("w"), F.col("id").cast("string")).alias("worker"), F.col("id").alias("streak"))
    return health.records(sources, volume, health.outcomes(bind.request_log(spark, d), "host"), collectors, today, WINDOW)


@query("health_records", f"WITH {HEALTH} SELECT id, measured, items, days_since_item, attempts, unanswered, shared_with, health FROM rec")
def health_records(spark, d):
    """The record of every source: volume, requests of its host, label; unmeasured ones without figures."""
    return _records(spark, d).select("id", "measured", "items", F.col("days_since_item").cast("long").alias("days_since_item"), "attempts", "unanswered", "shared_with", "health")


@query(
    "health_summary",
    f"""WITH {HEALTH}, hosts AS (SELECT host, max(attempts) AS a, max(unanswered) AS u FROM rec WHERE attempts IS NOT NULL GROUP BY 1), z AS (SELECT count(*) AS hosts_measured, sum(a)::BIGINT AS requests_window, array_to_string(list_sort(list(host) FILTER (WHERE u > 0)), ',') AS hosts_with_fetch_errors FROM hosts)
    SELECT count(*) AS sources_registered, count(*) FILTER (WHERE measured) AS sources_measured, sum(items)::BIGINT AS items_window, count(*) FILTER (WHERE unanswered > 0) AS sources_with_fetch_errors, count(*) FILTER (WHERE health = 'delivering') AS delivering, count(*) FILTER (WHERE health = 'no-data') AS no_data, any_value(hosts_measured) AS hosts_measured, any_value(requests_window) AS requests_window, any_value(hosts_with_fetch_errors) AS hosts_with_fetch_errors FROM rec, z""",
)
def health_summary(spark, d):
    """The directory's totals; a host's requests count once."""
    out = health.summary(_records(spark, d), WINDOW)
    return out.select("sources_registered", "sources_measured", "items_window", "sources_with_fetch_errors", F.col("health_counts")["delivering"].alias("delivering"), F.col("health_counts")["no-data"].alias("no_data"), "hosts_measured", "requests_window", F.array_join("hosts_with_fetch_errors", ",").alias("hosts_with_fetch_errors"))


@query("health_observed", f"WITH {HEALTH} SELECT id, CASE WHEN measured THEN health ELSE 'quiet' END AS label, CASE WHEN measured AND health <> 'quiet' THEN 'now' ELSE 'then' END AS since, CASE WHEN measured THEN 'now' ELSE 'then' END AS last_checked, coalesce(measured AND health <> 'quiet', false) AS changed FROM rec")
def health_observed(spark, d):
    """Stored labels after an observation; `since` moves when the label does."""
    state = bind.registry(spark, d).select("id", lit("quiet").alias("label"), lit("then").alias("since"), lit("then").alias("last_checked"))
    return health.observed(state, _records(spark, d), lit("now"))


@query(
    "machine_days",
    f"""WITH {T}, i AS (SELECT strftime(digest_day, '%Y-%m-%d') AS day, doc_id AS id, 'D ' || doc_id::VARCHAR AS title, collection AS section, doc_id % 7 = 0 AS is_backfill, [collection] AS tags FROM texts WHERE collection IS NOT NULL), f AS (SELECT day, section AS tag, count(*) AS n FROM i WHERE NOT is_backfill GROUP BY ALL), g AS (SELECT day, list({{'tag': tag, 'n': n}} ORDER BY n DESC, tag) AS facets FROM f GROUP BY 1),
    c AS (SELECT day, count(*) FILTER (WHERE NOT is_backfill) AS items, count(*) FILTER (WHERE is_backfill) AS backfill_count FROM i GROUP BY 1)
    SELECT day, 0 AS place, '' AS id, to_json({{'day': day, 'state': CASE WHEN day < '2024-01-20' THEN 'frozen' ELSE 'live' END, 'items': items, 'backfill_count': backfill_count, 'facets': coalesce(facets, [])}})::VARCHAR AS line FROM c LEFT JOIN g USING (day)
    UNION ALL SELECT day, 1, id::VARCHAR, to_json({{'id': id, 'title': title, 'section': section, 'is_backfill': is_backfill, 'tags': tags}})::VARCHAR FROM i""",
)
def machine_days(spark, d):
    """Days as JSON lines: counts and facets, then an item a line."""
    t = bind.texts(spark, d).filter("collection IS NOT NULL")
    items = t.select(day("digest_day").alias("day"), F.col("doc_id").alias("id"), F.concat(lit("D "), s("doc_id")).alias("title"), F.col("collection").alias("section"), (F.col("doc_id") % 7 == 0).alias("is_backfill"), F.array("collection").alias("tags"))
    return presentation.day_json(items, F.col("day") < "2024-01-20")


@query("machine_directory", f"""WITH {HEALTH}, t AS (SELECT r.*, registry.status AS st FROM rec r JOIN registry ON registry.id = r.id) SELECT id, to_json({{'id': id, 'name': name, 'status': st, 'notes': 'write to [address]', 'page': 'sources/' || id::VARCHAR || '.html', 'health': {{'measured': measured, 'items': items, 'health': health}}}})::VARCHAR AS line FROM t""")
def machine_directory(spark, d):
    """The sources' directory as JSON lines with health records, addresses taken out."""
    r = bind.registry(spark, d).withColumn("notes", F.concat(lit("write to a"), s("id"), lit("@x.gov")))
    return presentation.directory_json(r, _records(spark, d).select("id", "name", "host", "measured", "items", "health"))


@query("machine_index", f"WITH {T}, g AS (SELECT strftime(digest_day, '%Y-%m-%d') AS day, count(*) AS n FROM texts GROUP BY 1) SELECT day, to_json({{'date': day, 'title': 'Digest of ' || day, 'teaser': n::VARCHAR || ' texts', 'page': day || '.html'}})::VARCHAR AS line FROM g")
def machine_index(spark, d):
    """The index of digests."""
    g = bind.texts(spark, d).groupBy("digest_day").agg(F.count("*").alias("n"))
    return presentation.index_json(g.select(F.col("digest_day").alias("day"), F.concat(lit("Digest of "), day("digest_day")).alias("title"), F.concat(s("n"), lit(" texts")).alias("teaser"))).select(day("day").alias("day"), "line")


@query("atom_feed", f"""WITH {T}, g AS (SELECT digest_day AS d, count(*) AS n FROM texts GROUP BY 1 ORDER BY 1 DESC LIMIT 20) SELECT strftime(d, '%Y-%m-%d') AS day, '<entry><id>https://x/' || strftime(d, '%Y-%m-%d') || '?a=1&amp;b</id><title>A &lt;day&gt;</title><updated>' || strftime(d, '%Y-%m-%d') || 'T00:00:00Z</updated><link href="https://x/' || strftime(d, '%Y-%m-%d') || '?a=1&amp;b"/><summary>' || n::VARCHAR || ' texts</summary></entry>' AS entry FROM g""")
def atom_feed(spark, d):
    """The newest twenty digests as Atom entries (the limit is the feature)."""
    g = bind.texts(spark, d).groupBy(F.col("digest_day").alias("day")).agg(F.count("*").alias("n"))
    g = g.select("day", F.concat(lit("https://x/"), day("day"), lit("?a=1&b")).alias("link"), lit("A <day>").alias("title"), F.concat(s("n"), lit(" texts")).alias("teaser"))
    return presentation.atom_entries(g).select(day("day").alias("day"), "entry")
