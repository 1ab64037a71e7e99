"""Queries on source adapters: captured bodies of every kind, built from the tables and read by the adapter that their row names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.session import table
from docketflow.sources import adapters

Q: dict = {}
#: Sources by the remainder of their customer's key; the last is no adapter's name.
KINDS = ["feed", "feed-only", "interstitial", "presidential", "html-index", "votes", "bill-actions", "fax"]
TODAY, LOOKBACK, VOTE_LOOKBACK = "1998-12-31", 2000, 120


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


def said(*parts):  # noqa: ANN202
    """Text with columns in it: strings that begin with a dollar name a column."""
    return F.concat(*(F.col(p[1:]).cast("string") if p.startswith("$") else F.lit(p) for p in parts))


def sources(spark: SparkSession, d: str) -> DataFrame:
    """One source a customer, with a body of the customer's orders in the shape of its kind; every fortieth feed is broken."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("k"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.date_format("o_orderdate", "d-MMM").alias("short"), F.date_format("o_orderdate", "MMMM d, yyyy").alias("long"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("c") % 8 + 1).cast("int"))
    o = o.withColumn("category", F.when(F.col("o_orderstatus") == "F", " Executive Orders").when(F.col("o_orderstatus") == "O", "PROCLAMATIONS").otherwise("Remarks"))
    link = F.when(kind == "interstitial", said("https://x.gov/go?to=1&amp;nr=r%2F", "$k")).otherwise(said("https://x.gov/r/", "$k"))
    rss = F.concat(said("<item><title>Release ", "$k", "</title><link>"), link, said("</link><guid>o-", "$k", "</guid><pubDate>", "$day", "</pubDate><description>&lt;b&gt;About&lt;/b&gt; ", "$k", "</description><category>", "$category", "</category></item>"))
    item = (
        F.when(kind == "html-index", said("<li><a href='/r/", "$k", "'>Release number ", "$k", " here</a> <span>", "$long", "</span>"))
        .when(kind == "votes", said("<vote><vote_number>", "$k", "</vote_number><vote_date>", "$short", "</vote_date><question>On order ", "$k", "</question><result>Agreed</result></vote>"))
        .when(kind == "bill-actions", said('{"congress": 119, "type": "HR", "number": "', "$k", '", "title": "Bill ', "$k", '", "latestAction": {"actionDate": "', "$day", '", "text": "Referred"}}'))
        .otherwise(rss)
    )
    all_items = F.transform(F.array_sort(F.collect_list(F.struct("k", item.alias("item")))), lambda x: x["item"])  # one customer's orders
    bodies = o.groupBy("c").agg(all_items.alias("items")).withColumn("adapter", kind)
    joined = F.array_join("items", "")
    body = (
        F.when(F.col("adapter") == "html-index", F.concat(F.lit("<html><head><title>News</title></head><body><ul>"), joined, F.lit("</ul></body></html>")))
        .when(F.col("adapter") == "votes", F.concat(F.lit("<vote_summary><congress>119</congress><session>1</session><congress_year>1998</congress_year><votes>"), joined, F.lit("</votes></vote_summary>")))
        .when(F.col("adapter") == "bill-actions", F.concat(F.lit('{"bills": ['), F.array_join("items", ", "), F.lit("]}")))
        .when(F.col("c") % 40 == 0, F.concat(F.lit("<rss><channel>"), joined))
        .otherwise(F.concat(F.lit("<rss><channel>"), joined, F.lit("</channel></rss>")))
    )
    days = F.when(F.col("adapter") == "votes", str(VOTE_LOOKBACK)).otherwise(str(LOOKBACK))
    given = F.create_map(F.lit("index"), F.lit("https://x.gov/news"), F.lit("api"), F.lit("https://v.gov/"), F.lit("hint"), F.lit("/r/"), F.lit("today"), F.lit(TODAY), F.lit("days"), days)
    return bodies.select("c", said("s", "$c").alias("source_id"), "adapter", body.alias("body"), given.alias("given"))


def captures(spark: SparkSession, d: str) -> DataFrame:
    """Pages behind items: of three orders one has a good page, one a page without words, one none."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("k")).filter("k % 3 < 2")
    vote = F.col("c") % 8 == 5
    url = F.when(vote, F.concat(F.lit("https://v.gov/vote_119_1_"), F.lpad(F.col("k").cast("string"), F.greatest(F.lit(5), F.length(F.col("k").cast("string"))), F.lit("0")), F.lit(".xml"))).otherwise(said("https://x.gov/r/", "$k"))
    tally = said("<v><vote_number>", "$k", "</vote_number><question>On order ", "$k", "</question><vote_result>Agreed</vote_result><count><yeas>1</yeas><nays>0</nays></count><members><member><member_full>M</member_full><vote_cast>Yea</vote_cast></member></members></v>")
    good = F.when(vote, tally).otherwise(said("<html><script>x</script><p>Article ", "$k", "</p></html>"))
    bad = F.when(vote, "<v><broken").otherwise("<html><script>only a script</script></html>")
    return o.select(url.alias("url"), F.when(F.col("k") % 3 == 0, good).otherwise(bad).alias("page"))


SOURCE_ADAPTERS = f"""
WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_custkey % 8 AS a, o_orderstatus AS st, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '1998-%m-%d') AS vote_day FROM orders),
i AS (SELECT c, k, a, CASE a WHEN 5 THEN vote_day ELSE day END AS day,
  CASE WHEN a IN (2, 4) THEN 'https://x.gov/r/' || k::VARCHAR WHEN a = 5 THEN 'vote-119_1_' || lpad(k::VARCHAR, greatest(5, length(k::VARCHAR))::INT, '0') WHEN a = 6 THEN '119-hr-' || k::VARCHAR || ':' || day ELSE 'o-' || k::VARCHAR END AS identity,
  CASE a WHEN 4 THEN 'Release number ' || k::VARCHAR || ' here' WHEN 5 THEN 'On order ' || k::VARCHAR WHEN 6 THEN 'Bill ' || k::VARCHAR ELSE 'Release ' || k::VARCHAR END AS title,
  CASE a WHEN 5 THEN 'https://v.gov/vote_119_1_' || lpad(k::VARCHAR, greatest(5, length(k::VARCHAR))::INT, '0') || '.xml' WHEN 6 THEN NULL ELSE 'https://x.gov/r/' || k::VARCHAR END AS link,
  CASE WHEN a = 3 AND st = 'F' THEN 'EXECUTIVE_ORDER' WHEN a = 3 AND st = 'O' THEN 'PROCLAMATION' WHEN a = 3 THEN 'STATEMENT' WHEN a = 5 THEN 'ROLL_CALL' WHEN a = 6 THEN 'ACTION' ELSE 'RELEASE' END AS doc_type,
  CASE a WHEN 3 THEN 'PRESIDENTIAL' WHEN 5 THEN 'VOTES' WHEN 6 THEN 'BILL_ACTIONS' ELSE 'PRESS' END AS collection,
  CASE a WHEN 4 THEN 'Release number ' || k::VARCHAR || ' here' WHEN 5 THEN 'On order ' || k::VARCHAR || ': Agreed' WHEN 6 THEN 'Referred' ELSE 'About ' || k::VARCHAR END AS own,
  CASE a WHEN 5 THEN 'On order ' || k::VARCHAR || ': Agreed. Yeas 1, nays 0, present 0, not voting 0. Yea: M.' ELSE 'Article ' || k::VARCHAR END AS article, a NOT IN (1, 6) AS wants
  FROM o WHERE a < 7 AND c % 40 <> 0 AND (a NOT IN (4, 6) OR day BETWEEN strftime(DATE '{TODAY}' - {LOOKBACK}, '%Y-%m-%d') AND '{TODAY}') AND (a <> 5 OR (vote_day <> '1998-02-29' AND vote_day BETWEEN strftime(DATE '{TODAY}' - {VOTE_LOOKBACK}, '%Y-%m-%d') AND '{TODAY}')))
SELECT c AS o_custkey, 'PR-s' || c::VARCHAR || '-' || left(sha256(identity), 8) AS package_id, title, link, day, doc_type, collection, CASE WHEN wants AND k % 3 = 0 THEN article ELSE own END AS text,
  CASE WHEN wants AND k % 3 = 0 THEN 'article' ELSE 'item' END AS text_from, CASE WHEN wants AND k % 3 = 2 THEN 'not captured' WHEN wants AND k % 3 = 1 THEN CASE a WHEN 5 THEN 'ParseError' ELSE 'ValueError' END END AS note, NULL::VARCHAR AS error FROM i
UNION ALL SELECT DISTINCT o_custkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN o_custkey % 8 = 7 THEN 'KeyError' ELSE 'ParseError' END FROM orders WHERE o_custkey % 8 = 7 OR o_custkey % 40 = 0
"""


@query("source_adapters", SOURCE_ADAPTERS)
def source_adapters(spark: SparkSession, d: str) -> DataFrame:
    """Every source under the adapter its row names, its items' texts from pages where they can be taken
    out; an unknown name and a broken body are rows with their error."""
    found = adapters.texts(adapters.items(sources(spark, d)), captures(spark, d))
    kind = lambda c: F.substring_index(c, ":", 1).alias(c)
    return found.select(F.col("c").alias("o_custkey"), "package_id", "title", "link", "day", "doc_type", "collection", "text", "text_from", kind("note"), kind("error"))
