"""What readers see (B15-B17, E28, E30, J3, J17, J18, J21, J23, J25, J26, J32, J33): tags, titles, listings, series, documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.functions import text

#: The branch of a section.
BRANCH = {"senate": "legislative", "house": "legislative", "legislation": "legislative", "laws": "legislative", "rules": "executive", "proposed": "executive", "presidential": "executive", "judicial": "judicial", "agency": "executive", "votes": "legislative", "billactions": "legislative"}
OFFICIAL_CHARS = 1200


def lookup(table: dict[str, str], key: Column, default: str | None = None) -> Column:
    """A small fixed map as an expression."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def mechanical_tags(section: Column, doc_type: Column, agency: Column, source: Column) -> Column:
    """Branch, type in plain words, agency or source stem; nulls left out, order kept, each once."""
    parts = F.array(lookup(BRANCH, section, "cross-branch"), F.lower(F.replace(doc_type, F.lit("_"), F.lit(" "))), F.coalesce(F.lower(F.trim(agency)), F.split_part(source, F.lit("-"), F.lit(1))))
    return F.array_distinct(F.filter(parts, lambda x: x.isNotNull() & (x != "")))


def facets(rows: DataFrame, tags: str) -> DataFrame:
    """Counts of every tag in display order."""
    c = rows.select(F.explode(F.array_distinct(tags)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return c.orderBy(F.desc("n"), "tag")


def pivot_tags(tags: DataFrame, version: int) -> DataFrame:
    """Sorted tags of every section by method; rows without a version or of the current one."""
    now = tags.filter(F.col("version").isNull() | (F.col("version") == version))
    pick = lambda m: F.array_sort(F.collect_set(F.when(F.col("method") == m, F.col("tag"))))
    return now.groupBy("section").agg(pick("mechanical").alias("mechanical"), pick("llm").alias("llm"))


def title(granule_title: Column, body: Column, item: Column, most: int = 200) -> Column:
    """The granule's title, else the first line of the text, else the id; re-cased and truncated."""
    found = F.coalesce(F.nullif(text.one_line(granule_title), F.lit("")), text.one_line(text.first_line(body)), item)
    return text.truncate(text.display_title(found), most)


def official_first(metadata: Column, body: Column) -> tuple[Column, Column]:
    """The publisher's own summary, clipped, and the method; null and `llm` where it has none."""
    own = F.nullif(F.trim(F.get_json_object(metadata, "$.summary")), F.lit(""))
    return text.sentence_clip(own, OFFICIAL_CHARS, " […]"), F.when(own.isNotNull(), "official").otherwise("llm")


def arrivals(items: DataFrame, granules: DataFrame, summaries: DataFrame, keys: list[str], version: int) -> DataFrame:
    """The live listing, newest first; granule titles and summaries of the current version where there are any."""
    s = summaries.filter(F.col("version") == version).select(*keys, "summary")
    g = granules.select(*keys, F.col("title").alias("granule_title"))
    j = items.join(g, keys, "left").join(s, keys, "left")
    return j.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.nullif("granule_title", F.lit("")), F.col(keys[0]).cast("string"))).drop("granule_title").orderBy(F.desc("observed_at"), *keys)


def known_gaps(packages: DataFrame, texts: DataFrame, graphics: DataFrame, day: Column) -> DataFrame:
    """What a day still lacks, one row a kind, zeros included."""
    p = packages.filter(F.col("digest_day") == day)
    unfetched = p.filter(~F.col("fetch_status").isin("fetched", "skipped")).agg(F.count("*").alias("n")).withColumn("gap", F.lit("unfetched"))
    unextracted = p.filter("fetch_status = 'fetched'").join(texts.select("package_id"), "package_id", "left_anti").agg(F.count("*").alias("n")).withColumn("gap", F.lit("unextracted"))
    broken = graphics.join(p.select("package_id"), "package_id", "left_semi").filter("status = 'failed'").agg(F.count("*").alias("n")).withColumn("gap", F.lit("failed graphics"))
    return unfetched.unionByName(unextracted).unionByName(broken).select("gap", "n")


def floored_series(facts: DataFrame, day: str, first: Column, last: Column, floor: Column) -> DataFrame:
    """A dense day series from the later of the window's start and the floor: earlier days are absent,
    days without requests count 0, days without timing have no mean."""
    spark = facts.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.greatest(first, floor), last)).alias(day))
    g = facts.groupBy(day).agg(F.count("*").alias("requests"), F.bround(F.avg("elapsed_ms"), 0).cast("long").alias("mean_ms"))
    return days.join(g, day, "left").select(day, F.coalesce("requests", F.lit(0)).alias("requests"), "mean_ms")


def digest_lines(items: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Ordered lines of a digest (section, place, line) from items with section, title, summary, plain, rule and link:
    one heading a section, one block an item with its reason."""
    at = F.create_map(*[F.lit(x) for k, s in enumerate(sections) for x in (s, k)])
    place = F.row_number().over(W.partitionBy("section").orderBy("title", "link"))
    block = F.concat_ws("\n", F.concat(F.lit("### "), text.one_line("title")), F.when(F.col("summary").isNotNull(), F.col("summary")), F.when(F.col("plain").isNotNull(), F.concat(F.lit("> "), "plain")), F.concat(F.lit("Included: "), "rule"), F.concat(F.lit("Source: "), "link"))
    body = items.filter(F.col("section").isin(*sections)).select(F.element_at(at, F.col("section")).alias("n"), "section", place.alias("place"), block.alias("line"))
    heads = body.select("n", "section").distinct().select("n", "section", F.lit(0).alias("place"), F.concat(F.lit("## "), F.initcap("section")).alias("line"))
    return body.unionByName(heads).orderBy("n", "place")


def atom_entries(digests: DataFrame, most: int = 20) -> DataFrame:
    """The newest digests as Atom entries."""
    d = digests.orderBy(F.desc("day")).limit(most)
    entry = F.concat(F.lit("<entry><id>"), text.xml_escape("link"), F.lit("</id><title>"), text.xml_escape("title"), F.lit("</title><updated>"), F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00Z</updated><link href=\""), text.xml_escape("link"), F.lit("\"/><summary>"), text.xml_escape("teaser"), F.lit("</summary></entry>"))
    return d.select("day", entry.alias("entry"))


def methods(summaries: DataFrame, day: Column) -> DataFrame:
    """Stored summaries of a day by method."""
    return summaries.filter(F.col("digest_day") == day).groupBy("method").agg(F.count("*").alias("n"))


def _json(*fields: Column | str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def day_json(items: DataFrame, frozen: Column) -> DataFrame:
    """The machine form of a live or frozen day: line 0 has the day's counts and tag facets, then a line an item.

    items: day, id, title, section, is_backfill, tags. A line is a JSON object, so a day of any size is written by
    many tasks (`write.text`); `place` and `id` order the lines. Backfill items stay in and are flagged.
    """
    head = items.groupBy("day").agg(F.count_if(~F.col("is_backfill")).alias("items"), F.count_if("is_backfill").alias("backfill_count"))
    tags = items.filter(~F.col("is_backfill")).select("day", F.explode(F.array_distinct("tags")).alias("tag")).groupBy("day", "tag").agg(F.count("*").alias("n"))
    facets_ = tags.groupBy("day").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "tag", "n"))), lambda x: F.struct(x["tag"].alias("tag"), x["n"].alias("n"))).alias("facets"))
    head = head.join(facets_, "day", "left").select("day", F.lit(0).alias("place"), F.lit("").alias("id"), _json("day", F.when(frozen, "frozen").otherwise("live").alias("state"), "items", "backfill_count", F.coalesce("facets", F.array().cast(facets_.schema["facets"].dataType)).alias("facets")).alias("line"))
    body = items.select("day", F.lit(1).alias("place"), F.col("id").cast("string").alias("id"), _json("id", "title", "section", "is_backfill", "tags").alias("line"))
    return head.unionByName(body)


def directory_json(registry: DataFrame, records: DataFrame) -> DataFrame:
    """The sources' directory, a line a source: what the registry says (addresses taken out of prose) and its health record."""
    figures = [c for c in records.columns if c not in ("id", "name", "host")]
    return registry.join(records.select("id", F.struct(*figures).alias("health")), "id", "left").select("id", _json("id", "name", "status", text.redact("notes").alias("notes"), F.concat(F.lit("sources/"), F.col("id").cast("string"), F.lit(".html")).alias("page"), "health").alias("line"))


def index_json(digests: DataFrame) -> DataFrame:
    """The index of digests, newest first, a line each: day, title, teaser and where it is."""
    return digests.select("day", _json(F.date_format("day", "yyyy-MM-dd").alias("date"), "title", "teaser", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit(".html")).alias("page")).alias("line")).orderBy(F.desc("day"))
