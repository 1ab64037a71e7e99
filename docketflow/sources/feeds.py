"""Feeds and item APIs."""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.functions.times import instant
from docketflow.functions.urls import part, resolved
from docketflow.sources.base import parsed

ITEM = "format string, title string, link string, guid string, claimed_date string, description string, categories array<string>"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(e: ET.Element | None) -> str | None:
    return " ".join("".join(e.itertext()).split()) if e is not None else None


def parse_feed(body: bytes | str) -> Iterator[dict]:
    """Items of RSS 2.0, RDF or Atom, in document order."""
    root = ET.fromstring(body)
    kind = {"rss": "rss", "RDF": "rdf", "feed": "atom"}.get(_local(root.tag))
    if kind is None:
        raise ValueError("not a feed")
    for item in root.iter():
        if _local(item.tag) != ("entry" if kind == "atom" else "item"):
            continue
        by: dict[str, list[ET.Element]] = {}
        for c in item:
            by.setdefault(_local(c.tag), []).append(c)
        one = lambda *names: next((_text(by[n][0]) for n in names if n in by), None)  # noqa: E731, B023
        if kind == "atom":
            links = by.get("link", [])
            link = next((x.get("href") for x in links if x.get("rel", "alternate") == "alternate"), links[0].get("href") if links else None)
            tags = [c.get("term") or _text(c) for c in by.get("category", [])]
        else:
            link, tags = one("link"), [_text(c) for c in by.get("category", [])]
        yield {
            "format": kind, "title": one("title"), "link": link, "guid": one("guid", "id") or item.get("{http://www.w3.org/1999/02/22-rdf-syntax-ns#}about"),
            "claimed_date": one("pubDate", "published", "date", "updated"), "description": one("description", "summary", "content"), "categories": [t for t in tags if t],
        }


def feed_items(rows: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """The items of every feed body; unparsable bodies are error rows."""
    return parsed(rows, body, keep, ITEM, parse_feed)


def feed_quality(items: DataFrame, key: str) -> DataFrame:
    """Items, how many have an identity and a date, and the whole mean of description lengths."""
    n = F.count("*")
    return items.groupBy(key).agg(n.alias("items"), F.count("guid").alias("with_guid"), F.count("claimed_date").alias("with_date"), F.expr("sum(length(coalesce(description, ''))) div count(*)").alias("mean_chars"))


def verdict(status: Column, items: Column, dated: Column, parsed_ok: Column) -> Column:
    """What one sample of a source shows, first match wins."""
    return F.when(status.isNull(), "unreachable").when(status.isin(401, 403), "blocked").when(status >= 400, "missing").when(~parsed_ok, "not-a-feed").when(items == 0, "empty").when(dated < items, "undated-items").otherwise("usable")


def paged(rows: DataFrame, since: Column) -> DataFrame:
    """A1: packages of captured listing pages (JSON `packages` arrays) at or after the watermark, each once."""
    schema = "struct<packages: array<struct<packageId: string, lastModified: string, dateIssued: string, title: string>>, nextPage: string>"
    p = rows.select(F.explode(F.from_json("body", schema)["packages"]).alias("p")).select("p.*")
    p = p.withColumn("lastModified", F.try_to_timestamp("lastModified"))
    return p.filter(F.col("lastModified") >= since).groupBy("packageId").agg(F.max_by(F.struct("lastModified", "dateIssued", "title"), "lastModified").alias("x")).select("packageId", "x.*")


def advanced(pages: DataFrame, state: DataFrame, source: str = "source_id") -> DataFrame:
    """Each source's watermark after a listing: the latest instant on its pages, if the whole listing was read,
    else what it was (null before the first whole one). Times are the listings' own, in any dialect.

    pages: source, page (from 1), body (JSON with `packages` and `nextPage`). A listing is whole if its pages number from
    1 without a gap and the last one, and no other, names no next page; a body that can't be read is a gap.
    """
    schema = "struct<packages: array<struct<packageId: string, lastModified: string>>, nextPage: string>"
    p = pages.withColumn("_x", F.from_json("body", schema))
    p = p.select(F.col(source).alias("source"), "page", F.col("_x.packages").isNotNull().alias("read"), F.col("_x.nextPage").isNull().alias("last"), F.array_max(F.transform(F.coalesce("_x.packages", F.array().cast("array<struct<packageId: string, lastModified: string>>")), lambda x: instant(x["lastModified"]))).alias("at"))
    p = p.groupBy("source", "page").agg(F.max("read").alias("read"), F.bool_and("last").alias("last"), F.max("at").alias("at"))  # a page read twice is one
    ends = F.count_if("last") == 1
    g = p.groupBy("source").agg(F.max("at").alias("_at"), ((F.count_if("read") == F.max("page")) & (F.min("page") == 1) & (F.count("*") == F.max("page")) & ends & F.max_by("last", "page")).alias("whole"))
    s, g = state.select(F.col(source).alias("source"), "watermark").alias("s"), g.alias("g")
    both = s.join(g, F.col("s.source") == F.col("g.source"), "full")
    whole = F.coalesce(F.col("whole"), F.lit(False))
    return both.select(F.coalesce("s.source", "g.source").alias(source), whole.alias("whole"), F.when(whole, F.greatest("watermark", "_at")).otherwise(F.col("watermark")).alias("watermark"))


#: Media types of feeds, and where sites commonly have them, in the order they are tried.
FEED_TYPES = ("application/rss+xml", "application/atom+xml", "application/rdf+xml", "text/xml", "application/xml")
COMMON_PLACES = ("/feed", "/rss", "/rss.xml", "/feed.xml", "/atom.xml", "/news/feed", "/news/rss.xml", "/index.xml")


def parse_alternates(page: str) -> Iterator[dict]:
    """Alternate feed links of a page's head, in order."""
    found: list[dict] = []

    class Links(HTMLParser):
        def handle_starttag(self, tag: str, attrs: list) -> None:
            said = {k: (v or "").strip() for k, v in attrs}
            if tag == "link" and "alternate" in said.get("rel", "").lower().split() and said.get("type", "").lower().split(";")[0].strip() in FEED_TYPES and said.get("href"):
                found.append({"href": said["href"], "title": said.get("title") or None})

    links = Links(convert_charrefs=True)
    links.feed(page)
    links.close()
    yield from found


def candidates(homes: DataFrame, page: str = "page", url: str = "url", source: str = "source_id") -> DataFrame:
    """Where a source may have its feed: (source, rank, link), what its own page names before common places, each once."""
    named = parsed(homes.select(source, url, page), page, [source, url], "href string, title string", parse_alternates).filter("error IS NULL AND href IS NOT NULL")
    named = named.select(source, F.col("pos").alias("rank"), resolved(F.col(url), F.col("href")).alias("link"))
    root = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    common = homes.filter(root != "").select(source, F.posexplode(F.array(*map(F.lit, COMMON_PLACES))).alias("k", "place"), root.alias("root")).select(source, (F.col("k") + 1_000_000).alias("rank"), F.concat("root", "place").alias("link"))
    return named.unionByName(common).groupBy(source, "link").agg(F.min("rank").alias("rank")).select(source, "rank", "link")


def discovered(homes: DataFrame, samples: DataFrame, page: str = "page", url: str = "url", source: str = "source_id") -> DataFrame:
    """The verdict on each source and the feed chosen for it: the first candidate whose sample is usable, else the
    first one that a sample says anything about.

    samples: url, status, body, one captured answer a URL. A source none of whose candidates was captured is unreachable.
    """
    found = candidates(homes, page, url, source)
    tried = found.join(samples.select(F.col("url").alias("link"), "status", "body"), "link")
    items = feed_items(tried.select(source, "rank", "body"), "body", [source, "rank"])
    seen = items.groupBy(source, "rank").agg(F.count("format").alias("items"), F.count("claimed_date").alias("dated"), F.bool_and(F.col("error").isNull()).alias("parsed_ok"))
    empty = tried.select(source, "rank", "link", "status").join(seen, [source, "rank"], "left")
    # a feed without items gives no rows: it was parsed if it is there
    told = empty.withColumn("verdict", verdict(F.col("status"), F.coalesce("items", F.lit(0)), F.coalesce("dated", F.lit(0)), F.coalesce("parsed_ok", F.lit(True))))
    best = told.groupBy(source).agg(F.min_by(F.struct("verdict", "link"), F.struct(F.col("verdict") != "usable", "rank")).alias("x"))
    return homes.select(source).distinct().join(best, source, "left").select(source, F.coalesce("x.verdict", F.lit("unreachable")).alias("verdict"), F.when(F.col("x.verdict") == "usable", F.col("x.link")).alias("feed"))


def bill_actions(rows: DataFrame, body: str, today: Column, days: int = 7) -> DataFrame:
    """One row a bill action of the last days; identity is bill and action date, the newest first."""
    schema = "struct<bills: array<struct<congress: int, type: string, number: string, title: string, latestAction: struct<actionDate: string, text: string>>>>"
    b = rows.select(F.explode(F.from_json(body, schema)["bills"]).alias("b")).select("b.*")
    bill = F.concat_ws("-", F.col("congress").cast("string"), F.lower("type"), "number")
    day = F.to_date(F.try_to_timestamp(F.col("latestAction.actionDate"), F.lit("yyyy-MM-dd")))
    b = b.select(F.concat_ws(":", bill, F.col("latestAction.actionDate")).alias("guid"), day.alias("day"), "title", F.col("latestAction.text").alias("action"))
    return b.filter(F.col("day").isNotNull() & (F.col("day") >= F.date_sub(today, days))).dropDuplicates(["guid"]).orderBy(F.desc("day"), "guid")


VOTE = "number int, day string, question string, result string, yeas int, nays int, present int, not_voting int, positions map<string, array<string>>, note string"


def parse_vote(body: bytes | str) -> Iterator[dict]:
    """One roll-call vote: its tally, members by position, and a note where tally and roster disagree."""
    root = ET.fromstring(body)
    get = lambda p: _text(root.find(p)) or None
    count = {k: int(get(f"count/{k}") or 0) for k in ("yeas", "nays", "present", "absent")}
    positions: dict[str, list[str]] = {}
    for m in root.iter("member"):
        positions.setdefault(_text(m.find("vote_cast")) or "?", []).append(_text(m.find("member_full")) or "?")
    positions = {k: sorted(v, key=str.casefold) for k, v in positions.items()}
    roster = {"yeas": len(positions.get("Yea", [])), "nays": len(positions.get("Nay", []))}
    off = [f"{k}: published {count[k]}, roster {roster[k]}" for k in roster if positions and roster[k] != count[k]]
    yield {"number": int(get("vote_number") or 0), "day": get("vote_date"), "question": get("question"), "result": get("vote_result"), "yeas": count["yeas"], "nays": count["nays"], "present": count["present"], "not_voting": count["absent"], "positions": list(positions.items()), "note": "; ".join(off) or None}


def votes(rows: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return parsed(rows, body, keep, VOTE, parse_vote)


def item_class(categories: Column, classes: dict[str, str], default: str) -> Column:
    """The class that the publisher's own categories name, else the default."""
    table = F.create_map(*[F.lit(x) for k, v in classes.items() for x in (k.lower(), v)])
    found = F.filter(F.transform(categories, lambda c: F.try_element_at(table, F.lower(F.trim(c)))), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(1)), F.lit(default))


#: Reader functions by the adapter name of a registry row.
READERS = {"feed": feed_items, "votes": votes}


def reader_for(name: str):
    """The reader of an adapter name; an unknown one raises."""
    if name not in READERS:
        raise KeyError(f"no reader is called {name!r}; there are {sorted(READERS)}")
    return READERS[name]


def same_host(url: str, base: str) -> Column:
    return F.lower(part(url, "HOST")) == F.lower(part(base, "HOST"))


def dumps(x: object) -> str:
    """JSON with sorted keys."""
    return json.dumps(x, sort_keys=True, ensure_ascii=False)
