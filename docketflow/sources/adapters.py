"""Source adapters (L1, A13, A14): what each kind of source needs, dispatched by a column of the registry.

An adapter says how a captured body becomes items, what identifies an item for good, which class it has, whether its
text is on a page of its own, and how that page's text is taken out. `items` applies the adapter that each row names,
as a table function in a lateral join: one body, however broken, never stops the others. `texts` joins items with
captured pages; where there is none, or taking its text out fails, the item's own words are its text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta
from itertools import islice
from urllib.parse import parse_qs, unquote, urlsplit
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from docketflow.functions.hashing import package_id
from docketflow.sources.feeds import parse_feed, parse_vote
from docketflow.sources.listing import MOST_ITEMS, days_in, decoded, html_text, parse_listing

Given = dict[str, str]  # what the registry row says: its URLs, today's day, days to look back, a path hint
_TEXTS = [T.StructField(c, T.StringType()) for c in ("identity", "title", "link", "day", "doc_type", "collection", "own_text", "error")]
#: The columns of an item; those of its adapter alone are in `extra`, or beside them in a query on one adapter.
COMMON = [T.StructField("pos", T.IntegerType()), *_TEXTS[:6], T.StructField("wants_article", T.BooleanType()), *_TEXTS[6:]]
EXTRA = T.StructField("extra", T.MapType(T.StringType(), T.StringType()))


def page_text(page: str) -> str:
    """The words of a captured page; a page without any has failed."""
    if words := html_text(page):
        return words
    raise ValueError("no words on the page")


def vote_text(page: str) -> str:
    """A roll call in words: the question, its result, the tally and who voted how."""
    (vote,) = parse_vote(page)
    lines = [f"{vote['question']}: {vote['result']}. Yeas {vote['yeas']}, nays {vote['nays']}, present {vote['present']}, not voting {vote['not_voting']}."]
    lines += [f"{position}: {', '.join(names)}." for position, names in sorted(vote["positions"])]
    return " ".join([*lines, *([f"Note: {vote['note']}."] if vote["note"] else [])])


@dataclass(frozen=True)
class Adapter:
    """The hooks of one kind of source. `items` may raise, as its body is then an error row; `text` may too."""

    items: Callable[[str, Given], Iterable[dict]]
    collection: str = "PRESS"
    doc_type: str = "RELEASE"
    classes: dict[str, str] = field(default_factory=dict)  # by the publisher's categories, lower case
    dated_by_publisher: bool = True
    wants_article: bool = True
    identity: Callable[[dict], str | None] = lambda item: item.get("guid") or item.get("link")
    text: Callable[[str], str] = page_text
    own_text: Callable[[dict], str] = lambda item: html_text(item.get("description") or "") or item.get("title") or ""
    params: Callable[[Given], dict[str, str]] = lambda given: {}
    extra: dict[str, T.DataType] = field(default_factory=dict)  # columns beyond the common ones, for a query on this adapter alone

    def rows(self, body: str, given: Given) -> Iterator[dict]:
        """Items in order, each identity once, in the common columns."""
        seen = set()
        for item in self.items(body, given):
            identity = self.identity(item)
            if not identity or identity in seen:
                continue
            seen.add(identity)
            kinds = (self.classes.get(c.strip().lower()) for c in item.get("categories") or ())
            yield {
                "pos": len(seen) - 1, "identity": identity, "title": item.get("title"), "link": item.get("link"), "day": item.get("claimed_date") if self.dated_by_publisher else None,
                "doc_type": next((k for k in kinds if k), self.doc_type), "collection": self.collection, "wants_article": self.wants_article and bool(item.get("link")), "own_text": self.own_text(item),
                "extra": item.get("extra") or {},
            }


def since(given: Given) -> tuple[str, str]:
    """The first and last day of the window that a row looks back over; all days without one."""
    if not given.get("today"):
        return "", "9999"
    today = date.fromisoformat(given["today"])
    return (today - timedelta(days=int(given.get("days") or 7))).isoformat(), today.isoformat()


def listed(body: str, given: Given) -> Iterator[dict]:
    """A10: dated links of a listing page, within the window."""
    first, last = since(given)
    found = (x for x in parse_listing(body, given.get("index", ""), given.get("hint", "")) if x["day"] and first <= x["day"] <= last)
    return ({"title": x["title"], "link": x["link"], "claimed_date": x["day"]} for x in islice(found, MOST_ITEMS))


def through_interstitial(body: str, given: Given) -> Iterator[dict]:
    """Feed items whose links name their target in a parameter of an interstitial page."""
    for item in parse_feed(body):
        to = urlsplit(item["link"] or "")
        if target := parse_qs(to.query).get("nr"):
            item["link"] = f"{to.scheme}://{to.netloc}/{unquote(target[0]).lstrip('/')}"
        yield item


def voted(body: str, given: Given) -> Iterator[dict]:
    """Roll calls that a session's menu lists within the window; the year is the menu's, days are like 13-Jan."""
    root = ET.fromstring(body)
    said = {k: (root.findtext(k) or "").strip() for k in ("congress", "session", "congress_year")}
    first, last = since(given)
    base = given.get("api", "").rstrip("/")
    for vote in root.iter("vote"):
        get = lambda k, vote=vote: " ".join("".join(e.itertext()).split()) if (e := vote.find(k)) is not None else ""
        number = int(get("vote_number"))
        day, _, month = get("vote_date").partition("-")
        stated = next(days_in(f"{day} {MONTH.get(month[:3].lower(), '')} {said['congress_year']}"), (None,))[0]
        if stated and first <= stated <= last:
            name = f"{said['congress']}_{said['session']}_{number:05}"
            extra = {"number": str(number), "result": get("result")}
            yield {"guid": f"vote-{name}", "title": get("question"), "link": f"{base}/vote_{name}.xml", "claimed_date": stated, "description": f"{get('question')}: {get('result')}", "extra": extra}


def acted(body: str, given: Given) -> Iterator[dict]:
    """The latest actions on bills within the window; a bill acted on twice is two items."""
    first, last = since(given)
    for bill in json.loads(body).get("bills") or ():
        action = bill.get("latestAction") or {}
        day = action.get("actionDate") or ""
        if first <= day <= last and day:
            name = "-".join(str(x) for x in (bill["congress"], str(bill["type"]).lower(), bill["number"]))
            yield {"guid": f"{name}:{day}", "title": bill.get("title"), "link": bill.get("url"), "claimed_date": day, "description": action.get("text"), "extra": {"bill": name}}


#: Months as roll-call menus write them.
MONTH = {m[:3].lower(): m for m in "January February March April May June July August September October November December".split()}
#: The publisher's categories of presidential documents.
PRESIDENTIAL = {"executive orders": "EXECUTIVE_ORDER", "proclamations": "PROCLAMATION", "presidential memoranda": "MEMORANDUM", "nominations & appointments": "NOMINATION"}

#: Adapters by the name that a registry row gives.
ADAPTERS = {
    "feed": Adapter(lambda body, given: parse_feed(body)),
    "feed-only": Adapter(lambda body, given: parse_feed(body), wants_article=False),
    "interstitial": Adapter(through_interstitial, identity=lambda item: item.get("link")),
    "presidential": Adapter(lambda body, given: parse_feed(body), collection="PRESIDENTIAL", doc_type="STATEMENT", classes=PRESIDENTIAL),
    "html-index": Adapter(listed),
    "votes": Adapter(voted, collection="VOTES", doc_type="ROLL_CALL", text=vote_text, extra={"number": T.IntegerType(), "result": T.StringType()}),
    "bill-actions": Adapter(acted, collection="BILL_ACTIONS", doc_type="ACTION", wants_article=False, params=lambda given: {"format": "json", "sort": "updateDate+desc", "fromDate": since(given)[0]}, extra={"bill": T.StringType()}),
}


def adapter_for(name: str | None) -> Adapter:
    """The adapter of a name; an unknown one raises."""
    if name not in ADAPTERS:
        raise KeyError(f"no adapter is called {name!r}; there are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name]


@F.udtf
class SourceItems:
    """Items of one captured body under the adapter it names. With a constant name the adapter is settled when the query
    is analysed: an unknown one raises there, and the schema has the adapter's own columns; else it is a row's error."""

    @staticmethod
    def analyze(adapter: AnalyzeArgument, body: AnalyzeArgument, given: AnalyzeArgument) -> AnalyzeResult:
        if not adapter.isConstantExpression:
            return AnalyzeResult(schema=T.StructType([*COMMON, EXTRA]))
        return AnalyzeResult(schema=T.StructType([*COMMON, *(T.StructField(k, v) for k, v in adapter_for(adapter.value).extra.items())]))

    def __init__(self, analyzed: AnalyzeResult):
        self.kinds = {f.name: f.dataType for f in analyzed.schema.fields}

    def eval(self, adapter, body, given):  # noqa: ANN001
        if body is None:
            return
        text = decoded(bytes(body)) if isinstance(body, (bytes, bytearray)) else body
        try:
            found = list(adapter_for(adapter).rows(text, dict(given or {})))
        except Exception as e:  # the row of a body that can't be read, not a stop
            found = [{"error": f"{type(e).__name__}: {e}"[:300]}]
        for item in found:
            own = item.get("extra") or {}
            yield tuple(item[n] if n in item else self._own(n, own) for n in self.kinds)

    def _own(self, name: str, own: dict[str, str]):  # noqa: ANN202
        value = own.get(name)
        return value if value is None or isinstance(self.kinds[name], T.StringType) else int(value)


def items(sources: DataFrame, adapter: Column | str = "adapter", body: str = "body", given: str = "given", source: str = "source_id") -> DataFrame:
    """L1: the items of all captured bodies, each under the adapter its row names, with the columns of `sources` (body and
    given left out) and the item's id, which never changes with its page."""
    name = F.col(adapter).outer() if isinstance(adapter, str) else adapter
    found = sources.lateralJoin(SourceItems(name, F.col(body).outer(), F.col(given).outer()))
    return found.drop(body, given).withColumn("package_id", F.when(F.col("identity").isNotNull(), package_id(source, "identity")))


def requests(sources: DataFrame, adapter: str = "adapter", given: str = "given") -> DataFrame:
    """L1: what each source is asked with, beside its address."""

    @F.pandas_udf("map<string, string>")
    def asked(names: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series([ADAPTERS[n].params(dict(g or {})) if n in ADAPTERS else None for n, g in zip(names, rows, strict=True)])

    return sources.withColumn("params", asked(adapter, given))


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]))
def article_text(adapter: pd.Series, page: pd.Series) -> pd.DataFrame:
    """The text of a captured page as its adapter takes it out; the error where that fails."""
    out = []
    for name, body in zip(adapter, page, strict=True):
        try:
            out.append((None, None) if body is None else (adapter_for(name).text(decoded(bytes(body)) if isinstance(body, (bytes, bytearray)) else body), None))
        except Exception as e:  # falls back to the item's own words
            out.append((None, f"{type(e).__name__}: {e}"[:300]))
    return pd.DataFrame(out, columns=["text", "error"])


def texts(found: DataFrame, captures: DataFrame, adapter: str = "adapter") -> DataFrame:
    """L1: items with their text, where it is from (`article` or `item`), and why an article wasn't used.

    captures: url, page; one row a URL. Items that want no article are not joined."""
    wants = found.filter("wants_article")
    joined = wants.join(captures.select(F.col("url").alias("link"), "page"), "link", "left")
    got = joined.withColumn("_article", article_text(adapter, "page"))
    rest = found.filter("wants_article IS NOT TRUE").withColumn("_article", F.lit(None).cast("struct<text: string, error: string>")).withColumn("page", F.lit(None).cast("string"))
    out = got.unionByName(rest, allowMissingColumns=True)
    article = F.col("_article.text")
    why = F.when(F.col("wants_article") & F.col("page").isNull(), "not captured").otherwise(F.col("_article.error"))
    return out.withColumns({"text": F.coalesce(article, "own_text"), "text_from": F.when(article.isNotNull(), "article").when(F.col("own_text").isNotNull(), "item"), "note": why}).drop("_article", "page")
