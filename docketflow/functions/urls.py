"""URL columns."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def part(url: Column | str, what: str, key: str | None = None) -> Column:
    """A part of a URL; null where it can't be parsed."""
    return F.try_parse_url(_c(url), F.lit(what), *([F.lit(key)] if key else []))


def canonical(url: Column | str) -> Column:
    """One document's identity across channels. Scheme, leading www., fragment, utm_* parameters
    and trailing slashes go; other parameters stay in order; null for anything but HTTP."""
    u = F.trim(_c(url))
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_")), "&")
    return F.when(u.rlike(r"(?i)^https?://") & (host != ""), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def without_query(url: Column | str) -> Column:
    """Identity of mail items: no query, no fragment."""
    return F.regexp_replace(_c(url), r"[?#].*$", "")


def without_fragment(url: Column | str) -> Column:
    """Identity of listing items: the query stays."""
    return F.regexp_replace(_c(url), r"#.*$", "")


def interstitial(url: Column | str, key: str = "nr") -> Column:
    """The target that an interstitial page names in a parameter, on the page's host."""
    target = part(url, "QUERY", key)
    return F.when(target.isNotNull(), F.concat(part(url, "PROTOCOL"), F.lit("://"), part(url, "AUTHORITY"), F.lit("/"), F.regexp_replace(F.try_url_decode(target), "^/+", ""))).otherwise(_c(url))


def tracked(url: Column | str) -> Column:
    """The percent-encoded URL inside a tracking link, else the link."""
    inner = F.regexp_extract(_c(url), r"(https?%3A%2F%2F[^/&?#]+(?:%2F[^/&?#]*)*)", 1)
    return F.when(inner != "", F.try_url_decode(inner)).otherwise(_c(url))


def publisher(url: Column | str) -> Column:
    """Hosts under .gov or .mil."""
    return F.coalesce(F.lower(part(url, "HOST")).rlike(r"\.(?:gov|mil)$"), F.lit(False))


def group_host(urls: Column, *keys: str) -> Column:
    """The host (with its port) that a registry row is fetched from: the first of `keys` it has."""
    return part(F.coalesce(*[urls[k] for k in keys or ("feed", "index", "api", "home")]), "AUTHORITY")


@F.pandas_udf(StringType())
def resolved(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against its page. A pandas UDF: dot segments have no JVM function."""
    return pd.Series([urljoin(b or "", x) if x is not None else None for b, x in zip(base, link, strict=True)])


def article_anchor(link: Column | str, title: Column | str, base: Column | str, hint: str = "", least: int = 12) -> Column:
    """An anchor that may be an item: HTTP, the listing's own host, a long enough title, a path hint."""
    same = F.regexp_replace(F.lower(part(link, "HOST")), r"^www\.", "") == F.regexp_replace(F.lower(part(base, "HOST")), r"^www\.", "")
    ok = F.lower(part(link, "PROTOCOL")).isin("http", "https") & same & (F.length(F.trim(_c(title))) >= least)
    return F.coalesce(ok & F.contains(F.coalesce(part(link, "PATH"), F.lit("")), F.lit(hint)), F.lit(False))
