"""Listings, adapters, mail and digests against cases of their own."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docketflow.operators import digest
from docketflow.sources import adapters, listing, mail

BASE = "https://agency.gov/news"


def links(page, **k):
    return [(x["title"], x["day"]) for x in listing.parse_listing(page, BASE, **k)]


# --- listings ---


def test_items_at_any_depth():
    for depth in (10, 198, 200, 500, 20_000):
        inner = "<p>May 3, 2026</p><a href='/n/deep'>A release far down</a>"
        page = f"<div><a href='/n/top'>A release at the top</a></div>{'<div>' * depth}{inner}{'</div>' * depth}<div><b>2 May 2026</b> <a href='/n/after'>A release after it</a></div>"
        # the page itself is the first one's entry, as it holds few links
        assert links(page) == [("A release at the top", "2026-05-03"), ("A release far down", "2026-05-03"), ("A release after it", "2026-05-02")]


def test_references_cut_off_before_their_semicolon(spark):
    page = "<title>It&amp;&amp</title><p>&copy; a &lt;b &amp;lt; &#169; &#xA9; &notit; &c &</p>"
    assert listing.html_text(page) == "It&& © a <b &lt; © © ¬it; &c &"  # as browsers read it
    (got,) = listing.page_texts(spark.createDataFrame([(1, page)], "k int, html string"), "html", ["k"], closed=True).collect()
    assert got.text == "It&&amp © a <b &lt; © © &notit; &c &"


def test_plain_messages_are_read_as_the_general_parser_reads_them(monkeypatch):
    body = b"<p><a href='https://x.gov/1'>The first long release</a> one <a href='https://x.gov/2'>The second long release</a> two</p>"
    html = b"MIME-Version: 1.0\r\nContent-Type: text/html; charset=utf-8\r\n"
    plain = [b"X-Trace: " + b"ab\r\n " * 900 + b"end\r\nFrom: Agency\r\n <Agency@X.gov>\r\nSubject: Weekly\r\n  news\r\n", b"From: a@x.gov\nMessage-ID: <1@x.gov>\nDate: Mon, 2 Jan 2024 10:00 GMT\n"]
    other = [b'From: "A, B" <a@x.gov>\r\n', b"From: =?utf-8?q?A=C3=A9?= <a@x.gov>\r\nSubject: =?utf-8?b?w6k=?=\r\n", b"From: a@x.gov\r\nDate: nonsense\r\n", b"From: a@x.gov\r\nContent-Disposition: attachment\r\n", b"no field\r\nFrom: a@x.gov\r\n"]
    raws = [head + html + b"\r\n" + body for head in plain + other]
    general, calls = mail.message_from_bytes, []
    monkeypatch.setattr(mail, "message_from_bytes", lambda raw, **k: calls.append(k) or general(raw, **k))
    got = [list(mail.parse_bulletin(raw)) for raw in raws]
    assert sum("policy" in k for k in calls) == len(other)  # the rest didn't need it
    monkeypatch.setattr(mail, "_plain", lambda msg: None)
    assert got == [list(mail.parse_bulletin(raw)) for raw in raws]


def test_entries_without_end_tags():
    page = "<ul><li><a href=/n/1>The first release</a> 5/1/26<li><a href=/n/2>The second release</a> 5/2/26<li><a href=/n/3>The third release</a></ul><table><tr><td>2026-05-04<td><a href=/n/4>The fourth release</a><tr><td>2026-05-05<td><a href=/n/5>The fifth release</a></table>"
    assert links(page) == [("The first release", "2026-05-01"), ("The second release", "2026-05-02"), ("The third release", "2026-05-02"), ("The fourth release", "2026-05-04"), ("The fifth release", "2026-05-05")]


def test_shapes_of_listing_pages():
    dated_groups = "".join(f"<h3>June {k}, 2026</h3>" + "".join(f"<p><a href='/r/{k}{j}'>Order {k} part {j} of it</a></p>" for j in range(2)) for k in (1, 2))
    # of a flat block with two days the nearest one counts, until it holds too many links and is the list itself
    assert links(f"<div>{dated_groups}</div>") == [(f"Order {k} part {j} of it", f"2026-06-0{k}") for k in (1, 2) for j in (0, 1)]
    assert links(f"<div>{dated_groups}<p><a href='/r/30'>Order 3 part 0 of it</a></p></div>") == [(f"Order {k} part {j} of it", None) for k, j in ((1, 0), (1, 1), (2, 0), (2, 1), (3, 0))]
    many = "".join(f"<article><time datetime='2026-06-{k:02}T09:00:00Z'>{k} days ago</time><h2><a href='/r/{k}'>Statement number {k}</a></h2><a href='/r/{k}#c'>Statement number {k}</a></article>" for k in range(1, 10))
    assert links(many) == [(f"Statement number {k}", f"2026-06-{k:02}") for k in range(1, 10) for _ in range(2)]
    menu = "<nav>" + "<a href='/about/us'>About the agency</a>" * 3 + "</nav>"
    assert links(menu + "<p><a href='/about/us?x=1'>About the agency</a> 2026-01-02</p>") == [("About the agency", "2026-01-02")]
    assert links("<head><title>x</title><body><p>2026-01-02 <a href='/n/1'>A body without head's end</a></p>") == [("A body without head's end", "2026-01-02")]
    assert links("<p>2026-02-30 2026-13-01 31 February 2026 <a href='/n/1'>No such days here</a></p>") == [("No such days here", None)]
    assert links("<svg><a href='/n/1'>A drawing of words</a></svg><p><a href='mailto:a@b'>Write to the office</a><a href='javascript:x()'>Run this one now</a><a href=''>Nothing to go to</a></p>") == []
    assert links("<p>1/2/68 <a href='/n/1'>Of the last years</a></p><p>1/2/69 <a href='/n/2'>Of the first ones</a></p>") == [("Of the last years", "2068-01-02"), ("Of the first ones", "1969-01-02")]


@pytest.mark.parametrize("bad", ["<li>", "<div>", "</div>", "<a href=/n/1>x y", "<time datetime=2026-01-01>", "1/1/26 ", "<td>", "<b></i>"])
def test_bad_listings_take_linear_time(bad):
    import time

    began = time.process_time()
    list(listing.parse_listing(bad * 40_000 + "<a href='/n/1'>A release at the end</a>", BASE))
    assert time.process_time() - began < 8


# --- adapters ---

FEED = "<rss><channel><item><title>One</title><link>https://a.gov/1</link><guid>g1</guid><description>Own words</description></item><item><title>Two</title><link>https://a.gov/2</link><guid>g1</guid></item><item><title>None</title></item></channel></rss>"
MENU = "<vote_summary><congress>119</congress><session>2</session><congress_year>2026</congress_year><votes><vote><vote_number>00012</vote_number><vote_date>13-Jan</vote_date><question>On <b>the</b> bill</question><result>Agreed</result></vote><vote><vote_number>3</vote_number><vote_date>02-Jan</vote_date><question>Old</question><result>x</result></vote></votes></vote_summary>"
SHAPE = "source_id string, adapter string, body string, given map<string, string>"


def test_each_row_follows_its_adapter(spark):
    window = {"today": "2026-01-14", "days": "7", "api": "https://v.gov/"}
    rows = [("f", "feed", FEED, {}), ("o", "feed-only", FEED, None), ("v", "votes", MENU, window), ("x", "fax", FEED, {}), ("n", None, FEED, {}), ("b", "feed", "<rss", {}), ("e", "feed", None, {})]
    found = adapters.items(spark.createDataFrame(rows, SHAPE))
    got = {}
    for r in found.collect():
        got.setdefault(r.source_id, []).append(r)
    assert "e" not in got and [r.error[:8] for s in ("x", "n", "b") for r in got[s]] == ["KeyError", "KeyError", "ParseErr"]
    assert [(r.identity, r.wants_article, r.own_text) for r in got["f"]] == [("g1", True, "Own words")] and not got["o"][0].wants_article
    assert [(r.link, r.day, r.doc_type, dict(r.extra)) for r in got["v"]] == [("https://v.gov/vote_119_2_00012.xml", "2026-01-13", "ROLL_CALL", {"number": "12", "result": "Agreed"})]
    assert got["f"][0].package_id == got["o"][0].package_id.replace("-o-", "-f-") and got["x"][0].package_id is None

    pages = [("https://a.gov/1", "<p>The article</p>"), ("https://v.gov/vote_119_2_00012.xml", "<v><broken")]
    text = {r.source_id: r for r in adapters.texts(found, spark.createDataFrame(pages, "url string, page string")).collect()}
    assert (text["f"].text, text["f"].text_from, text["f"].note) == ("The article", "article", None)
    assert (text["o"].text, text["o"].text_from, text["o"].note) == ("Own words", "item", None)
    assert (text["v"].text, text["v"].text_from) == ("On the bill: Agreed", "item") and text["v"].note.startswith("ParseError")
    assert text["x"].text is None and text["x"].error

    asked = {r.source_id: r.params for r in adapters.requests(spark.createDataFrame([("a", "bill-actions", "", window), ("x", "fax", "", None)], SHAPE)).collect()}
    assert asked == {"a": {"format": "json", "sort": "updateDate+desc", "fromDate": "2026-01-07"}, "x": None}


def test_a_constant_adapter_is_settled_by_analysis(spark):
    rows = spark.createDataFrame([("v", "votes", MENU, {"today": "2026-01-14", "days": "30"})], SHAPE)
    found = adapters.items(rows, F.lit("votes"))
    assert [(r.number, r.result) for r in found.orderBy("pos").collect()] == [(12, "Agreed"), (3, "x")] and "extra" not in found.columns
    with pytest.raises(AnalysisException, match="no adapter is called 'fax'"):
        adapters.items(rows, F.lit("fax")).collect()


# --- mail ---


def test_long_and_folded_headers(spark):
    raw = ("Received: x\r\n" + "X-Long: " + "y" * 20_000 + "\r\nFrom: The\r\n\tOffice <Office@A.gov>\r\nSubject: News\r\n\r\nFrom: other@b.gov\r\n\r\nBody").encode()
    bare = b"Subject: News\nFrom: office@a.gov\n\nBody"
    rows = spark.createDataFrame([(1, raw), (2, bare), (3, b"From: other@b.gov\r\nSubject: x\r\n\r\nFrom: office@a.gov"), (4, b"From: office@a.gov\r\nSubject: Confirm your subscription\r\n\r\nx"), (5, None)], "id long, raw binary")
    got = mail.bulletins(rows, "raw", ["id"], spark.createDataFrame([("OFFICE@a.gov",)], "sender string")).collect()
    assert sorted(r.id for r in got) == [1, 2]


# --- digests ---


def parts(spark, *, wrong_cover=False, link="https://example.gov/doc/1", summary="Plain words.", rule="R1", official="x"):
    items = spark.createDataFrame([("house", "A  title", summary, None, rule, link), ("agency", "Second", None, "In short.", "R2", "https://example.gov/doc/2"), ("elsewhere", "No", None, None, "R", "l")], "section string, title string, summary string, plain string, rule string, link string")
    facts = spark.createDataFrame([("c", True, "R"), ("c", False, None), (None, False, "R")], "collection string, summarised boolean, rule string")
    cover = digest.rules.coverage(facts, ["collection"])
    cover = cover.withColumn("packages", F.col("packages") + 1) if wrong_cover else cover
    known = spark.createDataFrame([(1,), (2,)], "doc_id long")
    lines = digest.document(items, cover, "collection", {"title": "a name", "unused": "nothing"})
    found = digest.findings(lines, items, facts, cover, ["collection"], known, r"https://example\.gov/doc/(\d+)", spark.createDataFrame([(link, official)], "link string, official string"))
    return lines, found


def test_a_digest_and_its_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digest, "ROWS", 2)
    digest.published(*parts(spark), str(tmp_path), "2026-01-01")
    got = digest.read(spark, str(tmp_path), "2026-01-01").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    text = "\n".join(r.line for r in got)
    assert text == """## House floor
### A title
Plain words.
Included: R1
Source: https://example.gov/doc/1
## Agency releases
### Second
> In short.
Included: R2
Source: https://example.gov/doc/2
## Coverage

| Class | Packages | Summarised | Counted | Excluded |
|---|---|---|---|---|
| ? | 1 | 0 | 1 | 0 |
| c | 2 | 1 | 0 | 1 |
## Glossary
- **title**: a name"""
    assert digest.read(spark, str(tmp_path), "another").count() == 0


@pytest.mark.parametrize(
    ("gate", "fault"),
    [("coverage", {"wrong_cover": True}), ("citation", {"link": "https://example.gov/doc/9"}), ("term", {"summary": "A landmark  law."}), ("reason", {"rule": None}), ("reason", {"rule": ""})],
)
def test_a_failing_gate_leaves_the_old_digest(spark, tmp_path, gate, fault):
    folder = str(tmp_path)
    digest.published(*parts(spark, summary="The old words."), folder, "d")
    with pytest.raises(digest.Rejected, match=f"^{gate}|; {gate}"):
        digest.published(*parts(spark, **fault), folder, "d")
    assert len(digest.manifests(spark, folder, "d")) == 1
    assert "The old words." in {r.line for r in digest.read(spark, folder, "d").collect()}
    digest.published(*parts(spark, summary="The landmark words.", official="The landmark words"), folder, "d")  # an official string may say so
    assert "The landmark words." in {r.line for r in digest.read(spark, folder, "d").collect()}


def test_a_stopped_write_and_a_lost_race(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    digest.published(*parts(spark, summary="The old words."), folder, "d")
    lines, found = parts(spark, summary="Newer words.")
    broken = lines.withColumn("line", F.when(F.col("part") > 3, F.raise_error(F.lit("a lost disk")).cast("string")).otherwise(F.col("line")))
    with pytest.raises(Exception, match="a lost disk"):
        digest.published(broken, found, folder, "d")
    first = digest.manifests
    monkeypatch.setattr(digest, "manifests", lambda *a: [])  # as seen before the other one committed
    with pytest.raises(digest.Rejected, match="number 1"):
        digest.published(lines, found, folder, "d")
    monkeypatch.setattr(digest, "manifests", first)
    assert "The old words." in {r.line for r in digest.read(spark, folder, "d").collect()}


ODD_PARTS = ["<p>", "</p>", "<a href='/x y'>", '<a HREF="q" id=\'\'>', "</A>", "<br/>", "<b class>", "<title>", "</title>", "t&amp;", "&lt", " x ", "<", ">", "<script>", "</script>", "<!-- c -->", "</li >", "<x-y>", "word", '"', "<textarea>", "</textarea>", "<a b=c>", "<a b='1'c='2'>", "<svg/>", "<a b='&amp;'>", "<style>", "</style>", "</>", " "]


def odd_pages(n):
    rng = random.Random(4)
    return ["".join(rng.choice(ODD_PARTS[:13] if k % 2 else ODD_PARTS) for _ in range(rng.randint(0, 8))) for k in range(n)]


def test_plain_pages_are_split_as_the_parser_does():
    """plain markup is split without the parser, into the same events; anything else is left to it."""
    taken = 0
    for page in odd_pages(20_000):
        parser = listing._Events()
        parser.feed(page)
        parser.close()
        if (events := listing.plain_events(page)) is not None:
            taken += 1
            assert events == parser.list, page
    assert taken > 5_000
    assert listing.plain_events("<ul><li><a href='/a'>A title</a> <time datetime=\"1998-01-02\"/></ul>") is not None
    assert [x["day"] for x in listing.parse_listing("<ul><li><a href='/a'>A title of it</a> ١/٢/١٩٩٨</ul>", "https://x.gov/n")] == ["1998-01-02"]  # digits of any script


def test_words_of_plain_pages_need_no_parser(monkeypatch):
    """the words of pages are those that the parser gives, which pages of plain markup don't need."""

    def parsed(page):
        p = parser()
        p.feed(page)
        p.close()
        return " ".join(" ".join(p.out).split())

    parser = listing._Text
    for page in odd_pages(20_000):
        assert listing.html_text(page) == parsed(page), page
    monkeypatch.setattr(listing, "_Text", None)
    assert listing.html_text("<html><script>x && y</script><p>Article &amp; 7</p></html>") == "Article & 7" and listing.html_text("<b>About</b> 7") == "About 7"
