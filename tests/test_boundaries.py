"""Boundary cases of the operators on small rows of their own."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from docketflow.functions import hashing, text, times, urls
from docketflow.operators import change, corroborate, health, journal, lexicon, rules, upsert
from docketflow.sources import base, feeds, listing, packages, registry
from docketflow.streaming import operators as streaming


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


# --- selection ---

TEXTS = "doc_id long, collection string, doc_type string, char_count long, text string"


def test_rules_at_their_borders(spark):
    vote = "text [Roll No. 282] YEAS--214 and NAYS--208"
    rows = [
        (1, "CREC", "HOUSE", 15000, "x"), (2, "CREC", "HOUSE", 14999, "x"), (3, "CREC", "SENATE", 10, vote), (4, "CREC", "SENATE", 10, "the yeas and nays were ordered, proceedings postponed"),
        (5, "CREC", "HOUSE", 20000, vote), (6, "BILLS", "Reported-in-House", 1, ""), (7, "BILLS", "ENR", 1, ""), (8, "BILLS", "ih", 1, ""), (9, "FR", "NOTICE", 1, ""), (10, "FR", "PRORULE", 1, ""),
        (11, "PRESACT", "EO", 1, ""), (12, "PRESACT", None, 1, ""), (13, "XX", "RULE", 1, ""), (14, "CREC", "HOUSE", 5, "YEAS--1\n\n" + "y " * 9000 + "NAYS--2"), (15, "CREC", "EXTENSIONS", 99999, vote),
    ]
    got = {r.doc_id: (r.rule, r.exclusion) for r in rules.select_items(spark.createDataFrame(rows, TEXTS), rules.publication_rules(), rules.publication_exclusions()).collect()}
    want = ["CREC-SEL-01", None, "CREC-SEL-02", None, "CREC-SEL-01", "BILLS-SEL-01", "BILLS-SEL-01", None, None, "FR-SEL-02", "PRESACT-SEL-01", "PRESACT-SEL-04", None, "CREC-SEL-02", None]
    assert [got[k + 1][0] for k in range(15)] == want
    assert [got[k][1] for k in (2, 4, 8, 9, 13, 15)] == ["CREC-EX-01", "CREC-EX-01", "BILLS-EX-01", "FR-EX-01", None, "CREC-EX-02"]


def test_coverage_reconciles(spark):
    facts = spark.createDataFrame([("a", "R", True), ("a", None, False), ("a", "R", False), ("b", None, True)], "collection string, rule string, summarised boolean")
    cover = rules.coverage(facts, ["collection"])
    assert {tuple(r) for r in cover.collect()} == {("a", 3, 1, 1, 1), ("b", 1, 1, 0, 0)}
    assert rules.unreconciled(cover, facts, ["collection"]).count() == 0
    assert rules.unreconciled(cover.withColumn("counted", F.lit(5)), facts, ["collection"]).count() == 2
    assert rules.unreconciled(cover.filter("collection = 'a'"), facts, ["collection"]).count() == 1


def test_sections_and_stages(spark):
    got = spark.createDataFrame([("CREC-SEL-01", "HOUSE"), ("CREC-SEL-02", "HOUSE"), ("FR-SEL-03", "x"), ("NONE", "x")], "rule string, t string").select(rules.section(F.col("rule"), F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == ["house", None, "presidential", None]
    stages = spark.createDataFrame([("RH",), ("Engrossed-in-House",), ("Introduced-in-House",), (None,), ("enrolled",)], "t string").select(rules.bill_stage(F.col("t")).alias("s")).collect()
    assert [r.s for r in stages] == ["Reported", "Engrossed", "Introduced", "Other", "Enrolled"]


# --- health ---


@pytest.mark.parametrize(
    ("facts", "label"),
    [
        ((0, 0, 0, 0.0, 0, None), "no-data"), ((3, 5, 0, 1.0, 0, 1), "no-response"), ((3, 4, 0, 1.0, 0, 1), "delivering"), ((3, 10, 9, 0.1, 0, 1), "degraded"), ((3, 2, 1, 0.5, 0, 1), "delivering"),
        ((3, 11, 10, 1 / 11, 0, 1), "delivering"), ((3, 9, 9, 0.0, 3, 1), "degraded"), ((3, 9, 9, 0.0, 2, 7), "delivering"), ((3, 9, 9, 0.0, 0, 8), "quiet"), ((0, 9, 9, 0.0, 0, None), "quiet"),
    ],
)
def test_health_labels(spark, facts, label):
    row = spark.createDataFrame([facts], "i long, a long, k long, r double, s long, d long")
    assert row.select(health.label(*[F.col(c) for c in "iakrsd"])).first()[0] == label


def test_hosts_count_once(spark):
    sources = spark.createDataFrame([("s1", "h"), ("s2", "h"), ("s3", "g")], "id string, host string")
    hosts = spark.createDataFrame([("h", 10, 1), ("g", 5, 5), ("other", 99, 9)], "host string, attempts long, unanswered long")
    assert tuple(health.by_host_once(sources, hosts).first()) == (15, 6, 2)


def test_streaks(spark):
    rows = spark.createDataFrame([("w", k, b) for k, b in enumerate([True, True, False, True, True, True, False])], "w string, t long, bad boolean")
    got = health.streaks(rows, "w", ["t"], F.col("bad")).orderBy("t").collect()
    assert [r.streak for r in got] == [1, 2, 0, 1, 2, 3, 0]


# --- evidence ---


def test_change_kinds(spark):
    rows = [(1, "d", "a", "x", 1), (2, "d", "a", "x", 1), (3, "d", None, None, 1), (4, "d", "b", "x", 1), (5, "d", "c", "y", 1), (6, "d", "e", "y", 2), (7, "other", "a", "x", 1)]
    got = change.change_kind(spark.createDataFrame(rows, "id long, document_id string, content_sha string, text_sha string, version int")).orderBy("id").collect()
    assert [r.kind for r in got] == ["new", "unchanged", None, "bytes_changed", "modified", "modified", "new"]
    assert [r.prev_id for r in got] == [None, 1, 2, 2, 4, 5, None]


def test_chain_names_the_day_before():
    days = [("2024-01-02", 1, "b"), ("2024-01-01", 2, "a")]
    out = change.chain(days)
    assert [d for d, *_ in out] == ["2024-01-01", "2024-01-02"] and out[1][3] == out[0][4] and out[0][3] is None
    assert change.chain(days) == out and change.chain([("2024-01-01", 2, "z"), days[0]])[1][4] != out[1][4]


def test_stored_by_hash(spark):
    stored = change.store_by_hash(spark.createDataFrame([("a",), ("a",), ("b",)], "body string"), "body")
    assert stored.count() == 2 and change.mismatched(stored, "body").count() == 0
    assert change.mismatched(stored.withColumn("body", F.lit("c")), "body").count() == 2


def test_corroboration(spark):
    rows = [(1, "https://www.x.gov/a/", True), (2, "http://x.gov/a?utm_source=m", False), (3, "http://x.gov/a?id=1", False), (4, None, False), (5, None, False), (6, "ftp://x.gov/a", False), (7, "https://X.gov/a#top", False)]
    got = {r.id: r for r in corroborate.corroborate(spark.createDataFrame(rows, "id long, url string, mail boolean").withColumn("day", F.lit(1)), "url", F.col("mail"), ["id"], ["day"], "id").collect()}
    assert (got[2].primary, got[2].corroborated_by) == (2, 2)
    assert got[1].duplicate_of == got[7].duplicate_of == 2
    assert all(got[k].duplicate_of is None and got[k].corroborated_by == 0 for k in (3, 4, 5, 6))


def test_lexicon_positions(spark):
    items = spark.createDataFrame([(1, "A historic day."), (2, "The Historic Sites Act passed."), (3, "The Historic Sites Act is historic."), (4, "see [the page](http://x/historic) now"), (5, "prehistoric cracks   down"), (6, None)], "id long, text string")
    officials = spark.createDataFrame([(2, "Historic Sites Act"), (3, "Historic Sites Act"), (1, "A day")], "id long, official string")
    got = sorted((r.id, r.at, r.term) for r in lexicon.violations(items, officials, "id").collect())
    assert got == [(1, 2, "historic"), (3, 26, "historic"), (5, 12, "cracks down")]
    assert lexicon.first_violation(lexicon.violations(items, officials, "id"), ["id", "at"]).first().id == 1


def test_inclusion_lines(spark):
    lines = [(1, k, x) for k, x in enumerate(["# Title", "### One", "Included: rule", "### Two", "text", "### Three", "Included: x"])]
    got = lexicon.unexplained(spark.createDataFrame(lines, "doc long, n long, line string"), "doc", "n", "line").collect()
    assert [(r.n, r.line) for r in got] == [(3, "### Two")]


# --- journal and writes ---


def test_journal_is_idempotent(spark):
    facts = spark.createDataFrame([("p", ""), ("p", "g"), ("p", "g")], "package_id string, granule_id string")
    empty = spark.createDataFrame([], "package_id string, granule_id string, event string")
    new = journal.unjournaled(facts, empty, ["package_id", "granule_id"], "ingested")
    assert new.count() == 2
    assert journal.unjournaled(facts, new, ["package_id", "granule_id"], "ingested").count() == 0


def test_pending_and_triggers(spark):
    sel = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    att = spark.createDataFrame([(3,), (3,), (3,), (2,), (2,)], "id long")
    assert [r.id for r in journal.pending(sel, sel.filter("id = 1"), att, ["id"]).collect()] == [2]
    cases = [((6, 15, 1), True), ((6, 14, 99), False), ((5, 15, 59), False), ((5, 15, 60), True), ((0, 99, 99), False), ((6, None, None), True), ((1, None, None), False)]
    rows = spark.createDataFrame([c for c, _ in cases], "p long, m long, o long")
    assert [r.x for r in rows.select(journal.fires(F.col("p"), F.col("m"), F.col("o")).alias("x")).collect()] == [x for _, x in cases]


def test_upsert_keeps_the_filing_day(spark):
    t = spark.createDataFrame([("a", 1, "d1", "day1", "old", "fetched", 3), ("b", 5, None, "day1", "x", "failed", 2)], "package_id string, last_modified long, date_issued string, digest_day string, title string, fetch_status string, attempts int")
    u = spark.createDataFrame([("a", 2, None, "day9", "new"), ("a", 1, None, "day8", "older"), ("b", 5, "d2", "day9", None), ("c", 1, None, "day9", "c")], "package_id string, last_modified long, date_issued string, digest_day string, title string")
    got = {r.package_id: tuple(r)[1:] for r in upsert.upsert_revisions(t, u).collect()}
    assert got == {"a": (2, "d1", "day1", "new", "pending", 0), "b": (5, "d2", "day1", "x", "failed", 2), "c": (1, None, "day9", "c", "pending", 0)}
    again = {r.package_id: tuple(r)[1:] for r in upsert.upsert_revisions(upsert.upsert_revisions(t, u), u).collect()}
    assert again == got


def test_other_writes(spark, tmp_path):
    t = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    assert sorted(map(tuple, upsert.replaced(t, spark.createDataFrame([("b", 9)], "k string, v int"), "k", t.filter("k <> 'a'")).collect())) == [("a", 1), ("b", 9)]
    assert [tuple(r) for r in upsert.get_or_create(t, spark.createDataFrame([("a", 7), ("z", 8), ("z", 6)], "k string, v int"), ["k"], "v").collect()] == [("z", 6)]
    assert sorted(map(tuple, upsert.set_value(t, spark.createDataFrame([("b", 5)], "k string, v int"), "k", "v").collect())) == [("a", 1), ("b", 5), ("c", 3)]
    path = str(tmp_path / "t")
    upsert.replace_partitions(t, path, "k")
    upsert.replace_partitions(t.filter("k = 'a'").withColumn("v", F.lit(10)), path, "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 10), ("b", 2), ("c", 3)]
    f = spark.createDataFrame([("a", 47, "failed"), ("b", 1, "pending")], "package_id string, attempts int, fetch_status string")
    assert sorted(map(tuple, upsert.failed(f, f, "package_id").collect())) == [("a", 48, "exhausted"), ("b", 2, "failed")]


# --- columns ---


def test_times(spark):
    ts = dt.datetime(2026, 7, 31, 3, 59, 59)
    assert str(one(spark, times.publication_day("t"), t=ts)) == "2026-07-30"
    assert str(one(spark, times.publication_day("t"), t=dt.datetime(2026, 7, 31, 4, 0))) == "2026-07-31"
    assert str(one(spark, times.publication_day("t"), t=dt.datetime(2024, 3, 10, 4, 59))) == "2024-03-09"
    for raw, day in [("Fri, 31 Jul 2026 20:30:00 -0400", "2026-07-31"), ("Sat, 01 Aug 2026 00:30:00 GMT", "2026-07-31"), ("31 Jul 2026 23:59:00", "2026-07-31"), ("2026-07-31T23:00:00Z", "2026-07-31"), ("Wed, 08/05/2026 - 08:00", "2026-08-05"), ("July 17, 2026", "2026-07-17"), ("8/5/26", "2026-08-05"), ("February 30, 2026 or 1 March 2026", "2026-03-01"), ("none", None), ("", None)]:
        got = one(spark, times.claimed_day("t"), t=raw)
        assert (str(got) if got else None) == day, raw
    hol = {str(r.day): r.holiday for r in times.holidays(spark, 2021, 2022).collect()}
    assert hol["2021-12-31"] == "New Year's Day (observed)" and hol["2021-07-05"] == "Independence Day (observed)" and hol["2022-11-24"] == "Thanksgiving Day" and hol["2022-05-30"] == "Memorial Day"
    assert one(spark, times.filing_day(F.lit("cover"), F.lit("2026-01-01"), F.lit(ts)) .cast("string")) == "2026-01-01"


def test_texts(spark):
    assert one(spark, text.one_line("t"), t=" a \n b c\x1cd ") == "a b c d"
    assert one(spark, text.truncate("t", 5), t="abcd efg") == "abcd…" and one(spark, text.truncate("t", 8), t="abcd efg") == "abcd efg"
    assert one(spark, text.sentence_clip("t", 12, "+"), t="One. Two three four") == "One.+" and one(spark, text.sentence_clip("t", 5, "+"), t="abcdefgh") == "abcde+"
    assert one(spark, text.display_title("t"), t="LETTER FROM JOHN O'ROURKE OF THE EPA") == "Letter from John O'Rourke of the EPA"
    assert one(spark, text.display_title("t"), t="Already Mixed Title") == "Already Mixed Title"
    assert [one(spark, text.ordinal("n"), n=n) for n in (1, 2, 3, 4, 11, 12, 13, 21, 111)] == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "111th"]
    assert one(spark, text.json_reply("t"), t='```json\n{"a": 1}\n```') == '{"a":1}' and one(spark, text.json_reply("t"), t="no json") == "{}"
    assert one(spark, text.teaser("t"), t="# Head\n\nFirst one. Second.") == "First one."
    assert one(spark, text.strip_boilerplate("t"), t="Body\nUnsubscribe here\nmore\n-----\nfooter") == "Body\nmore"
    assert one(spark, F.size(text.words("t")), t="") == 0
    assert one(spark, text.word_bounds("t", 2, 3), t="a b c d") == "a b c" and one(spark, text.word_bounds("t", 2, 3), t="a") is None
    assert one(spark, text.administrative("t"), t="Please Confirm your subscription") is True


def test_urls(spark):
    same = ["http://www.X.gov/a/", "https://x.gov/a?utm_source=1&UTM_x=2", "https://x.gov/a#f", "http://x.gov/a//"]
    assert {one(spark, urls.canonical("u"), u=u) for u in same} == {"x.gov/a"}
    assert one(spark, urls.canonical("u"), u="http://x.gov/a?b=&a=1&utm_x=3") == "x.gov/a?b=&a=1"
    assert one(spark, urls.canonical("u"), u="mailto:a@b") is None
    assert one(spark, urls.resolved(F.lit("http://x.gov/a/b"), F.col("u")), u="../c?d") == "http://x.gov/c?d"
    assert one(spark, urls.tracked("u"), u="https://t.co/x/https%3A%2F%2Fy.gov%2Fz/1") == "https://y.gov/z"
    assert one(spark, urls.publisher("u"), u="https://www.army.mil/x") is True and one(spark, urls.publisher("u"), u="nonsense") is False
    assert one(spark, urls.interstitial("u"), u="https://a.gov/go?nr=%2Fb%2Fc") == "https://a.gov/b/c"


def test_hashes(spark):
    import hashlib
    import json

    assert one(spark, hashing.canonical_json_hash("t"), t='{"b": 1, "a": "é"}') == hashlib.sha256(json.dumps({"a": "é", "b": 1}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert one(spark, hashing.percent(F.lit(1), F.lit(0))) == 0.0 and one(spark, hashing.percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, hashing.package_id(F.lit("epa"), F.lit("x"))) == "PR-epa-" + hashlib.sha256(b"x").hexdigest()[:8]


# --- readers ---


def test_poison_bodies_are_rows(spark):
    rows = spark.createDataFrame([(1, "<rss><channel><item><title>T</title><guid>g</guid></item></channel></rss>"), (2, "<rss>"), (3, None), (4, "<html/>")], "id long, body string")
    got = feeds.feed_items(rows, "body", ["id"]).collect()
    assert [(r.id, r.title, r.error is None) for r in got] == [(1, "T", True), (2, None, False), (4, None, False)]
    good, bad = streaming.split_poison(feeds.feed_items(rows, "body", ["id"]))
    assert good.count() == 1 and bad.count() == 2
    with pytest.raises(KeyError):
        feeds.reader_for("nothing")


def test_votes_and_bills(spark):
    vote = "<v><vote_number>7</vote_number><vote_date>d</vote_date><question>q</question><vote_result>Agreed</vote_result><count><yeas>2</yeas><nays>1</nays></count><members><member><member_full>b</member_full><vote_cast>Yea</vote_cast></member><member><member_full>A</member_full><vote_cast>Yea</vote_cast></member></members></v>"
    r = feeds.votes(spark.createDataFrame([(vote,)], "body string"), "body", []).first()
    assert (r.number, r.yeas, r.positions["Yea"], r.note) == (7, 2, ["A", "b"], "nays: published 1, roster 0")
    bill = '<bill bill-stage="Reported-in-House"><metadata>skip</metadata><form><official-title>To do</official-title><sponsor>X</sponsor><cosponsor>Y</cosponsor><cosponsor>X</cosponsor></form></bill>'
    b = packages.bills(spark.createDataFrame([(bill,)], "body string"), "body", []).first()
    assert (b.doc_type, b.title, b.metadata["sponsors"]) == ("Reported-in-House", "To do", "X; Y") and "skip" not in b.text
    cited = "<law><meta><type>Public Law</type><docNumber>7</docNumber></meta><main>See Private Law 1.</main></law>"
    laws = [("PLAW-119pvtl1", "Public Law 1 & so on"), ("PLAW-119publ2", "Private Law 1 & so on"), ("PLAW-119publ7", cited), ("PLAW-119pvtl9", cited)]
    got = {r.package_id: r for r in packages.laws(spark.createDataFrame(laws, "package_id string, body string"), "body", ["package_id"]).collect()}
    assert [got[k].doc_type for k, _ in laws] == ["PRIVATE", "PUBLIC", "PUBLIC", "PRIVATE"] and got["PLAW-119publ2"].text == "Private Law 1 & so on"
    assert got["PLAW-119publ7"].metadata == {"law_number": "7", "law_type": "Public Law"}
    ids = spark.createDataFrame([("BILLS-119hconres12rh",)], "p string").select(*[c.alias(k) for k, c in packages.bill_id(F.col("p")).items()]).first()
    assert tuple(ids) == ("119", "hconres", "12", "rh", "house")
    assert one(spark, packages.precedential(F.col("t")), t="NOT FOR PUBLICATION precedential") is False
    assert one(spark, packages.court_category(F.lit(None), F.col("c")), c="cafc") == "APPELLATE"
    assert one(spark, packages.graphic_class(F.col("g")), g="ER01JA24.001") == "substantive"


def test_case_packages(spark):
    def package(mods, names):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            if mods is not None:
                z.writestr("c/mods.xml", mods)
            for n in names:
                z.writestr(f"c/pdf/{n}.pdf", b"%PDF one")
        return raw.getvalue()

    mods = """<mods xmlns="http://www.loc.gov/mods/v3"><titleInfo><title>A v. B</title></titleInfo><extension><courtType>Bankruptcy</courtType><caseNumber>1:2</caseNumber></extension>
    <relatedItem type="constituent"><extension><accessId>U-x-2</accessId><docketText>NOT FOR PUBLICATION</docketText></extension><originInfo><dateIssued>2024-01-02</dateIssued></originInfo></relatedItem></mods>"""
    broken = bytearray(package(mods, ["U-x-1"]))
    at = broken.index(b"%PDF one")
    broken[at : at + 4] = b"PDF%"  # its checksum is wrong now
    rows = [("USCOURTS-caDC-1", package(mods, ["U-x-10", "U-x-2", "U-x-a"]), {"U-x-2": "two", "U-x-10": "ten"}), ("USCOURTS-ca9-2", package(None, ["U-y-1"]), {"U-y-1": "one"}), ("USCOURTS-nysd-3", package("<mods", ["U-z-1"]), {}), ("p4", bytes(broken), {"U-x-1": None}), ("p5", b"no zip", {})]
    got = packages.case_zips(spark.createDataFrame(rows, "package_id string, body binary, texts map<string, string>"), "body", ["package_id", "texts"], texts="texts").orderBy("package_id", "pos").collect()
    by = lambda p: [r for r in got if r.package_id == p]
    assert [(r.granule_id, r.text, r.precedential) for r in by("USCOURTS-caDC-1")] == [("U-x-2", "two", False), ("U-x-10", "ten", None), ("U-x-a", "", None)]
    assert {r.doc_type for r in by("USCOURTS-caDC-1")} == {"BANKRUPTCY"} and by("USCOURTS-caDC-1")[0].metadata["date_filed"] == "2024-01-02" and by("USCOURTS-caDC-1")[2].metadata["extraction_note"] == "no text"
    assert [(r.doc_type, r.text, r.metadata["extraction_note"]) for r in by("USCOURTS-ca9-2")] == [("APPELLATE", "one", "mods.xml missing")]
    assert by("USCOURTS-nysd-3")[0].metadata["extraction_note"].startswith("mods.xml unreadable") and by("p4")[0].metadata["extraction_note"].startswith("unreadable member") and by("p5")[0].error


def test_plain_case_packages_are_read_without_parsers(monkeypatch):
    """Short plain packages are most of what there is: neither zipfile nor an XML parser is opened for them, and what either says of others stands."""

    def package(members, **how):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", **how) as z:
            for name, content in members:
                z.writestr(zipfile.ZipInfo(name) if not how else name, content)
        return raw.getvalue()

    ns = 'xmlns="http://www.loc.gov/mods/v3"'
    item = "<relatedItem type=\"constituent\"><extension><accessId>c-{0}</accessId><docketText> Not  for\npublication</docketText></extension> <originInfo><dateIssued>2024-01-0{0}</dateIssued>\n</originInfo></relatedItem>"
    plain = [f"<mods {ns}><titleInfo><title>A v. B</title></titleInfo><extension><courtType>x</courtType><courtType>District</courtType></extension>{item.format(1)}{item.format(2)}</mods>", "<mods></mods>", "<mods><extension><a></a></extension></mods>\n"]
    odd = [
        f"<mods {ns}><extension><courtType>A &amp; B</courtType></extension></mods>", f"<m:mods xmlns:m='u'><m:titleInfo><m:title>T</m:title></m:titleInfo>{item.format(1)}</m:mods>", f"<mods><extension/>{item.format(1)}</mods>", "<mods><extension><a>x<b>y</b>z</a>tail</extension></mods>",
        f"<mods><other>{item.format(1)}</other></mods>", "<mods><titleInfo><title>\u00e9</title></titleInfo></mods>", f"<mods>{item.format(1)}{item.format(1)[:-4]}</mods>", "<mods><extension><a>]]></a></extension></mods>", "<mods><extension><a>x</b></extension></mods>", "<mods></mods><mods></mods>", "",
    ]

    def said(body):
        try:
            return packages.parse_mods(body)
        except Exception as e:
            return type(e)

    got = [said(x.encode()) for x in plain + odd]
    files = [("x/mods.xml", plain[0].encode()), ("x/pdf/c-2.pdf", b"%PDF"), ("x/pdf/c-1.PDF", b""), ("x/pdf/none.pdf", b"%PDF" * 99), ("x/other", b"1")]
    zips = [package(files), package(files, compression=zipfile.ZIP_DEFLATED), package([])]
    assert packages.stored_zip(files) == zips[0] and packages.stored_zip([]) == zips[2]
    broken = bytearray(zips[0])
    broken[broken.index(b"%PDF")] ^= 1
    twice = bytearray(zips[0])
    twice[:] = bytes(twice).replace(b"c-2.pdf", b"c-1.PDF")  # two members of one name
    others = [bytes(broken), bytes(twice), b"before" + zips[0], zips[0] + b"after", zips[0][:-3], package([("x/pdf/\u00e9.pdf", b"1")]), package(files, compression=zipfile.ZIP_BZIP2), b"", b"no zip"]

    def read(body):
        try:
            return list(packages.parse_members(body, "")), list(packages.parse_case(body))
        except Exception as e:
            return type(e)

    rows = [read(x) for x in zips + others]
    assert [r["granule_id"] for r in rows[0][1]] == ["c-1", "c-2", "none"] and dict(rows[0][1][0]["own"])["docketText"] == "Not for publication" and dict(rows[0][1][0]["case"])["courtType"] == "District"
    with monkeypatch.context() as m:  # as they say without the short ways
        m.setattr(packages, "plain_mods", lambda body: None)
        m.setattr(packages, "plain_zip", lambda body: None)
        assert [said(x.encode()) for x in plain + odd] == got and [read(x) for x in zips + others] == rows
    monkeypatch.setattr(packages.zipfile, "ZipFile", None)
    monkeypatch.setattr(packages.ET, "fromstring", None)
    assert [said(x.encode()) for x in plain] == got[:3] and [read(x) for x in zips] == rows[:3]


def test_listing(spark):
    page = """<head><title>Not text, January 1, 2026</title></head><ul><li>January 5, 2026 <a href="/a">A long enough title</a></li><li><a href="/b">Another long title</a> 01/04/2026</li></ul>
    <a href="/x">Skip to all the nav</a><a href="/x">Skip to all the nav</a><a href="/x">Skip to all the nav</a><a href="#t">Top of this page</a><a href="/s">More</a><script>document.write('<a href="/z">no</a>')</script>"""
    got = listing.listing_items(spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, html string"), "html", ["id"]).orderBy("pos").collect()
    assert [(r.id, r.link, r.day, r.date_text) for r in got] == [(1, "/a", "2026-01-05", "January 5, 2026"), (1, "/b", "2026-01-04", "01/04/2026")]
    items = lambda body, **k: [(x["link"][-2:], x["day"]) for x in listing.parse_listing(body, "https://x.gov/news", **k)]
    entry = "<li><a href='/n/{0}'>Release number {0}</a></li>"
    many = "".join(entry.format(k) for k in range(10, 30))
    # a footer's day is nobody's, near or far; days of a list are no entry's; a short group under one day is dated by it
    assert set(items(f"<body><ul>{many}</ul><footer>Updated January 6, 2026</footer></body>")) == {(str(k), None) for k in range(10, 30)}
    assert items(f"<body><ul>{entry.format(10)}</ul>{'<p>x</p>' * 80}<footer>January 6, 2026</footer></body>") == [("10", None)]
    group = "".join(entry.format(k) for k in range(10, 18))
    assert set(items(f"<section><h2>July 4, 2026</h2><ul>{group}</ul></section>")) == {(str(k), "2026-07-04") for k in range(10, 18)}
    assert {d for _, d in items(f"<section><h2>July 4, 2026</h2><ul>{group}</ul><p>July 3, 2026</p></section>")} == {None}
    assert items("<li>May 1, 2026 <time datetime='2026-05-02T08:00'></time><a href='/n/10'>Release number 10</a></li>") == [("10", "2026-05-02")]
    assert items("<li><a href='https://other.gov/n/10'>Release elsewhere</a> <a href='/news/'>The listing itself</a> <a href='/n/11'>Release number 11</a> 2026-05-01</li>", hint="/n") == [("11", "2026-05-01")]
    assert listing.decoded("é".encode("latin-1"), "latin-1") == "é" and listing.decoded(b'<meta charset="iso-8859-1">\xe9').endswith("é") and listing.decoded(b"\xff") == "�"


def test_paged_listing_and_registry(spark):
    pages = spark.createDataFrame([('{"packages": [{"packageId": "a", "lastModified": "2024-01-02T00:00:00Z"}, {"packageId": "b", "lastModified": "2023-01-01T00:00:00Z"}], "nextPage": "x"}',), ('{"packages": [{"packageId": "a", "lastModified": "2024-01-03T00:00:00Z"}]}',), ("broken",)], "body string")
    got = feeds.paged(pages, F.lit("2024-01-02").cast("timestamp")).collect()
    assert [(r.packageId, str(r.lastModified)[:10]) for r in got] == [("a", "2024-01-03")]
    row = spark.createDataFrame([("zip", None, "p")], "x string, xmlLink string, pdfLink string").select(base.first_offered({"xml": "xmlLink", "pdf": "pdfLink"}, ["xml", "pdf"]).alias("f")).first()
    assert tuple(row.f) == ("pdf", "p")
    cols = registry.SCHEMA
    ok = ("epa", "EPA", "executive", None, None, "agency", 1, {"feed": "u"}, "rss", "active", None, None, None)
    bad = ("EPA!", "x", "moon", None, None, "agency", 9, None, "email", "active", None, ["A@b", "a@B"], None)
    got = {(r.id, r.problem) for r in registry.problems(spark.createDataFrame([ok, bad], cols)).collect()}
    assert {i for i, _ in got} == {"EPA!"} and len(got) == 4


# --- streams ---


def test_replayed_batches_add_nothing(spark, tmp_path):
    path = str(tmp_path / "journal")
    write = streaming.append_new(path, ["k"])
    b1, b2 = (spark.createDataFrame(x, "k long, v string") for x in ([(1, "a"), (2, "b"), (2, "c")], [(2, "x"), (3, "y")]))
    write(b1, 0)
    write(b2, 1)
    write(b2, 1)
    write(b1, 0)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_a_failing_read_fails_the_batch(spark, tmp_path):
    path = tmp_path / "journal"
    write = streaming.append_new(str(path), ["k"])
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    write(rows, 0)
    for f in path.rglob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt|read"):
        write(spark.createDataFrame([(1, "a")], "k long, v string"), 1)


def test_stream_across_batches(spark, tmp_path):
    from docketflow.plans import streams

    folder = str(tmp_path / "events.parquet")
    rows = [(k, dt.datetime(2024, 1, 1, 0, k), k % 2, k in (0, 2, 4)) for k in range(6)]
    for lo in (0, 3):
        spark.createDataFrame(rows[lo : lo + 3], "event_id long, ts timestamp_ntz, worker long, bad boolean").coalesce(1).write.mode("append").parquet(folder)
    stream = streams.file_stream(spark, str(tmp_path)).select("worker", "event_id", "ts", "bad")
    with streaming.rocks(spark):
        out = streams.finished(streaming.worker_state(stream), "update").collect()
    last = {r.worker: r for r in sorted(out, key=lambda r: r["rows"])}
    assert (last[0].streak, last[0]["rows"], last[1].streak) == (3, 3, 0)
    late = streaming.late(spark.createDataFrame([("2024-01-02", "2024-01-01"), ("2024-01-02", None)], "f string, c string"), "f", "c").collect()
    assert [r.is_backfill for r in late] == [True, False]


def test_poll_intervals(spark):
    rows = spark.createDataFrame([(10, 0, 0, 100), (10, 5, 0, 100), (10, 1, 70, 100)], "m long, e long, u long, b long")
    assert [r.x for r in rows.select(streaming.poll_interval(*[F.col(c) for c in "meub"]).alias("x")).collect()] == [10, 80, 40]


# --- schemas and model work ---


def test_schemas(spark, tmp_path):
    from docketflow import schema

    old = spark.createDataFrame([("u", 200), ("v", None)], "url string, status int")
    log = schema.conformed(old, "fetch_log")
    assert log.filter("client IS NULL").count() == 2 and log.schema == schema.empty(spark, "fetch_log").schema
    path = str(tmp_path / "log")
    schema.append(old, path, "fetch_log")
    schema.append(old, path, "fetch_log")
    assert spark.read.parquet(path).count() == 4
    j = spark.createDataFrame([("p", "", "ingested"), ("p", "", "ingested"), ("p", "g", "lost")], "package_id string, granule_id string, event string")
    assert {(r.column, r.value, r.n) for r in schema.violations(j, "item_journal").collect()} == {("event", "lost", 1), ("key", "p//ingested", 2)}


def test_model_rounds(spark):
    import json

    from docketflow.operators import model

    def moody(prompts):
        return ["```json\n" + json.dumps({k: "ok" for k in json.loads(p) if k != "3"} | {"99": "unasked"}) + "\n```" if "2" not in json.loads(p) else "sorry" for p in prompts]

    items = spark.createDataFrame([(k, f"text {k}") for k in range(8)], "key long, text string")
    got = model.answered(items, moody, 4)
    assert sorted(r.key for r in got.collect()) == ["4", "5", "6", "7"]
    left = model.unanswered(items, got)
    assert sorted(r.key for r in left.collect()) == [0, 1, 2, 3]
    assert sorted(r.key for r in model.answered(left, moody, 1).collect()) == ["0", "1"]


def test_long_official_lists_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "xthe Clean Water Act of 1972 stands"), (2, "nothing here"), (3, "a Clean Air Act"), (4, None)], "id long, text string")
    official = spark.createDataFrame([("Clean Water Act of 1972",), ("the Clean Water Act of",), ("Air Act",), ("Never Said Words In Here",)], "official string")
    want = sorted((r.id, r.official) for r in lexicon.contained(docs, official).collect())
    monkeypatch.setattr(lexicon, "FEW", 0)
    assert sorted((r.id, r.official) for r in lexicon.contained(docs, official).collect()) == want == [(1, "Clean Water Act of 1972"), (1, "the Clean Water Act of"), (3, "Air Act")]


def test_a_table_of_one_row_group_is_spread_over_tasks(spark, tmp_path):
    """Slow work on short rows must not be one task because the table's file has one row group."""
    from docketflow.session import spread

    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    dealt = spread(rows, "id").rdd.glom().map(len).collect()
    assert rows.rdd.getNumPartitions() == 1 and len(dealt) >= spark.sparkContext.defaultParallelism and max(dealt) < 200 and sum(dealt) == 1000


def test_packages_and_members_are_read_once(spark):
    """No body of a case package or an inventory is parsed a second time for another part of the plan."""
    zips = spark.createDataFrame([("USCOURTS-ca1-1", b"no zip", {})], "package_id string, body binary, texts map<string, string>")
    case = packages.case_zips(zips, "body", ["package_id", "texts"], texts="texts")
    rows = spark.createDataFrame([("p", 1, "<R><PRTPAGE P='3'/><GID>g</GID></R>"), ("p", 2, "<R"), ("p", 3, "<R><GID>h</GID></R>")], "package string, member int, body string")
    inventory = packages.inventory(rows, "body", "package", "member")
    for out in (case, inventory):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert [(r.member, r.pos, r.gid, r.page, r.error is None) for r in inventory.orderBy("member").collect()] == [(1, 0, "g", "3", True), (2, None, None, None, False), (3, 0, "h", "3", True)]
    assert [(r.error[:10], r.pos, r.text) for r in case.collect()] == [("BadZipFile", None, None)]
