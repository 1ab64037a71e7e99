"""Budgets, ladders, checked chains, watermarks, discovery and inventories against plain folds and cases of their own."""

import datetime as dt
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from docketflow.functions import times
from docketflow.operators import budgets, change
from docketflow.plans import streams
from docketflow.sources import feeds, packages
from docketflow.streaming import ladders as steps
from docketflow.streaming import operators as ops

START = dt.datetime(2024, 1, 1)


def greedy(rows, hourly, daily):
    out, recent, used, day = {}, {}, {}, {}
    for owner, at, tie in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] or "", r[1], r[2])):
        q = recent.setdefault(owner, deque())
        while q and q[0] <= at - dt.timedelta(hours=1):
            q.popleft()
        if day.get(owner) != at.date():
            day[owner], used[owner] = at.date(), 0
        out[owner, tie] = len(q) < hourly and used[owner] < daily
        if out[owner, tie]:
            q.append(at)
            used[owner] += 1
    return out | {(r[0], r[2]): False for r in rows if r[1] is None}


@pytest.mark.parametrize("hourly,daily", [(1, 5), (3, 10), (2, 1000), (0, 5), (5, 1)])
def test_budgets_against_a_fold(spark, hourly, daily):
    rng = random.Random(hourly)
    rows = [(rng.choice(["a", "b", None]), START + dt.timedelta(minutes=rng.choice([7, 30, 61]) * k), k) for k in range(400)]  # days without a pause
    rows += [("c", START + dt.timedelta(hours=23, minutes=50 + (k // 3)), 1000 + k) for k in range(60)] + [("c", START, 2000), ("c", START, 2001), ("d", None, 3000)]
    log = spark.createDataFrame(rows, "owner string, ts timestamp_ntz, id long")
    got = {(r.owner, r.tie): r.admitted for r in budgets.admitted(log, "owner", "ts", "id", hourly, daily).collect()}
    assert got == greedy(rows, hourly, daily)


def test_budgets_of_nothing_and_what_is_used(spark):
    shape = "owner string, ts timestamp_ntz, id long"
    assert budgets.admitted(spark.createDataFrame([], shape), "owner", "ts", "id", 1, 1).count() == 0
    rows = [("a", START + dt.timedelta(hours=h), 0) for h in (0, 1, 9, 9.5, 10, 11)] + [("b", START - dt.timedelta(minutes=30), 0)]
    log = spark.createDataFrame(rows, shape)
    assert {tuple(r) for r in budgets.used(log, "owner", "ts", F.lit("2024-01-01 10:00:00")).collect()} == {("a", 2, 5)}
    assert {tuple(r) for r in budgets.used(log, "owner", "ts", F.lit("2024-01-01 00:10:00")).collect()} == {("a", 1, 1), ("b", 1, 0)}


# --- ladders ---


def climbed(rows, most, patience, now):
    """The ladder of one key by its definition."""
    attempts, label, since, last = 0, None, None, None
    for at, _, failed in sorted(rows):
        if label == "retrying" and last + patience < at:
            label, since = "overdue", last + patience
        attempts = attempts + 1 if failed else 0
        new = "ok" if not attempts else "retrying" if attempts < most else "exhausted"
        label, since, last = new, since if new == label else at, at
    if label == "retrying" and last + patience < now:
        label, since = "overdue", last + patience
    return attempts, label, since, len(rows)


def test_a_replayed_journal_gives_the_batch_result(spark, tmp_path):
    """Batches in disorder, with and without a first state; timers find the overdue."""
    rng = random.Random(5)
    rows = [(k % 7, START + dt.timedelta(hours=3 * k + rng.randint(0, 40)), k, rng.random() < 0.6) for k in range(200)]
    rows += [(50, START + dt.timedelta(hours=5), 900, True), (51, START + dt.timedelta(hours=600), 901, True), (52, START + dt.timedelta(hours=6), 902, False)]
    cut = START + dt.timedelta(hours=200)
    old, new = [r for r in rows if r[1] < cut], [r for r in rows if r[1] >= cut]
    shape = "key long, ts timestamp, tie long, failed boolean"
    folder = str(tmp_path / "journal")
    rng.shuffle(new)
    new.sort(key=lambda r: r[1] > START + dt.timedelta(hours=400))
    for lo in range(0, len(new), 25):
        spark.createDataFrame(new[lo : lo + 25], shape).coalesce(1).write.mode("append").parquet(folder)
    first = steps.batch_state(spark.createDataFrame(old, shape), patience="30 hours")
    stream = ops.read_table(spark, folder)
    with ops.rocks(spark):
        out = streams.finished(steps.ladders(stream, "250 hours", patience="30 hours", initial=first), "update")
    got = {r.key: (r.attempts, r.label, r.since, r.seen) for r in steps.latest(out.unionByName(first.drop("last"))).collect()}
    now = max(r[1] for r in rows) - dt.timedelta(hours=250)
    want = {k: climbed([r[1:] for r in rows if r[0] == k], 3, dt.timedelta(hours=30), now) for k in {r[0] for r in rows}}
    assert got == want
    assert want[50][1] == "overdue" and want[51][1] == "retrying" and want[52][1] == "ok"


# --- evidence ---


def test_what_is_wrong_with_a_chain(spark):
    rows = [(f"2024-01-0{1 + k // 5}", k, "a") for k in range(30)]
    attempts = spark.createDataFrame(rows, "day string, id long, kind string")
    args = "day", ["id"], ["id", "kind"]
    chain = change.chain((r.day, r.rows, r.body_sha) for r in change.day_digests(attempts, *args).collect())
    shape = "day string, rows long, body_sha string, prev string, sha string"
    check = lambda a, h: sorted(tuple(r) for r in change.checked_chain(a, spark.createDataFrame(h, shape), *args).collect())
    assert check(attempts, chain) == []
    assert check(attempts, [*chain[:2], *chain[3:]]) == [("2024-01-03", "missing"), ("2024-01-04", "link")]
    assert check(attempts.filter("day <> '2024-01-02'"), chain) == [("2024-01-02", "extra")]
    assert check(attempts.filter("id <> 7"), chain) == [("2024-01-02", "body"), ("2024-01-02", "rows")]
    forged = [(d, n, b, p, "f" * 64 if d.endswith("5") else s) for d, n, b, p, s in chain]
    found = change.checked_chain(attempts, spark.createDataFrame(forged, shape), *args)
    assert sorted(tuple(r) for r in found.collect()) == [("2024-01-05", "header"), ("2024-01-06", "link")]
    assert tuple(change.first_broken(found).first()) == ("2024-01-05", ["header"])
    assert check(attempts, []) == [(f"2024-01-0{k}", "missing") for k in range(1, 7)]


# --- instants and watermarks ---


def test_instants_of_all_dialects(spark):
    same = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.999Z", "2024-01-02 03:04:05", " 2024-01-01T22:04:05-05:00 ", "2024-01-02T08:34:05+0530", "2024-01-02T05:04:05+02", "2024-01-02T03:04:05,5z"]
    bad = ["2024-01-02", "2024-13-02T03:04:05Z", "x", "", "2024-01-02T25:00:00Z", None]
    rows = spark.createDataFrame([(s,) for s in same + bad], "s string").select("s", times.instant("s").cast("timestamp_ntz").cast("string").alias("i")).collect()
    assert [r.i for r in rows] == ["2024-01-02 03:04:05"] * len(same) + [None] * len(bad)


def test_a_cut_off_listing_leaves_the_watermark(spark):
    def body(*stamps, more=False):
        return '{"packages": [' + ", ".join(f'{{"packageId": "p", "lastModified": "{s}"}}' for s in stamps) + "]" + (', "nextPage": "u"}' if more else "}")

    late, early = "2024-01-02T00:00:00Z", "2024-01-01T23:59:59.9Z"
    pages = [
        ("whole", 1, body("2024-01-01T22:00:00-05:00", more=True)), ("whole", 2, body(early)), ("whole", 2, body(early)), ("cut", 1, body(late, more=True)), ("gap", 1, body(late, more=True)), ("gap", 3, body(late)),
        ("broken", 1, body(late, more=True)), ("broken", 2, "{"), ("headless", 2, body(late)), ("old", 1, body("2020-01-01T00:00:00Z")), ("empty", 1, body()),
    ]
    state = [(s, dt.datetime(2023, 1, 1)) for s in ("whole", "cut", "gap", "broken", "old", "empty", "silent")]
    got = feeds.advanced(spark.createDataFrame(pages, "source_id string, page int, body string"), spark.createDataFrame(state, "source_id string, watermark timestamp"))
    was = dt.datetime(2023, 1, 1)
    assert {r.source_id: (r.whole, r.watermark) for r in got.collect()} == {
        "whole": (True, dt.datetime(2024, 1, 2, 3)), "cut": (False, was), "gap": (False, was), "broken": (False, was), "headless": (False, None), "old": (True, was), "empty": (True, was), "silent": (False, was),
    }


# --- discovery and inventory ---


def test_candidates_in_order(spark):
    page = '<link rel=alternate type="application/atom+xml" href="../a.xml"><link rel="alternate stylesheet" type="text/css" href="x"><link rel=alternate type="application/rss+xml" href="https://other.org/f"><link rel=alternate type="application/rss+xml"><link rel=alternate type="text/xml" href="/feed">'
    homes = spark.createDataFrame([(1, "https://a.gov/x/y", page), (2, "https://b.gov", None), (3, "nonsense", ""), (4, None, None)], "source_id int, url string, page string")
    got = {}
    for r in feeds.candidates(homes).orderBy("source_id", "rank").collect():
        got.setdefault(r.source_id, []).append(r.link)
    assert got[1][:3] == ["https://a.gov/a.xml", "https://other.org/f", "https://a.gov/feed"] and len(got[1]) == 2 + len(feeds.COMMON_PLACES)
    assert got[2][0] == "https://b.gov/feed" and set(got) == {1, 2}
    samples = [("https://a.gov/a.xml", 200, "<feed xmlns='http://www.w3.org/2005/Atom'></feed>"), ("https://other.org/f", 500, ""), ("https://b.gov/rss", 401, None)]
    told = feeds.discovered(homes, spark.createDataFrame(samples, "url string, status int, body string"))
    assert {r.source_id: (r.verdict, r.feed) for r in told.collect()} == {1: ("empty", None), 2: ("blocked", None), 3: ("unreachable", None), 4: ("unreachable", None)}


def test_pages_are_carried_over_members(spark):
    mark, gid = '<PRTPAGE P="{}"/>'.format, "<GID>{}</GID>".format
    rows = [("p", 1, f"<R>{gid('a')}{mark(7)}{gid('b')}<PRTPAGE>8</PRTPAGE></R>"), ("p", 2, f"<R>{gid('c')}<GID> </GID>{gid('d')}{mark(9)}</R>"), ("p", 3, "<R>" + mark(99)), ("p", 4, f"<R>{gid('e')}</R>"), ("q", 1, f"<R>{gid('f')}</R>"), ("q", 2, None)]
    got = packages.inventory(spark.createDataFrame(rows, "package string, member int, body string"), "body", "package", "member")
    assert sorted((r.package, r.member, r.pos, r.gid, r.page) for r in got.filter("error IS NULL").collect()) == [("p", 1, 0, "a", None), ("p", 1, 1, "b", "7"), ("p", 2, 0, "c", "8"), ("p", 2, 1, "d", "8"), ("p", 4, 0, "e", "9"), ("q", 1, 0, "f", None)]
    assert [(r.package, r.member) for r in got.filter("error IS NOT NULL").collect()] == [("p", 3)]


def test_a_slice_of_the_stream_is_one_batch(spark, sf, tmp_path, monkeypatch):
    """Batches don't grow in number with the table's files, as each costs every key it touches a visit of its state."""
    from docketflow.plans import progress

    class Seen(Exception):
        pass

    def read(spark, folder, files_per_trigger=1, schema=None):
        raise Seen(-(-len(spark.read.parquet(folder).inputFiles()) // files_per_trigger))

    spark.read.parquet(f"{sf}/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(progress.ops, "read_table", read)
    with pytest.raises(Seen) as seen:
        progress.stream_ladders(spark, str(tmp_path))
    assert seen.value.args[0] <= progress.SLICES - 1
