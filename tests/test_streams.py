"""Streams over several part files that are not in time order, against values of the whole table."""

import duckdb
import pytest

from docketflow.plans import streams

SF = "/root/testdata/sf0.001"
SESSIONS = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts), max(ts) + INTERVAL 6 HOUR, count(*) FROM s GROUP BY user_id, k"""


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("shuffled")
    e = spark.read.parquet(f"{SF}/events.parquet")
    for k in (2, 0, 3, 1):
        e.filter(f"pmod(hash(event_id), 4) = {k}").coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
    return str(d)


def test_sessions_are_whole(spark, shuffled):
    want = duckdb.sql(SESSIONS.replace("FROM events", f"FROM '{SF}/events.parquet'")).fetchall()
    for d in (SF, shuffled):
        assert sorted(tuple(r) for r in streams.stream_session_windows(spark, d).collect()) == sorted(want)


def test_worker_state_of_shuffled_files(spark, shuffled):
    sql = streams.Q["stream_keyed_state"][1].replace("FROM events", f"FROM '{SF}/events.parquet'")
    rows = lambda x: sorted(tuple(r) for r in x)
    assert rows(streams.stream_keyed_state(spark, shuffled).select("worker", "streak", "bad", "since", "rows").collect()) == rows(duckdb.sql(f"SELECT worker, streak, bad, since, rows FROM ({sql})").fetchall())
