"""Results that no driver or single body has to hold: their number grows with the rows, not their size."""

import hashlib
import json

from pyspark.sql import functions as F

from docketflow.operators import change
from docketflow.plans import readers, streams
from docketflow.sources import feeds, packages


def test_streams_end_in_files(spark, sf):
    for f in (streams.stream_tumbling_counts, streams.stream_dedupe_keys):
        assert f(spark, sf).inputFiles()


def test_bodies_are_bounded(spark, monkeypatch, tmp_path):
    spark.range(20_000).select(F.col("id").alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("1").alias("o_orderpriority"), F.expr("TIMESTAMP_NTZ '1998-02-02 00:00:00'").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(20_000).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("n").alias("p_name"), F.lit("t").alias("p_type")).write.parquet(f"{tmp_path}/part.parquet")
    seen = {}
    for module, name in ((feeds, "bill_actions"), (packages, "record_zips"), (packages, "issue")):
        inner = getattr(module, name)
        monkeypatch.setattr(module, name, lambda rows, *a, inner=inner, name=name: inner(seen.setdefault(name, rows), *a))
    for q, name, bodies in ((readers.bill_action_pages, "bill_actions", 80), (readers.zip_round_trip, "record_zips", 20), (readers.issue_round_trip, "issue", 2)):
        assert q(spark, str(tmp_path)).count() == (20_000 if name != "issue" else 20_000 - len(range(0, 20_000, 11)))
        assert seen[name].count() >= bodies


def test_day_digest_is_streamed(spark):
    rows = [(k, "a" if k % 3 else "b", None if k % 5 == 0 else k) for k in range(100)]
    got = change.day_digests(spark.createDataFrame(rows, "k long, day string, v long"), "day", ["k"], ["k", "v"])
    hashed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = lambda d: [hashlib.sha256(json.dumps({"k": k, "v": v}, separators=(",", ":")).encode()).hexdigest() for k, x, v in rows if x == d]
    bins = lambda d: [f"{b}:" + hashed("\n".join(x for x in lines(d) if x[:2] == b)) for b in sorted({x[:2] for x in lines(d)})]
    assert {(r.day, r["rows"], r.body_sha) for r in got.collect()} == {(d, len(lines(d)), hashed("\n".join(bins(d)))) for d in "ab"}
