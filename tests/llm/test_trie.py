"""Operator 13 against a trie of whole turns in one process, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from docketflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, score double"


def mark(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def expected(rows):
    own = {}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", mark(r[2] or "", r[3] or "")))
    for conv, _, role, text in order:
        own.setdefault(conv, []).append((role or "", text or ""))
    nodes = {}
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        path = tuple(own.get(base, [])[:h] + own[conv][h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((conv, d == len(path)))
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    def below(path):
        stack, leaves, saved = [path], 0, 0
        while stack:
            p = stack.pop()
            leaves += p not in kids
            saved += (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
            stack += kids.get(p, [])
        return leaves, saved

    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c, last in sorted(members) if last)
        leaves, saved = below(path)
        parent = min(c for c, _ in nodes[path[:-1]]) if path else None
        out.append((min(members)[0], len(path), parent, len(members), len(kids.get(path, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    conv = F.col("conv_id")
    return sorted((tuple(r) for r in trie.trie(df, conv - conv % 5, F.crc32(conv.cast("string")) % 9).collect()), key=repr)


def test_given_conversations(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in trie.op13_trie(spark, small).collect()), key=repr)
    assert found == expected(rows)


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    df = trie.op13_trie(spark, sf)
    want = con.sql(trie.OP13)
    assert want.columns == df.columns
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_families_that_share_turns(spark, seed, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 8)
    monkeypatch.setattr(trie, "HOT", 3)  # the root and common first turns are looked up by broadcast
    rng = random.Random(seed)
    rows = []
    for conv in range(-12, 90):
        if rng.random() < 0.85:
            length = rng.choice([1, 2, 3, 5, 9, 40 if conv % 11 == 0 else 4])
            rows += [(conv, t, "ab"[t % 2], f"turn {t} é {rng.choice([0, 0, 0, 1, conv])}") for t in range(length)]
    rng.shuffle(rows)
    assert got(spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA)) == expected(rows)


def test_odd_conversations(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", ""), (0, 1, "user", "tie b"), (0, 1, "user", "tie a"), (0, 1, "assistant", "tie a"),
        (1, 0, "user", "same"), (1, 0, "user", "same"), (2, 0, "user", "x" * 300_000), (3, 0, "", ""), (4, None, None, ""),
        (None, 0, "user", "nobody's"), (7, 3, "a", "b"), (8, 3, "ab", ""), (9, 3, "", "ab"), (-3, 0, "user", "before zero"), (-5, 0, "user", "base"),
    ]
    assert got(spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA)) == expected(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_one_conversation_many_times(spark):
    rows = [(c, t, "user", f"the same {t}") for c in range(3000) for t in range(3)]
    found = got(spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA))
    assert found == expected(rows)
