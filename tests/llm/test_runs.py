"""Operator 11 against a scan of every period, on whole documents and on made-up texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from docketflow.llm import runs


def scan(words, least=6, times=4):
    """All runs by definition: for every period the longest stretches whose words repeat at that distance."""
    number, out = {}, {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    for q in range(1, len(words) // times + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        for i, j in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)  # smaller periods came first
    return sorted((s, e - s, q) for (s, e), q in out.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = scan(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def digest(docs):
    class Reader:
        @staticmethod
        def parquet(path):
            return docs

    class Session:
        read = Reader

    return sorted((tuple(r) for r in runs.op11_runs(Session, "").collect()), key=repr)


def test_whole_documents(spark, small, texts):
    got = sorted(tuple(r) for r in runs.op11_runs(spark, small).collect())
    assert got == sorted(expected(i, t) for i, t in texts.items())
    assert sum(r[1] for r in got) > 5


@pytest.mark.parametrize("least,times", [(6, 4), (4, 4), (12, 4), (5, 6)])
def test_made_up_sequences(least, times):
    rng = random.Random(least * times)
    for _ in range(800):
        n, words = rng.randint(0, 150), []
        while len(words) < n:
            block = [rng.choice([b"a", b"b", b"c", b"d"][: rng.randint(1, 4)]) for _ in range(rng.randint(1, 9))]
            words += block * rng.randint(1, 7)
        assert runs.runs_of(words[:n], least, times) == scan(words[:n], least, times)


def test_one_word_and_one_period_over_a_long_text():
    assert runs.runs_of([b"x"] * 30_000) == [(0, 30_000, 1)]
    assert runs.runs_of([b"%d" % (i % 2999) for i in range(30_000)]) == [(0, 30_000, 2999)]
    # Thue-Morse: no cubes, and hashes modulo a power of two collide on its halves
    assert runs.runs_of([b"01"[bin(i).count("1") & 1 :][:1] for i in range(1 << 14)]) == []


def test_too_few_periods_are_refused():
    with pytest.raises(ValueError):
        runs.runs_of([b"x"] * 9, times=3)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    more = [(20, "a b " * 6), (20, "a b " * 6), (None, "x x\tx\nx x\x0bx\x0cx"), (21, "           ")]
    more += [(i, " ".join(f"w{k}" for k in range(40))) for i in range(60)]
    docs = odd.select("doc_id", "text", "score").union(spark.createDataFrame([(i, t, 0.0) for i, t in more], "doc_id long, text string, score double"))
    assert digest(docs) == sorted((expected(i, t) for i, t in rows + more), key=repr)
    assert digest(none) == []
    kept = runs.detect(odd.limit(3), runs="r", n_words="n", collapsed="c")
    assert kept.columns == [*odd.columns, "r", "n", "c"]
