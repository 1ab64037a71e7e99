"""Operator 12 against Katz backoff over plain dictionaries, its normalisation, and held-out texts."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketflow.llm import katz

END = "\n"  # no word has white space


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def good_turing(counts):
    """What a count becomes."""
    n = Counter(counts.values())
    for k in range(katz.K, 0, -1):
        if all(n[r] for r in range(1, k + 2)):
            rest = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, k + 1)} if rest < 1 else {1: 0}
            if all(0 < x < 1 for x in d.values()):
                return lambda c: c * d[c] if c in d else c - katz.DELTA
    return lambda c: c - 0.5 if c <= katz.K else c - katz.DELTA


class Katz:
    def __init__(self, texts):
        self.uni, self.bi, self.after = Counter(), Counter(), defaultdict(set)
        self.total = Counter()
        for t in map(tokens, texts):
            self.uni.update(t)
            for h, w in zip([None, *t], t, strict=False):
                self.bi[h, w] += 1
                self.after[h].add(w)
                self.total[h] += 1
        self.n = sum(self.uni.values())
        self.less1, self.less2 = good_turing(self.uni), good_turing(self.bi)
        self.unknown = 1 - sum(map(self.less1, self.uni.values())) / self.n if self.n else 1.0

    def one(self, w):
        return self.less1(self.uni[w]) / self.n if w in self.uni else self.unknown

    def p(self, w, h):
        if h not in self.after:
            return self.one(w)
        if w in self.after[h]:
            return self.less2(self.bi[h, w]) / self.total[h]
        left = 1 - sum(self.less2(self.bi[h, x]) for x in self.after[h]) / self.total[h]
        return left / (1 - sum(map(self.one, self.after[h]))) * self.one(w)

    def row(self, text):
        t = tokens(text)
        base = sum(math.log10((self.uni[w] + 0.5) / (self.n + 0.5 * (len(self.uni) + 1))) for w in t)
        return len(t), sum(w in self.uni for w in t), self.n, base, sum(math.log10(self.p(w, h)) for h, w in zip([None, *t], t, strict=False))


def check(found, rows, learn):
    model = Katz([t for i, t in rows if learn(i)])
    want = sorted(((i, None if i is None else not learn(i), *model.row(t)) for i, t in rows), key=repr)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (repr(r[0]), r[2], r[6])), sorted(want, key=lambda r: (repr(r[0]), r[2], r[6])), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return model


def by_fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def test_given_documents(spark, small, texts):
    found = katz.op12_katz(spark, small)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    model = check(found, list(texts.items()), by_fold)
    # every context's distribution sums to one, the unknown word included
    for h in [None, END, *list(model.after)[:40]]:
        assert sum(model.p(w, h) for w in [*model.uni, "never seen"]) == pytest.approx(1, abs=1e-9)
    held = found.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


@pytest.mark.parametrize("hot,parts", [(3, (1, 1)), (3, (4, 7)), (40, (3, 5)), (10**9, (2, 3))])
def test_salted_contexts_and_parts(spark, hot, parts, monkeypatch):
    monkeypatch.setattr(katz, "BATCH", 400)
    rng = random.Random(hot)
    words = [f"w{int(rng.paretovariate(0.9))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(katz.score(docs, F.col("doc_id") % 5 != 1, hot=hot, parts=parts), rows, lambda i: i % 5 != 1)


def test_a_word_that_is_always_followed_by_one_other(spark):
    rows = [(i, "a b a b a b a b a b") for i in range(40)] + [(100, "a c b z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(katz.score(docs, F.col("doc_id") < 100), rows, lambda i: i < 100)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(katz.score(odd, katz.fold("doc_id", 5) != 1), rows, by_fold)
    assert katz.score(none, katz.fold("doc_id", 5) != 1).collect() == []
    alone = katz.score(odd, F.lit(False)).collect()  # nothing to learn from
    assert {(r.n_known, r.train_tokens, r.score, r.base_score) for r in alone} == {(0, 0, 0.0, 0.0)}


def test_arrays_survive_packing():
    rng = np.random.default_rng(1)
    arrays = [np.zeros(0, np.int64), np.array([0]), rng.integers(0, 300, 1000), rng.integers(0, 2**63, 77).astype(np.uint64) * np.uint64(2)]
    for a, b in zip(arrays, katz.unbundle(katz.bundle(*arrays)), strict=True):
        assert a.astype(np.uint64).tolist() == b.view(np.uint64).tolist()
