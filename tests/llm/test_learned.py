"""Classifiers on held-out rows, their small parts by brute force, awkward rows, and the pipeline."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketflow.llm import common, language, quality, toxicity
from docketflow.llm.common import buffers

MID = "/root/testdata/sf0.1"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        ranks[s == v] = ranks[s == v].mean()
    p = y.sum()
    return (ranks[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def held(spark, rows, label):
    got = rows.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").filter("held_out").collect()
    return np.array([r[label] for r in got]), np.array([r.score for r in got]), np.array([r.predicted for r in got])


def test_toxicity_held_out(spark):
    y, s, p = held(spark, toxicity.op9_toxicity(spark, MID), "toxic")
    assert auc(y, s) > 0.93 and (p[y == 0] == 0).mean() > 0.99 and (p[y == 1] == 1).mean() > 0.75


def test_quality_held_out(spark):
    y, s, p = held(spark, quality.op5_quality(spark, MID), "quality")
    assert auc(y, s) > 0.98 and (p == y).mean() > 0.97


def test_language_held_out(spark):
    got = language.op7_language(spark, MID).join(spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_folds_are_those_of_the_contract(spark):
    import zlib

    ids = [0, 1, 7, 12345678901]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select(common.fold("doc_id", 5)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in ids]


def test_marginals_by_all_labelings():
    rng = np.random.default_rng(0)
    row = np.array([0, 0, 0, 0, 1, 2, 2, 2])
    e, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    p, counts = quality.marginals(e, trans, row, pairs=True)
    want, expected = np.zeros(8), np.zeros((2, 2))
    for d in range(3):
        at = np.flatnonzero(row == d)
        total, bad, pairs = 0.0, np.zeros(len(at)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(at)):
            w = np.exp(sum(e[i] * v for i, v in zip(at, y, strict=True)) + sum(trans[a, b] for a, b in itertools.pairwise(y)))
            total += w
            bad += w * np.array(y)
            for a, b in itertools.pairwise(y):
                pairs[a, b] += w
        want[at] = bad / total
        expected += pairs / total
    assert np.allclose(p, want) and np.allclose(counts, expected)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.3).astype(int)
    good, noise = rng.random(4000) < np.where(y, 0.7, 0.05), rng.random(4000) < 0.2
    votes = np.column_stack([good, good, noise, rng.random(4000) < np.where(y, 0.5, 0.1)])
    known = np.where(rng.random(4000) < 0.2, y, -1)
    p, rates, voice = toxicity.label_model(votes, known)
    assert abs(rates[1, 0] - 0.7) < 0.07 and abs(rates[0, 0] - 0.05) < 0.04
    assert voice[0] < 0.6 < voice[2]
    assert ((p > 0.5) == y).mean() > 0.85


def test_mixtures_against_all_subsets():
    """Plain expectation-maximisation over every subset of languages, by the penalised likelihood."""
    rng = np.random.default_rng(4)
    words = {x: ["".join(rng.choice(list(a), 5)) for _ in range(60)] for x, a in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "ijklmno"))}
    names = sorted(words)
    table = np.full((3, language.BUCKETS), 0.5)
    for k, x in enumerate(names):
        np.add.at(table[k], language.trigrams(*buffers(pa.array([" ".join(words[x])])))[0], 1)
    model = {"names": names, "logp": np.log(table / table.sum(1, keepdims=True)).T}
    agree, off = [], []
    for _ in range(60):
        mix = rng.dirichlet([0.4, 0.4, 0.4])
        text = " ".join(rng.choice(words[names[rng.choice(3, p=mix)]]) for _ in range(int(rng.integers(4, 40))))
        bucket, _, starts = language.trigrams(*buffers(pa.array([text])))
        ll = np.add.reduceat(model["logp"][bucket], starts, axis=0)
        found = []
        for some in ([0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]):
            pi = np.full(len(some), 1 / len(some))
            for _ in range(300):
                w = np.exp(ll[:, some] - ll[:, some].max(1, keepdims=True)) * pi
                pi = (w / w.sum(1, keepdims=True)).mean(0)
            top = ll[:, some].max(1, keepdims=True)
            total = (np.log((np.exp(ll[:, some] - top) * pi).sum(1)) + top[:, 0]).sum() - 0.5 * np.log(len(ll) + 1) * len(some)
            found.append((total, some[int(pi.argmax())], pi.max()))
        _, want, share = max(found)
        best, got = language.infer(*buffers(pa.array([text])), model)
        agree.append(best[0] == want)
        off.append(abs(got[0] - share))
    assert np.mean(agree) >= 0.95 and np.median(off) < 0.03


def test_posteriors_by_bayes():
    """The label model's posteriors are those that its own accuracies give, row by row, by both hypotheses written out."""
    rng = np.random.default_rng(6)
    truth = rng.random(400) < 0.3
    votes = np.column_stack([rng.random(400) < np.where(truth, a, b) for a, b in ((0.8, 0.1), (0.6, 0.05), (0.9, 0.4))]).astype(int)
    known = np.where(rng.random(400) < 0.3, truth, -1).astype(int)
    p, rates, voice = toxicity.label_model(votes, known, rounds=200)
    prior = p.mean()
    for v, k, got in zip(votes, known, p, strict=True):
        if k < 0:
            weigh = lambda c: math.prod((rates[c][j] if v[j] else 1 - rates[c][j]) ** voice[j] for j in range(3))  # noqa: E731, B023
            want = prior * weigh(1) / (prior * weigh(1) + (1 - prior) * weigh(0))
            assert abs(got - want) < 0.02
    assert p[known == 1].min() > 0.5 > p[known == 0].max()


def test_language_mixtures(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    model = language.fit(docs)
    by = {r.lang: r.t for r in docs.filter("n_chars between 800 and 3000").groupBy("lang").agg({"text": "first"}).toDF("lang", "t").collect()}
    mixed = by["en"] + " " + by["fr"][: len(by["en"]) // 3]
    texts = pa.array([by["de"], mixed, "", "12 34", "é"], pa.large_string())
    best, share = language.infer(*common.buffers(texts), model)
    assert model["names"][best[0]] == "de" and share[0] > 0.97
    assert model["names"][best[1]] == "en" and 0.55 < share[1] < 0.9
    assert best[2] == best[3] == -1 and best[4] >= 0


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_awkward_rows(spark, request, kind):
    docs = request.getfixturevalue(kind)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1), (7, 0, 1), (10, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    base = docs  # has a column called score
    n = docs.count()
    for model in (toxicity.fit(base, labels), toxicity.fit(base, labels.limit(0))):
        got = toxicity.score(base, model).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    for model in (quality.fit(docs, labels), quality.fit(docs, labels.limit(0))):
        got = quality.score(docs, model).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    got = language.predict(base, language.fit(base)).collect()
    assert len(got) == n
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)


def test_pipeline_of_odd_rows(spark, odd, none, small):
    import corpus_pipeline

    extra = ["copies", "toxicity", "language", "share", "number", "n", "copy", "row", "stays", "alike", "words", "size", "_copies", "_toxicity", "_language", "_share"]
    for docs in (odd, none):
        docs = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(extra)])
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = common.written(stage(spark, docs, small), name)
            assert name == "packing" or docs.columns == columns
            assert name == "packing" or all(tuple(r) == tuple(range(len(extra))) for r in docs.select(*extra).collect())
    kept = corpus_pipeline.near_copies(spark, odd, small).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, i) for i in (1, 4, 5, 6, 7, 9, 10, 12, 12, 13)] + [(True, 0)]


def test_pipeline(spark, small):
    import corpus_pipeline
    from test_exact import components, packing_ok

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.written(stage(spark, docs, small), name)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r.doc_id for r in seen["toxicity"][1].collect()}
    clean = [i for i, r in labels.items() if not r.toxic]
    assert sum(i in kept for i in clean) / len(clean) > 0.98
    before, after = seen["near_copies"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in components(rows)})
    before, after = seen["mixture"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    words = lambda df: df.selectExpr("sum(size(filter(split(text, ' '), x -> x <> ''))) AS n").first().n
    assert 1.3 < words(after) / words(before) < 1.7
    packing_ok(seen["packing"][1].collect(), [(r.doc_id, r.text) for r in after.collect()])
    assert corpus_pipeline.run(spark, small).count() == seen["packing"][1].count()


def test_stages_hand_few_texts_to_python(spark, small):
    import corpus_pipeline
    from docketflow.llm import packing

    whole = spark.conf.get(packing.BATCH_BYTES)
    try:
        corpus_pipeline.languages(spark, spark.read.parquet(f"{small}/documents.parquet"), small)
        assert spark.conf.get(packing.BATCH_BYTES) == "4m" != whole
    finally:
        spark.conf.set(packing.BATCH_BYTES, whole)
