"""Joins of texts with long lists against all pairs."""

import random

import pytest

from docketflow.operators import lexicon, overlap


def test_texts_keep_the_fingerprints_of_what_they_contain(monkeypatch):
    rng = random.Random(1)
    for g in overlap.GRAMS:
        for _ in range(60):
            text = bytes(rng.choice(b"ab c") for _ in range(rng.randint(2 * g, 400)))
            lo = rng.randint(0, len(text) - 2 * g)
            part = text[lo : rng.randint(lo + 2 * g, len(text))]
            assert set(overlap.kept(part, g)) <= set(overlap.kept(text, g))
            assert len(overlap.kept(part, g))
    data = bytes(rng.randrange(256) for _ in range(5000))
    whole = {g: overlap.kept(data, g).tolist() for g in overlap.GRAMS}
    monkeypatch.setattr(overlap, "PIECE", 100)
    assert {g: overlap.kept(data, g).tolist() for g in overlap.GRAMS} == whole
    assert [overlap.anchor(b"x" * n) and overlap.anchor(b"x" * n)[0] for n in (7, 8, 15, 16, 31, 32, 100)] == [None, 4, 4, 8, 8, 16, 16]


@pytest.mark.parametrize("few", [0, 200])
def test_long_lists_of_short_strings(spark, monkeypatch, few):
    """Strings of all lengths, some of one word, some inside words, some of letters of several bytes."""
    monkeypatch.setattr(lexicon, "FEW", few)
    rng = random.Random(2)
    words = ["law", "clean", "é", "Straße", "water", "actuary", "of", "the", "statute", "😀", "aaaaaaaaaaaa"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)] + ["", None, "a" * 50, "x" * 3000 + "needle in a very long text of one kind" + "y" * 3000]
    strings = ["law", "é", "aa", "aaaaaaaa", "a" * 40, "needle", "needle in a very long text of one kind", "x" * 64, "never said anywhere at all", "ße water", "😀 😀", "", None, "law"]
    for _ in range(120):
        t = rng.choice(texts[:60])
        if t:
            lo = rng.randrange(len(t))
            strings.append(t[lo : lo + rng.randint(1, 50)])
    docs = spark.createDataFrame([(k, 0, t) for k, t in enumerate(texts)], "id int, official_ int, text string")
    got = lexicon.contained(docs, spark.createDataFrame([(s,) for s in strings], "official string"))
    assert got.columns == ["id", "official_", "text", "official"]
    want = {(k, s) for k, t in enumerate(texts) for s in strings if t and s and s in t}
    rows = [(r.id, r.official) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


@pytest.mark.parametrize("least", [1, 2, 4])
def test_best_overlap_against_all_pairs(spark, least):
    rng = random.Random(least)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (1 + k) for k in range(60)]
    texts = [(k, sorted(set(rng.choices(vocabulary, weights, k=rng.randint(0, 40))))) for k in range(150)] + [(500, None), (501, ["none of them"])]
    anchors = [(k, sorted(set(rng.choices(vocabulary, weights, k=rng.randint(0, 25))))) for k in range(40)] + [(90, ["w1", "w2", "w3", "w4"]), (91, ["w1", "w2", "w3", "w4"]), (92, None), (93, ["unheard of"])]
    got = overlap.best_overlap(spark.createDataFrame(texts, "id int, words array<string>"), spark.createDataFrame(anchors, "item int, words array<string>"), least)
    want = {}
    for k, t in texts:
        score, item = max(((len(set(t or ()) & set(a or ())), -i) for i, a in anchors))
        if score >= least:
            want[k] = (-item, score)
    assert {r.id: (r.item, r.score) for r in got.collect()} == want


def test_best_overlap_of_nothing(spark):
    none = spark.createDataFrame([], "item int, words array<string>")
    texts = spark.createDataFrame([(1, ["a"])], "id int, words array<string>")
    assert overlap.best_overlap(texts, none).collect() == []
    assert overlap.best_overlap(spark.createDataFrame([], "id int, words array<string>"), none).columns == ["id", "item", "score"]
