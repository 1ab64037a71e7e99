"""Rows without an id, and rows alike, in near copies, sets and mixture."""

from collections import Counter

from docketflow.llm import jaccard, mixing

WORDS = [f"w{i}" for i in range(60)]
A = " ".join(WORDS)
MIDDLE = " ".join([*WORDS[:-3], "x1", "x2", "x3"])
FAR = " ".join(["y1", "y2", "y3", *WORDS[3:-3], "x1", "x2", "x3"])
ROWS = [
    (1, A), (None, A), (None, "an unrelated text without an id that nobody else has"), (None, "a second text without an id, also all alone here"),
    (2, FAR), (None, MIDDLE), (3, "some text of a third document alone"), (None, None),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")


def test_rows_without_ids(spark):
    import corpus_pipeline
    from test_exact import components, got_components

    docs = frame(spark, ROWS)
    assert got_components(jaccard.join(docs)) == components(ROWS)
    assert {r.component_id for r in jaccard.join(docs).filter("doc_id IN (1, 2)").collect()} == {1}  # the row without an id is the bridge
    kept = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    assert kept == sorted((i or 0, t or "") for i, t in [ROWS[0], ROWS[2], ROWS[3], ROWS[6], ROWS[7]])


def test_mixture_of_rows_without_ids(spark):
    import corpus_pipeline

    rows = [(None, f"text number {k} of no id") for k in range(6)] + [(9, "one text"), (9, "another text of the same id"), (None, "same"), (None, "same")]
    docs = frame(spark, rows)
    want = sorted(round(r.taken / r.size) for r in mixing.schedule(docs).collect() if round(r.taken / r.size))
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixture(spark, docs, "").collect())
    assert sum(got.values()) == sum(want) and set(got) <= set(rows) and (None, "text number 0 of no id") in got
