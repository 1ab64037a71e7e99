"""Queries over whole tables and whole texts against brute force."""

import re

from docketflow.plans import whole

FILL = "x " * 300
TEXTS = [(0, "UNITED STATES COURT RULES\nbody", "en", "src1"), (1, "plain words " + FILL, "de", "src2"), (2, FILL + "quantum flags harbor", "es", "src0"), (3, "AVISO DE LA CORTE\n", "es", "src3"), (4, "CARTA DE LA CORTE\n", "es", "src3")]


def tables(spark, path):
    spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, lang, s in TEXTS], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, "quantum harbor lights"), (8, "plain words only")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    html = f"<p>{FILL}</p>"
    pages = [html, html + "<p>more</p>", html + "<b><p>more</p>", html + "<b><p>more</p>", html + "<b><p>less</p>"]
    spark.createDataFrame([(i + 4, "http://h/1", t) for i, t in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path)


def test_whole_texts_and_tables(spark, tmp_path):
    d = tables(spark, tmp_path / "t")
    run = lambda name: whole.Q[name][0](spark, d).collect()
    assert sorted(r.doc_id for r in run("reply_keys_difference")) == [0, 2, 3, 4]
    words = lambda t: set(re.findall("[a-z]{5,}", t.lower()))
    items = {7: "quantum harbor lights", 8: "plain words only"}
    want = {(i, *max((len(words(t) & words(v)), -k) for k, v in items.items())) for i, t, _, _ in TEXTS}
    assert {(r.doc_id, r.score, -r.item_id) for r in run("best_word_overlap")} == {w for w in want if w[1] >= 2} != set()
    titles = {r.doc_id: r.title for r in run("title_chain")}
    assert set(titles) == {0, 1, 2, 3, 4} and titles[3] == "Granule 3"
    assert titles[4] != "CARTA DE LA CORTE" == titles[4].upper()  # re-cased
    assert {r.key: r.answer for r in run("model_batches")} == {str(i): " ".join(t.split()[:10]) for i, t, _, _ in TEXTS}
    assert [r.kind for r in sorted(run("change_kind"), key=lambda r: r.id)] == ["new", "modified", "bytes_changed", "unchanged", "modified"]
