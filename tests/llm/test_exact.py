"""Operators with exact contracts against brute force: fingerprints, licences, packing, joins, mixing, media, HTML."""

import glob
import hashlib
import html as entities
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from docketflow.llm import common, fingerprints, html, jaccard, licences, media, mixing, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(rows):
    """component by position for [(doc_id, text)], by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_size = sorted((i for i in range(len(rows)) if sets[i]), key=lambda i: len(sets[i]))
    for n, i in enumerate(by_size):
        for j in by_size[n + 1 :]:
            if 100 * len(sets[i]) < 80 * len(sets[j]):
                break
            o = len(sets[i] & sets[j])
            if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                root[find(j)] = find(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    low = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in groups.items()}
    return sorted((rows[i][0] if rows[i][0] is not None else -1, len(sets[i]), -1 if (c := low[find(i)]) is None else c) for i in range(len(rows)))


def got_components(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in df.collect())


# --- 1 ---


def edited_texts(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()))
    return out


def test_edited_texts_and_likeness(spark, small, texts):
    got = fingerprints.op1_fingerprints(spark, small).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(edited_texts(list(texts.items())))
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert np.mean([r.near_edited - r.near_next for r in got]) > 0.4
    same = defaultdict(set)
    for r in got:
        same[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_fingerprints_of_odd_rows(odd, none):
    from llm_rows import ROWS

    got = fingerprints.edited(odd, blocks=3).collect()
    key = lambda x: (x[0] if x[0] is not None else -1, x[1], x[2])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(edited_texts([(i, t) for i, t, _, _ in ROWS]), key=key)
    assert fingerprints.edited(none).count() == 0
    assert fingerprints.fingerprints(none).count() == 0


def test_small_edits_keep_fingerprints_alike():
    rng = np.random.default_rng(1)
    base = rng.integers(97, 123, 4000).astype(np.uint32)
    changed = np.delete(np.insert(base, 700, 120), 2500)
    other = rng.integers(97, 123, 4000).astype(np.uint32)
    off = np.array([0, 4000, 4000 + len(changed), 8000 + len(changed)])
    s = fingerprints.walk(*fingerprints.marked(np.concatenate([base, changed, other]), off))
    near = fingerprints.likeness(s[:, [0, 0]], s[:, [1, 2]])
    assert near[0] > 0.8 and near[1] < 0.2


def test_near_duplicates_by_bands(spark, odd, none):
    rng = np.random.default_rng(5)
    rows, group = [], {}
    for g in range(12):
        base = "".join(rng.choice(list("abcdefghij klmnop"), int(rng.integers(150, 6000))))
        for _ in range(4):
            t = list(base)
            for _ in range(len(t) // 400):
                t[int(rng.integers(len(t)))] = "Z"
            group[len(rows)] = g
            rows.append((len(rows), "".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(docs).collect()}
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    near = [(i, j) for i in group for j in group if i < j and fingerprints.alike(prints[i], prints[j]) >= 0.8]
    assert len(near) > 20 and np.mean([got[i] == got[j] for i, j in near]) > 0.95  # against all pairs
    assert all(group[got[i]] == g for i, g in group.items())
    assert fingerprints.near_duplicates(odd).count() == odd.count()
    assert fingerprints.near_duplicates(none).count() == 0


def test_recall_against_edit_rates(spark):
    """Pairs of texts by the rate of their edits: what the classes find of them, and that they join nothing else."""
    rng = np.random.default_rng(8)
    letters = list("etaoinshrdlucmfw      ")
    rows, base_of, rates = [], {}, {}
    for _ in range(40):
        base = list(rng.choice(letters, int(rng.integers(150, 3000))))
        first = len(rows)
        rows.append("".join(base))
        for rate in (0.0025, 0.005, 0.01):
            t = list(base)
            for _ in range(max(1, int(rate * len(base)))):
                k, how = int(rng.integers(len(t))), rng.random()
                t[k : k + (how < 0.67)] = [] if how < 0.33 else [str(rng.choice(letters))]
            base_of[len(rows)], rates[len(rows)] = first, rate
            rows.append("".join(t))
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    recall = {x: float(np.mean([got[i] == got[b] for i, b in base_of.items() if rates[i] == x])) for x in (0.0025, 0.005, 0.01)}
    assert recall[0.0025] >= 0.95 and recall[0.005] >= 0.9 and recall[0.01] >= 0.9, recall
    assert all(got[i] // 4 == i // 4 for i in got)


@pytest.mark.parametrize("length", [5_000, 10_000, 20_000, 30_000])
def test_recall_of_long_texts(spark, length):
    """Pairs at 1 % edits, and texts that share a third of their blocks with another and stay apart."""
    rng = np.random.default_rng(length)
    words = ["".join(rng.choice(list("etaoinshrdlu"), int(rng.integers(2, 10)))) for _ in range(4000)]
    rows = []
    for _ in range(24):
        base = list(" ".join(rng.choice(words, length // 6))[:length])
        t = list(base)
        for _ in range(length // 100):
            k, how = int(rng.integers(len(t))), rng.random()
            t[k : k + (how < 0.67)] = [] if how < 0.33 else [str(rng.choice(list("etaoinshrdlu ")))]
        third = base[: length // 3] + list(" ".join(rng.choice(words, length // 6))[: 2 * length // 3])
        rows += ["".join(base), "".join(t), "".join(third)]
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert np.mean([got[k] == got[k + 1] for k in range(0, len(rows), 3)]) >= 0.9
    assert all(got[k] // 3 == k // 3 for k in got) and all(got[k] == k for k in range(2, len(rows), 3))


def test_cuts_follow_the_text():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 64, 60_000).astype(np.uint8)
    ends = fingerprints.cuts(codes)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(codes) and sizes[:-1].min() >= fingerprints.SHORTEST and sizes.max() <= fingerprints.LONGEST
    moved = [e - 7 for e in fingerprints.cuts(np.concatenate([rng.integers(0, 64, 7).astype(np.uint8), codes]))]
    assert len({*ends} & {*moved}) > 0.9 * len(ends)
    assert fingerprints.cuts(codes[:0]) == [0] and fingerprints.cuts(codes[:3]) == [3]


def test_lone_keys_are_not_kept(spark, monkeypatch):
    """Most keys of a fingerprint are one text's alone: no table holds them (64 a text and walk), and walks settled one by one link alike."""
    rng = np.random.default_rng(21)
    rows = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 900)) for _ in range(40)]
    rows += [rows[k][:450] + "Z" + rows[k][450:] for k in range(0, 40, 4)]
    docs = spark.createDataFrame(list(enumerate(rows)), "node long, text string").repartition(1)
    prints = fingerprints.written(fingerprints.several(docs, 2, ["node"]), "lone")
    sizes, write = {}, fingerprints.written

    def counted(df, name):
        out = write(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(fingerprints, "written", counted)
    for many in (fingerprints.MANY, 0):
        monkeypatch.setattr(fingerprints, "MANY", many)
        links = fingerprints.linked(prints, [fingerprints.bands(prints, 0.6, w) for w in range(2)], 0.6, 24, 2048, fingerprints.ByWalks, "lone")
        assert {tuple(sorted(r)) for r in links.collect()} == {((i - 40) * 4, i) for i in range(40, 50)}
    assert max(sizes.values()) < 64 * 2 * 20, sizes


def test_pairs_are_verified_in_slices(spark):
    text = spark.createDataFrame([(i, ["abcdefgh"[i % 4] * 64]) for i in range(12)], "node long, prints array<string>")
    pairs = spark.createDataFrame([(i, j) for i in range(12) for j in range(i + 1, 12)], "a long, b long")
    tables = fingerprints.verified(pairs, text, 0.6, fingerprints.ByWalks, "slices", 20)
    assert len(tables) == 4 and sorted(tuple(r) for t in tables for r in t.collect()) == [(i, j) for i in range(12) for j in range(i + 4, 12, 4)]


def test_walks_gone_together_are_those_gone_alone():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("abcd é"), n)) for n in (0, 1, 40, 700, 9000)]
    at = fingerprints.marked(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, texts)]))
    alone = [fingerprints.strings(fingerprints.walk(*at, (w,))) for w in range(3)]
    assert fingerprints.prints_of(*at, 3).to_pylist() == [list(x) for x in zip(*alone, strict=True)]


def test_chance_meetings_are_not_written(spark, monkeypatch):
    """Texts of few letters meet at most keys: no table has more rows than there are texts, and the tiles' links join what all pairs that
    share a key and are alike do."""
    rng = np.random.default_rng(13)
    rows = ["".join(rng.choice(list("ab"), int(rng.integers(100, 900)))) for _ in range(150)]
    rows += ["".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 60)))) for _ in range(100)]
    rows += [t[: len(t) // 2] + "z" + t[len(t) // 2 :] for t in rows[::3]] + [t[: len(t) * 3 // 4] for t in rows[::5]]
    docs = spark.createDataFrame(list(enumerate(rows)), "node long, text string")
    prints = fingerprints.written(fingerprints.several(docs, 2, ["node"]), "chance")
    of, root, at, met = {r.node: r.prints for r in prints.collect()}, list(range(len(rows))), defaultdict(set), set()
    for r in fingerprints.bands(prints, 0.6, 0).union(fingerprints.bands(prints, 0.6, 1)).collect():
        met |= {(min(r.node, n), max(r.node, n)) for n in at[r.band] if n != r.node}
        at[r.band].add(r.node)
    met = sorted(met)
    for (a, b), near in zip(met, fingerprints.ByWalks.pairs([of[a] for a, _ in met], [of[b] for _, b in met]), strict=True):
        if near >= 0.6 and root[a] != root[b]:
            root = [root[a] if r == root[b] else r for r in root]
    classes = sorted(sorted(n for n in range(len(rows)) if root[n] == r) for r in set(root))
    assert len(met) > 5 * len(rows) and 20 < len(classes) < len(rows) - 50
    sizes, write = [], fingerprints.written

    def counted(df, name):
        out = write(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(fingerprints, "written", counted)
    for blocks, together in ((6, 50), (1, 1 << 20)):
        monkeypatch.setattr(fingerprints, "TILE", len(rows) * 2 * max(len(p[0]) for p in of.values()) // blocks)
        monkeypatch.setattr(fingerprints, "MET", together)
        links = fingerprints.by_tiles(prints, 0.6, "chance")
        part = {r.node: r.root for r in fingerprints.components(links, "chance-classes").collect()}
        assert sorted(sorted(n for n in range(len(rows)) if part.get(n, n) == r) for r in {part.get(n, n) for n in range(len(rows))}) == classes
    sizes.clear()
    fingerprints.near_duplicates(docs.withColumnRenamed("node", "doc_id"), walks=2).count()
    assert max(sizes) <= len(rows)


def test_near_duplicates_in_crowded_buckets(spark):
    """Thousands of unrelated texts of two letters share every bucket; pairs of near copies among them, long and short, are found as by all pairs."""
    rng = np.random.default_rng(11)
    rows = ["".join(rng.choice(list("ab"), int(rng.integers(150, 250)))) for _ in range(1500)]
    rows += ["".join(rng.choice(list("abcdefgh"), int(rng.integers(8, 30)))) for _ in range(1500)]
    for k in range(0, 3000, 15):
        t = list(rows[k])
        t[len(t) * 3 // 4] = "z"
        rows.append("".join(t))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(docs, least=0.8, walks=1).collect()}
    prints = [r.fingerprint for r in fingerprints.fingerprints(docs).orderBy("doc_id").collect()]
    m = fingerprints.matrix(prints)
    near = [(i, int(j) + i + 1) for i in range(len(rows) - 1) for j in np.flatnonzero(fingerprints.likeness(m[:, [i]], m[:, i + 1 :]) >= 0.8)]
    long = [(i, j) for i, j in near if min(len(prints[i]), len(prints[j])) >= 64]
    short = [(i, j) for i, j in near if min(len(prints[i]), len(prints[j])) < 64]
    assert len(long) > 50 and np.mean([got[i] == got[j] for i, j in long]) > 0.98
    assert len(short) > 50 and all(got[i] == got[j] for i, j in short)


# --- 2 ---


def notice_words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t)


def test_licences_against_containment(spark, small, texts):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {(r.doc_id, r.licence) for r in licences.scan(docs, best=False).collect()}
    want = set()
    for name, template in licences.TEMPLATES.items():
        w = notice_words(template)
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for i, t in texts.items():
            v = notice_words(t)
            if len(s & {tuple(v[i : i + 5]) for i in range(len(v) - 4)}) >= 0.8 * len(s):
                want.add((i, name))
    assert got == want
    best = {(r.doc_id, r.licence) for r in licences.op2_licences(spark, small).collect()}
    assert best <= want and {i for i, _ in best} == {i for i, _ in want}


def test_the_fullest_of_overlapping_notices(spark):
    t = licences.TEMPLATES
    texts = [t["MIT-text"], t["GPL-2.0-or-later"], t["AGPL-3.0-or-later"], t["BSD-3-Clause-text"], t["BSD-2-Clause-text"], t["Apache-2.0"] + " Now " + t["Apache-2.0-warranty"], f"{t['MIT']} only; then {t['GPL-3.0-or-later']}", t["MIT-line"] + " " + " ".join(f"y{k}" for k in range(30)) + " " + t["MIT-line"]]
    got = defaultdict(list)
    for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got[r.doc_id].append(r.licence)
    assert [sorted(got[k]) for k in range(len(texts))] == [["MIT-text"], ["GPL-2.0-or-later"], ["AGPL-3.0-or-later"], ["BSD-3-Clause-text"], ["BSD-2-Clause-text"], ["Apache-2.0", "Apache-2.0-warranty"], ["GPL-3.0-or-later", "MIT"], ["MIT-line", "MIT-line"]]


def test_long_notices_inside_long_texts(spark, none):
    filler = " ".join(f"x{i}" for i in range(3000))
    rows = [(k, f"{filler[: 37 * k]} {t} {filler}") for k, t in enumerate(licences.TEMPLATES.values())] + [(99, None), (98, ""), (97, filler)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), best=False).collect()
    assert {(k, n) for k, n in enumerate(licences.TEMPLATES)} <= {(r.doc_id, r.licence) for r in got}
    assert not {97, 98, 99} & {r.doc_id for r in got}
    texts = dict(rows)
    assert any("Permission is hereby granted" in texts[r.doc_id][r.start : r.end] for r in got)
    assert licences.scan(none).count() == 0


# --- 3 ---


def packing_ok(pieces, rows, limit=2048):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
    padding = 0
    for ps in by.values():
        ps.sort(key=lambda p: p.offset)
        assert [p.offset for p in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        total = sum(p.length for p in ps)
        assert 0 < total <= limit
        padding += 0 if total & (total - 1) == 0 else limit - total
    assert padding == 0
    assert sum(p.length for p in pieces) == sum(len(x) for v in ids.values() for x in v)
    for i, v in ids.items():
        if len(v) == 1:
            mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
            at = 0
            for p in mine:
                assert p.start == at and p.doc_tokens == len(v[0])
                assert p.ids_crc32 == zlib.crc32(v[0][at : at + p.length].tobytes())
                at += p.length
            assert at == len(v[0])


def test_packing(spark, small, texts):
    packing_ok(packing.op3_packing(spark, small).collect(), list(texts.items()))


def test_packing_of_odd_rows(odd, none):
    from llm_rows import ROWS

    packing_ok(packing.digest(packing.pack(odd, packing.default_tokenizer())).collect(), [(i, t) for i, t, _, _ in ROWS])
    assert packing.pack(none, packing.default_tokenizer()).count() == 0


def test_other_vocabularies_encode_whole_texts():
    from tokenizers import Tokenizer

    texts = ["Hello World, it's 12.5 °C  now", None, "", "Straße\n\nÄrger 😀 " * 5, "<|endoftext|> x"]
    paths = sorted(glob.glob("/opt/tokenizers/*.json"))
    assert packing.by_pieces(packing.default_tokenizer())
    tried = 0
    for path in paths:
        try:
            tok = Tokenizer.from_file(path)
        except Exception:
            continue  # not a vocabulary of this kind
        tried += not packing.by_pieces(path)
        assert packing.encode(texts, path) == [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert tried


def test_word_cache_gives_the_tokenizer_s_ids():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    cases = ["it's I'LL we've 'tis", "İstanbul ǰ J̌ ΣΑΣ", "a<|endoftext|>b", "½ ²x x² 3.14", "naïve—café x\x1cy", "日本語 text", "é É", "tabs\tand\r\nlines", "ªºµ DŽ ǆ"]
    for c, x in zip(cases, packing.encode(cases, packing.default_tokenizer()), strict=True):
        assert np.frombuffer(x, "<u4").tolist() == tok.encode(c, add_special_tokens=False).ids, c


def test_pieces_are_found_again_after_others_went():
    """Letters whose lower case lies beyond U+024F, apostrophes, a table that is thinned, and hashes that meet."""
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tok = Tokenizer.from_file(path)
    rng = np.random.default_rng(4)
    pool = ["x\u0181y", "\u023ab", "it's", "o'er'", "a|b", "<b>", "\xa0\x85", "3.14", "\xaa\xd7\xf7", *(f"w{x}é" for x in range(300))]
    packing.encode(["a"], path)
    for most in (40, 400_000):
        for _ in range(6):
            texts = [" ".join(rng.choice(pool, 30)) for _ in range(20)]
            assert packing.encode(texts, path, most) == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    pieces = packing.Pieces(tok, packing._TOKENIZERS[path][1].ends, 100)
    pieces.byte_hash[:] = 1  # pieces of one length have one hash
    assert pieces.encode([b"same", b"name same", b"other"])[::2] == [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("same", "other")]
    assert pieces.encode([b"name"]) == [None]


def test_kept_pieces_take_little_memory():
    words = ["".join(chr(97 + x // 26**k % 26) for k in range(4)) + "ings" for x in range(150_000)]
    packing.encode(["a"], packing.default_tokenizer())
    tracemalloc.start()
    try:
        for lo in range(0, len(words), 15_000):
            packing.encode([" ".join(words[lo : lo + 15_000])], packing.default_tokenizer())
        assert tracemalloc.get_traced_memory()[0] < 150_000 * 100
    finally:
        tracemalloc.stop()


def test_packing_hands_on_few_texts_at_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(packing, "written", lambda df, name: seen.append(spark.conf.get(packing.BATCH_BYTES)) or 1 / 0)
    before = spark.conf.get(packing.BATCH_BYTES)
    with pytest.raises(ZeroDivisionError):
        packing.pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), packing.default_tokenizer())
    assert seen == ["4m"] and spark.conf.get(packing.BATCH_BYTES) == before


def words_of(spark, n):
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, rng.integers(0, 150)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize(("limit", "grid"), [(64, 4), (48, 8), (2048, 16)])
def test_cuts_of_sequences_of_any_size(spark, limit, grid):
    rows, docs = words_of(spark, 120)
    pieces = packing.pack(docs, packing.default_tokenizer(), limit, grid)
    packing_ok(packing.digest(pieces).collect(), rows, limit)
    assert all(len(r.ids) == 4 * r.length for r in pieces.collect())


def test_packing_cuts_ids_without_python(spark):
    plan = packing.digest(packing.pack(words_of(spark, 20)[1], packing.default_tokenizer()))._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan


def test_packing_leaves_no_pieces_in_idle_workers(spark):
    def kept(batches):
        for b in batches:
            n = sum(len(p.key) for _, p in packing._TOKENIZERS.values() if p is not None)
            yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    packing.pack(words_of(spark, 200)[1], packing.default_tokenizer()).count()
    assert {r.n for r in spark.range(0, 64, 1, 16).mapInArrow(kept, "n long").collect()} == {0}


def test_tasks_give_memory_back(monkeypatch):
    """After each batch handed in and at the end, when the task's own arrays are gone."""
    batches, gone, said = [pa.RecordBatch.from_arrays([pa.array([k])], ["k"]) for k in range(3)], [], []

    class Big:
        def __del__(self):
            gone.append(1)

    def run(batches):
        big = Big()
        for b in batches:
            yield b
        assert big

    monkeypatch.setattr(common, "give_back", lambda: said.append(len(gone)))
    assert [b.column(0)[0].as_py() for b in common.tidy(run)(iter(batches))] == [0, 1, 2]
    assert said == [0, 0, 0, 1]
    monkeypatch.undo()
    common.give_back()


def test_columns_are_priced_right():
    rng = np.random.default_rng(3)
    demand = rng.integers(0, 60, 31)
    patterns, x = packing.solve(demand, 32)
    sizes = np.arange(1, 32)
    assert (patterns @ sizes <= 32).all() and (x >= -1e-9).all()
    assert (x @ patterns >= demand - 1e-6).all()
    assert x.sum() >= (demand * sizes).sum() / 32 - 1e-6


# --- 4 ---


def test_jaccard_against_all_pairs(spark, small, texts):
    assert got_components(jaccard.op4_jaccard(spark, small)) == components(list(texts.items()))


def test_jaccard_index_keeps_each_shared_row_once():
    """Rows of a bucket against brute force; rows come back from packing in full."""
    rng = np.random.default_rng(2)
    key, node, tag = rng.integers(0, 300, 900), rng.integers(1, 5, 900), rng.integers(0, 4, 900)
    tag[rng.random(900) < 0.05] = -1
    tag = np.where((rng.random(900) < 0.05) & (tag >= 0), tag | jaccard.DEALT, tag)
    batch = jaccard._packed([(jaccard.bucket_of(key[:400], 7), key[:400], node[:400], tag[:400]), (jaccard.bucket_of(key[400:], 7), key[400:], node[400:], tag[400:])])
    back = [np.frombuffer(b"".join(batch[x].to_pylist()), np.int64) for x in ("keys", "nodes", "tags")]
    assert sorted(zip(*(x.tolist() for x in back), strict=True)) == sorted(zip(key.tolist(), node.tolist(), tag.tolist(), strict=True))
    far = [(k, n, t - jaccard.DEALT, 0, 0, True) for k, n, t in zip(key.tolist(), node.tolist(), tag.tolist(), strict=True) if t >= jaccard.DEALT]
    near = defaultdict(set)
    for k, n, t in zip(key.tolist(), node.tolist(), tag.tolist(), strict=True):
        if t < jaccard.DEALT:
            near[k].add((n, t))
    want = list(far)
    for k, rows in near.items():
        real, part = [(n, t) for n, t in rows if t >= 0], any(t < 0 for _, t in rows)
        n0 = sum(t % 2 == 0 for _, t in real)
        if part or (len({n for n, _ in real}) > 1 and n0):
            want += [(k, n, t, 0 if part else n0, 0 if part else len(real) - n0, part) for n, t in real]
    assert sorted(zip(*(x.tolist() for x in jaccard.shared_rows(*back)), strict=True)) == sorted(want)
    assert [len(x) for x in jaccard.shared_rows(*[np.zeros(0, np.int64)] * 3)] == [0] * 6


def test_jaccard_of_odd_rows(odd, none):
    from llm_rows import ROWS

    assert got_components(jaccard.join(odd)) == components([(i, t) for i, t, _, _ in ROWS])
    assert jaccard.join(none).count() == 0


@pytest.mark.parametrize("seed", [1])
def test_jaccard_of_many_near_copies(spark, seed, monkeypatch):
    """Chains and hubs of edited texts of all sizes, at and around the border."""
    rng = np.random.default_rng(seed)
    rows = []
    for size in (5, 6, 8, 9, 12, 20, 40, 70, 150, 300):
        base = [f"v{x}" for x in rng.integers(0, 10**6, size)]
        rows.append(" ".join(base))
        for _ in range(12):
            edit = list(base)
            for _ in range(rng.integers(0, max(2, size // 25) + 1)):
                k = rng.integers(0, len(edit))
                if rng.random() < 0.4:
                    edit[k] = f"e{rng.integers(0, 10**6)}"
                elif rng.random() < 0.5:
                    edit.insert(0, f"p{rng.integers(0, 10**6)}")
                else:
                    edit.append(f"s{rng.integers(0, 10**6)}")
            rows.append(" ".join(edit))
            if rng.random() < 0.5:
                base = edit
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows, strict=True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_components(jaccard.join(docs)) == components(rows)
    for hubs, crowd, block, often in ((0, 2, 200, 1), (1, 8, 10**6, 0)):  # compared in blocks, without hubs, with salted segments
        monkeypatch.setattr(jaccard, "HUBS", hubs)
        monkeypatch.setattr(jaccard, "OFTEN", often)
        assert got_components(jaccard.join(docs, crowd=crowd, block=block)) == components(rows)


def test_jaccard_of_texts_around_one_passage(spark):
    """A passage that most of every text is, with pairs just over and under the border, and a chain of texts."""
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, f"{passage} " + " ".join(f"t{k // 2}x{j}" if j > k % 2 else f"u{k}x{j}" for j in range(9))) for k in range(150)]
    rows += [(1000 + k, " ".join(f"c{j}" for j in range(k, k + 60))) for k in range(0, 150, 3)]
    rows = [(i if i % 7 else None, t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = got_components(jaccard.join(docs, crowd=4, block=500))
    assert got == components(rows) and 1 < len({c for _, _, c in got}) < 140


def test_components_of_paths_and_stars(spark):
    rng = np.random.default_rng(3)
    name = rng.permutation(400)
    edges = [(int(name[k]), int(name[k + 1])) for k in range(0, 199)] + [(int(name[200]), int(name[k])) for k in range(201, 260)] + [(int(name[k]), int(name[k])) for k in (300, 301)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {int(x): int(name[:200].min()) for x in name[:200]} | {int(x): int(name[200:260].min()) for x in name[200:260]}
    assert got == want
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 6 ---


def test_mixing_against_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(con.sql(mixing.OP6).fetchall())
    got = sorted(tuple(r) for r in mixing.op6_mixing(spark, small).collect())
    assert got == want
    taken, target = Counter(), {}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for i, size, source_size, t, k in got:
        assert 0 <= k <= 2 * size and t <= 2 * source_size
        taken[source[i]] += k
        target[source[i]] = t
    assert all(abs(taken[s] - t) < 1 for s, t in target.items())


def test_mixing_of_odd_rows(odd, none):
    got = mixing.schedule(odd).collect()
    assert len(got) == odd.count() and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.schedule(none).count() == 0


# --- 8 ---


def test_media_round_trip(spark, small, texts, odd, none):
    for r in media.op8_media(spark, small).collect():
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == media.expected(texts[r.doc_id])
    for r in media.media(odd).collect():
        assert r.bad_checksums == 0 and r.skipped == 0 and r.frames == r.table_frames == len(r.seek_offsets)
    assert media.media(none).count() == 0


def test_damaged_audio_is_resynchronised():
    payload, _ = media.padded("some words of text " * 500)
    good = media.frames(payload)
    p = media.parse(good)
    assert p.payload == payload and p.samples == 1152 * p.frames and (p.table.kind, p.table.frames, p.table.bytes) == ("Xing", p.frames, len(good) - 10 - int.from_bytes(good[6:10], "big"))
    assert len(p.table.toc) == 100 and p.table.toc == sorted(p.table.toc) and p.layers == {3} and p.offsets[0] > 10
    cut = p.offsets[2] + 100
    broken = media.parse(good[:cut] + b"\xff\xfb noise \xff\xe2" + good[cut:])
    assert broken.skipped > 0 and broken.frames >= p.frames - 1
    flipped = bytearray(good)
    flipped[p.offsets[1] + 8] ^= 1
    assert media.parse(bytes(flipped)).bad_checksums == 1
    assert media.parse(b"").frames == 0 and media.parse(b"junk" * 50).payload == b""
    rng = np.random.default_rng(2)
    for k in range(0, len(good), 37):  # cut anywhere, and with bytes changed anywhere: read without an error
        assert media.parse(good[:k]).frames <= p.frames
        changed = bytearray(good)
        for at in rng.integers(0, len(good), 5):
            changed[at] = int(rng.integers(256))
        media.parse(bytes(changed))


def stream(head, length, mark=b"", at=4, n=3):
    """Frames of a given header and length, the first with a mark at a place."""
    first = bytearray(head.ljust(length, b"\0"))
    first[at : at + len(mark)] = mark
    return bytes(first[:length]) + head.ljust(length, b"\0") * n


def test_tables_of_every_kind():
    head = b"\xff\xfb\x90\xc0"  # MPEG-1 Layer III, 128 kbit/s, 44100 Hz, mono: 417 bytes
    field_of = {1: (7).to_bytes(4, "big"), 2: (12345).to_bytes(4, "big"), 4: bytes(range(100)), 8: (50).to_bytes(4, "big")}
    for flags in range(16):
        mark = b"Xing" + flags.to_bytes(4, "big") + b"".join(v for k, v in field_of.items() if flags & k)
        t = media.parse(stream(head, 417, mark, 21)).table
        assert (t.kind, t.frames, t.bytes, t.toc, t.quality) == ("Xing", 7 if flags & 1 else None, 12345 if flags & 2 else None, list(range(100)) if flags & 4 else [], 50 if flags & 8 else None)
    for cut in range(21, 150):  # a short first frame ends anywhere in its table
        assert media.table((head + bytes(17) + b"Xing" + (15).to_bytes(4, "big") + b"".join(field_of.values()))[:cut], 17, 21) is not None or cut < 25
    vbri = b"VBRI" + b"\0\1" + b"\0\2" + (75).to_bytes(2, "big") + (12345).to_bytes(4, "big") + (7).to_bytes(4, "big") + (2).to_bytes(2, "big") + (10).to_bytes(2, "big") + (2).to_bytes(2, "big") + (1).to_bytes(2, "big") + (30).to_bytes(2, "big") + (40).to_bytes(2, "big")
    t = media.parse(stream(head, 417, vbri, 36)).table
    assert (t.kind, t.frames, t.bytes, t.quality, t.toc) == ("VBRI", 7, 12345, 75, [300, 400])
    assert all(media.table((head + bytes(32) + vbri)[:k], 17, 21) for k in range(40, 36 + len(vbri)))


def test_layers_and_tags():
    one = media.parse(stream(b"\xff\xff\x40\xc0", (12000 * 128 // 44100) * 4))
    assert (one.frames, one.samples, one.layers, one.rates) == (4, 4 * 384, {1}, {128: 4})
    two = media.parse(stream(b"\xff\xfc\x80\xc0", 144000 * 128 // 44100))
    assert (two.frames, two.samples, two.layers, two.unverified) == (4, 4 * 1152, {2}, 4)
    low = media.parse(stream(b"\xff\xf3\x80\xc0", 72000 * 64 // 22050))
    assert (low.frames, low.samples, low.hertz) == (4, 4 * 576, 22050)
    half = (b"\xff\xfe\x40\xc0" + b"\0\0").ljust((12000 * 128 // 44100) * 4, b"\0")
    good = half[:4] + media.crc16(half[2:4] + half[6:22]).to_bytes(2, "big") + half[6:]
    assert media.parse(good * 3).bad_checksums == 0 and media.parse(half * 3).bad_checksums == 3
    text = b"\3name\0" + "wört".encode() * 40
    for version, size in ((3, len(text).to_bytes(4, "big")), (4, bytes((0, 0, len(text) >> 7, len(text) & 127)))):
        frame = b"TXXX" + size + b"\0\0" + text
        tag = b"ID3" + bytes((version, 0, 0, 0, 0, len(frame) >> 7, len(frame) & 127)) + frame
        p = media.parse(tag + stream(b"\xff\xfb\x90\xc0", 417))
        assert p.tags == {"name": "wört" * 40} and p.frames == 4 and p.skipped == 0


# --- 10 ---


def article(page):
    a = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", a))
    return "\n".join(b for b in blocks if b)


def test_main_text(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = html.op10_html(spark, small).collect()
    assert {r.page_id: r.text for r in got} == {k: article(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<div class=wrap><h1>Head</h1><div class=inner><p>One long paragraph of the main text here.</p><p>Two long paragraphs of the main text here.</p></div></div><div class=sidebar><p>Side words that are many and long enough to matter here.</p></div>", "Head\nOne long paragraph of the main text here.\nTwo long paragraphs of the main text here."),
        ("<article><header><h1>Head</h1></header><section><p>A much longer first section, with a lot of words in it to win.</p></section><section><p>Short.</p></section></article><p>Loose notice</p>", "Head\nA much longer first section, with a lot of words in it to win.\nShort."),
        ("<main><p>Main words.</p><ul class=related-links><li>Other story</ul><blockquote>Quoted &lt;b&gt;.</blockquote><table><tr><td>a<td>b</table></main>", "Main words.\nQuoted <b>.\na\nb"),
        ("<p>Only   one&nbsp;paragraph<br>with a break.", "Only one paragraph with a break."),
        ("<div class=top><a href=x>Link one</a> <a href=y>Link two</a> <a href=z>Link three</a></div><div class=text><p>Real words, some of them.</p></div>", "Real words, some of them."),
    ],
)
def test_containers(body, want):
    assert html.extract(f"<html><body><nav>Menu</nav>{body}<footer>F</footer></body></html>", None) == want


@pytest.mark.parametrize("wrapper", ["<div class='layout has-sidebar'>", "<div class=no-sidebar>", "<div id=top class='comments-open'>", "<div class=ad-free>", "<form action=/>", "<div class='page has-header'>"])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_with_a_boilerplate_word(wrapper, inner):
    text = "Long words of the article that go on and on, " * 6
    page = f"<html><body>{wrapper}<{inner}><h1>Head</h1><p>{text}</p></{inner}><div class=sidebar><p>Side words.</p></div></div></form><p>Loose notice</p></body></html>"
    assert html.extract(page, None) == f"Head\n{text.strip()}"


def test_comments_longer_than_the_article_stay_out():
    page = "<body><article><p>A short article.</p></article><div class=comments><p>" + "Nice post, I have read it. " * 30 + "</p></div></body>"
    assert html.extract(page, None) == "A short article."
    assert html.extract("<body><div class='ad-free comments'><p>All there is.</p></div></body>", None) == "All there is."


@pytest.mark.parametrize("bad", ["<div>", "<b c ", "<p class='a", '<a b=">', "<b>", "</x>", "<li>x", "<! ", "<div class='c d e f g'><span>", "<a x=\"'><a y='\">", "<xmp>"])
def test_bad_pages_take_linear_time_and_memory(bad):
    page = "<body><article><p>The one real article.</p></article>" + bad * 30_000
    tracemalloc.start()
    began = time.process_time()
    html.extract(page, None)
    took, most = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 12 and most < 60 << 20  # tracing takes some ten times the time
    assert html.extract(page[:52] + bad * 20, None).startswith("The one real article.") or bad == "<p class='a"


def test_the_host_s_votes_decide(spark):
    """On one page a box holds more text than the article, which is at the place where other pages of the host have theirs."""
    page = lambda k, box: f"<html><body><div class='story s{k}'><h1>Head {k}</h1><p>{'Words of the story. ' * 9}</p></div><div class=box><p>{box}</p></div></body></html>"
    rows = [(k, f"http://h/{k}", page(k, "Short box.")) for k in range(4)] + [(9, "http://h/9", page(9, "A long box of words. " * 40)), (10, "http://other/1", page(10, "A long box of words. " * 40))]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.main_text(docs).collect()}
    assert got[9] == "Head 9\n" + ("Words of the story. " * 9).strip()  # its own best container is the box
    assert html.extract(rows[4][2], None) == got[10] == ("A long box of words. " * 40).strip()
    assert {r.host: r.votes for r in html.winners(docs).collect()} == {"h": 4, "other": 1}


@pytest.mark.parametrize("holder", ["article", "main", "div"])
@pytest.mark.parametrize(
    ("part", "kept"),
    [
        ('<p class="share-price">The share price fell by two.</p>', True), ('<p class="notice-board">On the notice board it says so.</p>', True), ('<h2 id="related-work">Related work</h2>', True), ('<h3 class="comments">Comments on the law</h3>', True),
        ('<ul class="social-issues"><li>Housing is one of them.</li></ul>', True), ('<section id="comments-on-the-law"><p>These are no reader comments.</p></section>', True),
        ('<div class="share-buttons"><a href=x>Share it</a></div>', False), ('<div class="ad">Buy this.</div>', False), ('<div class="relatedLinks"><a href=y>Another story</a></div>', False), ('<div class="post-comments"><p>Nice post!</p><p>Indeed.</p></div>', False),
    ],
)
def test_parts_of_an_article_by_their_classes(holder, part, kept):
    text = "Long words of the article that go on and on. " * 12
    page = f"<html><body><nav>Menu</nav><{holder} class=story><h1>Head</h1><p>{text}</p>{part}<p>{text}</p></{holder}><footer>F</footer></body></html>"
    inner = re.sub("<[^>]*>", "", part)
    assert html.extract(page, None) == "\n".join(["Head", text.strip(), *([inner] if kept else []), text.strip()])


def test_an_article_elsewhere_than_the_host_s_path(spark):
    """On the last page the host's place holds a teaser of 13 characters and another one the article."""
    text = "Words of the whole article, and more of them. " * 18
    usual = lambda k: f"<html><body><div class=content><h1>Head {k}</h1><p>{text}</p></div></body></html>"
    odd = f"<html><body><div class=content><p>Short teaser.</p></div><div class=story><p>{text}</p></div></body></html>"
    rows = [(k, f"http://h/{k}", usual(k)) for k in range(3)] + [(9, "http://h/9", odd)]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == text.strip() and got[0] == f"Head 0\n{text.strip()}"


def test_classes_beyond_the_fourth_tell_paths_apart():
    one, two = (html.parse(f"<div class='a b c d {x}'>t</div>")[1].path[1] for x in "ef")
    assert one != two and html.parse("<div class='d c b a e'>t</div>")[1].path[1] == one


def test_pages_of_other_kinds(spark):
    page = """<html><body><header>Site</header><div id="main-content"><div class="sidebar">Links</div><h2>Title &amp; more</h2>
    <p>First   para<b>graph</b> with enough words to be the main text.<p>Second one.<div class="comments"><p>Nice post!</div>
    <form><p>Subscribe</form><script>var x = "<p>no</p>";</script></div><aside>Aside</aside><footer>Foot</footer>"""
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, None, ""), (4, "nonsense", "just text"), (5, "http://h/1", page), (6, "http://h/3", "<p>unclosed <a href='x>y'>link"), (7, "http://h/4", "<!-- never closed <p>x")]
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Title & more\nFirst paragraph with enough words to be the main text.\nSecond one."
    assert got[1] == got[5] == want
    assert got[2] == got[3] == got[7] == ""
    assert got[4] == "just text"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
