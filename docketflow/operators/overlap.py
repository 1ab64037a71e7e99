"""Joins of texts with lists of strings that are too long for every task (D17, D19): winnowed fingerprints, and best overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.session import forget, written

#: Classes of strings by their bytes: grams of `g` bytes, of which the least hash of each `g` + 1 neighbours is kept. A
#: string of 2g bytes or more has a whole such window, and so has every text around it.
GRAMS = (16, 8, 4)
SHORTEST = 2 * GRAMS[-1]
BITS = 27  # of the table of hashes that strings have, which every task holds: 16 MB
PIECE = 1 << 20  # bytes of text hashed at a time


# --- winnowed fingerprints -------------------------------------------------------------------


def _grams(raw: np.ndarray, g: int) -> np.ndarray:
    """Hashes of all g-byte grams."""
    n = len(raw) - g + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(g):
            h = (h ^ raw[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def kept(data: bytes, g: int) -> np.ndarray:
    """The least hash of every g + 1 neighbouring grams, each once. Both a string's and a text's windows keep the same."""
    found = []
    for lo in range(0, max(len(data) - 2 * g + 1, 0), PIECE):
        h = _grams(np.frombuffer(data[lo : lo + PIECE + 2 * g - 1], np.uint8), g)
        if len(h) > g:
            found.append(np.unique(sliding_window_view(h, g + 1).min(axis=1)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def anchor(data: bytes) -> tuple[int, int] | None:
    """A string's class and the fingerprint of its first window; None for one too short to have any."""
    for g in GRAMS:
        if len(data) >= 2 * g:
            return g, int(kept(data[: 2 * g], g)[0])
    return None


def contained(docs: DataFrame, strings: DataFrame, text: str, string: str) -> DataFrame:
    """Docs joined with the strings of SHORTEST bytes or more that they contain, in one pass over the texts.

    A string is found through one fingerprint, which every text that contains it has too; texts send on only those of
    their fingerprints that some string has (by a bit table of fixed size, which lets a few others through). What meets
    is compared itself. `strings`: one column, distinct, none shorter."""
    names, at = docs.columns, docs.columns.index(text)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [anchor(s.encode()) for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_key(*x) for x in got], pa.int64())], [string, "_f"])

    known = written(strings.select(string).mapInArrow(anchors, f"`{string}` string, _f long"), "anchors")
    slots = known.select((F.col("_f").bitwiseAND((1 << BITS) - 1)).alias("s")).distinct()
    # words of 64 slots each; no more rows than the table has words
    words = slots.groupBy(F.shiftrightunsigned("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toPandas()
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value.view(np.uint64)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                rows, found = [], []
                for k, t in enumerate(part.column(at).to_pylist()):
                    data = t.encode() if t else b""
                    f = np.concatenate([_keys(g, kept(data, g)) for g in GRAMS])
                    slot = f.view(np.uint64) & np.uint64((1 << BITS) - 1)
                    f = f[(bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1]
                    rows += [k] * len(f)
                    found.append(f)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(rows, pa.int64())).columns, pa.array(np.concatenate(found) if found else [], pa.int64())], [*names, "_f"])

    met = docs.mapInArrow(prints, T.StructType([*docs.schema.fields, T.StructField("_f", T.LongType())])).join(known, "_f")
    return met.drop("_f").filter(F.contains(F.col(text), F.col(string)))


def _keys(g: int, h: np.ndarray) -> np.ndarray:
    """Fingerprints told apart by their class."""
    with np.errstate(over="ignore"):
        return ((h ^ np.uint64(g)) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _key(g: int, h: int) -> int:
    return int(_keys(g, np.array([h], np.uint64))[0])


# --- best overlap ------------------------------------------------------------------------------


def best_overlap(texts: DataFrame, anchors: DataFrame, least: int = 2) -> DataFrame:
    """For each text the anchor that shares most words with it, `least` at least, the smallest item among equals:
    id, item, score. texts: id, words; anchors: item, words (arrays without repeats).

    Anchors are indexed under their words, rarest in the texts first. A text that shares s words or more with an anchor of
    m such words has one of its m - s + 1 rarest, so a round for s looks only there; it settles every text whose best
    score is s or more, and only the others go on to the next round, with half of s. So frequent words, which come last
    in every anchor, join those texts alone that have found nothing better, and only down to `least`."""
    vocabulary = anchors.select(F.explode("words").alias("w")).distinct()
    kept_words = texts.select("id", F.explode("words").alias("w")).join(vocabulary, "w", "left_semi")
    rows = written(kept_words, "overlap-words")
    counts = rows.groupBy("w").agg(F.count("*").alias("df"))
    order = W.partitionBy("item").orderBy("df", "w")
    index = anchors.select("item", F.explode("words").alias("w")).join(counts, "w").withColumns({"r": F.row_number().over(order), "m": F.count("*").over(W.partitionBy("item"))})
    index = written(index.filter(F.col("m") >= least), "overlap-index")
    most = index.agg(F.max("m")).first()[0]
    if most is None:
        return rows.select("id").join(anchors.select("item"), F.lit(False)).withColumn("score", F.lit(0))
    sets = index.groupBy("item").agg(F.collect_list("w").alias("those"))
    left, found, s = written(rows.groupBy("id").agg(F.collect_list("w").alias("these")), "overlap-left"), None, most
    while True:
        probes = index.filter((F.col("m") >= s) & (F.col("r") <= F.col("m") - s + 1)).select("item", "w")
        pairs = left.select("id", F.explode("these").alias("w")).join(probes, "w").select("id", "item").distinct()
        scored = pairs.join(left, "id").join(sets, "item").select("id", "item", F.size(F.array_intersect("these", "those")).alias("score")).filter(F.col("score") >= s)
        best = written(scored.groupBy("id").agg(F.max(F.struct("score", (-F.col("item")).alias("item"))).alias("x")).select("id", (-F.col("x.item")).alias("item"), "x.score"), "overlap-best")
        found = best if found is None else found.union(best)
        done = left
        if s <= least:
            forget(rows.sparkSession, *(t.written_at for t in (rows, index, done)))
            return found
        s = max(least, s // 2)
        left = written(left.join(best, "id", "left_anti"), "overlap-left")
        forget(rows.sparkSession, done.written_at)
