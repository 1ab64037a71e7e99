"""Operator 11, periodic run detection: repeated k-gram masking, then Main-Lorentz on what survives.

A run is a stretch of words with smallest period q (words q apart are identical) of at least
max(`least`, `times` * q) words that no neighbouring word extends. Its first and last (length - q)
words are the same sequence, so every word of a run lies in a k-gram that its document holds twice,
where k is the least overlap length - q any run can have. Words outside such k-grams are masked;
no run reaches across a masked word, and most documents have nothing left.

In each surviving segment runs are found by halving, all halves of a level at once: a run that
crosses the middle of a half has two periods on one side of it, so a comparison of two adjacent
blocks of q words names the candidates for each q, whose ends are then found by doubling and
bisection on hashes of word sequences. Ends are checked against the words themselves; where a hash
misled, the ends are walked word by word. Words of a segment are compared as bytes, never by hash.
Cost: n log n comparisons of numbers for the n words that survive.

One pass over whole texts without a shuffle; a text is one row's work. Null and empty texts have no
words and no runs. Repeated rows have the same runs. An empty table gives an empty result. Other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketflow.llm.common import SEED, WORD, mix64, sub_batches

LEAST = 6
TIMES = 4
SHAPE = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def overlap(least: int = LEAST, times: int = TIMES) -> int:
    """The least length - q of any run: periods up to least / times have `least` words, longer ones times * q."""
    if times < 4:
        raise ValueError("runs of fewer than four periods may have less than two periods on each side of a middle")
    return min(max(least, times * q) - q for q in range(1, least + 1))


def surviving(words: list[bytes], k: int) -> list[tuple[int, int]]:
    """Stretches of words that lie in k-grams occurring twice among them (by hash: too many may survive, never too few)."""
    n = len(words)
    if n <= k:
        return []
    h = mix64(np.fromiter(map(hash, words), np.int64, n).view(np.uint64) + np.uint64(SEED))
    gram = np.zeros(n - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            gram = gram * np.uint64(0x9FB21C651E98DF25) + h[i : n - k + 1 + i]
    order = np.argsort(gram)
    same = gram[order[1:]] == gram[order[:-1]]
    twice = np.zeros(n - k + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return []
    at = np.flatnonzero(twice)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + k, -1)
    inside = np.concatenate([[0], (np.cumsum(cover)[:n] > 0).astype(np.int8), [0]])
    edge = np.diff(inside)
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


class Sequence:
    """Word numbers with hashes of all their stretches."""

    def __init__(self, ids: np.ndarray):
        self.ids, n = ids, len(ids)
        base = np.uint64(0xD6E8FEB86659FD93)
        with np.errstate(over="ignore"):
            self.power = np.ones(n + 1, np.uint64)
            self.power[1:] = base
            np.multiply.accumulate(self.power, out=self.power)
            self.total = np.zeros(n + 1, np.uint64)
            np.cumsum(mix64(ids.astype(np.uint64) + np.uint64(SEED)) * self.power[:n], out=self.total[1:])

    def alike(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of `size` words at a and at b (a <= b) have the same hash."""
        t = self.total
        with np.errstate(over="ignore"):
            return (t[a + size] - t[a]) * self.power[b - a] == t[b + size] - t[b]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on (a < b)."""
        lo, hi = np.zeros(len(a), np.int64), len(self.ids) - b
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            yes = self.alike(a, b, mid)
            lo, hi = np.where(yes, mid, lo), np.where(yes, hi, mid - 1)
        return lo

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b (a < b)."""
        lo, hi = np.zeros(len(a), np.int64), a.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            yes = self.alike(a - mid, b - mid, mid)
            lo, hi = np.where(yes, mid, lo), np.where(yes, hi, mid - 1)
        return lo

    def settled(self, s: int, e: int, q: int) -> tuple[int, int]:
        """The stretch of period q around the words [s, e), by the words themselves."""
        ids, n = self.ids, len(self.ids)
        whole = np.array_equal(ids[s : e - q], ids[s + q : e])
        if whole and (s == 0 or ids[s - 1] != ids[s - 1 + q]) and (e == n or ids[e] != ids[e - q]):
            return s, e
        wrong = np.flatnonzero(ids[s : e - q] != ids[s + q : e])
        e = s + q + (int(wrong[0]) if len(wrong) else e - q - s)
        while s > 0 and ids[s - 1] == ids[s - 1 + q]:
            s -= 1
        while e < n and ids[e] == ids[e - q]:
            e += 1
        return s, e


def main_lorentz(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start and period."""
    n = len(ids)
    seq = Sequence(ids)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = 2
    while width < 2 * n:  # halves of a level are `width` words; a run inside one has at most width words
        middles = np.arange(width // 2, n, width)
        # a stretch of at least 2q words lies on one side of the middle, and the whole run in the half
        periods = np.arange(1, max(width // times, 1) + 1)
        step = max(1, (1 << 20) // len(periods))
        for lo in range(0, len(middles), step):
            mid, q = middles[lo : lo + step], periods
            m, q = np.repeat(mid, len(q)), np.tile(q, len(mid))
            for at in (m, m - 2 * q):
                fits = (at >= 0) & (at + 2 * q <= n)
                a, p = at[fits], q[fits]
                hit = seq.alike(a, a + p, p)
                if hit.any():
                    a, p = a[hit], p[hit]
                    s = a - seq.behind(a, a + p)
                    e = a + p + seq.ahead(a, a + p)
                    long = e - s >= np.maximum(least, times * p)
                    found.append((s[long], e[long], p[long]))
        width *= 2
    if not found:
        return []
    s, e, q = (np.concatenate(x) for x in zip(*found, strict=True))
    best: dict[tuple[int, int], int] = {}
    # The same stretch with a longer period is a multiple of its smallest one.
    for a, b, p in np.unique(np.stack([s, e, q], 1), axis=0).tolist():
        a, b = seq.settled(a, b, p)
        if b - a >= max(least, times * p):
            best[a, b] = min(p, best.get((a, b), p))
    return sorted((a, b - a, p) for (a, b), p in best.items())


def runs_of(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start and period."""
    out = []
    for lo, hi in surviving(words, overlap(least, times)):
        if hi - lo >= least:
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(w, len(number)) for w in words[lo:hi]), np.int64, hi - lo)
            out += [(s + lo, length, q) for s, length, q in main_lorentz(ids, least, times)]
    return out


def detect(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES, runs: str = "runs", n_words: str = "n_words", collapsed: str = "collapsed") -> DataFrame:
    """docs with its runs (array of start, length, period by start and period), number of words, and the
    collapsed text: words joined by one space, without those that a run repeats (null for a null text)."""
    names, at = docs.columns, docs.columns.index(text_col)
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col):
                all_runs, counts, texts = [], [], []
                for text in b.column(at).to_pylist():
                    words = (text or "").encode().split()  # bytes split at 0x20 and 0x09-0x0D
                    found = runs_of(words, least, times)
                    keep = np.ones(len(words), bool)
                    for s, length, q in found:
                        keep[s + q : s + length] = False
                    all_runs.append([{"start": s, "length": length, "period": q} for s, length, q in found])
                    counts.append(len(words))
                    texts.append(None if text is None else b" ".join(words if not found else [words[i] for i in np.flatnonzero(keep).tolist()]).decode())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(all_runs, shape), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], [*names, runs, n_words, collapsed])

    made = [T.StructField(runs, T.ArrayType(SHAPE)), T.StructField(n_words, T.LongType()), T.StructField(collapsed, T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *made]))


def with_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; where the crc32 h of doc_id is a multiple of 10, words from number a = g % n on repeat with
    period 1 + (n - a) / (3 + g % 8), g = h / 10 and n the number of words. Other texts, and those without an id, stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    g, n = F.floor(h / 10), F.size(words)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    mine = (h % 10 == 0) & (F.regexp_count("text", F.lit(WORD)) > 0)
    plain = docs.select("doc_id", "text", F.when(mine, words).alias("words"), F.when(mine, a).alias("a"), F.when(mine, p).alias("p"))
    tail = F.transform("words", lambda w, i: F.get(F.col("words"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return plain.select("doc_id", F.when(F.col("words").isNotNull(), F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, the strongest of each, and digests of all runs and of the collapsed text.

    A document without a run has null start, length, period and exponent_milli."""
    found = detect(with_tails(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    # l1 / p1 > l2 / p2 without division; ties keep the earlier one, as runs come by start and period
    strongest = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), strongest.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))
    milli = F.expr("(1000 * best.length) div best.period")
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op11_runs": op11_runs}
