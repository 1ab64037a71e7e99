"""Operator 5, quality classifier: a linear-chain conditional random field over lines.

Every line is good or bad; its features are its own and its neighbours' shape (letter case, symbols,
separators, digits, word lengths, repeated words, length). Labels are known for documents only, so
training alternates: lines of good documents are good; lines of bad documents are what the field's
marginals say, the worst line at least bad. Forward-backward marginals of every line, weighted by
its length, aggregate into a document's badness, and a logistic curve fitted on learning rows turns
that and the worst stretch into the score.

Fitting uses at most `sample` labelled rows (a documented bound, by hash of the id) of any length; of a
text with more than `train_lines` lines it takes that many, in stretches spread evenly over the whole
text, whose lengths then stand for the whole. Scoring covers every whole text without a shuffle.

A row without an id is scored and not learnt from, and its held_out is null.
Null and empty texts have one empty line and get a score from it. Repeated rows score alike. Without
two classes of labels the score is the share of good labels (0.5 without labels). An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import beyond, buffers, codepoints, fold, sub_batches, word_hashes
from docketflow.llm.toxicity import learning_rows, linear

SAMPLE = 6000
TRAIN_LINES = 120
STRETCH = 20
_KIND: list[np.ndarray] = []
LOWER, UPPER, DIGIT, SPACE, STOP, BAR, SYMBOL = range(7)
OWN = 12


def kinds(points: np.ndarray) -> np.ndarray:
    """The kind of each code point."""
    if not _KIND:
        t = np.full(0x10000, SYMBOL, np.uint8)
        for i in range(len(t)):
            c = chr(i)
            if c.isalpha():
                t[i] = UPPER if c.isupper() else LOWER
            elif c.isdigit():
                t[i] = DIGIT
            elif c.isspace():
                t[i] = SPACE
            elif c in ".,;:'\"-()?":
                t[i] = STOP
            elif c in "|\t":
                t[i] = BAR
        _KIND.append(t)
    return beyond(points, _KIND[0], lambda c: (UPPER if c.isupper() else LOWER) if c.isalpha() else DIGIT if c.isdigit() else SPACE if c.isspace() else SYMBOL)


def lines(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features by line, the row of each line, and its length in characters (1 at least)."""
    n = len(off) - 1
    joined = np.full(len(raw) + n, 10, np.uint8)  # a line end after each value
    place = np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(off))
    joined[place] = raw
    ends = np.flatnonzero(joined == 10)
    boff = np.concatenate([[0], ends + 1])
    row = np.searchsorted(off[1:] + np.arange(n), ends)
    points, coff = codepoints(joined, boff)
    k = kinds(points)
    length = np.diff(coff) - 1
    one = np.maximum(length, 1).astype(float)
    share = np.zeros((len(ends), 7))
    for c in range(7):
        s = np.concatenate([[0], np.cumsum(k == c)])
        share[:, c] = s[coff[1:] - 1] - s[coff[:-1]]
    letters = np.maximum(share[:, LOWER] + share[:, UPPER], 1)
    h, woff, _, _ = word_hashes(joined, boff)
    words = np.diff(woff)
    owner = np.repeat(np.arange(len(words)), words)
    order = np.lexsort((h, owner))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.bincount(owner[order][same], minlength=len(words))
    many = np.maximum(words, 1)
    x = np.column_stack([
        share[:, UPPER] / letters, share[:, DIGIT] / one, share[:, SPACE] / one, share[:, STOP] / one, share[:, BAR] / many, share[:, SYMBOL] / many,
        np.minimum(letters / many, 20) / 10, again / many, np.log1p(length) / 8, np.log1p(words) / 6, words <= 1, share[:, SYMBOL] / one,
    ])
    return x, row, one


def neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Own features with those of the line before and after (zeros at the ends), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x) > 1:
        same = row[1:] == row[:-1]
        before[1:][same] = x[:-1][same]
        after[:-1][same] = x[1:][same]
    return np.column_stack([np.ones(len(x)), x, before, after])


def marginals(emission: np.ndarray, trans: np.ndarray, row: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of each line under a two-state chain, all documents at once; with `pairs`, the expected transition counts.

    emission: log potential of bad against good. Documents of the same length of chain advance together, longest first.
    """
    n = len(row)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[first, n])
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    psi = np.exp(trans)  # [from, to]; states good 0, bad 1
    e = np.ones((n, 2))
    e[:, 1] = np.exp(np.clip(emission, -30, 30))
    e /= e.sum(1, keepdims=True)
    alpha, beta = np.empty((n, 2)), np.ones((n, 2))
    live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right") if len(size) else np.zeros(0, int)  # documents with more than t lines
    a = e[first]
    alpha[first] = a = a / a.sum(1, keepdims=True)
    for t in range(1, len(live)):
        m = live[t]
        at = first[:m] + t
        p = alpha[at - 1]
        a = np.column_stack([p[:, 0] * psi[0, 0] + p[:, 1] * psi[1, 0], p[:, 0] * psi[0, 1] + p[:, 1] * psi[1, 1]]) * e[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    for t in range(len(live) - 1, 0, -1):
        at = first[: live[t]] + t
        q = beta[at] * e[at]
        b = np.column_stack([psi[0, 0] * q[:, 0] + psi[0, 1] * q[:, 1], psi[1, 0] * q[:, 0] + psi[1, 1] * q[:, 1]])
        beta[at - 1] = b / b.sum(1, keepdims=True)
    g = alpha * beta
    p = g[:, 1] / g.sum(1)
    counts = np.zeros((2, 2))
    if pairs and n > 1:
        k = np.flatnonzero(row[1:] == row[:-1])
        q = beta[k + 1] * e[k + 1]
        joint = alpha[k][:, :, None] * psi[None] * q[:, None, :]
        counts = (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return p, counts


def train(x: np.ndarray, row: np.ndarray, y: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Conditional likelihood of line labels y by Adam: emission weights and transitions."""
    theta = np.zeros(x.shape[1] + 4)
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    k = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[k], y[k + 1]), 1)
    total = max(len(y), 1)
    for t in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, counts = marginals((x * w).sum(1), trans, row, pairs=True)
        g = np.concatenate([(x * (p - y)[:, None]).sum(0), (counts - seen).ravel()]) / total + 1e-4 * theta
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def summary(p: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """By document: constant, length-weighted badness, its square root, the log of the bad length, and the worst line."""
    total = np.bincount(row, weight, n)
    bad = np.bincount(row, weight * p, n) / np.maximum(total, 1)
    worst = np.zeros(n)
    np.maximum.at(worst, row, p)
    return np.column_stack([np.ones(n), bad, np.sqrt(bad), np.log1p(bad * total) / 5, worst])


def stretches(row: np.ndarray, weight: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines to fit on, and their weights: all of a text of up to `most` lines, else stretches spread evenly whose weights add up to the text's."""
    keep = []
    for lo, hi in zip(*(np.flatnonzero(x) for x in (np.r_[True, row[1:] != row[:-1]], np.r_[row[1:] != row[:-1], True])), strict=True):
        n = hi + 1 - lo
        if n <= most:
            keep.append(np.arange(lo, hi + 1))
        else:
            starts = np.linspace(0, n - STRETCH, max(1, most // STRETCH)).astype(int)
            keep.append(lo + np.unique((starts[:, None] + np.arange(STRETCH)).ravel()))
    some = np.concatenate(keep) if keep else np.zeros(0, int)
    n = int(row.max()) + 1 if len(row) else 0
    whole, taken = np.bincount(row, weight, n), np.bincount(row[some], weight[some], n)
    return some, weight[some] * (whole / np.maximum(taken, 1e-9))[row[some]]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 3, held: int = 1, sample: int = SAMPLE, train_lines: int = TRAIN_LINES, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Field and curve, a few dozen numbers. `label` 1 is good."""
    rows = learning_rows(docs, labels, label, parts, held, sample, id_col, text_col)

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Line features in the tasks: the driver gets numbers, never texts."""
        for big in batches:
            for b in sub_batches(big, "text", 2 << 20):
                xs, row, weight = lines(*buffers(b.column(0)))
                some, weight = stretches(row, weight, train_lines)
                xs, row = xs[some], row[some]
                cuts = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(1), pa.ListArray.from_arrays(pa.array(cuts * OWN), pa.array(xs.ravel().astype(np.float32))), pa.ListArray.from_arrays(pa.array(cuts), pa.array(weight.astype(np.float32)))], ["y", "x", "w"])

    got = rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(shapes, "y int, x array<float>, w array<float>").toArrow()  # at most `sample` rows
    good = got["y"].to_numpy()
    if not len(good) or good.min() == good.max():
        return {"w": None, "share": float(good.mean()) if len(good) else 0.5}
    xs = got["x"].combine_chunks().flatten().to_numpy().astype(float).reshape(-1, OWN)
    row = np.repeat(np.arange(len(good)), got["w"].combine_chunks().value_lengths().to_numpy())
    weight = got["w"].combine_chunks().flatten().to_numpy().astype(float)
    mean, sd = xs.mean(0), xs.std(0) + 1e-6
    x = neighbours((xs - mean) / sd, row)
    y = 1 - good[row]
    for _ in range(3):
        w, trans = train(x, row, y)
        p, _ = marginals((x * w).sum(1), trans, row)
        worst = np.zeros(len(good))
        np.maximum.at(worst, row, p)
        y = ((good[row] == 0) & ((p > 0.5) | (p >= worst[row]))).astype(int)
    p, _ = marginals((x * w).sum(1), trans, row)
    curve = linear(summary(p, row, weight, len(good)), good.astype(float), steps=1500)
    return {"w": w, "trans": trans, "mean": mean, "sd": sd, "curve": curve, "share": float(good.mean())}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (1: good) and bad_share, the length-weighted share of bad lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, 2 << 20):
                if model["w"] is None:
                    s, bad = np.full(b.num_rows, model["share"]), np.zeros(b.num_rows)
                else:
                    xs, row, weight = lines(*buffers(b.column(1)))
                    x = neighbours((xs - model["mean"]) / model["sd"], row)
                    p, _ = marginals((x * model["w"]).sum(1), model["trans"], row)
                    z = summary(p, row, weight, b.num_rows)
                    s, bad = 1 / (1 + np.exp(-np.clip((z * model["curve"]).sum(1), -30, 30))), z[:, 1]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(bad)], ["doc_id", "score", "bad_share"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(run, f"doc_id {kind}, score double, bad_share double")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "bad_share")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op5_quality": op5_quality}
