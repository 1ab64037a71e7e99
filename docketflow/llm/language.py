"""Operator 7, language ID: multilingual mixture inference.

Each learned language has a distribution over letter trigrams (hashed to a fixed table), counted
over all learning rows. A document is a mixture: expectation-maximisation over its words finds the
share of each language, and languages are taken out, smallest share first, while the likelihood
penalised by half a log of the word count for each language rises. The prediction is the largest
share of what stays; the score is that share.

A row without an id is predicted and not learnt from, and its held_out is null.
Null texts and texts without a letter are `und` with score 0. Without learning rows every text is
`und`. Ties go to the language that sorts first. Texts are read whole. Repeated rows are equal. An
empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from docketflow.llm.common import beyond, buffers, codepoints, fold, sub_batches, tidy

BUCKETS = 1 << 15
ROUNDS = 6
_TABLE: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    """Lower-cased code points, 32 for anything but a letter."""
    if not _TABLE:
        t = np.full(0x30000, 32, np.uint32)
        for i in range(len(t)):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                t[i] = ord(low) if len(low) == 1 else i
        _TABLE.append(t)
    return beyond(points, _TABLE[0], lambda c: ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32)


def trigrams(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each letter, the letter's value (row), and where words begin among the letters."""
    points, coff = codepoints(raw, off)
    n = len(coff) - 1
    c = np.full(len(points) + n + 1, 32, np.uint32)  # a space before each value and at the end
    c[np.arange(len(points)) + 1 + np.repeat(np.arange(n), np.diff(coff))] = letters(points)
    at = np.flatnonzero(c != 32)
    if not len(at):
        return np.zeros(0, np.int64), at, at
    with np.errstate(over="ignore"):
        h = (c[at - 1] * np.uint32(0x85EBCA6B)) ^ (c[at] * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)) ^ (c[at + 1] * np.uint32(0x9E3779B1)) * np.uint32(5)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    bucket = (h >> np.uint32(17)).astype(np.int64)
    row = np.searchsorted(coff[1:] + np.arange(n) + 1, at, side="right")
    return bucket, row, np.flatnonzero(c[at - 1] == 32)


def fit(docs: DataFrame, parts: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Log-probabilities by language and bucket: counts of all learning rows, summed in tasks before they are shuffled."""
    rows = docs.filter(F.col(lang_col).isNotNull() & ((fold(id_col, parts) != held) | F.col(id_col).isNull())).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for big in batches:
            for b in sub_batches(big, "text", 1 << 20):
                langs = b.column(1).to_pylist()
                names = sorted(set(langs))
                which = np.array([names.index(x) for x in langs])
                bucket, row, _ = trigrams(*buffers(b.column(0)))
                got = np.bincount(which[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for k, x in enumerate(names):
                    sums[x] = sums[x] + got[k] if x in sums else got[k]
        for x, s in sums.items():
            k = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(k), pa.string()), pa.array(k.astype(np.int32)), pa.array(s[k].astype(np.int64))], ["lang", "bucket", "n"])

    got = rows.mapInArrow(tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages x buckets numbers at most
    lang = got["lang"].combine_chunks().dictionary_encode()
    lang = lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang
    names = sorted(lang.dictionary.to_pylist())
    table = np.full((len(names), BUCKETS), 0.5)
    if names:
        order = np.argsort(np.argsort(np.array(lang.dictionary.to_pylist(), object)))
        table[order[lang.indices.to_numpy()], got["bucket"].to_numpy()] += got["n"].to_numpy()
    return {"names": names, "logp": np.ascontiguousarray(np.log(table / table.sum(1, keepdims=True)).T).astype(np.float32)}


def infer(raw: np.ndarray, off: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Index of the predicted language (-1: none) and its share, by value."""
    n, k = len(off) - 1, len(model["names"])
    best, share = np.full(n, -1), np.zeros(n)
    bucket, row, words = trigrams(raw, off)
    if not len(words) or not k:
        return best, share
    ll = np.add.reduceat(model["logp"][bucket].astype(float), words, axis=0)  # by word
    owner = row[words]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    docs, count = owner[first], np.diff(np.r_[first, len(owner)]).astype(float)
    local = np.repeat(np.arange(len(docs)), count.astype(int))
    top = ll.max(1)
    like = np.exp(np.maximum(ll - top[:, None], -60))
    base = np.add.reduceat(top, first)

    def em(allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pi = allowed / allowed.sum(1, keepdims=True)
        for _ in range(ROUNDS):
            w = like * pi[local]
            w /= np.maximum(w.sum(1, keepdims=True), 1e-300)
            pi = np.add.reduceat(w, first, axis=0) / count[:, None]
        total = np.add.reduceat(np.log(np.maximum((like * pi[local]).sum(1), 1e-300)), first) + base
        return pi, total - 0.5 * np.log(count + 1) * allowed.sum(1)

    allowed = np.ones((len(docs), k))
    pi, fitness = em(allowed)
    for _ in range(k - 1):
        weakest = np.argmin(np.where(allowed > 0, pi, np.inf), axis=1)
        fewer = allowed.copy()
        fewer[np.arange(len(docs)), weakest] = 0
        fewer[fewer.sum(1) == 0] = allowed[fewer.sum(1) == 0]
        pi2, fitness2 = em(fewer)
        better = fitness2 > fitness
        if not better.any():
            break
        allowed[better], pi[better], fitness[better] = fewer[better], pi2[better], fitness2[better]
    best[docs] = np.argmax(pi, axis=1)
    share[docs] = pi.max(axis=1)
    return best, np.clip(share, 0, 1)


def predict(docs: DataFrame, model: dict, text_col: str = "text", pred: str = "lang_pred", share_col: str = "score") -> DataFrame:
    """docs with the predicted language and its share added; columns of those names are replaced."""
    docs = docs.drop(pred, share_col)
    names, at = docs.columns, docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers: once an executor, not in every task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        langs = np.array([*model["names"], "und"], object)
        for big in batches:
            for b in sub_batches(big, text_col, 1 << 19):
                best, share = infer(*buffers(b.column(at)), model)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs[best].tolist(), pa.string()), pa.array(share)], names=[*names, pred, share_col])

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(pred, StringType()), StructField(share_col, DoubleType())]))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op7_language": op7_language}
